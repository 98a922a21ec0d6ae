"""Scratch tables, Arrow helpers and connected components shared by the operators."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


class Scratch:
    """Intermediate tables of one operator call, in the folder the cluster shares.

    A table cuts lineage: later steps and retries read it instead of computing it again, also after
    executors were lost. ``drop`` removes tables that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def keep(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.name)
        # texts may be long: small batches bound what a task holds on both sides of the pipe to Python
        before = self.spark.conf.get(BATCH_SETTING)
        self.spark.conf.set(BATCH_SETTING, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(BATCH_SETTING, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def folder(self) -> str:
        return scratch_path(self.spark, self.name)

    def drop(self, *frames: DataFrame | None) -> None:
        for df in frames:
            if df is not None and id(df) in self.paths:
                _, path = self.paths.pop(id(df))
                target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def by_hash(df: DataFrame, key: Column, rows: int, total: int) -> DataFrame:
    """About ``rows`` of ``total`` rows, never more, chosen by a hash of ``key``; all if there are no more."""
    if total <= rows:
        return df
    share = 1 << 20
    return df.where(F.pmod(F.xxhash64(key), F.lit(share)) < int(share * 0.95 * rows / total)).limit(rows)


def worker_state(name: str, tag, make: Callable):
    """Something built once per worker process for what was sent; it stays until another operator's turn."""
    home = sys.modules.setdefault("tidemark_worker_state", ModuleType("tidemark_worker_state"))
    held = getattr(home, "held", None)
    if held is None or held[:2] != (name, tag):
        home.held = held = None  # the old one goes before the new one is made
        home.held = held = (name, tag, make())
    return held[2]


def forget_worker_state(keep: str | None) -> None:
    """Workers serve many jobs: what an earlier operator left does not stay in memory."""
    home = sys.modules.get("tidemark_worker_state")
    held = getattr(home, "held", None)
    if held is not None and held[0] != keep:
        home.held = held = None
        gc.collect()
        trim()


def trim() -> None:
    """Hand freed memory back to the system, where the libraries can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def batch_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema, state: str | None = None) -> DataFrame:
    """``mapInArrow`` as every operator uses it: workers drop what others left before, and freed memory after.

    ``state`` names the worker state that ``run`` uses.
    """
    def clean(batches):
        forget_worker_state(state)
        yield from run(batches)
        trim()

    return df.mapInArrow(clean, schema)


def arrow_map(df: DataFrame, schema: str, rows: Callable[[Iterator[dict]], Iterable[tuple]] | None = None, size: int = 2000, state: str | None = None) -> DataFrame:
    """``mapInArrow`` from an iterator of row dicts to tuples in the order of ``schema``, in batches of at most ``size``.

    ``state`` names the worker state that ``rows`` uses.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema
    names = fields.names
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def run(batches):
        def source():
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    yield from batch.slice(start, 256).to_pylist()

        held = []
        for row in rows(source()):
            held.append(row)
            if len(held) >= size:
                yield _batch(held, names, arrow)
                held = []
        if held:
            yield _batch(held, names, arrow)

    return batch_map(df, run, fields, state)


def _batch(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=schema.field(n).type) for n, c in zip(names, zip(*rows))], schema=schema)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` for every node of ``edges`` (a, b) that is not the smallest of its component.

    Each round every node hooks on its smallest smaller neighbour, trees are flattened by pointer
    jumping, and edges are rewritten between roots; the smallest node never hooks, so it is the root in
    the end. All steps are joins and minima; hubs are combined before the shuffle. Nulls have no edges.
    """
    spark = scratch.spark
    left = scratch.keep(
        edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), (F.col("a") != F.col("b")).alias("ok")).where("ok").select("lo", "hi").distinct()
    )
    kind = left.schema["lo"].dataType.simpleString()
    done = None
    while not left.isEmpty():
        hook = scratch.keep(left.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("parent")))
        while True:
            up = hook.select(F.col("node").alias("parent"), F.col("parent").alias("upper"))
            jumped = scratch.keep(hook.join(up, "parent", "left").select("node", F.coalesce("upper", "parent").alias("parent"), F.col("upper").isNotNull().alias("moved")))
            moved = not jumped.where("moved").isEmpty()
            scratch.drop(hook)
            hook = jumped.select("node", "parent")
            scratch.paths[id(hook)] = (hook, scratch.paths.pop(id(jumped))[1])
            if not moved:
                break
        lo, hi = (hook.select(F.col("node").alias(c), F.col("parent").alias(f"{c}_root")) for c in ("lo", "hi"))
        rest = left.join(lo, "lo", "left").join(hi, "hi", "left")
        rest = rest.select(F.coalesce("lo_root", "lo").alias("x"), F.coalesce("hi_root", "hi").alias("y")).where("x <> y")
        rest = scratch.keep(rest.select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).distinct())
        if done is None:
            new = hook
        else:
            up = hook.select(F.col("node").alias("parent"), F.col("parent").alias("upper"))
            new = scratch.keep(done.join(up, "parent", "left").select("node", F.coalesce("upper", "parent").alias("parent")).unionByName(hook))
            scratch.drop(done, hook)
        scratch.drop(left)
        left, done = rest, new
    scratch.drop(left)
    if done is None:
        return spark.createDataFrame([], f"node {kind}, component {kind}")
    return done.select("node", F.col("parent").alias("component"))
