"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "8", memory: str = "20g") -> SparkSession:
    """Session for tests and for the bench, with a scratch folder of its own; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder the cluster shares (``spark.checkpoint.dir``); where it is unset in local mode, one in the warehouse."""
    context = spark.sparkContext
    root = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage before iterative work; unlike executor-held blocks it outlives lost executors,
    and unlike an RDD checkpoint it stays columnar, so later passes read only what they use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
