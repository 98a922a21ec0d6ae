"""Near duplicates of embeddings: an epsilon grid order join inside each label.

Unit vectors are projected on their leading principal directions and sorted by the cells of a grid whose
width is the largest distance that a pair at the cosine threshold can have. The sorted sequence is cut
into blocks, blocks into longer intervals. Intervals are joined first, then the blocks of near intervals,
then, inside a task, halves of the two blocks down to small pieces; at each level two parts whose boxes are
further apart than the grid width are skipped, as a projection never lengthens a distance. Pieces that
remain are compared by matrix products in double precision.

The basis only decides how much is skipped, so it is fitted on a bounded sample. Equal vectors are one
class with a count. A task returns link counts per class and a spanning forest of the links it found, so a
dense group does not emit its pairs.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, by_hash, components

#: Vectors the basis is fitted on (chosen by their hashes), and the bytes they may have together.
SAMPLE_ROWS, SAMPLE_BYTES = 20_000, 32 << 20
DIMENSIONS = 6
BLOCK_BYTES = 1 << 20
BLOCKS_IN_INTERVAL = 32
PIECE = 256


def unit(raw: bytes) -> np.ndarray:
    x = np.frombuffer(raw, np.float64)
    return x / math.sqrt(float(x @ x))


def _parse(vectors: DataFrame) -> DataFrame:
    """id, label, dim, fp, vec (doubles as bytes) per row; dim, fp and vec are null if the vector links with nothing."""
    import xxhash

    def rows(source):
        for r in source:
            v = r["vec"]
            raw = None
            if v is not None and r["id"] is not None and r["label"] is not None and len(v) and None not in v:
                x = np.array(v, np.float64) + 0.0
                with np.errstate(over="ignore"):
                    length = float(x @ x)
                if np.isfinite(x).all() and x.any():
                    if not 1e-200 < length < 1e200:  # keep squares in range; the cosine does not change
                        x = x / np.abs(x).max()
                    raw = x.tobytes()
            yield r["id"], r["label"], len(v) if raw else None, xxhash.xxh3_128_digest(raw) if raw else None, raw

    return arrow_map(vectors, "id long, label string, dim int, fp binary, vec binary", rows, size=1000)


def _bases(classes: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal directions for each vector length that occurs in the sample."""
    seen = classes.agg(F.max("dim").alias("widest"), F.count("*").alias("n")).first()
    sample = by_hash(classes.select("vec", "dim"), F.col("vec"), max(100, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * (seen["widest"] or 1)))), seen["n"])
    by: dict[int, list[np.ndarray]] = {}
    for r in sample.collect():
        by.setdefault(r["dim"], []).append(unit(bytes(r["vec"])))
    out = {}
    for dim, rows in by.items():
        x = np.array(rows)
        x -= x.mean(0)
        out[dim] = np.linalg.svd(x.T @ x)[0][:, :DIMENSIONS]
    return out


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = 0.98) -> DataFrame:
    """One row per input row: ``id_col``, n_links (other rows linked directly), component_id, kept.

    Rows are compared only if their labels are equal and not null and their vectors have the same length.
    A vector that is null, empty, zero or has a null or non-finite component is linked with nothing, as is
    a row without id. Rows that repeat an id are vectors of their own that share it. Other columns are not
    read; an empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession, "embeddings")
    kind = vectors.schema[id_col].dataType.simpleString()
    source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).alias("vec"))
    rows = scratch.keep(_parse(source))
    classes = rows.where("vec is not null").groupBy("label", "dim", "fp").agg(F.min("id").alias("c"), F.count("*").alias("m"), F.first("vec").alias("vec"))
    classes = scratch.keep(classes.withColumn("k", F.monotonically_increasing_id()))
    context = vectors.sparkSession.sparkContext
    eps = math.sqrt(2 - 2 * threshold) + 1e-9
    sent = context.broadcast(_bases(classes))

    def cells(source_):
        for r in source_:
            u = unit(r["vec"])
            basis = sent.value.get(r["dim"])
            p = u @ basis if basis is not None else u[:DIMENSIONS]
            p = np.concatenate([p, np.zeros(max(0, DIMENSIONS - len(p)))])
            yield r["label"], r["dim"], np.floor(p / eps).astype(int).tolist(), r["k"], r["m"], p.astype(np.float64).tobytes(), u.tobytes()

    placed = arrow_map(classes.select("label", "dim", "k", "m", "vec"), "label string, dim int, cell array<int>, k long, m long, p binary, u binary", cells, size=1000)
    ordered = scratch.keep(placed).orderBy("label", "dim", "cell", "k")

    def cut(source_):
        """Blocks of the sorted sequence; consecutive ones form an interval, named by its first class."""
        held, interval, inside = [], None, 0

        def block():
            nonlocal interval, inside
            if interval is None or inside == BLOCKS_IN_INTERVAL:
                interval, inside = held[0]["k"], 0
            inside += 1
            p = np.array([np.frombuffer(r["p"], np.float64) for r in held])
            return (
                held[0]["k"], interval, held[0]["label"], held[0]["dim"], p.min(0).tolist(), p.max(0).tolist(),
                [r["k"] for r in held], [r["m"] for r in held], p.tobytes(), b"".join(r["u"] for r in held),
            )

        for r in source_:
            if held and ((r["label"], r["dim"]) != (held[0]["label"], held[0]["dim"]) or len(held) * 8 * r["dim"] >= BLOCK_BYTES):
                yield block()
                if (r["label"], r["dim"]) != (held[0]["label"], held[0]["dim"]):
                    interval = None
                held = []
            held.append(r)
        if held:
            yield block()

    schema = "b long, interval long, label string, dim int, lo array<double>, hi array<double>, ks array<long>, ms array<long>, p binary, u binary"
    blocks = scratch.keep(arrow_map(ordered, schema, cut, size=4))
    box = blocks.select("b", "interval", "label", "dim", "lo", "hi")
    edge = lambda f, side: F.array(*[f(F.element_at(side, d + 1)).alias(f"{side}{d}") for d in range(DIMENSIONS)])
    intervals = scratch.keep(box.groupBy("interval", "label", "dim").agg(edge(F.min, "lo").alias("lo"), edge(F.max, "hi").alias("hi")))
    cell = lambda c: F.floor(F.element_at(c, 1) / eps)
    x = intervals.select(*[F.col(c).alias(f"{c}_x") for c in ("interval", "lo", "hi")], "label", "dim", F.explode(F.sequence(cell("lo"), cell("hi"))).alias("cell"))
    y = intervals.select(*[F.col(c).alias(f"{c}_y") for c in ("interval", "lo", "hi")], "label", "dim", F.explode(F.sequence(cell("lo") - 1, cell("hi") + 1)).alias("cell"))
    near = x.join(y, ["label", "dim", "cell"]).where(_close(eps)).select("interval_x", "interval_y").distinct().where("interval_x <= interval_y")
    near = scratch.keep(near)
    bx = box.select(F.col("b").alias("x"), F.col("interval").alias("interval_x"), F.col("lo").alias("lo_x"), F.col("hi").alias("hi_x"))
    by = box.select(F.col("b").alias("y"), F.col("interval").alias("interval_y"), F.col("lo").alias("lo_y"), F.col("hi").alias("hi_y"))
    pairs = near.join(bx, "interval_x").join(by, "interval_y").where(_close(eps) & ((F.col("interval_x") != F.col("interval_y")) | (F.col("x") <= F.col("y"))))
    pairs = scratch.keep(pairs.select("x", "y"))
    body = blocks.select("b", "dim", "ks", "ms", "p", "u")
    side = lambda s: body.select(F.col("b").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("dim", "ks", "ms", "p", "u")])
    loaded = pairs.join(side("x"), "x").join(side("y"), "y")
    found = scratch.keep(arrow_map(loaded, "a long, b long, n long", lambda rows_: _compare(rows_, threshold, eps), size=20_000))
    scratch.drop(blocks, near, pairs, intervals)

    counts = found.where("b is null").groupBy(F.col("a").alias("k")).agg(F.sum("n").alias("links"))
    place = components(found.where("b is not null").select("a", "b"), scratch).select(F.col("node").alias("k"), "component")
    labelled = scratch.keep(classes.select("label", "dim", "fp", "k", "c", "m").join(place, "k", "left").withColumn("component", F.coalesce("component", "k")).join(counts, "k", "left"))
    least = scratch.keep(labelled.groupBy("component").agg(F.min("c").alias("component_id")))
    table = labelled.join(least, "component").select("label", "dim", "fp", "component_id", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    out = rows.select("id", "label", "dim", "fp").join(scratch.keep(table), ["label", "dim", "fp"], "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").cast(kind).alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def _close(eps: float):
    """Boxes no further apart than ``eps``."""
    gap = lambda d: F.greatest(F.lit(0.0), F.element_at("lo_x", d) - F.element_at("hi_y", d), F.element_at("lo_y", d) - F.element_at("hi_x", d))
    return sum((gap(d) * gap(d) for d in range(1, DIMENSIONS + 1)), F.lit(0.0)) <= eps * eps


def _compare(rows, threshold: float, eps: float):
    """(class, null, linked rows) and forest edges (class, class, null) of pairs of blocks."""
    for r in rows:
        dim, same = r["dim_x"], r["x"] == r["y"]
        left, right = (_load(r, s, dim) for s in "xy")
        links_x, links_y = np.zeros(len(left[0]), np.int64), np.zeros(len(right[0]), np.int64)
        edges: list[tuple[int, int]] = []
        todo = [(0, len(left[0]), 0, len(right[0]))]
        while todo:
            a, b, c, d = todo.pop()
            p, q = left[2][a:b], right[2][c:d]
            gap = np.maximum(0, np.maximum(p.min(0) - q.max(0), q.min(0) - p.max(0)))
            if gap @ gap > eps * eps:
                continue
            if b - a > PIECE or d - c > PIECE:
                if b - a >= d - c:
                    m = (a + b) // 2
                    todo += [(a, m, c, d), (m, b, c, d)]
                else:
                    m = (c + d) // 2
                    todo += [(a, b, c, m), (a, b, m, d)]
                continue
            linked = left[3][a:b] @ right[3][c:d].T >= threshold
            if same:  # each unordered pair is met in both orders; the count takes one side, the diagonal is no pair
                at = np.arange(max(a, c), min(b, d))
                linked[at - a, at - c] = False
                links_x[a:b] += linked @ right[1][c:d]
            else:
                links_x[a:b] += linked @ right[1][c:d]
                links_y[c:d] += left[1][a:b] @ linked
            if linked.any():
                edges += _forest(linked, left[0][a:b], right[0][c:d])
        for ks, links in ((left[0], links_x), (right[0], links_y)):
            for k in np.flatnonzero(links):
                yield int(ks[k]), None, int(links[k])
        for x, y in set(edges):
            yield x, y, None


def _load(r: dict, s: str, dim: int):
    ks, ms = np.array(r[f"ks_{s}"], np.int64), np.array(r[f"ms_{s}"], np.int64)
    return ks, ms, np.frombuffer(r[f"p_{s}"], np.float64).reshape(len(ks), -1), np.frombuffer(r[f"u_{s}"], np.float64).reshape(len(ks), dim)


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the links of a piece connect: at most as many as its rows and columns."""
    out, todo_rows, free = [], set(np.flatnonzero(linked.any(1)).tolist()), np.ones(len(right), bool)
    while todo_rows:
        queue = [todo_rows.pop()]
        while queue:
            i = queue.pop()
            for j in np.flatnonzero(linked[i] & free).tolist():
                free[j] = False
                out.append((int(left[i]), int(right[j])))
                for other in np.flatnonzero(linked[:, j]).tolist():
                    if other in todo_rows:
                        todo_rows.discard(other)
                        out.append((int(left[other]), int(right[j])))
                        queue.append(other)
    return out
