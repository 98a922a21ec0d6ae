"""Customer segments and forest proximity."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.ml.clustering import BisectingKMeans, BisectingKMeansModel, KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..session import materialize, scratch_path
from .modeling import LABEL, assemble, importances, random_forest

TERMS = 50  # of the expression that places a row; at 100 its passes were several times slower
SMALL = 3_000_000  # rows; below it a round costs more to plan than MLlib's learner needs for it


def pair_proximity(leaves: DataFrame, pairs: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Share of trees in which both rows of a given pair end in the same leaf.

    ``leaves`` holds an array of leaf numbers per row; ``pairs`` names its two rows by columns with the
    suffixes ``_a`` and ``_b``.
    """
    sides = [leaves.select(*[F.col(k).alias(f"{k}_{s}") for k in entity], F.col("leaves").alias(f"_l{s}")) for s in "ab"]
    joined = pairs.join(sides[0], [f"{k}_a" for k in entity]).join(sides[1], [f"{k}_b" for k in entity])
    same = F.aggregate(F.zip_with("_la", "_lb", lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x)
    return joined.select(*pairs.columns, ratio(same, F.size("_la")).alias("proximidad"))


def group_proximity(leaves: DataFrame, entity: Sequence[str], group: str) -> DataFrame:
    """Mean proximity of every row to every group of rows.

    The mean over a group needs only the group's row count per leaf, so no pair of rows is ever formed: the
    count table has at most trees x leaves x groups rows.
    """
    # spread by row before the arrays are unfolded, so that the sums per row need no second shuffle
    placed = leaves.repartition(*entity).select(*entity, group, F.posexplode("leaves").alias("tree", "leaf"))
    counts = placed.groupBy("tree", "leaf", F.col(group).alias("grupo")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = leaves.groupBy(F.col(group).alias("grupo")).agg(F.count(F.lit(1)).alias("_size"), F.max(F.size("leaves")).alias("_trees"))
    met = placed.select(*entity, "tree", "leaf").join(counts, ["tree", "leaf"])
    sums = met.groupBy(*entity, "grupo").agg(F.sum("_n").alias("_met"))
    return sums.join(sizes, "grupo").select(
        *entity, "grupo", ratio(F.col("_met"), F.col("_size") * F.col("_trees")).alias("proximidad"))


def near_classes(leaves: DataFrame, entity: Sequence[str], minimum: float) -> tuple[DataFrame, DataFrame]:
    """Rows that end in the same leaf in at least a share ``minimum`` (> 0) of the trees, without comparing all pairs.

    Rows with equal leaves are one class (its ``clase`` is the array of leaves). Returns the membership (entity,
    ``clase``) and the pairs of near classes with their ``proximidad``, each once with ``clase_a`` < ``clase_b``.
    Two rows that differ in at most d trees agree on at least one of d + 1 blocks of trees, whichever the blocks are,
    so only classes that share a whole block meet. A pair counts at the first block it shares; nothing is lost or repeated.
    Rows without leaves are members of the class null, which is near none.
    """
    if not 0 < minimum <= 1:
        raise ValueError("the share must lie in (0, 1]")
    members = leaves.select(*entity, F.col("leaves").alias("clase"))
    # both sides of the join read a written table, so that adaptive execution can split blocks that many classes share
    classes = materialize(members.filter(F.size("clase") > 0).select("clase").distinct(), "classes")
    trees = F.size("clase")
    needed = F.ceil(F.lit(float(minimum)) * trees - F.lit(1e-9)).cast("int")
    n = trees - needed + 1
    # block b holds the trees b, b + n, b + 2n, ...
    blocks = F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.filter("clase", lambda _, i: i % n == b))
    spread = classes.select("clase", n.alias("_n"), F.posexplode(blocks).alias("_block", "_value"))
    a, b = (spread.select(F.col("clase").alias(f"clase_{s}"), "_n", "_block", "_value") for s in "ab")
    met = a.join(b, ["_n", "_block", "_value"]).filter("clase_a < clase_b and size(clase_a) = size(clase_b)")
    same = F.zip_with("clase_a", "clase_b", lambda x, y: x == y)
    shared = F.aggregate(same, F.lit(0), lambda s, x: s + x.cast("int"))
    earlier = F.exists(F.sequence(F.lit(0), F.col("_n") - 1), lambda k: (k < F.col("_block")) & F.forall(
        F.sequence(F.lit(0), F.size("clase_a") - 1), lambda i: (i % F.col("_n") != k) | F.get(same, i)))
    pairs = met.filter((shared >= F.ceil(F.lit(float(minimum)) * F.size("clase_a") - F.lit(1e-9))) & ~earlier)
    return members, pairs.select("clase_a", "clase_b", ratio(shared, F.size("clase_a")).alias("proximidad"))


def _scaled(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    matrix = assemble(df, features, keep, missing=0.0)
    scaler = StandardScaler(inputCol="features", outputCol="_scaled", withMean=True).fit(matrix)
    return materialize(scaler.transform(matrix).select(*keep, F.col("_scaled").alias("features")), "scaled")


def place(names: Sequence[str], centres: Mapping[int, Sequence[float]], number: Mapping[int, int], node: int = 1) -> str:
    """Expression for the number of the cluster a row falls to, from the root down to the nearer half each time.

    The halves of node n are the nodes 2n and 2n + 1; a row in the middle belongs to the first.
    """
    halves = [n for n in (2 * node, 2 * node + 1) if n in centres]
    below = [place(names, centres, number, n) for n in halves]
    if len(halves) < 2:
        return below[0] if below else str(number[node])
    first, second = (centres[n] for n in halves)
    along = " + ".join(f"{c} * {y - x!r}D" for c, x, y in zip(names, first, second))
    middle = sum((y - x) * (y + x) for x, y in zip(first, second)) / 2
    return f"CASE WHEN {along} > {middle!r}D THEN {below[1]} ELSE {below[0]} END"


def hierarchy(rows: DataFrame, names: Sequence[str], k: int, seed: int, rounds: int = 20) -> dict[int, tuple[list[float], float]]:
    """Centre and cost of every node of a hierarchy of up to k clusters, by bisecting k-means.

    The root is node 1, the halves of node n are the nodes 2n and 2n + 1. The nodes of a level are halved together, the
    largest ones where not all are needed; each round moves the centres of all halves by one grouped sum over the columns
    of the rows, so a row is never moved or kept as an object. The driver holds fewer than two nodes per cluster.
    """
    draw = rows.sparkSession._jvm.java.util.Random(seed)
    names, square = list(names), reduce(add, [F.col(c) * F.col(c) for c in names])
    placed = [F.count(F.lit(1)).alias("n"), F.sum("_square").alias("square"), *[F.sum(c).alias(c) for c in names]]

    def summaries(centres: Mapping[int, Sequence[float]]) -> dict[int, tuple[int, list[float], float]]:
        nodes = rows.select(*names, square.alias("_square"), F.expr(place(names, centres, {n: n for n in {1, *centres}})).alias("_node"))
        out = {}
        for r in nodes.groupBy("_node").agg(*placed).collect():
            centre = [r[c] / r["n"] for c in names]
            out[r["_node"]] = (r["n"], centre, max(r["square"] - r["n"] * sum(x * x for x in centre), 0.0))
        return out

    active = summaries({})
    tree = {n: (centre, cost) for n, (_, centre, cost) in active.items()}
    needed = k - 1
    for _ in range(30):  # levels, so that the numbers of the nodes are integers
        halved = [n for n, (size, _, cost) in sorted(active.items()) if cost > sys.float_info.epsilon * size]
        if len(halved) > needed:
            halved = sorted(halved, key=lambda n: -active[n][0])[:needed]
        if not halved:
            break
        halves = {}
        for n in halved:
            centre = active[n][1]
            step = 1e-4 * math.hypot(*centre)
            shift = [step * draw.nextDouble() for _ in centre]
            halves[2 * n] = [x - s for x, s in zip(centre, shift)]
            halves[2 * n + 1] = [x + s for x, s in zip(centre, shift)]
        for _ in range(rounds):
            found = summaries({n: centre for n, (centre, _) in tree.items()} | halves)
            active = {n: found[n] for n in halves if n in found}
            before, halves = halves, {n: centre for n, (_, centre, _) in active.items()}
            # centres that stand still, but for the order of a sum, stay
            if all(n in halves and math.dist(centre, halves[n]) <= 1e-12 * math.hypot(*centre) for n, centre in before.items()):
                break
        tree |= {n: (centre, cost) for n, (_, centre, cost) in active.items()}
        needed -= len(halved)
    return tree


def learned_nodes(spark: SparkSession, model: BisectingKMeansModel, path: str) -> list[tuple[int, list[int], float]]:
    """Nodes of a fitted hierarchy from its saved form: number, children, cost. Leaves have the numbers of their clusters."""
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data/data")
    return [(r["index"], list(r["children"]), r["cost"]) for r in nodes.select("index", "children", "cost").collect()]


def numbered(tree: Mapping[int, tuple[list[float], float]]) -> tuple[dict[int, int], list[tuple[int, list[int], float]]]:
    """Number of every cluster, from the first half to the second, and the nodes of a hierarchy: number, children, cost.

    Nodes that are halved have negative numbers, so that they differ from those of the clusters.
    """
    number: dict[int, int] = {}

    def visit(node: int) -> None:
        halves = [n for n in (2 * node, 2 * node + 1) if n in tree]
        number[node] = -node if halves else sum(1 for n in number.values() if n >= 0)
        for n in halves:
            visit(n)

    visit(1)
    return number, [(m, [number[h] for h in (2 * n, 2 * n + 1) if h in tree], tree[n][1]) for n, m in number.items()]


def cuts(nodes: Sequence[tuple[int, list[int], float]], k: int) -> list[dict[int, int]]:
    """Segment of every cluster for 1, 2, ... up to k segments.

    Each cut splits the segment whose split lowers the cost most; the half with the smallest cluster number keeps the
    segment's number, the other one gets the next, so segments nest. A hierarchy of fewer clusters gives fewer cuts.
    """
    children, cost = {n: c for n, c, _ in nodes}, {n: x for n, _, x in nodes}

    def divided(node: int) -> int:
        # a split that left one half empty is none
        return divided(children[node][0]) if len(children[node]) == 1 else node

    below: dict[int, list[int]] = {}

    def clusters(node: int) -> list[int]:
        if node not in below:
            below[node] = sorted(x for c in children[node] for x in clusters(c)) if children[node] else [node]
        return below[node]

    root = (set(children) - {c for many in children.values() for c in many}).pop()
    segments, out = {0: divided(root)}, []
    while True:
        out.append({cluster: number for number, node in segments.items() for cluster in clusters(node)})
        open_ = [(sum(cost[c] for c in children[n]) - cost[n], clusters(n)[0], number) for number, n in segments.items() if children[n]]
        if len(out) == k or not open_:
            return out
        number = min(open_)[2]
        first, second = sorted(map(divided, children[segments[number]]), key=lambda n: clusters(n)[0])
        segments.update({number: first, len(segments): second})


def nested_segments(df: DataFrame, features: Sequence[str], keep: Sequence[str], ks: Iterable[int] = range(3, 11),
                    seed: int = 1) -> DataFrame:
    """One hierarchy of segments cut at several numbers of segments, side by side as ``labels_{k}``.

    Every segment of a larger cut lies inside one of a smaller cut. Where the rows have fewer distinct points than k,
    the finest cut stands for k. Small or wide tables go through MLlib's learner, long ones through ``hierarchy``, which
    draws by node number, as the learner does unless its partitions are few.
    """
    ks = list(ks)
    if max(ks) < 2:
        raise ValueError("a cut needs at least two segments")
    names = [f"_x{i}" for i in range(len(features))]
    values = assemble(df, features, keep, missing=0.0).select(*keep, vector_to_array("features").alias("_values"))
    matrix = materialize(values.select(*keep, *[F.get("_values", F.lit(i)).alias(c) for i, c in enumerate(names)]), "measures")
    scaler = StandardScaler(inputCol="features", withMean=True).fit(assemble(matrix, names))
    if not all(map(math.isfinite, scaler.mean)) or any(map(math.isnan, scaler.std)):
        raise ValueError("the values must be finite")
    # a split starts by moving the centre by a share of its length, so the centre must not be the origin
    moved = {c: (F.col(c) - float(m)) * (1 / float(s) if s else 0.0) + 1 for c, m, s in zip(names, scaler.mean, scaler.std)}
    if max(ks) * len(names) <= TERMS and matrix.count() >= SMALL:
        tree = hierarchy(matrix.select([moved[c].alias(c) for c in names]), names, max(ks), seed)
        number, nodes = numbered(tree)
        out = matrix.withColumns(moved).withColumn("_cluster", F.expr(place(names, {n: centre for n, (centre, _) in tree.items()}, number)))
    else:
        points = VectorAssembler(inputCols=names, outputCol="_point").transform(matrix.withColumns(moved)).select(*keep, "_point")
        model = BisectingKMeans(k=max(ks), seed=seed, featuresCol="_point", predictionCol="_cluster").fit(points)
        nodes, out = learned_nodes(df.sparkSession, model, scratch_path(df.sparkSession, "hierarchy")), model.transform(points).drop("_point")
    found = cuts(nodes, max(ks))
    for k in ks:
        cut = found[min(k, len(found)) - 1]
        out = out.withColumn(f"labels_{k}", F.get(F.array(*[F.lit(cut[c]) for c in range(len(cut))]), F.col("_cluster")))
    return out.drop(*names, "_cluster")


def flat_segments(df: DataFrame, features: Sequence[str], keep: Sequence[str], k: int = 15, seed: int = 1) -> DataFrame:
    matrix = _scaled(df, features, keep)
    return KMeans(k=k, seed=seed, predictionCol="segmento").fit(matrix).transform(matrix).drop("features")


def what_separates(df: DataFrame, features: Sequence[str], segment: str, values: Iterable, n_trees: int = 20,
                   depth: int = 5, seed: int = 1) -> DataFrame:
    """Feature importances of each segment against the rest."""
    matrix = materialize(assemble(df, features, [segment]), "segments")
    tables = []
    for value in values:
        one = matrix.withColumn(LABEL, (F.col(segment) == value).cast("int"))
        forest = random_forest(numTrees=n_trees, maxDepth=depth)(seed).fit(one)
        tables.append(importances(df.sparkSession, forest, features).withColumn("segmento", F.lit(value)))
    return reduce(DataFrame.unionByName, tables)
