"""Trees of all depths read off the deepest one."""

from pyspark.sql import functions as F

from tidemark.functions.columns import hash_uniform
from tidemark.operators import modeling
from tidemark.operators.gain import BREAK_EVEN, gain_at_threshold


def test_cuts_of_the_deepest_tree_are_the_trees_of_each_depth(spark, monkeypatch):
    rows = spark.range(3000).select("id", F.lit(1).alias("mes"), *[hash_uniform("id", F.lit(i)).alias(f"x{i}") for i in range(3)])
    rows = rows.withColumn("target", ((F.col("x0") * F.col("x1") > 0.8) | (hash_uniform("id", F.lit(9)) < 0.02)).cast("int"))
    train, test = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")
    features, depths, want = ["x0", "x1", "x2"], [1, 2, 3, 5, 8, 14], {}
    for depth in depths:
        matrices = [modeling.assemble(part, features, ["target"]) for part in (train, test)]
        model = modeling.single_tree(maxDepth=depth, minInstancesPerNode=1)(1).fit(matrices[0])
        want[depth] = tuple(float(gain_at_threshold(modeling.probability(model, m, ["target"]), "prob", "target", BREAK_EVEN).first()[0]) for m in matrices)
    fits, real = [], modeling.single_tree
    monkeypatch.setattr(modeling, "single_tree", lambda **k: fits.append(k) or real(**k))
    got = {r[0]: (r[1], r[2]) for r in modeling.depth_sweep(train, test, features, depths).collect()}
    assert got == want and len(set(want.values())) > 3
    assert len(fits) == 1
