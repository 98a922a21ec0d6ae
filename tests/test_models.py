"""Model jobs: determinism, resuming, shapes."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import hash_uniform
from tidemark.operators import modeling


@pytest.fixture(scope="module")
def rows(spark):
    u = hash_uniform("id", F.lit(2))
    return spark.range(400).select(
        "id", (F.lit(202001) + F.col("id") % 2).cast("int").alias("mes"), u.alias("a"),
        hash_uniform("id", F.lit(3)).alias("b"), (u > 0.7).cast("int").alias("target")).cache()


def test_seeds_are_reproducible_and_models_resume(rows, tmp_path):
    matrix, made = modeling.assemble(rows, ["a", "b"], ["id", "target"]), []

    def maker(seed):
        estimator = modeling.random_forest(numTrees=3, maxDepth=3)(seed)
        fit = estimator.fit
        estimator.fit = lambda *a, **k: made.append(seed) or fit(*a, **k)
        return estimator

    first = modeling.fit_seeds(matrix, maker, [1, 2], str(tmp_path))
    again = modeling.fit_seeds(matrix, maker, [1, 2], str(tmp_path))
    assert made == [1, 2]
    scores = [{(r["model"], r["id"]): r["prob"] for r in modeling.score(m, matrix, ["id"]).collect()} for m in (first, again)]
    assert scores[0] == scores[1] and len(scores[0]) == 800


def test_leaf_columns_cover_every_leaf_once(rows):
    got = modeling.leaf_features(rows.filter("mes = 202001"), rows, ["a", "b"], ["id"], n_trees=3, depth=2)
    for tree in (1, 2, 3):
        leaves = [c for c in got.columns if c.startswith(f"rf_{tree:03d}_")]
        total = sum((F.col(c) for c in leaves), F.lit(0))
        assert got.filter(total != 1).isEmpty()


def test_noise_does_not_beat_the_signal(rows):
    got = {r["feature"]: r["kept"] for r in modeling.canary_selection(rows, ["a", "b"], 3, 1, depth=3, n_trees=5).collect()}
    assert got["a"]


def test_impossible_settings_are_pruned(rows):
    trials = modeling.search(rows, rows, ["a", "b"], lambda **s: modeling.random_forest(numTrees=2, **s),
                             [{"maxDepth": 2, "minInstancesPerNode": 1000}], [1], fits=lambda s, n: s["minInstancesPerNode"] <= n)
    assert trials.first()["state"] == "PRUNED"


def test_min_leaf_scaling():
    assert modeling.scaled_min_leaf(100, 0.2) == 500 and modeling.scaled_min_leaf(0, 0.5) == 1
    with pytest.raises(ValueError):
        modeling.scaled_min_leaf(10, 0)


def test_other_rows_in_the_same_folder_train_anew(rows, tmp_path):
    maker, counts = modeling.random_forest(numTrees=2, maxDepth=2), []
    matrix = modeling.assemble(rows, ["a", "b"], ["id", "target"])
    # the same rows in another order, other labels, a repeated row
    for table in (matrix, matrix.orderBy("id", ascending=False), matrix.withColumn("target", 1 - F.col("target")), matrix.union(matrix.limit(1))):
        modeling.fit_seeds(table, maker, [1], str(tmp_path))
        counts.append(len([p for p in tmp_path.iterdir() if p.name.startswith("model-")]))
    assert counts == [1, 1, 2, 3]
