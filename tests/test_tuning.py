"""Tuning jobs give what one fit and one curve per setting give, with fewer of both."""

import pytest
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tidemark.functions.columns import KEYS, hash_uniform
from tidemark.operators import gain, modeling
from tidemark.operators.sampling import partition
from tidemark.session import materialize

FEATURES = ["x0", "x1", "x2"]


@pytest.fixture(scope="module")
def rows(spark):
    made = spark.range(3000).select("id", F.lit(1).alias("mes"), *[hash_uniform("id", F.lit(i)).alias(f"x{i}") for i in range(3)])
    return made.withColumn("target", ((F.col("x0") * F.col("x1") > 0.8) | (hash_uniform("id", F.lit(9)) < 0.02)).cast("int"))


def counted(maker, fits):
    def make(seed):
        estimator = maker(seed)
        kind = type(estimator)
        own = type(kind.__name__, (kind,), {"_fit": lambda self, data: fits.append(1) or kind._fit(self, data)})
        estimator.__class__ = own
        return estimator

    return make


def test_folds_equal_a_fit_and_a_curve_per_setting(rows):
    grid = {"maxDepth": [1, 2, 3, 6], "minInstancesPerNode": [1, 40]}
    matrix = modeling.assemble(partition(rows, [1] * 3, ["target"], 1, first=0), FEATURES, ["id", "mes", "target", "fold"]).cache()
    tree = modeling.single_tree()(1)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(tree.getParam(name), values)
    tuned = CrossValidator(estimator=tree, estimatorParamMaps=builder.build(), numFolds=3, foldCol="fold",
                           evaluator=modeling.GainEvaluator(KEYS.pair, share=1 / 3)).fit(matrix)
    want = {tuple(s[tree.getParam(n)] for n in grid): g for s, g in zip(builder.build(), tuned.avgMetrics)}
    fits = []
    found = modeling.cross_validate(rows, FEATURES, ["target"], counted(modeling.single_tree(), fits), grid, folds=3).collect()
    assert {(r["maxDepth"], r["minInstancesPerNode"]): r["ganancia"] for r in found} == pytest.approx(want)
    assert len(set(want.values())) > 3
    assert len(fits) == 6


def test_search_equals_one_trial_at_a_time(rows):
    train, validate = rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1").union(rows.filter("id < 50"))
    settings, fits = [{"maxDepth": 2}, {"maxDepth": 4}, {"maxDepth": 2}], []
    found = modeling.search(train, validate, FEATURES, lambda **s: counted(modeling.random_forest(numTrees=3, **s), fits), settings, [1, 2]).collect()
    assert len(fits) == 4
    # written as the search writes it, since bags follow the partitions
    matrix = materialize(modeling.assemble(train, FEATURES, ["target"]), "train")
    target = modeling.assemble(validate, FEATURES, ["id", "mes", "target"])
    for setting, r in zip(settings, found):
        models = modeling.fit_seeds(matrix, modeling.random_forest(numTrees=3, **setting), [1, 2])
        mean = gain.ensemble(modeling.score(models, target, ["id", "mes", "target"]), ["id", "mes", "target"], "prob")
        best = gain.best_point(gain.gain_curve(mean, "prob", "target", ["id", "mes"]), "prob").first()["ganancia_max"]
        assert r["value"] == best and r["auc"] == pytest.approx(modeling.auc(mean, "prob"), abs=1e-12)
