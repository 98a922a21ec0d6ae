"""Segments of one hierarchy, near rows of a forest, votes of its trees."""

import itertools
import random

import pytest
from pyspark.ml.clustering import BisectingKMeans
from pyspark.sql import functions as F

from tidemark.functions.columns import hash_uniform
from tidemark.operators import modeling, segments

FEW = [(-1, [-2, -3], 100.0), (-2, [0, 1], 30.0), (-3, [-4], 20.0), (-4, [2, 3], 20.0), (0, [], 1.0), (1, [], 2.0), (2, [], 9.0), (3, [], 8.0)]


def test_cuts_split_what_lowers_the_cost_most():
    assert segments.cuts(FEW, 9) == [{0: 0, 1: 0, 2: 0, 3: 0}, {0: 0, 1: 0, 2: 1, 3: 1}, {0: 0, 1: 2, 2: 1, 3: 1}, {0: 0, 1: 2, 2: 1, 3: 3}]
    assert segments.cuts([(0, [], 5.0)], 3) == [{0: 0}]


def test_segments_nest_and_have_the_asked_number(spark):
    rows = spark.range(600).select("id", *[hash_uniform("id", F.lit(i)).alias(c) for i, c in enumerate("abc")])
    ks = list(range(3, 11))
    found = [tuple(r) for r in segments.nested_segments(rows, list("abc"), ["id"], ks).drop("id").collect()]
    for at, k in enumerate(ks):
        assert {r[at] for r in found} == set(range(k))
        if at:
            assert len({(r[at - 1], r[at]) for r in found}) == k


def test_centred_features_are_split_too(spark):
    rows = spark.range(40).select("id", F.when(F.col("id") % 2 == 0, -1.0).otherwise(1.0).alias("a"))
    found = segments.nested_segments(rows, ["a"], ["id", "a"], [2, 5])
    assert sorted(map(tuple, found.select("a", "labels_2").distinct().collect()))[0][1] != sorted(map(tuple, found.select("a", "labels_2").distinct().collect()))[1][1]
    # two points can't be five segments
    assert found.select("labels_5").distinct().count() == 2


@pytest.mark.parametrize("points", [600, 37, 5])
def test_hierarchy_has_the_clusters_of_the_learner(spark, points):
    rows = spark.range(600).select("id", *[(hash_uniform(F.col("id") % points, F.lit(i)) * 3 + 1).alias(c) for i, c in enumerate("abc")]).cache()
    matrix = modeling.assemble(rows, list("abc"), ["id"])
    known = {r["id"]: r["prediction"] for r in BisectingKMeans(k=10, seed=1).fit(matrix).transform(matrix).collect()}
    tree = segments.hierarchy(rows, list("abc"), 10, 1)
    number, _ = segments.numbered(tree)
    at = F.expr(segments.place(list("abc"), {n: centre for n, (centre, _) in tree.items()}, number))
    assert {r["id"]: r["at"] for r in rows.select("id", at.alias("at")).collect()} == known
    assert max(known.values()) == min(10, points) - 1


def test_clusters_are_numbered_from_the_first_half_on():
    tree = {1: ([0.0], 9.0), 2: ([-1.0], 4.0), 3: ([1.0], 2.0), 5: ([-1.0], 4.0), 10: ([-2.0], 1.0), 11: ([0.0], 1.5)}
    number, nodes = segments.numbered(tree)
    assert [number[n] for n in (10, 11, 3)] == [0, 1, 2]
    assert sorted(nodes) == [(-5, [0, 1], 4.0), (-2, [-5], 4.0), (-1, [-2, 2], 9.0), (0, [], 1.0), (1, [], 1.5), (2, [], 2.0)]
    assert segments.cuts(nodes, 9) == [{0: 0, 1: 0, 2: 0}, {0: 0, 1: 0, 2: 1}, {0: 0, 1: 2, 2: 1}]


def test_rounds_end_when_the_centres_stand_still(spark, monkeypatch):
    monkeypatch.setattr(segments, "SMALL", 0, raising=False)
    rows = spark.range(40).select("id", (F.col("id") % 2).alias("a"))
    spark.sparkContext.setJobGroup("rounds", "rounds")
    try:
        found = segments.nested_segments(rows, ["a"], ["id", "a"], [2, 5])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("rounds")) < 20
    assert found.select("a", "labels_5").distinct().count() == 2


def test_many_columns_missing_values_and_few_rows(spark):
    wide = [f"w{i}" for i in range(300)]
    rows = spark.range(60).select("id", *[F.when(F.col("id") % 7 != i % 7, F.col("id") % 3 + i).alias(c) for i, c in enumerate(wide)])
    found = segments.nested_segments(rows, wide, ["id"], [2, 3])
    assert found.columns == ["id", "labels_2", "labels_3"] and found.select("labels_3").distinct().count() == 3
    one = segments.nested_segments(rows.limit(1), ["w0"], ["id"], [2, 3]).collect()
    assert [tuple(r)[1:] for r in one] == [(0, 0)]
    with pytest.raises(ValueError):
        segments.nested_segments(rows.select("id", F.lit(float("inf")).alias("a")), ["a"], ["id"], [2])
    with pytest.raises(ValueError):
        segments.nested_segments(rows, wide, ["id"], [1])


def test_both_ways_to_a_hierarchy_give_the_same_segments(spark, monkeypatch):
    rows = spark.range(300).select("id", *[(hash_uniform("id", F.lit(i)) * 50).alias(c) for i, c in enumerate("ab")])
    monkeypatch.setattr(segments, "SMALL", 300)
    one = sorted(map(tuple, segments.nested_segments(rows, list("ab"), ["id"], [3, 8]).collect()))
    monkeypatch.setattr(segments, "SMALL", 301)
    assert one == sorted(map(tuple, segments.nested_segments(rows, list("ab"), ["id"], [3, 8]).collect()))


@pytest.mark.parametrize("minimum", [0.2, 0.5, 0.7, 1.0])
def test_near_classes_are_those_of_all_pairs(make, minimum):
    draw = random.Random(5)
    rows = [(i, [draw.randrange(3) for _ in range(7)]) for i in range(80)] + [(100 + i, [1] * 7) for i in range(40)] + [(200, None), (201, [])]
    members, pairs = segments.near_classes(make(rows, "id long, leaves array<int>"), ["id"], minimum)
    classes = sorted({tuple(v) for _, v in rows if v})
    want = {(a, b, sum(x == y for x, y in zip(a, b)) / 7) for a, b in itertools.combinations(classes, 2)}
    got = [(tuple(r["clase_a"]), tuple(r["clase_b"]), r["proximidad"]) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == {w for w in want if w[2] >= minimum - 1e-12}
    assert members.count() == len(rows)


def test_near_classes_of_an_empty_table(make):
    members, pairs = segments.near_classes(make([], "id long, leaves array<int>"), ["id"], 0.8)
    assert members.count() == 0 and pairs.count() == 0
    with pytest.raises(ValueError):
        segments.near_classes(members, ["id"], 0)


@pytest.fixture(scope="module")
def fitted(spark):
    u = hash_uniform("id", F.lit(2))
    rows = spark.range(500).select("id", F.lit(202001).alias("mes"), u.alias("a"), hash_uniform("id", F.lit(3)).alias("b"),
                                   (u + hash_uniform("id", F.lit(4)) > 1.1).cast("int").alias("target"))
    matrix = modeling.assemble(rows, ["a", "b"], ["id", "target"]).cache()
    return modeling.random_forest(numTrees=9, maxDepth=4)(1).fit(matrix), matrix


def test_votes_are_those_of_the_trees(fitted):
    forest, matrix = fitted
    votes = {r["id"]: r["votes"] for r in modeling.tree_votes(forest, matrix, ["id"]).collect()}
    for number, tree in enumerate(forest.trees):
        alone = tree.copy().setProbabilityCol("_alone").setRawPredictionCol("").setPredictionCol("").transform(matrix)
        for r in alone.select("id", "_alone").collect():
            assert votes[r["id"]][number] == pytest.approx(r["_alone"][1], abs=1e-12)


def test_growth_is_the_gain_of_the_first_trees(fitted):
    forest, matrix = fitted
    truth = {r["id"]: r["target"] for r in matrix.select("id", "target").collect()}
    votes = {r["id"]: r["votes"] for r in modeling.tree_votes(forest, matrix, ["id"]).collect()}
    got = {r["tree"]: r["ganancia"] for r in modeling.forest_growth(forest, matrix, "target", [1, 4, 9, 512]).collect()}
    assert got == {n: sum(780000 if truth[i] else -20000 for i, v in votes.items() if sum(v[:n]) > n * 0.025) for n in (1, 4, 9)}


def test_growth_sums_votes_while_it_scores(fitted):
    forest, matrix = fitted
    plan = modeling.forest_growth(forest, matrix, "target", [1, 4, 9])._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan and "zip_with" not in plan


def test_a_forest_of_blocks_has_all_trees_and_small_fits(fitted):
    _, matrix = fitted
    made = []
    forest = modeling.fit_in_blocks(matrix, lambda n: made.append(n) or modeling.subspace_trees(n, 0.5, maxDepth=3), 21, 1, block=8)
    assert made == [7, 7, 7] and forest.getNumTrees == 21
    assert len({tree.toDebugString.split("\n", 1)[1] for tree in forest.trees}) > 7
    votes = modeling.tree_votes(forest, matrix, ["id"]).select("id", (F.aggregate("votes", F.lit(0.0), lambda s, x: s + x) / 21).alias("p"))
    assert votes.join(modeling.probability(forest, matrix, ["id"]), "id").filter("abs(p - prob) > 1e-12").isEmpty()


def test_leaf_numbers_of_a_fitted_forest_are_unchanged_by_scoring(fitted):
    forest, matrix = fitted
    before = modeling.leaves(forest, matrix, ["id"]).collect()
    modeling.probability(forest, matrix, ["id"]).collect()
    assert sorted(before) == sorted(modeling.leaves(forest, matrix, ["id"]).collect())
