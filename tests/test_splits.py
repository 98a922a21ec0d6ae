"""Repeated splits: borders by a narrow stretch of the hash, gains in the same pass."""

import hashlib

from pyspark.sql import functions as F

from tidemark.operators import leaderboard, sampling


def _test_keys(rows, split, share, seed):
    """By definition: the first rows of each stratum in the order of hash and key, equal keys together."""
    def order(row):
        text = "|".join(str(p) for p in (row[0], row[1], split, seed) if p is not None)
        return hashlib.md5(text.encode()).hexdigest()[:8], row[0] is not None, row[0] or 0, row[1] is not None, row[1] or 0

    chosen = []
    for y in {r[2] for r in rows}:
        part = sorted((r for r in rows if r[2] == y), key=order)
        want = int(len(part) * share + 0.5)
        if want:
            chosen += [r for r in part if order(r) <= order(part[want - 1])]
    return sorted(chosen, key=str)


def test_borders_with_keys_that_many_rows_share(make):
    rows = [(i % 7, 1, i % 2) for i in range(600)] + [(None, None, 1)] * 50 + [(None, 3, None)] * 3 + [(i, 2, 0) for i in range(900)]
    df = make(rows, "id long, mes int, y int")
    got = sampling.shuffle_splits(df, 6, 0.3, 5, ["y"]).filter("side = 'test'").collect()
    for split in range(6):
        assert sorted(((r["id"], r["mes"], r["y"]) for r in got if r["split"] == split), key=str) == _test_keys(rows, split, 0.3, 5)


def test_split_sums_are_those_of_the_test_sides(make):
    rows = [(i % 9, 1, i % 2, i) for i in range(300)] + [(None, 4, 1, 1000)] * 20 + [(i, 2, None, 3 * i) for i in range(500)]
    df = make(rows, "id long, mes int, y int, v long")
    want = sampling.shuffle_splits(df, 5, 0.4, 8, ["y"]).filter("side = 'test'").groupBy("split").agg(F.sum("v").alias("v"))
    got = sampling.split_sums(df, 5, 0.4, 8, ["v"], ["y"])
    assert {tuple(r) for r in got.select("split", "v").collect()} == {tuple(r) for r in want.collect()}


def test_few_rows_are_put_in_order(spark, make):
    """Counts of the rows outside the stretch, and the few keys in it, are all that leaves the pass over the hashes."""
    df = spark.range(40000).select(F.col("id"), F.lit(1).alias("mes"), (F.col("id") % 2).cast("int").alias("y"))
    seen, real = [], sampling.materialize
    sampling.materialize = lambda frame, name="table": seen.append((name, real(frame, name))) or seen[-1][1]
    try:
        sampling.split_borders(df, 4, 0.3, 5, ["y"]).collect()
    finally:
        sampling.materialize = real
    (counts,) = [f for n, f in seen if n == "counts"]
    assert counts.count() < 4 * 40000 / 20 and counts.agg(F.sum("_n")).first()[0] == 4 * 40000


def test_simulated_cuts_order_only_the_first_rows(make):
    rows = [(i, 1, (i * 37 % 4000) / 4000, int(i % 5 == 0)) for i in range(4000)]
    df = make(rows, "id long, mes int, prob double, y int")
    asked, real = [], leaderboard.running_totals
    leaderboard.running_totals = lambda *a, **k: asked.append(k.get("top")) or real(*a, **k)
    try:
        got = {tuple(r) for r in leaderboard.simulate_cuts(df, "prob", "y", [10, 50], 3).collect()}
    finally:
        leaderboard.running_totals = real
    assert asked[0] is not None and asked[0] < 4000
    want = set()
    for split in range(3):
        test = {r[0] for r in _test_keys([(r[0], r[1], r[3]) for r in rows], split, 0.3, 42)}
        for side, chosen in (("public", [r for r in rows if r[0] in test]), ("private", [r for r in rows if r[0] not in test])):
            best = sorted(chosen, key=lambda r: (-r[2], r[0]))
            want |= {(split, side, c, sum(780000 if r[3] else -20000 for r in best[:c])) for c in (10, 50)}
    assert got == want


def test_models_with_null_keys_and_models(make):
    rows = [(m, i, 1, (i * m * 13 % 100) / 100, i % 2) for m in (1, 2) for i in range(200)]
    rows += [(None, i, 1, 0.9, i % 2) for i in range(50)] + [(1, None, 1, 0.9, 1)] * 5
    got = {(r["model"], r["split"], r["tipo"]): r["ganancia"] for r in leaderboard.models_over_splits(
        make(rows, "model int, id long, mes int, prob double, y int"), "prob", "y", n_splits=2, threshold=0.5).collect()}
    customers = sorted({(r[1], r[2], r[4]) for r in rows}, key=str)
    for split in range(2):
        test = {r[:2] for r in _test_keys(customers, split, 0.3, 42)}
        for model in (1, 2, None):
            for side, share in (("public", 0.3), ("private", 1 - 0.3)):
                part = [r for r in rows if r[0] == model and r[1] is not None and ((r[1], r[2]) in test) == (side == "public")]
                assert got[model, split, side] == sum(780000 if r[4] else -20000 for r in part if r[3] >= 0.5) / share
    assert len(got) == 12
