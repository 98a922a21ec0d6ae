"""Ordering primitives: hot values, hot groups, ties, nulls, any partitioning."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordering

SCHEMA = "g int, v double, id long, w long"


def table(seed=1, n=3000, hot=0.4):
    """A third of the rows in one group and more than a third on one value."""
    draw, rows = random.Random(seed), []
    for i in range(n):
        g = 0 if draw.random() < 0.4 else draw.randrange(1, 6)
        v = 5.0 if draw.random() < hot else draw.choice([0.0, -0.0, draw.gauss(0, 10), float(draw.randrange(-3, 3))])
        rows.append((g, v, i, draw.randrange(-9, 9)))
    return rows


def brute_positions(rows, by_group, descending):
    groups = {}
    for r in rows:
        groups.setdefault(r[0] if by_group else None, []).append(r)
    out = {}
    for members in groups.values():
        members.sort(key=lambda r: (-r[1] if descending else r[1], r[2]))
        run = 0
        for pos, r in enumerate(members, 1):
            run += r[3]
            out[r[2]] = (pos, run, len(members))
    return out


@pytest.mark.parametrize("by_group", [True, False])
@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("partitions", [1, 7])
def test_running_totals(make, by_group, descending, partitions):
    rows = table()
    df = make(rows, SCHEMA, partitions)
    got = ordering.running_totals(df, "v", ["id"], by=["g"] if by_group else [], sums={"run": "w"}, descending=descending,
                                  size="n", cells=16)
    assert {r["id"]: (r["pos"], r["run"], r["n"]) for r in got.collect()} == brute_positions(rows, by_group, descending)


@pytest.mark.parametrize("top", [1, 37, 100000])
def test_top_rows(make, top):
    rows = table(2)
    got = ordering.running_totals(make(rows, SCHEMA), "v", ["id"], by=["g"], descending=True, top=top, cells=16)
    want = {i: p[0] for i, p in brute_positions(rows, True, True).items() if p[0] <= top}
    assert {r["id"]: r["pos"] for r in got.collect()} == want


def test_null_values_come_in_one_place(make):
    rows = [(0, None, i, 1) for i in range(40)] + [(0, float(i), 100 + i, 1) for i in range(10)]
    got = ordering.running_totals(make(rows, SCHEMA), "v", ["id"], cells=8).collect()
    assert sorted(r["pos"] for r in got) == list(range(1, 51))
    assert [r["id"] for r in sorted(got, key=lambda r: r["pos"]) if r["v"] is not None] == list(range(100, 110))


def test_null_group_is_a_group(make):
    rows = [(None if i % 2 else 1, float(i), i, 1) for i in range(20)]
    got = ordering.running_totals(make(rows, SCHEMA), "v", ["id"], by=["g"], cells=4).collect()
    assert sorted(r["pos"] for r in got if r["g"] is None) == list(range(1, 11))


def test_rank_counts(make):
    rows = table(3)
    got = ordering.rank_counts(make(rows, SCHEMA), "v", ["g"], cells=16).collect()
    for r in got:
        peers = [x[1] for x in rows if x[0] == r["g"]]
        assert (r["_rank"], r["_ties"], r["_size"]) == (1 + sum(p < r["v"] for p in peers), sum(p == r["v"] for p in peers), len(peers))


def test_no_cell_holds_a_hot_group(make):
    rows = [(0, float(i % 7), i, 1) for i in range(4000)]
    cells = ordering.with_cells(make(rows, SCHEMA), F.col("v"), "id", cells=20)
    largest = cells.groupBy("g", ordering.CELL, ordering.SUB).count().agg(F.max("count")).first()[0]
    assert largest < 4000 / 20 * 3


@pytest.mark.parametrize("hot", [0.0, 0.9])
def test_exact_quantiles(make, hot):
    import numpy as np

    rows, ps = table(4, hot=hot), [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = ordering.exact_quantiles(make(rows, SCHEMA), ["v", "w"], ps, ["g"], cells=16).collect()
    assert len(got) == 2 * len({r[0] for r in rows})
    for r in got:
        values = [x[1] if r["column"] == "v" else x[3] for x in rows if x[0] == r["g"]]
        assert np.allclose([r[f"q{i}"] for i in range(len(ps))], np.quantile(values, ps), rtol=1e-12)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ordering.running_totals(empty, "v", ["id"], by=["g"]).count() == 0
    assert ordering.exact_quantiles(empty, ["v"], [0.5]).count() == 0


def test_a_hot_score_with_prefixed_string_ids_splits(make):
    rows = [(0.5, f"customer_{i:08d}") for i in range(4000)] + [(float(i), f"customer_x{i}") for i in range(400)]
    df = make(rows, "v double, id string")
    cells = ordering.with_cells(df, F.col("v"), "id", cells=20)
    assert cells.groupBy(ordering.CELL, ordering.SUB).count().agg(F.max("count")).first()[0] < 4400 / 20 * 3
    got = ordering.running_totals(df, "v", ["id"], cells=20).collect()
    assert [r["id"] for r in sorted(got, key=lambda r: r["pos"])] == [i for _, i in sorted(rows)]


def test_parts_are_no_more_than_cells(make):
    rows = [(float(i % 5), i) for i in range(5000)]
    cells = ordering.with_cells(make(rows, "v double, id long"), F.col("v"), "id", cells=20)
    assert cells.select(ordering.CELL, ordering.SUB).distinct().count() <= 40


def test_a_value_that_changes_when_computed_again_has_one_place(make):
    df = make([(i,) for i in range(3000)], "id long").withColumn("v", F.rand())
    got = sorted(ordering.running_totals(df, "v", ["id"], cells=16).collect(), key=lambda r: r["pos"])
    assert [r["pos"] for r in got] == list(range(1, 3001))
    assert [r["v"] for r in got] == sorted(r["v"] for r in got)


def test_bins_by_halving(make):
    edges, rows = [1.0, 2.0, 2.5, 7.0], [(x / 4,) for x in range(-4, 40)]
    got = make(rows, "v double").select("v", ordering.bin_of(F.col("v"), F.array(*map(F.lit, edges)), 4).alias("b")).collect()
    assert all(r["b"] == sum(e <= r["v"] for e in edges) for r in got)


def test_few_values_are_shuffled_for_a_median(make, spark):
    """Only cells that hold the wanted rank are counted value by value."""
    df = make([(float(i % 9973), i % 3) for i in range(20_000)], "v double, g int")
    got = {r["g"]: r["q0"] for r in ordering.exact_quantiles(df, ["v"], [0.5], ["g"], cells=50).collect()}
    import numpy as np

    assert got == {g: np.median([float(i % 9973) for i in range(20_000) if i % 3 == g]) for g in range(3)}
