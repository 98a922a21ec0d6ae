"""Inputs on which an answer could lose rows or values."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import Keys
from tidemark.operators import features, gain, leaderboard, modeling, quality
from tidemark.operators.ordering import running_totals
from tidemark.sources import readers


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_top_list_reaches_null_scores(make):
    df = make([(k, k / 10 if k <= 5 else None) for k in range(1, 11)], "id long, prob double")
    got = {r["id"]: r["Predicted"] for r in gain.label_top(df, "prob", ["id"], 7).collect()}
    assert got == {k: int(k <= 7) for k in range(1, 11)}


def test_files_of_other_layouts_are_read(spark, tmp_path):
    write(f"{tmp_path}/a/p.csv", "id\tprob\n1\t0.5\n2\t0.25\n")
    write(f"{tmp_path}/b/p.csv", "otra\tid\tprob\nx\t3\t0.75\n")
    got = {(r["modelo"], r["id"], r["otra"]) for r in readers.read_predictions(spark, str(tmp_path), "*.csv").collect()}
    assert got == {("a", 1, None), ("a", 2, None), ("b", 3, "x")}


def test_files_without_rows_are_counted(spark, tmp_path):
    write(f"{tmp_path}/a/p.csv", "id\tprob\n1\t0.5\n2\t0.25\n")
    write(f"{tmp_path}/b/p.csv", "id\tprob\n")
    write(f"{tmp_path}/c/p.csv", "")
    got = {r["archivo"].split("/")[-2]: r["filas"] for r in readers.rows_per_file(spark, str(tmp_path), "*.csv").collect()}
    assert got == {"a": 2, "b": 0, "c": 0}


def test_rows_without_month_keep_their_values(make):
    df = make([(1, 202001, 0.0), (2, 202001, 0.0), (3, None, 5.0), (4, 202002, 1.0)], "id long, foto_mes int, x double")
    got = {r["id"]: r["x"] for r in quality.repair_zero_months(df, ["x"], keys=Keys(id="id", month="foto_mes", period="p")).collect()}
    assert got == {1: None, 2: None, 3: 5.0, 4: 1.0}


def test_index_with_two_values_for_a_month(make):
    df = make([(1, 202001, 10.0)], "id long, foto_mes int, x double")
    index = make([(202001, 1.0), (202001, 2.0)], "foto_mes int, valor_ipc double")
    with pytest.raises(Exception, match="several values for month 202001"):
        features.adjust_by_index(df, index, ["x"], 202001, keys=Keys(id="id", month="foto_mes", period="p")).collect()


def test_auc_uses_every_score(spark):
    df = spark.range(5000).select(F.rand(3).alias("prob"), (F.rand(4) < 0.4).cast("int").alias("y"))
    df = spark.createDataFrame(df.collect(), df.schema)
    rows = sorted((r["prob"], r["y"]) for r in df.collect())
    positive = sum(y for _, y in rows)
    want = (sum(k + 1 for k, (_, y) in enumerate(rows) if y) - positive * (positive + 1) / 2) / (positive * (len(rows) - positive))
    assert modeling.auc(df, "prob", "y") == pytest.approx(want, abs=1e-9)


def test_signed_rank_methods(make):
    pairs = make([(1, float(k), 0.0) for k in range(1, 61)], "g int, x double, y double")
    p = {m: leaderboard.wilcoxon(pairs, "x", "y", ["g"], method=m).first()["p"] for m in ("exact", "normal", "auto")}
    assert p["exact"] == pytest.approx(2.0**-59, rel=1e-9) and p["auto"] == p["normal"] != p["exact"]
    assert leaderboard.wilcoxon(pairs, "x", "y", ["g"], exact_up_to=60).first()["p"] == p["exact"]


def test_string_ties(make):
    rows = [(f"id{k % 50:03d}é{k}", float(k % 3)) for k in range(600)]
    got = {r["id"]: r["pos"] for r in running_totals(make(rows, "id string, v double"), "v", ["id"], cells=8).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0].encode()))
    assert got == {r[0]: k + 1 for k, r in enumerate(order)}


def test_sizes_of_any_length(make):
    df = make([(1, 100), (2, 250), (3, 1)], "id int, n int")
    got = {r["id"]: r["hoja"] for r in df.select("id", modeling.scaled_min_leaf_column(F.col("n"), 0.25).alias("hoja")).collect()}
    assert got == {1: 400, 2: 1000, 3: 4}


# --- splits by borders, areas by rank sums

def test_splits_of_odd_strata(make):
    import random

    from pyspark.sql import functions as F

    from tidemark.functions.columns import Keys
    from tidemark.operators import sampling

    rng = random.Random(8)
    rows = [(k % 700, 202001 + k // 700, rng.choice([0, 0, 0, 1, None, 7 if k < 3 else 0]), "x") for k in range(2000)]
    keys = Keys(id="id", month="mes", period="p")
    df = make(rows, "id long, mes int, y int, extra string")
    for share in (0.0, 0.3, 1.0):
        got = sampling.shuffle_splits(df, 4, share, 5, ["y"], keys)
        assert got.columns == [*df.columns, "split", "side"]
        sizes = got.groupBy("split", "y").agg(F.count("*").alias("n"), F.count_if(F.col("side") == "test").alias("t")).collect()
        assert {r["split"] for r in sizes} == set(range(4)) and sum(r["n"] for r in sizes) == 8000
        assert all(r["t"] == int(r["n"] * share + 0.5) for r in sizes)
        whole = sampling.shuffle_splits(df, 2, share, 5, (), keys).groupBy("split").agg(F.count_if(F.col("side") == "test").alias("t")).collect()
        assert [r["t"] for r in whole] == [int(2000 * share + 0.5)] * 2
    assert sampling.shuffle_splits(df.limit(0), 3, 0.3, 5, ["y"], keys).count() == 0
    plan = sampling.shuffle_splits(df, 50, 0.3, 5, ["y"], keys)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan


def test_area_by_rank_sums(make):
    import random

    from tidemark.operators import modeling

    rng = random.Random(9)
    rows = [(k % 3, rng.choice([None, 0.1, 0.2, 0.2, 0.5, rng.random()]), rng.choice([0, 1, 1, None]) if k % 3 < 2 else 1) for k in range(900)]
    got = {r["g"]: r["auc"] for r in modeling.auc_by(make(rows, "g int, p double, y int"), "p", "y", ["g"]).collect()}
    for g in (0, 1):
        pos = [p for h, p, y in rows if h == g and p is not None and y == 1]
        neg = [p for h, p, y in rows if h == g and p is not None and y == 0]
        want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
        assert abs(got[g] - want) < 1e-12
    assert got[2] is None


def test_exact_signed_rank_with_ties_and_zeros(make):
    import itertools
    import random

    from tidemark.operators import leaderboard

    rng, rows = random.Random(4), []
    for g in range(12):
        rows += [(g, float(rng.randrange(5 if g % 2 else 50)), float(rng.randrange(5 if g % 2 else 50))) for _ in range(rng.randint(1, 10))]
    rows += [(99, 1.0, 1.0)]
    got = {r["g"]: r for r in leaderboard.wilcoxon(make(rows, "g int, x double, y double"), "x", "y", ["g"], method="exact").collect()}
    for g in {r[0] for r in rows}:
        d = [x - y for h, x, y in rows if h == g and x != y]
        size = sorted(abs(v) for v in d)
        ranks = [size.index(abs(v)) + (size.count(abs(v)) + 1) / 2 for v in d]
        w = min(sum(r for r, v in zip(ranks, d) if v > 0), sum(r for r, v in zip(ranks, d) if v < 0))
        sums = [sum(r for r, s in zip(ranks, signs) if s) for signs in itertools.product((0, 1), repeat=len(d))]
        assert got[g]["estadistico"] == w
        assert abs(got[g]["p"] - min(1.0, 2 * sum(s <= w for s in sums) / len(sums))) < 1e-12
