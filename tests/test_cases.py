"""Hand-written cases with known answers."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import amount_columns, count_amount_pairs, hash_uniform, nan_to_null, period_index
from tidemark.operators import aggregates, features, gain, history, labels, leaderboard, panel, quality, ranks, sampling
from tidemark.sources import readers, writers

PANEL = "id long, mes int, x double"


def with_period(df):
    return df.withColumn("periodo", period_index("mes"))


def by_month(df, column, id=None):
    rows = df.filter(F.col("id") == id) if id is not None else df
    return {r["mes"]: r[column] for r in rows.collect()}


# --- labels

def presence(make, **months):
    return with_period(make([(int(c[1:]), m, 1.0) for c, ms in months.items() for m in ms], PANEL))


def test_year_change_is_no_gap(make):
    df = presence(make, c1=[201912, 202001, 202002], c2=[202003, 202004])
    got = by_month(labels.churn_label(df), "clase_ternaria", 1)
    assert got == {201912: "CONTINUA", 202001: "BAJA+2", 202002: "BAJA+1"}


def test_gap(make):
    df = presence(make, c1=[202001, 202002, 202004], c2=[202001, 202012])
    got = by_month(labels.churn_label(df), "clase_ternaria", 1)
    assert got[202001] == "BAJA+2" and got[202002] == "BAJA+1"


def test_unknown_tail(make):
    df = presence(make, c1=[202001, 202002, 202003, 202004])
    assert by_month(labels.churn_label(df), "clase_ternaria") == {202001: "CONTINUA", 202002: "CONTINUA", 202003: None, 202004: None}
    stays = by_month(labels.churn_label(df, tail="stays"), "clase_ternaria")
    assert stays[202003] == stays[202004] == "CONTINUA"


def test_vanished_in_the_last_step(make):
    df = presence(make, c1=[202002, 202003], c2=[202004])
    for tail in ("null", "stays"):
        assert by_month(labels.churn_label(df, tail), "clase_ternaria", 1)[202003] == "BAJA+1"


def test_month_label_agrees_with_the_whole(make):
    df = presence(make, c1=[201911, 201912, 202001], c2=[201912], c3=[201912, 202002], c4=[201912, 202001, 202002])
    whole = labels.churn_label(df, "stays").filter("mes = 201912")
    one = labels.month_label(df, 201912)
    assert {(r["id"], r["clase_ternaria"]) for r in whole.collect()} == {(r["id"], r["clase_ternaria"]) for r in one.collect()}


def test_null_label_policy(make):
    df = make([(1, 202001, 1.0)], PANEL).withColumn("c", F.lit(None).cast("string"))
    assert [df.select(labels.binary_target("c", "both", v)).first()[0] for v in (None, 0, 1)] == [None, 0, 1]


def test_bad_arguments(make):
    df = presence(make, c1=[202001])
    with pytest.raises(ValueError):
        labels.churn_label(df, tail="other")
    with pytest.raises(ValueError):
        labels.churn_label(df.drop("mes"))
    with pytest.raises(ValueError):
        history.lags(df, [])
    with pytest.raises(ValueError):
        ranks.signed_rank(df, [])
    with pytest.raises(ValueError):
        panel.keep_months(df, [])
    with pytest.raises(ValueError):
        sampling.split_by_month(labels.churn_label(df), "clase_ternaria", [209901], [202001], [202001])
    with pytest.raises(ValueError):
        panel.attach(df, df.unionByName(df).select("id", "mes"))


# --- history

@pytest.fixture
def five(make):
    return with_period(make([(1, 202000 + i, float(i)) for i in range(1, 6)] + [(2, 202001, 9.0)], PANEL))


def test_frames(five):
    at = lambda df, c: by_month(df, c, 1)[202005]
    assert at(history.rolling_mean(five, ["x"], 3), "x_rolling_mean_3") == 3.0
    assert at(history.moving_stats(five, ["x"], 3), "x_media_3") == 3.5
    assert at(history.trend_pack(five, ["x"], 3), "x_avg3") == 4.0


def test_one_row_customer(five):
    row = history.trend_pack(history.lags(five, ["x"]), ["x"], 6).filter("id = 2").first()
    assert [row[c] for c in ("x_lag_1", "x_delta_1", "x_tend6", "x_min6", "x_max6", "x_avg6")] == [None] * 6


def test_nulls_keep_their_place(make):
    df = with_period(make([(1, 202001, 1.0), (1, 202002, None), (1, 202003, 5.0)], PANEL))
    row = history.trend_pack(df, ["x"], 3).filter("mes = 202003").first()
    assert (row["x_tend3"], row["x_min3"], row["x_max3"], row["x_avg3"]) == (2.0, 1.0, 5.0, 3.0)


def test_lags_count_rows_unless_calendar(make):
    df = with_period(make([(1, 202001, 1.0), (1, 202003, 3.0)], PANEL))
    assert by_month(history.lags(df, ["x"]), "x_lag_1")[202003] == 1.0
    assert by_month(history.lags(df, ["x"], calendar=True), "x_lag_1")[202003] is None


def test_other_customers_change_nothing(make, five):
    more = five.unionByName(with_period(make([(3, 202000 + i, -4.0 * i) for i in range(1, 9)], PANEL)))
    rows = lambda df: sorted(map(tuple, history.trend_pack(df, ["x"], 4).filter("id < 3").collect()), key=str)
    assert rows(five) == rows(more) == rows(more.repartition(7)) == rows(more.coalesce(1))


# --- ranks

def ranked(make, mode, **options):
    values = [-4.0, -2.0, 0.0, 3.0, 3.0, 9.0, None]
    df = make([(i, 202001, v) for i, v in enumerate(values)], PANEL)
    return [r["x"] for r in ranks.signed_rank(df, ["x"], mode, **options).orderBy("id").collect()]


def test_signed_rank(make):
    assert ranked(make, "signed") == [-1.0, 0.0, 0.0, 0.0, 0.0, 1.0, None]


def test_positive_rank(make):
    assert ranked(make, "positive") == [0.0, 1.0, 0.0, 0.0, 0.0, 1.0, None]
    assert ranked(make, "positive", null_rank=0.0)[-1] == 0.0


def test_ranks_stay_on_their_rows(make):
    df = make([(i, 202001 + m, float((i * 7 + m) % 23 - 9)) for i in range(60) for m in range(3)], PANEL)
    got = ranks.signed_rank(df, ["x"], "signed", replace=False).collect()
    for month in (202001, 202002, 202003):
        positive = sorted((r["x"], r["pct_rank_x"]) for r in got if r["mes"] == month and r["x"] > 0)
        assert [p for _, p in positive] == sorted(p for _, p in positive)


# --- per-row features

def test_count_ratio(make):
    df = make([(10.0, 0), (10.0, 2), (10.0, None)], "mpago double, cpago int")
    assert sorted((r["ratio_pago"] for r in features.amounts_per_operation(df).collect()), key=str) == [10.0, 5.0, None]


def test_tenure_factors(make):
    df = make([(t, 10) for t in (1, 2, 3, 4)], "t int, n int")
    got = df.select("t", features.normalised_by_tenure("n", "t").alias("v")).orderBy("t").collect()
    assert [r["v"] for r in got] == [50.0, 20.0, 12.0, 10.0]


def test_zero_months(make):
    df = make([(1, 1, 0.0), (2, 1, None), (1, 2, 0.0), (2, 2, 4.0), (1, 3, None)], PANEL)
    got = quality.repair_zero_months(df, ["x"]).collect()
    assert {(r["id"], r["mes"]): r["x"] for r in got} == {(1, 1): None, (2, 1): None, (1, 2): 0.0, (2, 2): 4.0, (1, 3): None}


def test_exponential_weights(make):
    df = make([(1, 0, 1.0), (1, 1, 1.0), (1, 2, 1.0)], "id long, periodo int, x double")
    got = labels.weight_by_age_of_month(df).orderBy("periodo").collect()
    assert [round(r["peso"], 12) for r in got] == [0.81, 0.9, 1.0]


def test_neutral_columns_keep_their_type(make):
    df = make([(1, 2, 3.0)], PANEL)
    assert features.neutralise(df, ["x"]).schema["x"].dataType == df.schema["x"].dataType


def test_names():
    names = ["id", "mes", "mpago", "cpago", "Master_msaldo", "Visa_mlimite", "ratio_pago", "otro"]
    assert amount_columns(names) == ["mpago", "Master_msaldo", "Visa_mlimite"]
    assert amount_columns(names, ratios=True)[-1] == "ratio_pago"
    assert count_amount_pairs(names) == [("cpago", "mpago")]


def test_nan_is_missing(make):
    assert nan_to_null(make([(1, 1, float("nan"))], PANEL)).first()["x"] is None


def test_index_adjustment_drops_unknown_months(make):
    df = make([(1, 1, 10.0), (1, 2, 10.0), (1, 3, 10.0)], PANEL)
    index = make([(1, 50.0), (2, 100.0)], "mes int, valor_ipc double")
    assert by_month(features.adjust_by_index(df, index, ["x"], 2), "x") == {1: 20.0, 2: 10.0}


# --- gain

@pytest.fixture
def four(make):
    return make([(1, 0.9, 1), (2, 0.8, 0), (3, 0.7, 1), (4, 0.6, 0)], "id long, p double, y int")


def test_curve(four):
    curve = gain.gain_curve(four, "p", "y", ["id"])
    assert [r["gan_acum"] for r in curve.orderBy("pos").collect()] == [780000, 760000, 1540000, 1520000]
    best = gain.best_point(curve, "p").first()
    assert (best["ganancia_max"], best["pos_max"], best["umbral"]) == (1540000, 3, 0.7)


def test_cut_out_of_range(four):
    assert gain.gain_at_cuts(four, "p", "y", ["id"], [2, 10]).orderBy("corte").collect()[1]["ganancia"] is None
    assert gain.gain_at_cuts(four, "p", "y", ["id"], [2, 10], clip=True).orderBy("corte").collect()[1]["ganancia"] == 1520000


def test_plateau_edges(make):
    df = make([(i, 1 - i / 10, i % 2) for i in range(5)], "id long, p double, y int")
    curve = gain.gain_curve(df, "p", "y", ["id"])
    assert gain.plateau(curve, 3).count() == 5
    assert gain.plateau(curve, 3, "drop").count() == 3


def test_plateau_over_many_stretches(spark):
    curve = spark.range(1, 5001).select(F.col("id").alias("pos"), (F.col("id") * F.col("id") % 97).alias("gan_acum"))
    got = {r["pos"]: r["meseta"] for r in gain.plateau(curve, 21).collect()}
    values = [0] + [i * i % 97 for i in range(1, 5001)]
    for pos in (1, 5, 1023, 1024, 1025, 2047, 2048, 4999, 5000):
        around = values[max(1, pos - 10): pos + 11]
        assert got[pos] == sum(around) / len(around)


def test_holdout_scaling(spark):
    rows = spark.range(2939).select((F.col("id") < 172).cast("int").alias("y"), F.lit(1).alias("p"))
    total = gain.gain_of_prediction(rows, "p", "y").select(gain.scaled_up(F.col("ganancia"), 0.3)).first()[0]
    assert int(total) == 262733333


def test_three_ways_of_counting(make):
    df = make([(i, 202001, "BAJA+2" if i % 3 == 0 else "CONTINUA") for i in range(30)], "id long, mes int, c string")
    hit = F.col("c") == "BAJA+2"
    assert df.filter(hit).count() == df.agg(F.sum(hit.cast("int"))).first()[0] == 10
    assert aggregates.class_share(df, hit).first()["share"] == 10 / 30


# --- paired tests

def wilcoxon(make, x, y, **options):
    df = make([("g", float(a), float(b)) for a, b in zip(x, y)], "g string, x double, y double")
    return leaderboard.wilcoxon(df, "x", "y", ["g"], **options).first()


def test_exact_p_of_one_sided_differences(make):
    for n, p in zip(range(1, 9), (1, 0.5, 0.25, 0.125, 0.0625, 0.03125, 0.015625, 0.0078125)):
        assert wilcoxon(make, range(1, n + 1), [0] * n)["p"] == p


def test_exact_p_with_one_negative(make):
    got = wilcoxon(make, [1, -2, 3, 4, 5, 6, 7, 8, 9], [0] * 9)
    assert (got["estadistico"], got["p"]) == (2.0, 0.01171875)


def test_equal_models_are_not_different(make):
    assert wilcoxon(make, [1, 2, 3], [1, 2, 3])["p"] == 1.0


def test_normal_approximation(make):
    # 60 differences 1..60, every third negative: W- = 630, mean 915, sd sqrt(18452.5)
    got = wilcoxon(make, [(-i if i % 3 == 0 else i) for i in range(1, 61)], [0] * 60)
    assert got["estadistico"] == 630.0
    assert abs(got["p"] - 0.035891) < 1e-4


def test_sequential_stops_early(make):
    df = make([("g", i, 10.0 + i, 0.0) for i in range(20)], "g string, run int, x double, y double")
    got = leaderboard.sequential_comparison(df, "x", "y", "run", ["g"]).first()
    assert (got["n_runs"], got["out"], got["p"]) == (6, 1, 0.03125)


# --- samples, drift, sinks

def test_partition_is_exact(make):
    df = make([(i, 202001, "a" if i < 10 else "b") for i in range(20)], "id long, mes int, c string")
    got = sampling.partition(df, [3, 7], ["c"], 5).groupBy("c", "fold").count().collect()
    assert {(r["c"], r["fold"]): r["count"] for r in got} == {("a", 1): 3, ("a", 2): 7, ("b", 1): 3, ("b", 2): 7}


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(500).select("id", F.lit(202001).alias("mes"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    draw = lambda d: {r["id"] for r in sampling.undersample_rows(d, "y", 0.3, 1).collect()}
    assert draw(df) == draw(df.repartition(7)) == draw(df.orderBy(F.desc("id")))
    never = sampling.undersample_customers(df, "y", 0.0, 1)
    assert {r["y"] for r in never.collect()} == {1}


def test_shuffled_canaries_keep_relations(spark):
    df = spark.range(300).select("id", F.lit(202001).alias("mes"), (F.col("id") * 2).alias("a"), (F.col("id") * 3).alias("b"))
    got = sampling.shuffled_canaries(df, ["a", "b"], 3).collect()
    assert all(r["canarito_a"] * 3 == r["canarito_b"] * 2 for r in got)
    assert sorted(r["canarito_a"] for r in got) == sorted(r["a"] for r in got)
    assert sum(r["canarito_a"] == r["a"] for r in got) < 20


def test_hash_uniform_is_uniform(spark):
    got = spark.range(4000).select(hash_uniform("id", F.lit(1)).alias("u")).agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(got[0] - 0.5) < 0.02 and 0 <= got[1] and got[2] < 1


def test_psi_of_equal_months_is_zero(make):
    df = make([(i, m, float(i)) for i in range(100) for m in (1, 2)], PANEL)
    assert quality.psi(df, ["x"], F.col("mes") == 1, F.col("mes") == 2).first()["psi"] == 0.0


def test_psi_of_an_empty_bin(make):
    df = make([(i, 1, float(i)) for i in range(100)] + [(i, 2, 1.0) for i in range(50)], PANEL)
    sides = (F.col("mes") == 1, F.col("mes") == 2)
    assert quality.psi(df, ["x"], *sides).first()["psi"] is None
    assert quality.psi(df, ["x"], *sides, epsilon=1e-4).first()["psi"] > 1


def test_submission_errors(make, tmp_path):
    good = make([(1, 0), (2, 1)], "numero_de_cliente long, Predict int")
    for bad in (good.withColumn("Predict", F.lit(2)), good.drop("Predict"), good.limit(0)):
        with pytest.raises(ValueError):
            writers.write_submission(bad, str(tmp_path / "no"))
    writers.write_submission(good, str(tmp_path / "yes"))


def test_ragged_prediction_files(make, spark, tmp_path):
    for name, extra in (("a", True), ("b", False)):
        (tmp_path / name).mkdir()
        head, tail = ("\tgan_acum", "\t5") if extra else ("", "")
        (tmp_path / name / "prediccion.txt").write_text(f"numero_de_cliente\tprob{head}\n7\t0.5{tail}\n")
    got = readers.read_predictions(spark, str(tmp_path), "prediccion*").collect()
    assert {(r["modelo"], r["prob"], r["gan_acum"]) for r in got} == {("a", 0.5, 5), ("b", 0.5, None)}
    assert {r["filas"] for r in readers.rows_per_file(spark, str(tmp_path), "prediccion*").collect()} == {1}


def test_malformed_rows_are_kept(spark, tmp_path):
    (tmp_path / "p.csv").write_text("id,x\n1,2.5\n2,oops\n")
    got = readers.read_panel(spark, str(tmp_path / "p.csv"), spark.createDataFrame([], "id long, x double").schema)
    assert {r["id"]: r[readers.CORRUPT] for r in got.collect()} == {1: None, 2: "2,oops"}
