"""Registered queries: counts, pivots, profiles, drift, imputation, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import hash_uniform
from ..operators import aggregates, gain, quality, sampling
from ..operators.panel import keep_months
from .registry import query
from .tables import AMOUNTS, GAIN, LABELLED, MEASURES, SCORED, SCORE_MONTH, SCORES, TRAIN_MONTH, sql, u


# --- counts and pivots

@query("a1_rows_by_month_and_class", sql("SELECT mes, clase_ternaria, count(*) AS n FROM labelled GROUP BY ALL", LABELLED))
def _(t):
    return aggregates.count_by(t.labelled(), "mes", "clase_ternaria")


@query("a1_rows_by_month", sql("SELECT mes, count(*) AS n FROM panel GROUP BY ALL"))
def _(t):
    return aggregates.count_by(t.panel(), "mes")


@query("a2_class_by_month", sql("""SELECT mes, count(*) FILTER (clase_ternaria = 'BAJA+1') AS "BAJA+1",
  count(*) FILTER (clase_ternaria = 'BAJA+2') AS "BAJA+2", count(*) FILTER (clase_ternaria = 'CONTINUA') AS "CONTINUA"
FROM labelled GROUP BY mes""", LABELLED))
def _(t):
    return aggregates.class_by_month(t.labelled())


_SOME_MONTHS = [199801, 199802, 199803, 199804, 199805, 199806]


@query("a3_presence_matrix", sql("SELECT id, " + ", ".join(
    f"CAST(max(CASE WHEN mes = {m} THEN 1 ELSE 0 END) AS INTEGER) AS m_{m}" for m in _SOME_MONTHS) +
    ", count(*) AS meses FROM panel GROUP BY id"))
def _(t):
    return aggregates.presence_matrix(t.panel(), _SOME_MONTHS)


@query("a4_class_share", sql("""SELECT mes, count(*) AS n,
  CAST(count(*) FILTER (clase_ternaria = 'BAJA+1') AS DOUBLE) / count(*) AS share FROM labelled WHERE m_net > 0 GROUP BY mes""", LABELLED))
def _(t):
    return aggregates.class_share(t.labelled(), F.col("clase_ternaria") == "BAJA+1", ["mes"], F.col("m_net") > 0)


@query("a5_lift", sql("""SELECT mes, share_where, share, share_where / nullif(share, 0) AS lift FROM (
  SELECT mes, CAST(count(*) FILTER (y = 1 AND prob < 0.3) AS DOUBLE) / nullif(count(*) FILTER (prob < 0.3), 0) AS share_where,
    CAST(count(*) FILTER (y = 1) AS DOUBLE) / count(*) AS share FROM scored GROUP BY mes)""", SCORED))
def _(t):
    return aggregates.lift(t.scored(), F.col("y") == 1, F.col("prob") < 0.3, ["mes"])


@query("a6_gain_of_rules", sql(" UNION ALL ".join(f"""SELECT '{name}' AS regla, count(*) FILTER ({rule}) AS filas,
  count(*) FILTER ({rule} AND y = 1) AS aciertos, CAST(coalesce(sum({GAIN}) FILTER ({rule}), 0) AS BIGINT) AS ganancia,
  CAST(count(*) FILTER ({rule} AND y = 1) AS DOUBLE) / count(*) FILTER ({rule}) AS share,
  (CAST(count(*) FILTER ({rule} AND y = 1) AS DOUBLE) / count(*) FILTER ({rule})) / (CAST(count(*) FILTER (y = 1) AS DOUBLE) / count(*)) AS lift
  FROM scored""" for name, rule in (("simple", "prob < 0.2"), ("compound", "prob < 0.5 AND mes % 2 = 0"), ("all", "true"))), SCORED))
def _(t):
    p = F.col("prob")
    return gain.gain_of_rule(t.scored(), {"simple": p < 0.2, "compound": (p < 0.5) & (F.col("mes") % 2 == 0), "all": F.lit(True)}, "y")


@query("a7_threshold_sweep", sql(f"""SELECT CAST(t AS DOUBLE) AS umbral, CAST(coalesce(sum({GAIN}) FILTER (c_total < t), 0) AS BIGINT) AS ganancia
FROM (SELECT c_total, CAST(m_final IS NOT NULL AS INTEGER) AS y FROM panel), (SELECT unnest(range(0, 33)) AS t) GROUP BY t"""))
def _(t):
    rows = t.panel().select("c_total", F.col("m_final").isNotNull().cast("int").alias("y"))
    return gain.sweep_below(rows, "c_total", "y", range(33))


_RATES = """CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn) AS accuracy, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision,
  CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall"""
_F1 = "2 * precision * recall / nullif(precision + recall, 0) AS f1"


@query("a8_confusion", sql(f"""SELECT *, {_F1} FROM (SELECT *, {_RATES} FROM (
  SELECT count(*) FILTER (p AND y = 1) AS tp, count(*) FILTER (p AND y = 0) AS fp, count(*) FILTER (NOT p AND y = 0) AS tn,
    count(*) FILTER (NOT p AND y = 1) AS fn FROM (SELECT *, prob > 0.6 AS p FROM scored)))""", SCORED))
def _(t):
    return gain.confusion(t.scored().withColumn("p", (F.col("prob") > 0.6).cast("int")), "p", "y")


@query("a8_guarded_rates", sql("""SELECT *, 2 * "precision" * recall / ("precision" + recall + 1e-10) AS f1 FROM (
  SELECT *, CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn) AS accuracy, tp / (tp + fp + 1e-10) AS "precision", tp / (tp + fn + 1e-10) AS recall FROM (
  SELECT count(*) FILTER (p AND y = 1) AS tp, count(*) FILTER (p AND y = 0) AS fp, count(*) FILTER (NOT p AND y = 0) AS tn,
    count(*) FILTER (NOT p AND y = 1) AS fn FROM (SELECT *, prob > 2 AS p FROM scored)))""", SCORED))
def _(t):
    """Nothing is predicted: the guard keeps the rates at 0."""
    return gain.confusion(t.scored().withColumn("p", (F.col("prob") > 2).cast("int")), "p", "y", guard=1e-10)


@query("a9_rates_by_model", sql(f"""SELECT *, {_F1} FROM (SELECT *, {_RATES} FROM (
  SELECT model, count(*) FILTER (p AND y = 1) AS tp, count(*) FILTER (p AND y = 0) AS fp, count(*) FILTER (NOT p AND y = 0) AS tn,
    count(*) FILTER (NOT p AND y = 1) AS fn
  FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY prob DESC, id, mes) <= 400 AS p FROM scores) GROUP BY model))""", SCORES))
def _(t):
    return gain.rates_of_top(t.scores(), "prob", "y", ["id", "mes"], 400, ["model"])


@query("a10_predicted_counts", sql("""SELECT p, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM scored) AS share
FROM (SELECT CAST(prob > 0.7 AS INTEGER) AS p FROM scored) GROUP BY p""", SCORED))
def _(t):
    return gain.predicted_counts(t.scored().select((F.col("prob") > 0.7).cast("int").alias("p")), "p")


_TRIALS = """trials AS (SELECT CAST(mes % 100 AS INTEGER) AS maxdepth, CAST(mes // 100 % 3 AS INTEGER) AS minsplit, mes AS semilla,
  CAST(sum(m_net) AS BIGINT) AS ganancia FROM panel GROUP BY mes)"""


def trials(t):
    """A trial per month: two parameters, a seed and a gain."""
    return t.panel().groupBy("mes").agg(F.sum("m_net").alias("ganancia")).select(
        (F.col("mes") % 100).alias("maxdepth"), (F.floor(F.col("mes") / 100) % 3).cast("int").alias("minsplit"),
        F.col("mes").alias("semilla"), "ganancia")


@query("a11_grid_summary", sql("""SELECT *, row_number() OVER (ORDER BY media DESC, maxdepth, minsplit) AS id FROM (
  SELECT maxdepth, minsplit, CAST(sum(ganancia) AS DOUBLE) / count(ganancia) AS media, count(*) AS repeticiones FROM trials GROUP BY 1, 2)""", _TRIALS))
def _(t):
    return aggregates.grid_summary(trials(t), ["maxdepth", "minsplit"], "ganancia")


@query("a12_trial_statistics", sql("""SELECT count(ganancia) AS n, max(ganancia) AS mejor, min(ganancia) AS peor,
  CAST(sum(ganancia) AS DOUBLE) / count(ganancia) AS media FROM trials""", _TRIALS))
def _(t):
    return aggregates.trial_statistics(trials(t), "ganancia")


@query("a12_best_trials", sql("SELECT * FROM trials ORDER BY ganancia DESC, semilla LIMIT 5", _TRIALS))
def _(t):
    return aggregates.best_trials(trials(t), "ganancia", 5, "semilla")


_SEGMENTED = f"""segmented AS (SELECT l.*, {u('id', 'mes', 1)} AS prob, CAST(floor({u('id', 3)} * 4) AS INTEGER) AS segmento FROM labelled l)"""


def segmented(t):
    return t.labelled().withColumns({"prob": hash_uniform("id", "mes", F.lit(1)),
                                     "segmento": F.floor(hash_uniform("id", F.lit(3)) * 4).cast("int")})


@query("a13_class_by_segment", sql("""SELECT segmento, count(*) FILTER (clase_ternaria = 'BAJA+1') AS "BAJA+1",
  count(*) FILTER (clase_ternaria = 'BAJA+2') AS "BAJA+2", count(*) FILTER (clase_ternaria = 'CONTINUA') AS "CONTINUA",
  sum(prob) / count(prob) AS prob_media FROM segmented GROUP BY segmento""", LABELLED, _SEGMENTED))
def _(t):
    return aggregates.class_by_segment(segmented(t), "segmento", "clase_ternaria", "prob")


@query("a14_segment_vs_rest", sql("SELECT * FROM (" + " UNION ALL ".join(f"""SELECT segmento = 2 AS en_segmento, '{c}' AS "column", count({c}) AS n,
  CAST(sum({c}) AS DOUBLE) / count({c}) AS media, round(stddev_samp({c}), 2) AS desvio, CAST(min({c}) AS DOUBLE) AS minimo, CAST(max({c}) AS DOUBLE) AS maximo,
  count(DISTINCT {c}) AS distintos, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS mediana,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75, count(*) - count({c}) AS faltantes FROM segmented GROUP BY 1""" for c in MEASURES) + ")", LABELLED, _SEGMENTED))
def _(t):
    table = aggregates.segment_vs_rest(segmented(t), MEASURES, F.col("segmento") == 2)
    return table.withColumns({"desvio": F.round("desvio", 2), "q25": F.round("q25", 4), "q75": F.round("q75", 4)})


@query("a15_medians_by_segment", sql("SELECT segmento, " + ", ".join(
    f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in MEASURES) + " FROM segmented GROUP BY segmento", LABELLED, _SEGMENTED))
def _(t):
    return aggregates.medians_by(segmented(t), MEASURES, ["segmento"])


# --- quality and drift

def _shares(test: str) -> str:
    def one(c: str, m: int) -> str:
        return f"CAST(count(*) FILTER (mes = {m} AND {test.format(c=c)}) AS DOUBLE) / count(*) FILTER (mes = {m}) * 100"

    return "SELECT *, abs(score_pct - train_pct) AS diff FROM (" + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {one(c, TRAIN_MONTH)} AS train_pct, {one(c, SCORE_MONTH)} AS score_pct FROM panel""" for c in MEASURES) + ")"


@query("d1_null_share", sql(_shares("{c} IS NULL")))
def _(t):
    return quality.null_share(t.panel(), MEASURES, TRAIN_MONTH, SCORE_MONTH)


@query("d2_zero_share", sql(_shares("coalesce({c} = 0, false)")))
def _(t):
    return quality.zero_share(t.panel(), MEASURES, TRAIN_MONTH, SCORE_MONTH)


@query("d3_zero_months", sql(" UNION ALL ".join(
    f"""SELECT mes, '{c}' AS "column" FROM broken GROUP BY mes HAVING max(abs({c})) = 0""" for c in ("m_net", "c_final", "c_total")),
    "broken AS (SELECT mes, CASE WHEN mes % 100 = 6 THEN m_net * 0 ELSE m_net END AS m_net, "
    "CASE WHEN mes < 199504 THEN 0 ELSE c_final END AS c_final, c_total FROM panel)"))
def _(t):
    broken = t.panel().select("id", "mes", "c_total", F.when(F.col("mes") % 100 == 6, F.col("m_net") * 0).otherwise(F.col("m_net")).alias("m_net"),
                              F.when(F.col("mes") < 199504, 0).otherwise(F.col("c_final")).alias("c_final"))
    return quality.zero_month_report(broken, ["m_net", "c_final", "c_total"])


_QS = "[" + ", ".join(f"{i / 10}" for i in range(11)) + "]"


def _psi_ctes(expected: str, actual: str, columns) -> list[str]:
    long = " UNION ALL ".join(f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS value, {expected} AS e, {actual} AS a FROM panel""" for c in columns)
    return [
        f"long AS (SELECT * FROM ({long}) WHERE e OR a)",
        f"""edges AS (SELECT "column", list_sort(list_distinct(quantile_cont(value, {_QS}))) AS ed FROM long WHERE e AND value IS NOT NULL GROUP BY 1)""",
        """bins AS (SELECT "column", ed, unnest(range(1, greatest(len(ed), 2))) AS bin FROM edges)""",
        """counted AS (SELECT b."column", b.bin, ed[b.bin] AS low, ed[b.bin + 1] AS high,
  count(*) FILTER (l.e) AS n_expected, count(*) FILTER (l.a) AS n_actual
FROM bins b LEFT JOIN long l ON l."column" = b."column" AND ((l.value >= ed[b.bin] AND l.value < ed[b.bin + 1])
  OR ((b.bin = len(ed) - 1 OR len(ed) = 1) AND l.value = ed[len(ed)]))
GROUP BY 1, 2, 3, 4)""",
        """sizes AS (SELECT "column", count(*) FILTER (e) AS e0, count(*) FILTER (a) AS a0, count(value) FILTER (e) AS e1, count(value) FILTER (a) AS a1 FROM long GROUP BY 1)""",
    ]


_PSI = """SELECT c."column", round(CASE WHEN count(term) = count(*) THEN sum(term) END
    + CASE WHEN any_value(e0 > e1 AND a0 > a1) THEN any_value((CAST(a0 - a1 AS DOUBLE) / a0 - CAST(e0 - e1 AS DOUBLE) / e0)
      * ln(nullif(CAST(a0 - a1 AS DOUBLE) / a0, 0) / nullif(CAST(e0 - e1 AS DOUBLE) / e0, 0))) ELSE 0 END, 9) AS psi
FROM (SELECT counted.*, sizes.* EXCLUDE ("column"), CASE WHEN n_actual > 0 AND n_expected > 0 THEN
    (CAST(n_actual AS DOUBLE) / a1 - CAST(n_expected AS DOUBLE) / e1) * ln((CAST(n_actual AS DOUBLE) / a1) / (CAST(n_expected AS DOUBLE) / e1)) END AS term
  FROM counted JOIN sizes USING ("column")) c GROUP BY 1"""


def _psi(t, columns):
    year = F.floor(F.col("mes") / 100)
    return quality.psi(t.panel(), columns, year == 1996, year == 1999).withColumn("psi", F.round("psi", 9))


@query("d4_psi", sql(_PSI, *_psi_ctes("mes // 100 = 1996", "mes // 100 = 1999", ["m_total"])))
def _(t):
    return _psi(t, ["m_total"])


@query("d5_psi_all_columns", sql(_PSI, *_psi_ctes("mes // 100 = 1996", "mes // 100 = 1999", MEASURES)))
def _(t):
    return _psi(t, MEASURES)


@query("d6_bin_counts", sql("SELECT * REPLACE (round(low, 4) AS low, round(high, 4) AS high) FROM counted", *_psi_ctes(f"mes = {TRAIN_MONTH}", f"mes = {SCORE_MONTH}", AMOUNTS)))
def _(t):
    return quality.bin_counts(t.panel(), AMOUNTS, F.col("mes") == TRAIN_MONTH, F.col("mes") == SCORE_MONTH).withColumns(
        {"bin": F.col("bin").cast("long"), "low": F.round("low", 4), "high": F.round("high", 4)})


@query("d7_histogram", sql("""SELECT clase_ternaria, bin, n, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY clase_ternaria) AS share FROM (
  SELECT clase_ternaria, CASE WHEN m_total < 1000000 THEN 0 WHEN m_total >= 41000000 THEN 21
    ELSE CAST(floor((m_total - 1000000) / 2000000e0) AS BIGINT) + 1 END AS bin, count(*) AS n FROM labelled WHERE m_total IS NOT NULL GROUP BY 1, 2)""", LABELLED))
def _(t):
    return quality.histogram(t.labelled(), "m_total", 1000000, 41000000, 20, ["clase_ternaria"])


@query("d7_histogram_whole", sql("""SELECT bin, n, CAST(n AS DOUBLE) / sum(n) OVER () AS share FROM (
  SELECT CASE WHEN m_net < -20000000 THEN 0 WHEN m_net >= 20000000 THEN 11
    ELSE CAST(floor((m_net + 20000000) / 4000000e0) AS BIGINT) + 1 END AS bin, count(*) AS n FROM panel WHERE m_net IS NOT NULL GROUP BY 1)"""))
def _(t):
    return quality.histogram(t.panel(), "m_net", -20000000, 20000000, 10)


@query("d7_five_numbers", sql("""SELECT clase_ternaria, count(m_total) AS size, quantile_cont(CAST(m_total AS DOUBLE), 0) AS min, round(quantile_cont(CAST(m_total AS DOUBLE), 0.25), 4) AS q25,
  quantile_cont(CAST(m_total AS DOUBLE), 0.5) AS median, round(quantile_cont(CAST(m_total AS DOUBLE), 0.75), 4) AS q75, quantile_cont(CAST(m_total AS DOUBLE), 1) AS max
FROM labelled GROUP BY 1""", LABELLED))
def _(t):
    box = quality.five_numbers(t.labelled(), "m_total", ["clase_ternaria"])
    return box.withColumns({"q25": F.round("q25", 4), "q75": F.round("q75", 4)})


def _imputed(fill: str) -> str:
    return sql("SELECT id, mes, " + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), (SELECT {fill.format(c=c)} FROM panel WHERE mes < 199901)) AS {c}" for c in ("m_final", "m_net")) +
        " FROM panel")


def _impute(t, strategy):
    df = t.panel().select("id", "mes", "m_final", "m_net")
    return quality.impute(df, df.filter("mes < 199901"), ["m_final", "m_net"], strategy)


@query("d10_impute_median", _imputed("quantile_cont(CAST({c} AS DOUBLE), 0.5)"))
def _(t):
    return _impute(t, "median")


@query("d10_impute_mean", _imputed("CAST(sum({c}) AS DOUBLE) / count({c})"))
def _(t):
    return _impute(t, "mean")


@query("d10_impute_mode", sql("""SELECT id, mes, coalesce(CAST(c AS DOUBLE), (SELECT CAST(c AS DOUBLE) FROM counts WHERE mes < 199901 AND c IS NOT NULL
    GROUP BY c ORDER BY count(*) DESC, c LIMIT 1)) AS c FROM counts""",
    "counts AS (SELECT id, mes, CASE WHEN m_net > 0 THEN c_total END AS c FROM panel)"))
def _(t):
    df = t.panel().select("id", "mes", F.when(F.col("m_net") > 0, F.col("c_total")).alias("c"))
    return quality.impute(df, df.filter("mes < 199901"), ["c"], "mode")


# --- samples

_TARGET = "targeted AS (SELECT *, CAST(m_final IS NOT NULL AS INTEGER) AS y FROM panel)"


def targeted(t):
    return t.panel().withColumn("y", F.col("m_final").isNotNull().cast("int"))


@query("x1_undersample_rows", sql(f"SELECT id, mes, y FROM targeted WHERE y <> 0 OR {u('id', 'mes', 42)} < 0.2e0", _TARGET))
def _(t):
    return sampling.undersample_rows(targeted(t), "y", 0.2, 42).select("id", "mes", "y")


@query("x2_undersample_customers", sql(f"""SELECT id, mes FROM panel WHERE id IN (SELECT id FROM ids WHERE ever)
OR id IN (SELECT id FROM (SELECT id, row_number() OVER (ORDER BY {u('id', 42)}, id) AS pos, count(*) OVER () AS n FROM ids WHERE NOT ever)
  WHERE pos <= floor(n * 0.3e0))""", "ids AS (SELECT id, max(m_total) > 45000000 AS ever FROM panel GROUP BY id)"))
def _(t):
    flagged = t.panel().withColumn("y", (F.col("m_total") > 45000000).cast("int"))
    return sampling.undersample_customers(flagged, "y", 0.3, 42).select("id", "mes")


@query("x3_split_by_month", sql(f"""SELECT 'train' AS parte, id, mes, CAST(coalesce(clase_ternaria IN ('BAJA+1', 'BAJA+2'), false) AS INTEGER) AS target
  FROM labelled WHERE mes IN (199801, 199802, 199803) AND (coalesce(clase_ternaria IN ('BAJA+1', 'BAJA+2'), false) OR {u('id', 'mes', 11)} < 0.5e0)
UNION ALL SELECT 'validate', id, mes, CAST(coalesce(clase_ternaria = 'BAJA+2', false) AS INTEGER) FROM labelled WHERE mes = 199805
UNION ALL SELECT 'future', id, mes, CAST(coalesce(clase_ternaria = 'BAJA+2', false) AS INTEGER) FROM labelled WHERE mes = 199807""", LABELLED))
def _(t):
    parts = sampling.split_by_month(t.labelled(), "clase_ternaria", [199801, 199802, 199803], [199805], [199807], 0.5, 11)
    tagged = [p.select(F.lit(n).alias("parte"), "id", "mes", "target") for n, p in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query("x4_canaries", sql("SELECT id, mes, " + ", ".join(f"{u('id', 'mes', i, 5)} AS canarito_{i}" for i in (1, 2, 3)) + " FROM panel"))
def _(t):
    return sampling.canaries(t.panel(), 3, 5).select("id", "mes", "canarito_1", "canarito_2", "canarito_3")


def _shuffled(partition: str) -> str:
    rows = [f"SELECT *, row_number() OVER ({partition} ORDER BY {u('id', 'mes', 9, turn)}, id, mes) AS lugar FROM panel" for turn in (0, 1)]
    using = "(mes, lugar)" if partition else "(lugar)"
    return f"""SELECT a.id, {'mes' if partition else 'a.mes'} AS mes, b.m_total AS canarito_m_total, b.c_total AS canarito_c_total
FROM ({rows[0]}) a JOIN ({rows[1]}) b USING {using}"""


@query("x5_shuffled_canaries", sql(_shuffled("")))
def _(t):
    return sampling.shuffled_canaries(t.panel(), ["m_total", "c_total"], 9).select("id", "mes", "canarito_m_total", "canarito_c_total")


@query("x5_shuffled_canaries_by_month", sql(_shuffled("PARTITION BY mes")))
def _(t):
    return sampling.shuffled_canaries(t.panel(), ["m_total", "c_total"], 9, True).select("id", "mes", "canarito_m_total", "canarito_c_total")


@query("x6_partition", sql(f"""SELECT id, mes, CASE WHEN (row_number() OVER (PARTITION BY clase_ternaria ORDER BY {u('id', 'mes', 17)}, id, mes) - 1) % 10 < 3
  THEN 1 ELSE 2 END AS fold FROM labelled""", LABELLED))
def _(t):
    return sampling.partition(t.labelled(), [3, 7], ["clase_ternaria"], 17).select("id", "mes", "fold")


_REPEATED = f"""repeated AS (SELECT *, {u('id', 'mes', 'split', 23)} AS r FROM scored, (SELECT CAST(unnest(range(0, 20)) AS INTEGER) AS split))"""


@query("x7_stratified_shuffle_splits", sql("""SELECT id, mes, split, CASE WHEN row_number() OVER (PARTITION BY split, y ORDER BY r, id, mes)
  <= round(count(*) OVER (PARTITION BY split, y) * 0.3e0) THEN 'test' ELSE 'train' END AS side FROM repeated""", SCORED, _REPEATED))
def _(t):
    return sampling.shuffle_splits(t.scored(), 20, 0.3, 23, ["y"]).select("id", "mes", "split", "side")


@query("x8_shuffle_splits", sql("""SELECT id, mes, split, CASE WHEN row_number() OVER (PARTITION BY split ORDER BY r, id, mes)
  <= round(count(*) OVER (PARTITION BY split) * 0.3e0) THEN 'test' ELSE 'train' END AS side FROM repeated""", SCORED, _REPEATED))
def _(t):
    return sampling.shuffle_splits(t.scored(), 20, 0.3, 23).select("id", "mes", "split", "side")


@query("x9_balanced_sample", sql(f"""SELECT id, mes, y FROM targeted WHERE y <> 0
UNION ALL SELECT id, mes, y FROM (SELECT * FROM targeted WHERE y = 0 ORDER BY {u('id', 'mes', 3)}, id, mes LIMIT 2000)""", _TARGET))
def _(t):
    return sampling.balanced_sample(targeted(t), "y", 2000, 3).select("id", "mes", "y")


@query("x10_month_holdout", sql(f"""SELECT id, mes, CASE WHEN (row_number() OVER (PARTITION BY clase_ternaria ORDER BY {u('id', 'mes', 4)}, id, mes) - 1) % 100 < 70
  THEN 1 ELSE 2 END AS fold FROM labelled WHERE mes = {TRAIN_MONTH}""", LABELLED))
def _(t):
    return sampling.partition(keep_months(t.labelled(), TRAIN_MONTH), [70, 30], ["clase_ternaria"], 4).select("id", "mes", "fold")
