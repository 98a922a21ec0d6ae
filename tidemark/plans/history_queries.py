"""Registered queries: customer history, joins and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, features, history, labels, leaderboard, panel, quality, ranks
from . import chains
from .registry import query
from .tables import AMOUNTS, DENSE, LABELLED, MEASURES, SCORED, TRAIN_MONTH, sql

W = "(PARTITION BY id ORDER BY periodo)"


def _each(template: str, columns=MEASURES) -> str:
    return ", ".join(template.format(c=c) for c in columns)


def _frame(lo: str, hi: str) -> str:
    return f"(PARTITION BY id ORDER BY periodo ROWS BETWEEN {lo} AND {hi})"


def _mean(c: str, frame: str) -> str:
    return f"CAST(sum({c}) OVER {frame} AS DOUBLE) / nullif(count({c}) OVER {frame}, 0)"


def _slope(c: str, x: str, frame: str) -> str:
    """Least squares from integer sums in wide integers, divided once."""
    known = f"CASE WHEN {c} IS NOT NULL THEN CAST({x} AS HUGEINT) END"
    n, sx, sy = f"count({c}) OVER {frame}", f"sum({known}) OVER {frame}", f"sum(CAST({c} AS HUGEINT)) OVER {frame}"
    sxx, sxy = f"sum(({known}) * ({known})) OVER {frame}", f"sum(({known}) * {c}) OVER {frame}"
    return f"CAST({n} * {sxy} - {sx} * {sy} AS DOUBLE) / nullif(CAST({n} * {sxx} - {sx} * {sx} AS DOUBLE), 0)"


# --- lags, leads and moving statistics

@query("w1_lags", sql("SELECT id, mes, " + _each(
    f"lag({{c}}, 1) OVER {W} AS {{c}}_lag_1, lag({{c}}, 2) OVER {W} AS {{c}}_lag_2") + " FROM panel"))
def _(t):
    lagged = history.lags(t.panel(), MEASURES, (1, 2), deltas=False)
    return lagged.select("id", "mes", *[f"{c}_lag_{j}" for c in MEASURES for j in (1, 2)])


@query("w2_deltas", sql("SELECT id, mes, " + _each(
    f"{{c}} - lag({{c}}, 1) OVER {W} AS {{c}}_delta_1, {{c}} - lag({{c}}, 2) OVER {W} AS {{c}}_delta_2") + " FROM panel"))
def _(t):
    lagged = history.lags(t.panel(), MEASURES, (1, 2))
    return lagged.select("id", "mes", *[f"{c}_delta_{j}" for c in MEASURES for j in (1, 2)])


@query("w3_lag_set", sql("SELECT id, mes, " + ", ".join(
    f"lag(m_total, {j}) OVER {W} AS m_total_lag_{j}, m_total - lag(m_total, {j}) OVER {W} AS m_total_delta_{j}"
    for j in (1, 2, 3, 6, 12)) + " FROM panel"))
def _(t):
    lagged = history.lags(t.panel(), ["m_total"], (1, 2, 3, 6, 12))
    return lagged.drop("periodo", *MEASURES)


@query("w4_calendar_lags", sql("SELECT id, mes, " + ", ".join(
    f"CASE WHEN lag(periodo, {j}) OVER {W} = periodo - {j} THEN lag(m_total, {j}) OVER {W} END AS m_total_lag_{j}"
    for j in (1, 2)) + " FROM panel"))
def _(t):
    lagged = history.lags(t.panel(), ["m_total"], (1, 2), deltas=False, calendar=True)
    return lagged.select("id", "mes", "m_total_lag_1", "m_total_lag_2")


@query("w5_leads", sql(f"SELECT id, mes, lead(m_total, 1) OVER {W} AS m_total_lead_1, "
                       f"lead(m_total, 2) OVER {W} AS m_total_lead_2 FROM panel"))
def _(t):
    return history.leads(t.panel(), ["m_total"]).select("id", "mes", "m_total_lead_1", "m_total_lead_2")


@query("w6_rolling_mean", sql("SELECT id, mes, " + ", ".join(
    f"{_mean(c, _frame('3 PRECEDING', '1 PRECEDING'))} AS {c}_rolling_mean_3" for c in MEASURES) + " FROM panel"))
def _(t):
    return history.rolling_mean(t.panel(), MEASURES, 3).select("id", "mes", *[f"{c}_rolling_mean_3" for c in MEASURES])


_F4 = _frame("3 PRECEDING", "CURRENT ROW")


@query("w7_moving_stats", sql("SELECT id, mes, " + ", ".join(
    f"{_mean(c, _F4)} AS {c}_media_3, max({c}) OVER {_F4} AS {c}_max_3, min({c}) OVER {_F4} AS {c}_min_3"
    for c in AMOUNTS) + " FROM panel"))
def _(t):
    return history.moving_stats(t.panel(), AMOUNTS, 3).drop("periodo", *MEASURES)


_F6 = _frame("5 PRECEDING", "CURRENT ROW")


def _two(c: str, expression: str) -> str:
    return f"CASE WHEN count({c}) OVER {_F6} >= 2 THEN {expression} END"


_NUMBERED = f"numbered AS (SELECT *, row_number() OVER {W} AS rn FROM dense)"
_NUMBERED_PANEL = f"numbered AS (SELECT *, row_number() OVER {W} AS rn FROM panel)"


def _pack(c: str) -> str:
    return (f"{_two(c, _slope(c, 'rn', _F6))} AS {c}_tend6, {_two(c, f'min({c}) OVER {_F6}')} AS {c}_min6, "
            f"{_two(c, f'max({c}) OVER {_F6}')} AS {c}_max6, {_two(c, _mean(c, _F6))} AS {c}_avg6")


@query("w8_trend_pack", sql("SELECT id, mes, " + ", ".join(_pack(c) for c in MEASURES) + " FROM numbered", _NUMBERED_PANEL))
def _(t):
    return history.trend_pack(t.panel(), MEASURES, 6).drop("periodo", *MEASURES)


@query("w8_trend_pack_dense", sql("SELECT id, mes, " + ", ".join(_pack(c) for c in AMOUNTS) + " FROM numbered",
                                  DENSE, _NUMBERED))
def _(t):
    return history.trend_pack(t.dense(), AMOUNTS, 6).drop("periodo", *MEASURES)


@query("w9_window_ratios", sql("SELECT id, mes, " + ", ".join(
    f"CAST({c} AS DOUBLE) / nullif({_two(c, _mean(c, _F6))}, 0) AS {c}_ratioavg6, "
    f"CAST({c} AS DOUBLE) / nullif(CAST({_two(c, f'max({c}) OVER {_F6}')} AS DOUBLE), 0) AS {c}_ratiomax6"
    for c in AMOUNTS) + " FROM panel"))
def _(t):
    return history.trend_pack(t.panel(), AMOUNTS, 6, trend=False, minimum=False, maximum=False, mean=False,
                              ratio_mean=True, ratio_max=True).drop("periodo", *MEASURES)


@query("w10_period_trend", sql("SELECT id, mes, " + ", ".join(
    f"{_slope(c, 'px', _F4)} AS {c}_trend_3m" for c in AMOUNTS) + " FROM placed",
    f"placed AS (SELECT *, periodo - first(periodo) OVER {W} AS px FROM panel)"))
def _(t):
    return history.period_trend(t.panel(), AMOUNTS, 3).drop("periodo", *MEASURES)


@query("w11_trend_against_tenure", sql("SELECT id, mes, " + ", ".join(
    f"{_slope(c, 'rn', _F4)} AS {c}_slope_3" for c in MEASURES) + " FROM numbered", _NUMBERED_PANEL))
def _(t):
    numbered = history.tenure(t.panel())
    return history.trend_against(numbered, MEASURES, "antiguedad", 3).drop("periodo", "antiguedad", *MEASURES)


@query("w12_simple_trend_pack", sql("SELECT id, mes, " + ", ".join(
    f"{c} - lag({c}, 5) OVER {W} AS {c}_tend6, {_two(c, f'min({c}) OVER {_F6}')} AS {c}_min6, "
    f"{_two(c, f'max({c}) OVER {_F6}')} AS {c}_max6, {_two(c, _mean(c, _F6))} AS {c}_avg6" for c in AMOUNTS) + " FROM panel"))
def _(t):
    return history.simple_trend_pack(t.panel(), AMOUNTS, 6).drop("periodo", *MEASURES)


# --- ranks

def _sign_rank(c: str, negative: str) -> str:
    rank = f"percent_rank() OVER (PARTITION BY mes, sign({c}) ORDER BY {c})"
    return f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} = 0 THEN 0e0 WHEN {c} < 0 THEN {rank}{negative} ELSE {rank} END"


@query("w13_positive_rank", sql("SELECT id, mes, " + ", ".join(f"{_sign_rank(c, '')} AS {c}" for c in AMOUNTS) + " FROM panel"))
def _(t):
    return ranks.signed_rank(t.panel(), AMOUNTS).select("id", "mes", *AMOUNTS)


@query("w13_positive_rank_dense", sql("SELECT id, mes, " + ", ".join(
    f"coalesce({_sign_rank(c, '')}, 0e0) AS pct_rank_{c}" for c in MEASURES) + " FROM dense", DENSE))
def _(t):
    ranked = ranks.signed_rank(t.dense(), MEASURES, replace=False, null_rank=0.0)
    return ranked.select("id", "mes", *[f"pct_rank_{c}" for c in MEASURES])


@query("w14_signed_rank", sql("SELECT id, mes, " + ", ".join(f"{_sign_rank(c, ' - 1')} AS {c}" for c in AMOUNTS) + " FROM panel"))
def _(t):
    return ranks.signed_rank(t.panel(), AMOUNTS, "signed").select("id", "mes", *AMOUNTS)


@query("w15_whole_month_rank", sql("""
SELECT id, mes, CASE WHEN m_net IS NULL THEN NULL WHEN m_net = 0 THEN 0e0
  ELSE (rank() OVER (PARTITION BY mes ORDER BY m_net) + (count(*) OVER (PARTITION BY mes, m_net) - 1) / 2e0)
       / (sign(m_net) * count(*) OVER (PARTITION BY mes, sign(m_net))) END AS m_net
FROM panel"""))
def _(t):
    return ranks.signed_rank(t.panel(), ["m_net"], "whole_month").select("id", "mes", "m_net")


@query("w16_month_position", sql(f"""
SELECT id, mes, antiguedad, percent_rank() OVER m AS percent_rank, cume_dist() OVER m AS cume_dist,
       CAST(ntile(4) OVER (PARTITION BY mes ORDER BY antiguedad, id) AS INTEGER) AS ntile_4,
       CAST(ntile(10) OVER (PARTITION BY mes ORDER BY antiguedad, id) AS INTEGER) AS ntile_10
FROM (SELECT *, CAST(row_number() OVER {W} AS INTEGER) AS antiguedad FROM panel)
WINDOW m AS (PARTITION BY mes ORDER BY antiguedad)"""))
def _(t):
    return ranks.month_position(history.tenure(t.panel()).select("id", "mes", "antiguedad"), "antiguedad")


@query("w17_zero_month_repair", sql("SELECT id, mes, periodo, m_total, " + ", ".join(
    f"CASE WHEN max(abs({c})) OVER (PARTITION BY mes) <> 0 THEN {c} END AS {c}" for c in ("m_final", "c_final")) +
    " FROM zeroed", DENSE,
    "zeroed AS (SELECT id, mes, periodo, m_total, CASE WHEN mes % 100 = 3 THEN m_final * 0 ELSE m_final END AS m_final, "
    "CASE WHEN mes % 100 = 5 THEN c_final * 0 ELSE c_final END AS c_final FROM dense)"))
def _(t):
    kmes = F.col("mes") % 100
    zeroed = t.dense().select("id", "mes", "periodo", "m_total",
                              F.when(kmes == 3, F.col("m_final") * 0).otherwise(F.col("m_final")).alias("m_final"),
                              F.when(kmes == 5, F.col("c_final") * 0).otherwise(F.col("c_final")).alias("c_final"))
    return quality.repair_zero_months(zeroed, ["m_final", "c_final"])


@query("w18_mean_by_runs", sql("""
SELECT mes, row_number() OVER w AS n_runs,
       CAST(sum(g) OVER (PARTITION BY mes ORDER BY semilla ROWS UNBOUNDED PRECEDING) AS DOUBLE) / row_number() OVER w AS media
FROM (SELECT id % 20 AS semilla, mes, CAST(sum(CASE WHEN y = 1 THEN 780000 ELSE -20000 END) AS BIGINT) AS g
      FROM scored GROUP BY 1, 2) WINDOW w AS (PARTITION BY mes ORDER BY semilla)""", SCORED))
def _(t):
    runs = t.scored().withColumn("semilla", F.col("id") % 20).groupBy("semilla", "mes").agg(
        F.sum(labels.gain(F.col("y") == 1)).alias("g"))
    return leaderboard.running_mean_by_runs(runs, "semilla", "g", ["mes"])


# --- labels and joins

_EXISTS = """SELECT id, mes, CASE
    WHEN periodo <= fin - 1 AND NOT EXISTS (SELECT 1 FROM panel b WHERE b.id = a.id AND b.periodo = a.periodo + 1) THEN 'BAJA+1'
    WHEN periodo <= fin - 2 AND NOT EXISTS (SELECT 1 FROM panel b WHERE b.id = a.id AND b.periodo = a.periodo + 2) THEN 'BAJA+2'
    ELSE 'CONTINUA' END AS clase_ternaria
FROM (SELECT *, (SELECT max(periodo) FROM panel) AS fin FROM panel) a"""


@query("j1_label_existence", sql(_EXISTS))
def _(t):
    return labels.churn_label(t.panel(), tail="stays").select("id", "mes", "clase_ternaria")


@query("j2_label_lead", sql("SELECT id, mes, clase_ternaria FROM labelled", LABELLED))
def _(t):
    return t.labelled().select("id", "mes", "clase_ternaria")


@query("j3_month_label", sql(f"SELECT * FROM ({_EXISTS}) WHERE mes = 199812"))
def _(t):
    return labels.month_label(t.panel(), 199812)


_GRID = """grid AS (SELECT i.id, m.mes, CASE WHEN p.id IS NULL THEN 0 ELSE 1 END AS mes_0
  FROM (SELECT DISTINCT id FROM panel) i CROSS JOIN (SELECT DISTINCT mes FROM panel) m
  LEFT JOIN panel p ON p.id = i.id AND p.mes = m.mes)"""


@query("j4_presence_grid", sql("SELECT id, mes, mes_0 AS present FROM grid", _GRID))
def _(t):
    return panel.grid(t.panel())


@query("j5_presence_leads", sql("""SELECT * FROM (SELECT id, mes, mes_0, lead(mes_0, 1) OVER w AS mes_1,
  lead(mes_0, 2) OVER w AS mes_2 FROM grid WINDOW w AS (PARTITION BY id ORDER BY mes)) WHERE mes_0 = 1""", _GRID))
def _(t):
    return panel.presence_leads(t.panel())


@query("j6_above_own_mean", sql("""SELECT p.id, mes, CASE WHEN m_total > media THEN 'mayor' ELSE 'menor' END AS comparacion
FROM panel p JOIN (SELECT id, CAST(sum(m_total) AS DOUBLE) / count(m_total) AS media FROM panel GROUP BY id) q USING (id)"""))
def _(t):
    return history.above_own_mean(t.panel(), "m_total").select("id", "mes", "comparacion")


_INDEX = """idx AS (SELECT mes, CAST(sum(m_total) % 900 + 100 AS DOUBLE) AS valor_ipc FROM panel
  WHERE mes % 100 <> 2 GROUP BY mes)"""


def price_index(t):
    """A price per month, February missing."""
    return t.panel().filter("mes % 100 <> 2").groupBy("mes").agg(
        (F.sum("m_total") % 900 + 100).cast("double").alias("valor_ipc"))


@query("j7_price_index", sql("""SELECT id, mes, periodo, m_total * factor AS m_total, m_final * factor AS m_final,
  m_net * factor AS m_net, c_total, c_final
FROM panel JOIN (SELECT mes, (SELECT valor_ipc FROM idx WHERE mes = 199901) / valor_ipc AS factor FROM idx) USING (mes)""", _INDEX))
def _(t):
    return features.adjust_by_index(t.panel(), price_index(t), AMOUNTS, 199901)


@query("j8_prediction_with_truth", sql("""SELECT s.id, s.mes, s.prob, l.clase_ternaria FROM scored s
LEFT JOIN (SELECT * FROM labelled WHERE mes % 2 = 0) l ON l.id = s.id AND l.mes = s.mes""", SCORED, LABELLED))
def _(t):
    truth = t.labelled().filter("mes % 2 = 0").select("id", "mes", "clase_ternaria")
    return t.scored().select("id", "mes", "prob").join(truth, ["id", "mes"], "left")


@query("j9_future_customers", sql(f"SELECT id, mes, prob FROM scored WHERE id IN (SELECT id FROM panel WHERE mes = {TRAIN_MONTH})", SCORED))
def _(t):
    alive = panel.keep_months(t.panel(), TRAIN_MONTH).select("id").distinct()
    return t.scored().select("id", "mes", "prob").join(alive, "id", "left_semi")


@query("j10_ever_and_never", sql("""SELECT DISTINCT id, 'ever' AS grupo FROM labelled WHERE clase_ternaria = 'BAJA+2'
UNION ALL SELECT DISTINCT id, 'never' FROM labelled WHERE id NOT IN (SELECT id FROM labelled WHERE clase_ternaria = 'BAJA+2')""", LABELLED))
def _(t):
    labelled = t.labelled()
    ever = labelled.filter("clase_ternaria = 'BAJA+2'").select("id").distinct()
    everyone = t.panel().select("id").distinct()
    return everyone.join(ever, "id", "left_semi").withColumn("grupo", F.lit("ever")).unionByName(
        everyone.join(ever, "id", "left_anti").withColumn("grupo", F.lit("never")))


@query("j11_stack_snapshots", sql("""SELECT id, mes, m_total, CASE WHEN mes >= 199901 THEN c_total END AS c_total FROM panel"""))
def _(t):
    old = t.panel().filter("mes < 199901").select("id", "mes", "m_total")
    new = t.panel().filter("mes >= 199901").select("id", "mes", "m_total", "c_total")
    return panel.stack_snapshots(old, new)


@query("j12_distinct_counts", sql("""SELECT 'id' AS "column", count(DISTINCT id) AS n_distinct FROM panel
UNION ALL SELECT 'mes', count(DISTINCT mes) FROM panel UNION ALL SELECT 'm_final', count(DISTINCT m_final) FROM panel"""))
def _(t):
    return panel.distinct_counts(t.panel(), ["id", "mes", "m_final"])


@query("j12_distinct_months", sql("SELECT DISTINCT mes FROM panel"))
def _(t):
    return panel.distinct_values(t.panel(), "mes")


@query("j13_attach", sql("SELECT a.*, b.prob FROM panel a LEFT JOIN (SELECT * FROM scored WHERE prob < 0.5) b USING (id, mes)", SCORED))
def _(t):
    return panel.attach(t.panel(), t.scored().filter("prob < 0.5").select("id", "mes", "prob"))


_ALIGNED = """firsts AS (SELECT id, min(periodo) AS baja FROM labelled WHERE clase_ternaria = 'BAJA+2' GROUP BY id),
aligned AS (SELECT l.*, CAST(l.periodo - baja - 2 AS INTEGER) AS meses_hasta_baja FROM labelled l JOIN firsts USING (id)
  WHERE l.periodo - baja - 2 < 0)"""


@query("j14_history_before_leaving", sql("SELECT id, mes, m_total, meses_hasta_baja FROM aligned", LABELLED, _ALIGNED))
def _(t):
    return aggregates.months_to_churn(t.labelled(), "clase_ternaria").select("id", "mes", "m_total", "meses_hasta_baja")


@query("a16_mean_before_leaving", sql("""SELECT meses_hasta_baja, segmento, CAST(sum(m_total) AS DOUBLE) / count(m_total) AS media,
  count(*) AS n FROM (SELECT *, CAST(id % 3 AS INTEGER) AS segmento FROM aligned) GROUP BY 1, 2""", LABELLED, _ALIGNED))
def _(t):
    aligned = aggregates.months_to_churn(t.labelled(), "clase_ternaria")
    return aggregates.mean_by(aligned.withColumn("segmento", (F.col("id") % 3).cast("int")), "m_total", "meses_hasta_baja", "segmento")


_RANKED = "ranked AS (SELECT id, mes, periodo, " + ", ".join(f"{_sign_rank(c, '')} AS {c}" for c in AMOUNTS) + ", c_total, c_final FROM panel)"


def _engineered(c: str) -> str:
    frame = _frame("3 PRECEDING", "1 PRECEDING")
    mean = f"sum({c}) OVER {frame} / nullif(count({c}) OVER {frame}, 0)"
    return (f"{c}, round({mean}, 9) AS {c}_rolling_mean_3, lag({c}) OVER {W} AS {c}_lag_1, "
            f"round({c} - lag({c}) OVER {W}, 9) AS {c}_delta_1")


@query("feature_chain", sql(f"""SELECT r.id, r.mes, {', '.join(f'r.{c}, {c}_rolling_mean_3, {c}_lag_1, {c}_delta_1' for c in AMOUNTS)}, l.clase_ternaria
FROM (SELECT id, mes, {', '.join(_engineered(c) for c in AMOUNTS)} FROM ranked) r JOIN ({_EXISTS}) l ON l.id = r.id AND l.mes = r.mes""", _RANKED))
def _(t):
    made = chains.engineer_features(t.panel())
    kept = [f"{c}{s}" for c in AMOUNTS for s in ("", "_rolling_mean_3", "_lag_1", "_delta_1")]
    return made.select("id", "mes", "clase_ternaria", *[
        F.round(c, 9).alias(c) if c.endswith(("_3", "_delta_1")) else F.col(c) for c in kept])
