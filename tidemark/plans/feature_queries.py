"""Registered queries: columns, filters, per-row features, targets and weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import amount_columns, calendar_month, period_index, register_sql_functions
from ..operators import features, labels, panel
from .registry import query
from .tables import AGED, AMOUNTS, DENSE, LABELLED, MEASURES, TRAIN_MONTH, sql


@query("p1_amount_columns", sql("SELECT id, mes, m_total, m_final, m_net FROM panel"))
def _(t):
    df = t.panel()
    return df.select("id", "mes", *amount_columns(df.columns))


@query("p2_drop_columns", sql("SELECT id, mes, periodo, m_total, m_net, c_total FROM panel"))
def _(t):
    return features.drop_columns(t.panel(), ["m_final", "c_final", "not_there"])


@query("p3_neutralise", sql("""SELECT id, mes, periodo, CAST(NULL AS BIGINT) AS m_total, m_final, m_net,
  CAST(NULL AS BIGINT) AS c_total, c_final FROM panel"""))
def _(t):
    return features.neutralise(t.panel(), ["m_total", "c_total", "not_there"])


@query("p4_keep_months", sql("SELECT * FROM panel WHERE mes IN (199801, 199803, 199912)"))
def _(t):
    return panel.keep_months(t.panel(), [199801, 199803, 199912])


@query("p5_keep_month_range", sql("SELECT * FROM panel WHERE mes BETWEEN 199711 AND 199802"))
def _(t):
    return panel.keep_month_range(t.panel(), 199711, 199802)


@query("p6_drop_month_range", sql("SELECT * FROM panel WHERE NOT mes BETWEEN 199601 AND 200012"))
def _(t):
    return panel.drop_month_range(t.panel(), 199601, 200012)


@query("p6_months_outside", sql("SELECT * FROM panel WHERE mes NOT BETWEEN 199601 AND 200012"))
def _(t):
    df = t.panel()
    return panel.keep_months(df, panel.months_outside(panel.months_of(df), 199601, 200012))


@query("p7_calendar_month", sql("SELECT id, mes, mes % 100 AS kmes FROM panel"))
def _(t):
    return t.panel().select("id", "mes", calendar_month("mes").alias("kmes"))


@query("p8_period_index", sql("SELECT id, mes, CAST(mes // 100 * 12 + mes % 100 AS INTEGER) AS periodo0 FROM panel"))
def _(t):
    return t.panel().select("id", "mes", period_index("mes").alias("periodo0"))


@query("p9_normalised_by_tenure", sql("""SELECT id, mes, CASE antiguedad WHEN 1 THEN c_total * 5e0 WHEN 2 THEN c_total * 2e0
  WHEN 3 THEN c_total * 1.2e0 ELSE CAST(c_total AS DOUBLE) END AS normalizado FROM aged""", AGED))
def _(t):
    return t.with_age().select("id", "mes", features.normalised_by_tenure("c_total", "antiguedad").alias("normalizado"))


@query("p10_per_age", sql("SELECT id, mes, " + ", ".join(
    f"CAST({c} AS DOUBLE) / nullif(edad, 0) AS {c}_sobre_edad" for c in AMOUNTS) + " FROM aged", AGED))
def _(t):
    return features.per_age(t.with_age(), AMOUNTS, "edad").select("id", "mes", *[f"{c}_sobre_edad" for c in AMOUNTS])


@query("p11_amounts_per_operation", sql("""SELECT id, mes, CAST(m_total AS DOUBLE) / greatest(c_total, 1) AS ratio__total,
  CASE WHEN c_net IS NOT NULL THEN CAST(m_net AS DOUBLE) / greatest(c_net, 1) END AS ratio__net
FROM (SELECT *, CASE WHEN c_final <> 1 THEN c_final END AS c_net FROM panel)"""))
def _(t):
    counts = t.panel().select("id", "mes", "m_total", "c_total", "m_net",
                              F.when(F.col("c_final") != 1, F.col("c_final")).alias("c_net"))
    return features.amounts_per_operation(counts).select("id", "mes", "ratio__total", "ratio__net")


@query("p12_sql_functions", sql("""SELECT id, mes, coalesce(m_final, 0) + coalesce(CAST(m_net AS DOUBLE), 0) AS suma,
  CAST(m_final AS DOUBLE) / nullif(c_final, 0) AS cociente FROM panel"""))
def _(t):
    register_sql_functions(t.spark)
    t.panel().createOrReplaceTempView("tidemark_panel")
    return t.spark.sql("""SELECT id, mes, sum_ignoring_nulls(m_final, m_net) AS suma,
                          safe_ratio(m_final, c_final) AS cociente FROM tidemark_panel""")


@query("p13_two_column_operations", sql("""SELECT id, mes, greatest(m_final, m_net) AS mayor, least(m_final, m_net) AS menor,
  m_final + m_net AS suma, coalesce(m_final, 0) + coalesce(m_net, 0) AS suma_sin_null FROM panel"""))
def _(t):
    return t.panel().select(
        "id", "mes", features.larger("m_final", "m_net").alias("mayor"), features.smaller("m_final", "m_net").alias("menor"),
        features.total("m_final", "m_net").alias("suma"),
        features.total("m_final", "m_net", null_as_zero=True).alias("suma_sin_null"))


@query("p14_sql_idioms", sql("""SELECT id, mes, m_total, m_net, c_total, CASE WHEN m_net > 0 THEN 'neto' ELSE 'nada' END AS signo,
  m_total * 2 AS doble, m_total * 2 + c_total AS mas FROM panel"""))
def _(t):
    t.panel().createOrReplaceTempView("tidemark_panel")
    return t.spark.sql("""SELECT * EXCEPT (periodo, m_final, c_final), if(m_net > 0, 'neto', 'nada') AS signo,
                          m_total * 2 AS doble, doble + c_total AS mas FROM tidemark_panel""")


@query("p15_binary_targets", sql("""SELECT id, mes,
  CASE WHEN clase_ternaria IS NULL THEN NULL ELSE CAST(clase_ternaria IN ('BAJA+1', 'BAJA+2') AS INTEGER) END AS ambas,
  CAST(coalesce(clase_ternaria = 'BAJA+2', false) AS INTEGER) AS segunda,
  CASE WHEN clase_ternaria = 'CONTINUA' THEN 0 ELSE 1 END AS no_continua FROM labelled""", LABELLED))
def _(t):
    return t.labelled().select("id", "mes", labels.binary_target("clase_ternaria").alias("ambas"),
                               labels.binary_target("clase_ternaria", "after", 0).alias("segunda"),
                               labels.binary_target("clase_ternaria", "both", 1).alias("no_continua"))


@query("p16_gain_column", sql("""SELECT id, mes, CAST(CASE WHEN clase_ternaria = 'BAJA+2' THEN 780000 ELSE -20000 END AS BIGINT) AS ganancia
FROM labelled""", LABELLED))
def _(t):
    return t.labelled().select("id", "mes", labels.gain(F.col("clase_ternaria") == "BAJA+2").alias("ganancia"))


@query("p17_class_weights", sql("""SELECT id, mes,
  CASE clase_ternaria WHEN 'BAJA+2' THEN 2.5e0 WHEN 'BAJA+1' THEN 1.5e0 WHEN 'CONTINUA' THEN 1e0 END AS clase_pesada,
  CASE clase_ternaria WHEN 'BAJA+2' THEN 1.00002e0 WHEN 'BAJA+1' THEN 1.00001e0 WHEN 'CONTINUA' THEN 1e0 END AS peso
FROM labelled""", LABELLED))
def _(t):
    return t.labelled().select("id", "mes", labels.weight_by_class("clase_ternaria").alias("clase_pesada"),
                               labels.weight_by_class("clase_ternaria", labels.TIE_BREAK_WEIGHTS).alias("peso"))


@query("p18_weight_by_month", sql("SELECT id, mes, round(pow(0.9e0, max(periodo) OVER () - periodo), 12) AS peso FROM panel"))
def _(t):
    return labels.weight_by_age_of_month(t.panel()).select("id", "mes", F.round("peso", 12).alias("peso"))


@query("p19_weight_by_customer_month", sql(
    "SELECT id, mes, round(pow(0.9e0, max(periodo) OVER (PARTITION BY id) - periodo), 12) AS peso FROM panel"))
def _(t):
    return labels.weight_by_customer_age(t.panel()).select("id", "mes", F.round("peso", 12).alias("peso"))


@query("p20_weight_switch", sql(f"SELECT id, mes, CASE WHEN mes <= {TRAIN_MONTH} THEN 1 ELSE 0 END AS peso FROM panel"))
def _(t):
    return t.panel().select("id", "mes", labels.weight_switch(TRAIN_MONTH).alias("peso"))


@query("p21_transformations", sql("""SELECT id, mes, round((m_total - avg(m_total) OVER (PARTITION BY mes))
    / nullif(stddev_samp(m_total) OVER (PARTITION BY mes), 0), 9) AS m_total_z,
  round(ln(1 + CAST(c_total AS DOUBLE)), 12) AS c_log, m_net * 2e0 AS m_net_x1, m_net * -0.5e0 AS m_net_x2,
  CASE WHEN m_total > 30000000 THEN m_total * 1000e0 ELSE m_total END AS m_out FROM panel"""))
def _(t):
    scaled = features.z_score(t.panel(), ["m_total"], ["mes"])
    copies = features.collinear_copies(scaled, "m_net", [2.0, -0.5])
    return copies.select("id", "mes", F.round("m_total_z", 9).alias("m_total_z"),
                         F.round(features.log_plus_one("c_total"), 12).alias("c_log"), "m_net_x1", "m_net_x2",
                         features.inflate_outliers("m_total", 30000000).alias("m_out"))


@query("p21_z_score_whole_table", sql(
    "SELECT id, mes, round((m_net - avg(m_net) OVER ()) / stddev_samp(m_net) OVER (), 9) AS m_net_z FROM panel"))
def _(t):
    return features.z_score(t.panel(), ["m_net"]).select("id", "mes", F.round("m_net_z", 9).alias("m_net_z"))


@query("p22_sentinel", sql("SELECT id, mes, coalesce(m_final, -999) AS m_final, m_net FROM panel"))
def _(t):
    return features.fill_sentinel(t.panel(), ["m_final", "m_net"]).select("id", "mes", "m_final", "m_net")


@query("p23_lookup", sql("SELECT id, mes, m_total FROM panel WHERE id = 7 ORDER BY mes"))
def _(t):
    return panel.lookup(t.panel(), F.col("id") == 7, "mes").select("id", "mes", "m_total")


@query("p24_head", sql("SELECT id, mes, m_total FROM panel ORDER BY m_total DESC, id, mes LIMIT 25"))
def _(t):
    return panel.head(t.panel().select("id", "mes", "m_total"), 25, F.desc("m_total"), "id", "mes")


@query("p25_zeros_to_null", sql("SELECT id, mes, " + ", ".join(f"nullif({c}, 0) AS {c}" for c in MEASURES) + " FROM dense", DENSE))
def _(t):
    return features.zeros_to_null(t.dense(), MEASURES).drop("periodo")
