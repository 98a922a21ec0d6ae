"""Registered queries: files written from the panel and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gain
from ..session import materialize, scratch_path
from ..sources import readers, writers
from .aggregate_queries import _TRIALS, trials
from .gain_queries import CURVE, CURVES, TIES, curve, curves
from .history_queries import _INDEX, price_index
from .registry import query
from .tables import MEASURES, SCORED, SCORES, sql

_LONGS = ["id", *MEASURES]


def _long(df):
    return df.withColumns({c: F.col(c).cast("long") for c in df.columns if c in _LONGS})


@query("s1_read_panel", sql("SELECT * FROM panel"))
def _(t):
    path = writers.write_csv(t.panel(), scratch_path(t.spark, "panel"), compress=True)
    return _long(readers.read_panel(t.spark, path, partitions=8))


@query("s1_read_panel_with_schema", sql("SELECT * EXCLUDE (periodo), periodo FROM panel"))
def _(t):
    panel = t.panel().drop("periodo")
    path = writers.write_csv(panel, scratch_path(t.spark, "panel"))
    return readers.read_panel(t.spark, path, panel.schema, month="mes").drop(readers.CORRUPT)


@query("s2_csv_view", sql("SELECT mes, count(*) AS n, CAST(sum(m_total) AS BIGINT) AS total FROM panel GROUP BY mes"))
def _(t):
    path = writers.write_csv(t.panel(), scratch_path(t.spark, "view"))
    readers.csv_view(t.spark, path, "tidemark_csv")
    return t.spark.sql("SELECT mes, count(*) AS n, CAST(sum(m_total) AS BIGINT) AS total FROM tidemark_csv GROUP BY mes")


@query("s3_read_index", sql("SELECT mes AS foto_mes, valor_ipc FROM idx", _INDEX))
def _(t):
    raw = price_index(t).select(F.col("mes").alias("Periodo"), F.col("valor_ipc").alias("Indice_ipc"), F.lit("x").alias("nota"))
    path = writers.write_csv(raw, scratch_path(t.spark, "index"))
    return readers.read_index(t.spark, path, rename={"Periodo": "foto_mes", "Indice_ipc": "valor_ipc"})


def prediction_tree(t) -> str:
    """Prediction files of several runs: production files lack the running gain."""
    root, all_runs = scratch_path(t.spark, "predictions"), scratch_path(t.spark, "curves")
    # a folder per run, so that a run's files are written from its own rows only, by as many tasks as they fill
    curves(t).select("id", "mes", "model", "prob", "gan_acum").write.partitionBy("model").parquet(all_runs)
    for m in range(1, 6):
        run = t.spark.read.parquet(f"{all_runs}/model={m}").select("id", "mes", F.lit(m).alias("meta_modelo"), "prob", "gan_acum")
        run = run if m < 3 else run.drop("gan_acum")
        writers.write_csv(run, f"{root}/exp{m}", sep="\t")
    return root


@query("s4_read_predictions", sql("""SELECT 'exp' || model AS modelo, id, mes, model AS meta_modelo, prob,
  CASE WHEN model < 3 THEN gan_acum END AS gan_acum FROM curves""", SCORES, CURVES))
def _(t):
    rows = readers.read_predictions(t.spark, prediction_tree(t), "*.csv")
    return rows.withColumns({"id": F.col("id").cast("long"), "gan_acum": F.col("gan_acum").cast("long")})


@query("s5_rows_per_file", sql("SELECT 'exp' || model AS modelo, count(*) AS filas FROM scores GROUP BY model", SCORES))
def _(t):
    counts = readers.rows_per_file(t.spark, prediction_tree(t), "*.csv")
    return counts.groupBy(F.regexp_extract("archivo", r"([^/]+)/[^/]+$", 1).alias("modelo")).agg(F.sum("filas").alias("filas"))


@query("s6_write_csv", sql("SELECT id, mes, m_total, m_final FROM panel"))
def _(t):
    slim = t.panel().select("id", "mes", "m_total", "m_final")
    path = writers.write_csv(slim, scratch_path(t.spark, "out"), compress=True)
    return t.spark.read.schema(slim.schema).option("header", True).csv(path)


@query("s7_append_scores", sql("SELECT * FROM scores", SCORES))
def _(t):
    path = scratch_path(t.spark, "log")
    for m in range(1, 6):
        writers.append_scores(t.scores().filter(F.col("model") == m), path, "model")
    return t.spark.read.schema("id long, mes int, prob double, y int, model int").option("header", True).option("sep", "\t").csv(path)


@query("s8_submission", sql("SELECT id AS numero_de_cliente, CAST(max(prob) > 0.9 AS INTEGER) AS \"Predict\" FROM scored GROUP BY id", SCORED))
def _(t):
    rows = t.scored().groupBy(F.col("id").alias("numero_de_cliente")).agg((F.max("prob") > 0.9).cast("int").alias("Predict"))
    path = writers.write_submission(rows, scratch_path(t.spark, "submission"))
    return t.spark.read.schema("numero_de_cliente long, Predict int").option("header", True).csv(path)


@query("s9_id_list", sql("SELECT id FROM (SELECT id, max(prob) AS prob FROM scored GROUP BY id) ORDER BY prob DESC, id LIMIT 300", SCORED))
def _(t):
    best = t.scored().groupBy("id").agg(F.max("prob").alias("prob"))
    path = writers.write_id_list(best, scratch_path(t.spark, "ids"), "id", "prob", 300)
    return t.spark.read.schema("id long").csv(path)


@query("s10_experiment_registry", sql(" UNION ALL ".join(f"""SELECT 'exp{m}' AS experimento,
  max(CASE WHEN pos = 50 THEN CAST(gan_acum AS DOUBLE) END) AS e50, max(CASE WHEN pos = 500 THEN CAST(gan_acum AS DOUBLE) END) AS e500
FROM curves WHERE model = {m}""" for m in range(1, 6)), SCORES, CURVES))
def _(t):
    path = scratch_path(t.spark, "registry")
    for m in range(1, 6):
        cuts = gain.gain_at_cuts(t.scores().filter(F.col("model") == m), "prob", "y", TIES, [50, 500], ["model"])
        means = cuts.groupBy("corte").agg(F.avg("ganancia").alias("ganancia_media"))
        writers.append_registry(means, f"exp{m}", path)
    return writers.registry_table(t.spark.read.parquet(path), [50, 500])


def trial_log(t) -> str:
    path = scratch_path(t.spark, "trials")
    rows = trials(t).select(F.col("semilla").alias("trial_number"), (F.col("maxdepth") / 2).alias("num_leaves_exp"),
                            (F.col("minsplit") * 1.25).alias("min_child_samples_exp"), F.col("ganancia").cast("double").alias("value"),
                            F.lit("COMPLETE").alias("state"))
    for half in (0, 1):
        writers.append_json(rows.filter(F.col("trial_number") % 2 == half), path)
    return path


@query("s11_trial_log", sql("""SELECT CAST(semilla AS BIGINT) AS trial_number, maxdepth / 2e0 AS num_leaves_exp, minsplit * 1.25e0 AS min_child_samples_exp,
  CAST(ganancia AS DOUBLE) AS value, 'COMPLETE' AS state FROM trials""", _TRIALS))
def _(t):
    return readers.read_trials(t.spark, trial_log(t))


@query("m10_top_trials", sql("""SELECT CAST(semilla AS BIGINT) AS trial_number, CAST(greatest(2, round_even(pow(2, maxdepth / 2e0), 0)) AS INTEGER) AS num_leaves,
  CAST(greatest(1, round_even(pow(2, minsplit * 1.25e0), 0)) AS INTEGER) AS min_child_samples, CAST(ganancia AS DOUBLE) AS value, 'COMPLETE' AS state
FROM trials ORDER BY value DESC, trial_number LIMIT 7""", _TRIALS))
def _(t):
    return readers.top_trials(readers.read_trials(t.spark, trial_log(t)), 7, "value", "trial_number")


@query("s12_test_records", sql("SELECT CAST(model AS BIGINT) AS model, max(gan_acum) AS ganancia_max, count(*) AS filas FROM curves GROUP BY model", SCORES, CURVES))
def _(t):
    path = scratch_path(t.spark, "results")
    points = gain.best_point(curves(t), "prob", ["model"])
    writers.append_json(points.select("model", "ganancia_max", "filas"), path)
    return t.spark.read.json(path)


@query("s12_study_report", sql("""SELECT (SELECT count(*) FROM scored WHERE y = 1) AS positivos, (SELECT count(*) FROM scored) AS filas,
  gan_acum AS ganancia_max, pos AS pos_max, prob AS umbral,
  (SELECT CAST(sum(CASE WHEN y = 1 THEN 780000 ELSE -20000 END) AS BIGINT) FROM scored WHERE prob > 0.025e0) AS ganancia_umbral
FROM curve ORDER BY gan_acum DESC, pos LIMIT 1""", SCORED, CURVE))
def _(t):
    return gain.study_report(t.scored(), "prob", "y", TIES)


@query("s13_export_curve", sql("SELECT pos, gan_acum, prob FROM curve", SCORED, CURVE))
def _(t):
    path = writers.export_curve(curve(t), scratch_path(t.spark, "curve"), "prob")
    return t.spark.read.schema("pos long, gan_acum long, prob double").option("header", True).csv(path)
