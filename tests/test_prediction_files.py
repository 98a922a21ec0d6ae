"""Prediction files are written by as many tasks as their rows fill, and a row's folder is found without a pattern."""

import os

from tidemark.plans import source_queries
from tidemark.plans.tables import Tables
from tidemark.sources import readers

FOLDER = "/root/testdata/sf0.001"


def test_folder_of_a_row_without_pattern(spark, tmp_path):
    for run in ("exp.1", "exp_2"):
        os.makedirs(tmp_path / "deep" / run)
        (tmp_path / "deep" / run / "prediccion.csv").write_text("id\tprob\n1\t0.5\n")
    rows = readers.read_predictions(spark, str(tmp_path), "*.csv")
    assert {r["modelo"] for r in rows.collect()} == {"exp.1", "exp_2"}
    assert "regexp" not in rows._jdf.queryExecution().optimizedPlan().toString().lower()


def test_a_run_is_written_from_its_own_rows(spark, monkeypatch):
    plans, real = [], source_queries.writers.write_csv
    monkeypatch.setattr(source_queries.writers, "write_csv",
                        lambda df, *a, **k: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, *a, **k))
    source_queries.prediction_tree(Tables(spark, FOLDER))
    assert len(plans) == 5 and not any("Repartition" in p or "Filter" in p for p in plans)
