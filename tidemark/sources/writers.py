"""Writing tables, score logs, submissions and run records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import require
from ..operators.ordering import running_totals


def write_csv(df: DataFrame, path: str, compress: bool = False, sep: str = ",", header: bool = True,
              mode: str = "errorifexists") -> str:
    writer = df.write.mode(mode).option("header", header).option("sep", sep)
    writer.csv(path, compression="gzip" if compress else "none")
    return path


def append_scores(scores: DataFrame, path: str, model: str = "modelo", sep: str = "\t") -> str:
    """Add the scores of a run to the prediction log, one folder per model."""
    scores.write.mode("append").partitionBy(model).option("header", True).option("sep", sep).csv(path)
    return path


def check_submission(df: DataFrame, id: str, predicted: str) -> DataFrame:
    """The submission with both columns as integers; raises if it cannot be one."""
    require(df, [id, predicted])
    typed = df.select(F.col(id).cast("long").alias(id), F.col(predicted).cast("int").alias(predicted))
    rows, bad = typed.agg(F.count(F.lit(1)), F.count_if(F.col(id).isNull() | ~F.coalesce(
        F.col(predicted).isin(0, 1), F.lit(False)))).first()
    if rows == 0:
        raise ValueError("the submission is empty")
    if bad:
        raise ValueError(f"{bad} rows have no id or a {predicted} other than 0 and 1")
    return typed


def write_submission(df: DataFrame, path: str, id: str = "numero_de_cliente", predicted: str = "Predict") -> str:
    return write_csv(check_submission(df, id, predicted), path)


def write_id_list(df: DataFrame, path: str, id: str, prob: str, top: int) -> str:
    """Ids of the first ``top`` rows, without header."""
    first = running_totals(df.select(id, prob), prob, [id], descending=True, top=top)
    return write_csv(first.select(id), path, header=False)


def append_json(df: DataFrame, path: str) -> str:
    """Add records to a JSON-lines log: trials, test results."""
    df.write.mode("append").json(path)
    return path


def append_record(spark: SparkSession, record: Mapping, path: str) -> str:
    """Add one record given as a mapping."""
    return append_json(spark.createDataFrame([dict(record)]).coalesce(1), path)


def append_registry(mean_gains: DataFrame, experiment: str, path: str) -> str:
    """Add the mean gain per cut of one experiment to the registry."""
    rows = mean_gains.select(F.lit(experiment).alias("experimento"), "corte", "ganancia_media")
    rows.write.mode("append").parquet(path)
    return path


def registry_table(registry: DataFrame, cuts: Sequence[int]) -> DataFrame:
    """One row per experiment, one column ``e{cut}`` per cut."""
    return registry.groupBy("experimento").agg(
        *[F.max(F.when(F.col("corte") == c, F.col("ganancia_media"))).alias(f"e{c}") for c in cuts])


def export_curve(curve: DataFrame, path: str, prob: str) -> str:
    """Points of the gain curve for plotting: position, running gain, probability."""
    return write_csv(curve.select("pos", "gan_acum", prob), path)
