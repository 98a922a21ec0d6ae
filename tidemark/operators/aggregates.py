"""Counts, pivots and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import KEYS, Keys, ratio
from ..session import materialize
from .labels import LEAVES_AFTER, LEAVES_NEXT, STAYS
from .ordering import exact_quantiles, running_totals, to_long

CLASSES = (LEAVES_NEXT, LEAVES_AFTER, STAYS)


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def class_by_month(df: DataFrame, label: str = "clase_ternaria", classes: Sequence[str] = CLASSES,
                   keys: Keys = KEYS) -> DataFrame:
    """Months as rows, classes as columns, absent combinations 0. Stating the classes spares a scan."""
    return df.groupBy(keys.month).pivot(label, list(classes)).count().fillna(0, list(classes))


def presence_matrix(df: DataFrame, months: Sequence[int], keys: Keys = KEYS) -> DataFrame:
    """One 0/1 column per month and the number of months present, per customer."""
    here = {m: F.max((F.col(keys.month) == m).cast("int")) for m in months}
    wide = df.groupBy(keys.id).agg(*[F.coalesce(e, F.lit(0)).alias(f"m_{m}") for m, e in here.items()],
                                   F.count(F.lit(1)).alias("meses"))
    return wide


def class_share(df: DataFrame, condition: Column, by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """Share of rows that meet a condition, among those that meet ``where``."""
    base = df if where is None else df.filter(where)
    return base.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                                 ratio(F.count_if(condition), F.count(F.lit(1))).alias("share"))


def lift(df: DataFrame, condition: Column, where: Column, by: Sequence[str]) -> DataFrame:
    """Share under ``where`` over the share in the whole group, in one pass."""
    inside = ratio(F.count_if(condition & where), F.count_if(where))
    whole = ratio(F.count_if(condition), F.count(F.lit(1)))
    return df.groupBy(*by).agg(inside.alias("share_where"), whole.alias("share"), F.try_divide(inside, whole).alias("lift"))


def grid_summary(trials: DataFrame, parameters: Sequence[str], value: str) -> DataFrame:
    """Mean and number of repetitions per parameter tuple, best first, numbered.

    The tuples are those of a parameter grid, so the numbering is over a short table.
    """
    means = trials.groupBy(*parameters).agg(ratio(F.sum(value), F.count(value)).alias("media"), F.count(F.lit(1)).alias("repeticiones"))
    return running_totals(means, "media", list(parameters), descending=True, position="id")


def trial_statistics(trials: DataFrame, value: str) -> DataFrame:
    return trials.agg(F.count(value).alias("n"), F.max(value).alias("mejor"), F.min(value).alias("peor"),
                      ratio(F.sum(value), F.count(value)).alias("media"))


def best_trials(trials: DataFrame, value: str, n: int, *ties: str) -> DataFrame:
    return trials.orderBy(F.desc(value), *ties).limit(n)


def class_by_segment(df: DataFrame, segment: str, label: str, prob: str, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Class counts and mean probability per segment."""
    counts = [F.count_if(F.col(label) == c).alias(c) for c in classes]
    return df.groupBy(segment).agg(*counts, ratio(F.sum(prob), F.count(prob)).alias("prob_media"))


def segment_vs_rest(df: DataFrame, columns: Sequence[str], inside: Column) -> DataFrame:
    """Count, mean, deviation, min, quartiles, max, distinct and missing of a segment and of the rest."""
    columns = list(columns)
    # read several times below: written once, with only the columns described
    flagged = materialize(df.select(F.coalesce(inside, F.lit(False)).alias("en_segmento"), *columns), "segment")
    long = to_long(flagged, ["en_segmento"], columns)
    by = ["en_segmento", "column"]
    # + 0.0: both zeros are one value
    moments = long.groupBy(*by).agg(F.count_distinct(F.col("value") + F.lit(0.0)).alias("distintos"), F.count(F.lit(1)).alias("n"), ratio(F.sum("value"), F.count("value")).alias("media"),
                                    F.stddev_samp("value").alias("desvio"), F.min("value").alias("minimo"),
                                    F.max("value").alias("maximo"))
    quartiles = exact_quantiles(flagged, columns, [0.25, 0.5, 0.75], ["en_segmento"], written=True).select(
        *by, F.col("q0").alias("q25"), F.col("q1").alias("mediana"), F.col("q2").alias("q75"))
    sizes = flagged.groupBy("en_segmento").agg(F.count(F.lit(1)).alias("_rows"))
    return (moments.join(quartiles, by).join(sizes, "en_segmento")
            .withColumn("faltantes", F.col("_rows") - F.col("n")).drop("_rows"))


def medians_by(df: DataFrame, columns: Sequence[str], by: Sequence[str], approximate: bool = False) -> DataFrame:
    """Median of each column per group, one column each."""
    if approximate:
        return df.groupBy(*by).agg(*[F.percentile_approx(c, 0.5).alias(c) for c in columns])
    table = exact_quantiles(df, columns, [0.5], by)
    return table.groupBy(*by).agg(*[F.max(F.when(F.col("column") == c, F.col("q0"))).alias(c) for c in columns])


def months_to_churn(df: DataFrame, label: str, ahead: int = 2, positive: str = LEAVES_AFTER,
                    keys: Keys = KEYS) -> DataFrame:
    """History of the customers who leave, up to their absence: ``meses_hasta_baja`` is negative.

    The absence starts ``ahead`` months after the customer's first positive row. Differences are taken on
    the month number, so they hold across years.
    """
    first = F.min(F.when(F.col(label) == positive, F.col(keys.period)))
    left = df.groupBy(keys.id).agg(first.alias("_left")).filter("_left is not null")
    aligned = df.join(left, keys.id).withColumn("meses_hasta_baja", F.col(keys.period) - F.col("_left") - ahead)
    return aligned.filter("meses_hasta_baja < 0").drop("_left")


def mean_by(df: DataFrame, value: str, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(ratio(F.sum(value), F.count(value)).alias("media"), F.count(F.lit(1)).alias("n"))

