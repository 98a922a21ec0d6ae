"""Churn labels read off future presence, training targets and row weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import KEYS, Keys, require

# The three classes, the two class weightings, the campaign's gain and cost.
LEAVES_NEXT, LEAVES_AFTER, STAYS = "BAJA+1", "BAJA+2", "CONTINUA"
CLASS_WEIGHTS = {"BAJA+2": 2.5, "BAJA+1": 1.5, "CONTINUA": 1.0}
TIE_BREAK_WEIGHTS = {"BAJA+2": 1.00002, "BAJA+1": 1.00001, "CONTINUA": 1.0}
HIT, CONTACT = 780000, 20000


def last_period(df: DataFrame, keys: Keys = KEYS) -> Column:
    """Latest period of the whole panel, as a scalar subquery over the period column alone."""
    return df.select(F.max(keys.period)).scalar()


def churn_label(df: DataFrame, tail: str = "null", keys: Keys = KEYS, label: str = "clase_ternaria") -> DataFrame:
    """Label each row by the customer's presence one and two months ahead.

    Absent next month: ``BAJA+1``. Present next month, absent the month after: ``BAJA+2``. Otherwise
    ``CONTINUA``. Where the panel ends before the answer is known the label is null (``tail="null"``)
    or ``CONTINUA`` (``tail="stays"``).
    """
    if tail not in ("null", "stays"):
        raise ValueError("tail is 'null' or 'stays'")
    require(df, [keys.id, keys.month, keys.period])
    period, end, history = F.col(keys.period), last_period(df, keys), keys.history()
    unknown = F.lit(STAYS) if tail == "stays" else F.lit(None).cast("string")
    next_1, next_2 = F.lead(keys.period, 1).over(history), F.lead(keys.period, 2).over(history)
    here_1 = F.coalesce(next_1 == period + 1, F.lit(False))
    here_2 = F.coalesce(next_2 == period + 2, F.lit(False))
    return df.withColumn(
        label,
        F.when(period >= end, unknown)
        .when(~here_1, F.lit(LEAVES_NEXT))
        .when(period + 1 >= end, unknown)
        .when(~here_2, F.lit(LEAVES_AFTER))
        .otherwise(F.lit(STAYS)),
    )


def month_label(df: DataFrame, month: int, keys: Keys = KEYS, label: str = "clase_ternaria") -> DataFrame:
    """Label of a single month; only that month and the two after it are read."""
    end = last_period(df, keys)
    start = month // 100 * 12 + month % 100
    near = df.filter(F.col(keys.period).between(start, start + 2)).select(keys.id, keys.month, keys.period)
    seen = near.groupBy(keys.id).agg(
        F.max(F.when(F.col(keys.period) == start, F.col(keys.month))).alias(keys.month),
        *[F.max((F.col(keys.period) == start + k).cast("int")).alias(f"_in_{k}") for k in (1, 2)])
    return seen.filter(F.col(keys.month).isNotNull()).select(
        keys.id, keys.month,
        F.when((F.col("_in_1") == 0) & (F.lit(start) < end), LEAVES_NEXT)
        .when((F.col("_in_2") == 0) & (F.lit(start + 1) < end), LEAVES_AFTER)
        .otherwise(STAYS).alias(label))


def binary_target(label: str, rule: str = "both", null_label: int | None = None) -> Column:
    """0/1 target. ``both``: either leaving class is 1; ``after``: only ``BAJA+2`` is 1.

    A null label becomes ``null_label``, so 0, 1 or null are all the caller's choice.
    """
    positive = {"both": [LEAVES_NEXT, LEAVES_AFTER], "after": [LEAVES_AFTER]}[rule]
    return F.when(F.col(label).isNull(), F.lit(null_label).cast("int")).otherwise(
        F.col(label).isin(positive).cast("int"))


def gain(truth: Column, hit: int = HIT, contact: int = CONTACT) -> Column:
    """What contacting the row earns or costs."""
    return F.when(truth, F.lit(hit)).otherwise(F.lit(-contact)).cast("long")


def weight_by_class(label: str, weights: dict[str, float] = CLASS_WEIGHTS) -> Column:
    chosen = F.lit(None).cast("double")
    for name, weight in weights.items():
        chosen = F.when(F.col(label) == name, F.lit(weight)).otherwise(chosen)
    return chosen


def weight_by_age_of_month(df: DataFrame, alpha: float = 0.9, keys: Keys = KEYS, out: str = "peso") -> DataFrame:
    """alpha^k for rows k months before the panel's last month."""
    return df.withColumn(out, F.pow(F.lit(alpha), last_period(df, keys) - F.col(keys.period)))


def weight_by_customer_age(df: DataFrame, alpha: float = 0.9, keys: Keys = KEYS, out: str = "peso") -> DataFrame:
    """alpha^k for rows k months before the customer's own last month."""
    last = F.max(keys.period).over(Window.partitionBy(keys.id))
    return df.withColumn(out, F.pow(F.lit(alpha), last - F.col(keys.period)))


def weight_switch(last_training_month: int, keys: Keys = KEYS) -> Column:
    """1 up to the last training month, 0 after it."""
    return F.when(F.col(keys.month) <= last_training_month, 1).otherwise(0)
