"""Per-row features and column-list operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import KEYS, Keys, count_amount_pairs, ratio, require, require_some

# Factor on the quarterly count for customers of 1, 2 and 3 months.
TENURE_FACTORS = {1: 5.0, 2: 2.0, 3: 1.2}


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*[c for c in columns if c in df.columns])


def neutralise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null out the listed columns that exist; their types stay."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in present}) if present else df


def normalised_by_tenure(count: str, tenure: str, factors: Mapping[int, float] = TENURE_FACTORS) -> Column:
    """Quarterly count scaled up for customers who were not there the whole quarter."""
    scaled = F.col(count).cast("double")
    for months, factor in factors.items():
        scaled = F.when(F.col(tenure) == months, F.col(count) * F.lit(factor)).otherwise(scaled)
    return scaled


def per_age(df: DataFrame, columns: Sequence[str], age: str) -> DataFrame:
    """``{c}_sobre_edad`` for every listed column; null at age 0."""
    require_some(columns, "per_age")
    return df.withColumns({f"{c}_sobre_edad": ratio(F.col(c), F.col(age)) for c in columns})


def amounts_per_operation(df: DataFrame) -> DataFrame:
    """``ratio_X = mX / max(cX, 1)`` for every count cX with an amount mX; null where the count is."""
    pairs = count_amount_pairs(df.columns)
    if not pairs:
        return df
    at_least_one = {c: F.when(F.col(c).isNotNull(), F.greatest(F.col(c), F.lit(1))) for c, _ in pairs}
    return df.withColumns({f"ratio_{c[1:]}": ratio(F.col(m), at_least_one[c]) for c, m in pairs})


def larger(*columns: str) -> Column:
    """Row maximum, nulls skipped."""
    return F.greatest(*[F.col(c) for c in columns])


def smaller(*columns: str) -> Column:
    return F.least(*[F.col(c) for c in columns])


def total(*columns: str, null_as_zero: bool = False) -> Column:
    """Row sum; null if any part is, unless nulls count as 0."""
    out = None
    for c in columns:
        part = F.coalesce(F.col(c), F.lit(0)) if null_as_zero else F.col(c)
        out = part if out is None else out + part
    return out


def z_score(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``{c}_z``: centred and scaled by the sample deviation of the group.

    Group moments are one row per group, joined back, or a scalar for the whole table; no row moves to
    another task unless Spark finds the moments too large to broadcast.
    """
    require_some(columns, "z_score")
    moments = [e for c in columns for e in (F.avg(c).alias(f"_avg_{c}"), F.stddev_samp(c).alias(f"_sd_{c}"))]
    if by:
        joined = df.join(df.groupBy(*by).agg(*moments), list(by), "left")
    else:
        names = [f"{m}_{c}" for c in columns for m in ("_avg", "_sd")]
        whole = df.agg(*moments).select(F.struct(*names)).scalar()
        joined = df.withColumns({n: whole[n] for n in names})
    scaled = {f"{c}_z": F.try_divide(F.col(c) - F.col(f"_avg_{c}"), F.col(f"_sd_{c}")) for c in columns}
    return joined.withColumns(scaled).select(*df.columns, *scaled)


def log_plus_one(column: str) -> Column:
    return F.when(F.col(column) > -1, F.log1p(F.col(column)))


def collinear_copies(df: DataFrame, column: str, factors: Sequence[float]) -> DataFrame:
    return df.select("*", *[(F.col(column) * F.lit(k)).alias(f"{column}_x{i}") for i, k in enumerate(factors, 1)])


def inflate_outliers(column: str, threshold: float, factor: float = 1000.0) -> Column:
    return F.when(F.col(column) > threshold, F.col(column) * F.lit(factor)).otherwise(F.col(column))


def fill_sentinel(df: DataFrame, columns: Sequence[str], sentinel: int = -999) -> DataFrame:
    return df.fillna({c: sentinel for c in columns if c in df.columns})


def zeros_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in columns})


def adjust_by_index(df: DataFrame, index: DataFrame, columns: Sequence[str], reference_month: int,
                    value: str = "valor_ipc", keys: Keys = KEYS) -> DataFrame:
    """Express amounts in prices of the reference month; months the index lacks drop out.

    The index has one row per calendar month, which the reduction below makes certain, so it is safe to
    broadcast. A month with two different values is an error.
    """
    require(index, [keys.month, value])
    by_month = index.groupBy(keys.month).agg(
        F.when(F.min(value) < F.max(value), F.raise_error(F.concat(F.lit("the index has several values for month "), F.first(keys.month).cast("string"))))
        .otherwise(F.max(value)).alias("_index"))
    base = by_month.filter(F.col(keys.month) == reference_month).select("_index").scalar()
    factors = by_month.select(keys.month, ratio(base, F.col("_index")).alias("_factor"))
    adjusted = df.join(F.broadcast(factors), keys.month)
    return adjusted.withColumns({c: F.col(c) * F.col("_factor") for c in columns}).select(*df.columns)
