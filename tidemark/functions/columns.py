"""Column expressions and column-name selection shared by all operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Keys:
    """Names of the panel key: one row per customer and month."""

    id: str = "id"
    month: str = "mes"
    period: str = "periodo"

    @property
    def pair(self) -> list[str]:
        return [self.id, self.month]

    def history(self) -> WindowSpec:
        """Customer history in calendar order.

        The panel key is unique, so a customer never has more rows than the panel has months and the
        window stays small however many raw records the customer produced.
        """
        return Window.partitionBy(self.id).orderBy(self.period)


KEYS = Keys()

# Name patterns of amount columns and the key columns they never include.
AMOUNT_PATTERN = r"^m|Master_m|Visa_m"
RATIO_PATTERN = r"ratio_"
NEVER_AMOUNTS = ("numero_de_cliente", "foto_mes")


def period_index(month: Column | str) -> Column:
    """yyyymm to a consecutive month number."""
    month = F.col(month) if isinstance(month, str) else month
    return (F.floor(month / 100) * 12 + month % 100).cast("int")


def calendar_month(month: str) -> Column:
    return F.col(month) % 100


def amount_columns(columns: Iterable[str], ratios: bool = False, keys: Keys = KEYS) -> list[str]:
    """Names that denote amounts; ``ratios`` also takes the per-operation ratios."""
    pattern = re.compile(f"{AMOUNT_PATTERN}|{RATIO_PATTERN}" if ratios else AMOUNT_PATTERN)
    excluded = {*NEVER_AMOUNTS, keys.id, keys.month, keys.period}
    return [c for c in columns if pattern.search(c) and c not in excluded]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def count_amount_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    """(count, amount) names that differ only in the leading c / m."""
    known = set(columns)
    return [(c, "m" + c[1:]) for c in columns if c.startswith("c") and "m" + c[1:] in known]


def require(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def require_some(columns: Sequence[str], what: str) -> None:
    if not columns:
        raise ValueError(f"{what}: the column list is empty")


def hash_uniform(*parts: Column | str | int) -> Column:
    """Uniform number in [0, 1) drawn from the row's own key.

    It does not depend on partitioning, task order or retries, which ``rand(seed)`` does.
    """
    texts = [(p if isinstance(p, Column) else F.col(p) if isinstance(p, str) else F.lit(p)).cast("string")
             for p in parts]
    digest = F.substring(F.md5(F.concat_ws("|", *texts)), 1, 8)
    return F.conv(digest, 16, 10).cast("long") / F.lit(4294967296.0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null where the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing everywhere; keep NULL as the only missing value."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def register_sql_functions(spark: SparkSession) -> None:
    """SQL-side helpers: a sum that takes null as 0 and a quotient that is null on zero."""
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION sum_ignoring_nulls(a DOUBLE, b DOUBLE) RETURNS DOUBLE
                 RETURN coalesce(a, 0) + coalesce(b, 0)""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION safe_ratio(a DOUBLE, b DOUBLE) RETURNS DOUBLE
                 RETURN try_divide(a, b)""")
