"""The panel itself: build, check, combine, enumerate, lay out as a grid."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import KEYS, Keys, require


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    require(df, keys)
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"{list(keys)} is not unique")


def stack_snapshots(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Snapshots one below the other; a column that one of them lacks is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Number of distinct values per column.

    Exact counts go through one grouped pass over (column, value) pairs, which combines before it
    shuffles, instead of one distinct aggregation per column.
    """
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.explode(pairs).alias("p")).select("p.*").filter("value is not null").distinct()
    return values.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def months_of(df: DataFrame, month: str = KEYS.month) -> list[int]:
    """The calendar months of a panel: a handful per year of data, whatever its size."""
    return sorted(r[0] for r in df.select(month).distinct().collect() if r[0] is not None)


def keep_months(df: DataFrame, months: int | Iterable[int], month: str = KEYS.month) -> DataFrame:
    """Keep the listed months; prunes partitions where the panel is stored by month."""
    wanted = [months] if isinstance(months, int) else list(months)
    if not wanted:
        raise ValueError("the month list is empty")
    return df.filter(F.col(month).isin(wanted))


def keep_month_range(df: DataFrame, first: int, last: int, month: str = KEYS.month) -> DataFrame:
    return df.filter(F.col(month).between(first, last))


def drop_month_range(df: DataFrame, first: int, last: int, month: str = KEYS.month) -> DataFrame:
    return df.filter(~F.col(month).between(first, last))


def months_outside(months: Iterable[int], first: int, last: int) -> list[int]:
    return [m for m in months if not first <= m <= last]


def grid(df: DataFrame, keys: Keys = KEYS, present: str = "present") -> DataFrame:
    """Every customer in every month of the panel, with a 0/1 presence flag.

    Months are bounded by the calendar, so each customer is expanded by a literal list.
    """
    months = F.array(*[F.lit(m) for m in months_of(df, keys.month)])
    cells = df.select(keys.id).distinct().withColumn(keys.month, F.explode(months))
    seen = df.select(*keys.pair).withColumn(present, F.lit(1))
    return cells.join(seen, keys.pair, "left").withColumn(present, F.coalesce(present, F.lit(0)))


def presence_leads(df: DataFrame, keys: Keys = KEYS) -> DataFrame:
    """Presence now, one and two months of the grid ahead (``mes_0``..``mes_2``), present rows only."""
    ahead = Window.partitionBy(keys.id).orderBy(keys.month)
    full = grid(df, keys, present="mes_0")
    return full.select("*", *[F.lead("mes_0", k).over(ahead).alias(f"mes_{k}") for k in (1, 2)]).filter("mes_0 = 1")


def densify(df: DataFrame, fill: Sequence[str], keys: Keys = KEYS) -> DataFrame:
    """Add a customer's missing months between first and last appearance, with ``fill`` columns at 0."""
    spans = (df.groupBy(keys.id).agg(F.min(keys.period).alias("_first"), F.max(keys.period).alias("_last"))
             .select(keys.id, F.explode(F.sequence("_first", "_last")).alias(keys.period)))
    year, month = F.floor((F.col(keys.period) - 1) / 12), (F.col(keys.period) - 1) % 12 + 1
    months = spans.withColumn(keys.month, (year * 100 + month).cast("int"))
    rest = [c for c in df.columns if c not in (keys.id, keys.month, keys.period)]
    joined = months.join(df.drop(keys.month), [keys.id, keys.period], "left")
    return joined.select(keys.id, keys.month, keys.period, *[
        F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)).alias(c) if c in fill else F.col(c) for c in rest])


def attach(df: DataFrame, features: DataFrame, keys: Keys = KEYS) -> DataFrame:
    """Add feature columns by panel key; the key must be unique on the feature side."""
    require_unique(features, keys.pair)
    return df.join(features, keys.pair, "left")


def head(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First n rows of a stated order."""
    return df.orderBy(*order).limit(n)


def lookup(df: DataFrame, condition: Column | str, *order: Column | str) -> DataFrame:
    return df.filter(condition).orderBy(*order)
