"""Features from each customer's own past.

Every operator takes all its columns at once, so they share one window: one shuffle by customer, one
sort. Rows are counted, not calendar months, unless a function says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.columns import KEYS, Keys, ratio, require, require_some


def _usable(df: DataFrame, columns: Sequence[str], what: str) -> list[str]:
    require_some(columns, what)
    require(df, columns)
    return list(columns)


def lags(df: DataFrame, columns: Sequence[str], orders: Iterable[int] = (1,), deltas: bool = True,
         calendar: bool = False, keys: Keys = KEYS) -> DataFrame:
    """``{c}_lag_{j}`` and ``{c}_delta_{j}``; with ``calendar`` null unless the row is exactly j months back."""
    columns = _usable(df, columns, "lags")
    history, period = keys.history(), F.col(keys.period)
    new: dict[str, Column] = {}
    for c in columns:
        for j in orders:
            past = F.lag(c, j).over(history)
            if calendar:
                past = F.when(F.lag(keys.period, j).over(history) == period - j, past)
            new[f"{c}_lag_{j}"] = past
            if deltas:
                new[f"{c}_delta_{j}"] = F.col(c) - past
    return df.select("*", *[e.alias(n) for n, e in new.items()])


def leads(df: DataFrame, columns: Sequence[str], orders: Iterable[int] = (1, 2), keys: Keys = KEYS) -> DataFrame:
    columns = _usable(df, columns, "leads")
    history = keys.history()
    return df.select("*", *[F.lead(c, j).over(history).alias(f"{c}_lead_{j}") for c in columns for j in orders])


def _mean(c: str, frame: WindowSpec) -> Column:
    return ratio(F.sum(c).over(frame), F.count(c).over(frame))


def rolling_mean(df: DataFrame, columns: Sequence[str], window: int = 3, keys: Keys = KEYS) -> DataFrame:
    """Mean of the ``window`` rows before the current one, as ``{c}_rolling_mean_{window}``."""
    columns = _usable(df, columns, "rolling_mean")
    frame = keys.history().rowsBetween(-window, -1)
    return df.select("*", *[_mean(c, frame).alias(f"{c}_rolling_mean_{window}") for c in columns])


def moving_stats(df: DataFrame, columns: Sequence[str], preceding: int = 3, keys: Keys = KEYS) -> DataFrame:
    """Mean, max and min over ``preceding`` rows and the current one."""
    columns = _usable(df, columns, "moving_stats")
    frame = keys.history().rowsBetween(-preceding, 0)
    return df.select("*", *[e for c in columns for e in (
        _mean(c, frame).alias(f"{c}_media_{preceding}"),
        F.max(c).over(frame).alias(f"{c}_max_{preceding}"),
        F.min(c).over(frame).alias(f"{c}_min_{preceding}"))])


def slope(y: str, x: Column, frame: WindowSpec) -> Column:
    """Least-squares slope over a frame from plain sums, exact for integer columns; nulls in y are skipped.

    ``x`` should be small (a row or month number counted from a recent origin): a shift of x leaves the
    slope as it is but large x costs digits.
    """
    known = F.col(y).isNotNull()
    x = F.when(known, x.cast("long"))
    n, sx, sy = F.count(y).over(frame), F.sum(x).over(frame), F.sum(y).over(frame)
    sxx, sxy = F.sum(x * x).over(frame), F.sum(x * F.col(y)).over(frame)
    return ratio(n * sxy - sx * sy, n * sxx - sx * sx)


def _row_number(keys: Keys) -> Column:
    return F.row_number().over(keys.history())


def trend_pack(df: DataFrame, columns: Sequence[str], window: int = 6, trend: bool = True, minimum: bool = True,
               maximum: bool = True, mean: bool = True, ratio_mean: bool = False, ratio_max: bool = False,
               keys: Keys = KEYS) -> DataFrame:
    """Slope, min, max, mean of the last ``window`` rows, current included, and current-to-mean/max ratios.

    Null unless the window holds two known values. Missing values keep their place on the x axis.
    """
    columns = _usable(df, columns, "trend_pack")
    frame = keys.history().rowsBetween(-(window - 1), 0)
    numbered = df.withColumn("_row", _row_number(keys))
    new: list[Column] = []
    for c in columns:
        two = F.count(c).over(frame) >= 2
        top, middle = F.when(two, F.max(c).over(frame)), F.when(two, _mean(c, frame))
        if trend:
            new.append(F.when(two, slope(c, F.col("_row"), frame)).alias(f"{c}_tend{window}"))
        if minimum:
            new.append(F.when(two, F.min(c).over(frame)).alias(f"{c}_min{window}"))
        if maximum:
            new.append(top.alias(f"{c}_max{window}"))
        if mean:
            new.append(middle.alias(f"{c}_avg{window}"))
        if ratio_mean:
            new.append(ratio(F.col(c), middle).alias(f"{c}_ratioavg{window}"))
        if ratio_max:
            new.append(ratio(F.col(c), top).alias(f"{c}_ratiomax{window}"))
    return numbered.select("*", *new).drop("_row")


def period_trend(df: DataFrame, columns: Sequence[str], window: int = 3, keys: Keys = KEYS) -> DataFrame:
    """Slope against the calendar month over ``window`` rows and the current one: ``{c}_trend_{window}m``."""
    columns = _usable(df, columns, "period_trend")
    frame = keys.history().rowsBetween(-window, 0)
    origin = F.first(keys.period).over(keys.history())
    placed = df.withColumn("_x", F.col(keys.period) - origin)
    return placed.select("*", *[slope(c, F.col("_x"), frame).alias(f"{c}_trend_{window}m") for c in columns]).drop("_x")


def trend_against(df: DataFrame, columns: Sequence[str], x: str, preceding: int = 3, keys: Keys = KEYS) -> DataFrame:
    """Slope against another column, such as tenure: ``{c}_slope_{preceding}``."""
    columns = _usable(df, columns, "trend_against")
    frame = keys.history().rowsBetween(-preceding, 0)
    return df.select("*", *[slope(c, F.col(x), frame).alias(f"{c}_slope_{preceding}") for c in columns])


def simple_trend_pack(df: DataFrame, columns: Sequence[str], window: int = 6, keys: Keys = KEYS) -> DataFrame:
    """Min, max, mean with two known values, and the change since the first row of the window."""
    columns = _usable(df, columns, "simple_trend_pack")
    history = keys.history()
    frame = history.rowsBetween(-(window - 1), 0)
    new: list[Column] = []
    for c in columns:
        two = F.count(c).over(frame) >= 2
        new += [(F.col(c) - F.lag(c, window - 1).over(history)).alias(f"{c}_tend{window}"),
                F.when(two, F.min(c).over(frame)).alias(f"{c}_min{window}"),
                F.when(two, F.max(c).over(frame)).alias(f"{c}_max{window}"),
                F.when(two, _mean(c, frame)).alias(f"{c}_avg{window}")]
    return df.select("*", *new)


def tenure(df: DataFrame, keys: Keys = KEYS, out: str = "antiguedad") -> DataFrame:
    """Months seen so far, recomputed from the panel itself."""
    return df.withColumn(out, _row_number(keys))


def above_own_mean(df: DataFrame, column: str, keys: Keys = KEYS, out: str = "comparacion") -> DataFrame:
    """``mayor`` where the row lies above the customer's own mean, else ``menor``."""
    everything = Window.partitionBy(keys.id)
    return df.withColumn(out, F.when(F.col(column) > _mean(column, everything), "mayor").otherwise("menor"))
