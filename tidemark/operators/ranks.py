"""Rank normalisation within a month, robust to inflation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import KEYS, Keys, ratio, require, require_some
from ..session import materialize
from .ordering import long_with_cells, rank_counts, rank_counts_in_cells, running_totals


def _percent(rank: Column, size: Column) -> Column:
    return F.when(size > 1, (rank - 1) / (size - 1)).otherwise(F.lit(0.0))


def signed_rank(df: DataFrame, columns: Sequence[str], mode: str = "positive", replace: bool = True,
                null_rank: float | None = None, keys: Keys = KEYS) -> DataFrame:
    """Percent rank of every column among the month's values of the same sign; 0 stays 0.

    ``positive``: both signs run over [0, 1]. ``signed``: negatives run over [-1, 0]. ``whole_month``:
    mean-tie rank over the whole month divided by the number of positives (or minus the number of
    negatives), which is not bounded to [-1, 1]. ``null_rank`` is the rank of a missing value. Without
    ``replace`` the ranks go to ``pct_rank_{c}``.

    All columns travel through one shuffle in long form. Zeros and nulls, usually most of the data, need
    no ranking and stay out of it except in ``whole_month``.
    """
    if mode not in ("positive", "signed", "whole_month"):
        raise ValueError("mode is 'positive', 'signed' or 'whole_month'")
    require_some(columns, "signed_rank")
    require(df, [*keys.pair, *columns])
    columns = list(columns)
    df = materialize(df, "ranked")  # cut points, totals, ranks and the rows themselves are read from it
    long = long_with_cells(df, keys.pair, columns, split_signs=True).withColumn("sign", F.signum("value").cast("int"))
    if mode == "whole_month":
        ranked = rank_counts_in_cells(long, "value", [keys.month, "column"])
        sides = ranked.filter("sign <> 0").groupBy(keys.month, "column", "sign").agg(F.count(F.lit(1)).alias("_side"))
        ranked = ranked.filter("sign <> 0").join(sides, [keys.month, "column", "sign"])
        rank = (F.col("_rank") + (F.col("_ties") - 1) / 2) / (F.col("_side") * F.col("sign"))
    else:
        ranked = rank_counts_in_cells(long.filter("sign <> 0"), "value", [keys.month, "column", "sign"])
        rank = _percent(F.col("_rank"), F.col("_size"))
        if mode == "signed":
            rank = F.when(F.col("sign") < 0, rank - 1).otherwise(rank)
    wide = ranked.withColumn("_r", rank).groupBy(*keys.pair).agg(
        *[F.max(F.when(F.col("column") == c, F.col("_r"))).alias(f"_rank_{i}") for i, c in enumerate(columns)])
    joined = df.join(wide, keys.pair, "left")
    new = {
        (c if replace else f"pct_rank_{c}"):
            F.when(F.col(c).isNull(), F.lit(null_rank).cast("double")).when(F.col(c) == 0, F.lit(0.0))
            .otherwise(F.col(f"_rank_{i}"))
        for i, c in enumerate(columns)
    }
    kept = [new[c].alias(c) if c in new else F.col(c) for c in df.columns]
    return joined.select(*kept, *[e.alias(n) for n, e in new.items() if n not in df.columns])


def percent_rank(df: DataFrame, column: str, by: Sequence[str], out: str) -> DataFrame:
    ranked = rank_counts(df, column, by)
    return ranked.withColumn(out, _percent(F.col("_rank"), F.col("_size"))).select(*df.columns, out)


def month_position(df: DataFrame, column: str, tiles: Sequence[int] = (4, 10), keys: Keys = KEYS) -> DataFrame:
    """Percent rank, cumulative share and n-tiles of a column within its month.

    Tiles are cut by position with the customer id as tie-break, the larger ones first.
    """
    require(df, [*keys.pair, column])
    placed = running_totals(df, column, [keys.id], by=[keys.month], position="_pos", size="_size", ranks=True)
    return placed.select(
        *df.columns, _percent(F.col("_rank"), F.col("_size")).alias("percent_rank"),
        ((F.col("_rank") + F.col("_ties") - 1) / F.col("_size")).alias("cume_dist"),
        *[_tile(F.col("_pos"), F.col("_size"), n).alias(f"ntile_{n}") for n in tiles])


def _tile(position: Column, size: Column, n: int) -> Column:
    """Tile of a position when ``size`` rows go into n tiles whose sizes differ by at most one."""
    small, extra = F.floor(size / n), size % n
    in_large = position <= extra * (small + 1)
    return F.when(in_large, F.ceil(position / (small + 1))).otherwise(
        extra + F.ceil(ratio(position - extra * (small + 1), small))).cast("int")
