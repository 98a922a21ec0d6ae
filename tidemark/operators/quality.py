"""Data quality, drift between months, imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import KEYS, Keys, numeric_columns, ratio, require_some
from ..session import materialize
from .ordering import exact_quantiles, to_long


def _month_all_zero(df: DataFrame, columns: Sequence[str], month: str) -> DataFrame:
    """One row per month: is every known value of the column 0?"""
    return df.groupBy(month).agg(
        *[(F.coalesce(F.max(F.abs(F.col(c))), F.lit(1)) == 0).alias(f"_zero_{c}") for c in columns])


def repair_zero_months(df: DataFrame, columns: Sequence[str] | None = None, keys: Keys = KEYS) -> DataFrame:
    """Null out a column in the months where all its known values are 0.

    One map-side combined pass gives a row per calendar month; that table is broadcast. Rows without a month
    keep their values.
    """
    columns = list(columns) if columns is not None else numeric_columns(df, [keys.id, keys.month, keys.period])
    require_some(columns, "repair_zero_months")
    flags = _month_all_zero(df, columns, keys.month)
    joined = df.join(F.broadcast(flags), keys.month, "left")
    return joined.select(*[
        F.when(~F.coalesce(F.col(f"_zero_{c}"), F.lit(False)), F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


def zero_month_report(df: DataFrame, columns: Sequence[str], keys: Keys = KEYS) -> DataFrame:
    """(month, column) pairs whose known values are all 0."""
    flags = _month_all_zero(df, columns, keys.month)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_zero_{c}").alias("z")) for c in columns])
    return (flags.select(keys.month, F.explode(pairs).alias("p")).filter("p.z")
            .select(keys.month, F.col("p.column").alias("column")))


def _share_comparison(df: DataFrame, columns: Sequence[str], train: int, score: int, test, keys: Keys) -> DataFrame:
    counted = df.filter(F.col(keys.month).isin(train, score)).groupBy().agg(*[
        F.try_divide(F.sum(F.when(F.col(keys.month) == m, test(c).cast("long"))).cast("double"),
                     F.count(F.when(F.col(keys.month) == m, 1)).cast("double")).alias(f"_{side}_{i}")
        for i, c in enumerate(columns) for side, m in (("t", train), ("s", score))])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), (F.col(f"_t_{i}") * 100).alias("train_pct"),
                              (F.col(f"_s_{i}") * 100).alias("score_pct")) for i, c in enumerate(columns)])
    table = counted.select(F.explode(rows).alias("r")).select("r.*")
    return (table.withColumn("diff", F.abs(F.col("score_pct") - F.col("train_pct")))
            .orderBy(F.desc("diff"), "column"))


def null_share(df: DataFrame, columns: Sequence[str], train: int, score: int, keys: Keys = KEYS) -> DataFrame:
    """Percentage of nulls per column in two months, largest change first."""
    return _share_comparison(df, columns, train, score, lambda c: F.col(c).isNull(), keys)


def zero_share(df: DataFrame, columns: Sequence[str], train: int, score: int, keys: Keys = KEYS) -> DataFrame:
    """Percentage of zeros per column in two months; a null is not a zero."""
    return _share_comparison(df, columns, train, score, lambda c: F.coalesce(F.col(c) == 0, F.lit(False)), keys)


def bin_counts(df: DataFrame, columns: Sequence[str], expected: Column, actual: Column, bins: int = 10) -> DataFrame:
    """Rows of the expected and actual side per quantile bin of the expected side.

    Bins are [a, b), the last one closed; values outside the expected range fall in no bin. Returns
    ``column, bin, low, high, n_expected, n_actual``.
    """
    return _bin_counts(_two_sides(df, columns, expected, actual), list(columns), bins)


def _two_sides(df: DataFrame, columns: Sequence[str], expected: Column, actual: Column) -> DataFrame:
    """The rows and columns a comparison needs, written once because it reads them several times."""
    flags = [F.coalesce(side, F.lit(False)).alias(name) for name, side in (("_e", expected), ("_a", actual))]
    return materialize(df.select(*flags, *columns).filter("_e or _a"), "sides")


def _bin_counts(sides: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    found = exact_quantiles(sides.filter("_e"), columns, [i / bins for i in range(bins + 1)], written=True)
    # bins + 1 numbers per column: small whatever the data
    edges = {r["column"]: sorted({r[f"q{i}"] for i in range(bins + 1)}) for r in found.collect()}
    names = [c for c in columns if c in edges]
    rows = [(c, k + 1, edges[c][k], edges[c][k + 1] if k + 1 < len(edges[c]) else None) for c in names for k in range(max(1, len(edges[c]) - 1))]
    all_bins = sides.sparkSession.createDataFrame(rows, "column string, bin int, low double, high double")
    if not names:
        return all_bins.select("*", F.lit(0).cast("long").alias("n_expected"), F.lit(0).cast("long").alias("n_actual"))
    slim = sides.select("_e", "_a", *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(names)])
    cut = Bucketizer(inputCols=[f"_v{i}" for i in range(len(names))], outputCols=[f"_b{i}" for i in range(len(names))],
                     splitsArray=[[float("-inf"), *edges[c], float("inf")] for c in names], handleInvalid="keep").transform(slim)

    def entry(i: int, c: str) -> Column:
        last = len(edges[c]) - 1  # bins are [a, b), the last one closed
        inside = F.when(F.col(f"_v{i}") == edges[c][-1], max(last, 1)).when(F.col(f"_b{i}") <= last, F.col(f"_b{i}").cast("int"))
        return F.struct(F.lit(c).alias("column"), inside.alias("bin"))

    long = cut.select("_e", "_a", F.explode(F.array(*[entry(i, c) for i, c in enumerate(names)])).alias("r")).select("_e", "_a", "r.*")
    counts = long.filter("bin >= 1").groupBy("column", "bin").agg(
        F.sum(F.col("_e").cast("long")).alias("n_expected"), F.sum(F.col("_a").cast("long")).alias("n_actual"))
    return all_bins.join(counts, ["column", "bin"], "left").select(
        "column", "bin", "low", "high", F.coalesce("n_expected", F.lit(0)).alias("n_expected"), F.coalesce("n_actual", F.lit(0)).alias("n_actual"))


def psi(df: DataFrame, columns: Sequence[str], expected: Column, actual: Column, bins: int = 10,
        epsilon: float | None = None) -> DataFrame:
    """Population stability index of every column, largest first.

    Sum of (a - e) ln(a / e) over quantile bins of the expected side, plus a term for missing values when
    both sides have some. An empty bin makes the index null unless ``epsilon`` stands in for its share.
    """
    columns = list(columns)
    sides = _two_sides(df, columns, expected, actual)
    counts = _bin_counts(sides, columns, bins)
    rows = [F.count(F.when(F.col(f"_{s}") & (F.col(c).isNotNull() if known else F.lit(True)), 1)).alias(f"_{s}{known:d}_{i}")
            for i, c in enumerate(columns) for s in "ea" for known in (True, False)]
    names = ("e1", "a1", "e0", "a0")
    sizes = sides.agg(*rows).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"_{n}_{i}").alias(n) for n in names])
        for i, c in enumerate(columns)])).alias("s")).select("s.*")

    def term(e: Column, a: Column) -> Column:
        return (a - e) * F.ln(ratio(a, e))

    def share(n: Column, size: Column) -> Column:
        part = ratio(n, size)
        return part if epsilon is None else F.greatest(part, F.lit(epsilon))

    by_bin = counts.join(F.broadcast(sizes), "column").withColumn(
        "_term", term(share(F.col("n_expected"), F.col("e1")), share(F.col("n_actual"), F.col("a1"))))
    parts = by_bin.groupBy("column", *names).agg(F.sum("_term").alias("_known"), F.count("_term").alias("_n"),
                                                 F.count(F.lit(1)).alias("_bins"))
    e_null, a_null = F.col("e0") - F.col("e1"), F.col("a0") - F.col("a1")
    missing = F.when((e_null > 0) & (a_null > 0), term(ratio(e_null, F.col("e0")), ratio(a_null, F.col("a0")))).otherwise(0.0)
    return (parts.select("column", (F.when(F.col("_n") == F.col("_bins"), F.col("_known")) + missing).alias("psi"))
            .orderBy(F.desc_nulls_last("psi"), "column"))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Rows per equal-width bin (0 below the range, bins + 1 above it) and their share of the group."""
    counts = (df.filter(F.col(column).isNotNull())
              .withColumn("bin", F.width_bucket(F.col(column).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins)))
              .groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n")))
    # groups x bins rows: a short table
    size = F.sum("n").over(Window.partitionBy(*by))
    return counts.select(*by, "bin", "n", ratio(F.col("n"), size).alias("share"))


def five_numbers(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Box-plot numbers per group: min, quartiles, max."""
    q = exact_quantiles(df, [column], [0.0, 0.25, 0.5, 0.75, 1.0], by)
    return q.select(*by, "size", *[F.col(f"q{i}").alias(n) for i, n in enumerate(("min", "q25", "median", "q75", "max"))])


def fill_values(train: DataFrame, columns: Sequence[str], strategy: str = "median") -> DataFrame:
    """One row with the value that stands in for a missing one, fitted on the training rows."""
    columns = list(columns)
    if strategy == "mean":
        return train.agg(*[ratio(F.sum(c), F.count(c)).alias(c) for c in columns])
    if strategy == "median":
        table = exact_quantiles(train, columns, [0.5]).withColumnRenamed("q0", "_fill")
    elif strategy == "mode":
        counts = to_long(train, [], columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        # the most frequent value, the smallest among equals
        table = counts.groupBy("column").agg(F.max(F.struct("n", (-F.col("value")).alias("minus"))).alias("m")).select(
            "column", (-F.col("m.minus")).alias("_fill"))
    else:
        raise ValueError("strategy is 'mean', 'median' or 'mode'")
    return table.agg(*[F.max(F.when(F.col("column") == c, F.col("_fill"))).alias(c) for c in columns])


def impute(df: DataFrame, train: DataFrame, columns: Sequence[str], strategy: str = "median") -> DataFrame:
    """Fill nulls of ``df`` with values fitted on ``train`` only."""
    fills = fill_values(train, columns, strategy).select(F.struct(*columns).alias("fill")).scalar()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), fills[c]) for c in columns})
