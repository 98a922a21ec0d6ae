"""Ranks, positions, running totals and exact quantiles without single-task groups.

A month, a model or the whole table may hold any share of the rows, so ``Window.partitionBy(month)``
or an unpartitioned window would sort it in one task. Here the order key is first cut into cells at
approximate quantiles of the whole table. Cell totals come from one map-side combined aggregation,
each row's place inside its cell from a window partitioned by cell, and the two are added. A cell holds
about 1/cells of the table however the rows spread over the groups. A value so frequent that it fills a
cell by itself gets a cell of its own, split again by the tie-break key into as many parts as it fills cells.
The cut points decide only how even the cells are: any cut points give the same result.

The input is evaluated once: what is ordered is written to the shared folder, and cut points, cell totals and
rows are read from there. So a value that may come out differently when it is computed again, such as a mean of
doubles, has one place in the order.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

CELL, SUB, POINT, KEY, TIE = "_cell", "_sub", "_point", "_key", "_tie"
EXACT_LONG = float(2**53)


def default_cells(spark: SparkSession) -> int:
    """A few cells per shuffle task, however many tasks there are."""
    return max(32, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def _ordered_number(df: DataFrame, column: str) -> Column | None:
    """A double that never falls where the column rises; it only has to spread the rows. None for strings."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return None
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType, T.TimestampType)):
        return F.col(column).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.lit(0.0)


def bin_of(value: Column, edges: Column, most: int) -> Column:
    """How many of the ascending ``edges``, at most ``most`` of them, are not above ``value``: found by halving."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, int(most).bit_length())))])

    def go(at: Column, step: Column) -> Column:
        return F.when((at + step <= F.size(edges)) & (F.get(edges, at + step - 1) <= value), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), go)


def _string_part(df: DataFrame, column: str, n: int) -> Column:
    """Part 0..n-1 of a string, cut at strings of a bounded sample, in the order Spark compares them."""
    wanted = 8 * n
    rows = max(1, df.count())
    some = df.select(column).where(F.col(column).isNotNull()).sample(min(1.0, wanted / rows), seed=1).limit(2 * wanted).collect()
    values = sorted({bytes(r[0]) if isinstance(r[0], bytearray) else r[0] for r in some})
    cuts = sorted({values[len(values) * k // n] for k in range(1, n)}) if values else []
    if not cuts:
        return F.lit(0)
    return F.coalesce(bin_of(F.col(column), F.array(*[F.lit(c) for c in cuts]), len(cuts)), F.lit(0))


def _edges(quantiles: Sequence[float], extra: Sequence[float] = (), limit: float = EXACT_LONG) -> tuple[list[float], dict[int, int]]:
    """Cell borders, and for the cells that hold exactly one value how many cells' worth of rows it has."""
    frequent = {v: times for v, times in Counter(quantiles).items() if times > 1 and abs(v) < limit}
    frequent = {v: 1 for v in extra} | frequent
    cuts = set(quantiles) | set(frequent) | {math.nextafter(v, math.inf) for v in frequent}
    borders = [-math.inf, *sorted(c for c in cuts if math.isfinite(c)), math.inf]
    if len(borders) < 3:
        borders.insert(1, 0.0)
    at = {v: k for k, v in enumerate(borders)}
    return borders, {at[v]: times + 1 for v, times in frequent.items()}


def _worth(points: Mapping[int, int]) -> Column:
    """Number of parts of a single-value cell; null for other cells. All parts together are no more than cells."""
    if not points:
        return F.lit(None).cast("int")
    return F.try_element_at(F.create_map(*[F.lit(int(x)) for pair in points.items() for x in pair]), F.col(CELL))


def _bucket(df: DataFrame, columns: Sequence[str], borders: Sequence[Sequence[float]], out: Sequence[str]) -> DataFrame:
    cut = Bucketizer(inputCols=list(columns), outputCols=list(out), splitsArray=[list(b) for b in borders],
                     handleInvalid="keep").transform(df)
    return cut.withColumns({c: F.col(c).cast("int") for c in out})


def _in(column: Column, values: Sequence[int]) -> Column:
    return column.isin(list(values)) if values else F.lit(False)


def _is_double(df: DataFrame, column: str) -> bool:
    """Large longs share a double, so one double is one value only if the column holds doubles."""
    return isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))


def with_cells(df: DataFrame, key: Column, tie: str | None = None, uniform: bool = False,
               cells: int | None = None, exact: bool = False) -> DataFrame:
    """Add the ordering key as double, its cell, the sub-cell and whether the cell is a single value.

    ``exact`` says the key came from a double. ``uniform`` says the key is a hash in [0, 1), which needs no look at the data.
    Without ``tie`` the sub-cell of a single-value cell is a mere salt. ``df`` is read several times: it should be a written table.
    """
    n = cells or default_cells(df.sparkSession)
    rows = df.columns
    # + 0.0 turns -0.0 into 0.0, which the bucketing would otherwise put below it
    df = df.withColumn(KEY, key.cast("double") + F.lit(0.0))
    if uniform:
        return df.withColumns({CELL: F.floor(F.col(KEY) * n).cast("int"), SUB: F.lit(0), POINT: F.lit(False)})
    looked_at, number = [KEY], None
    if tie is not None:
        number = _ordered_number(df, tie)
        if number is not None:
            df = df.withColumn(TIE, number)
            looked_at.append(TIE)
    quantiles = df.select(*looked_at).approxQuantile(looked_at, [i / n for i in range(1, n)], 1 / (4 * n))
    borders, points = _edges(quantiles[0], limit=math.inf if exact else EXACT_LONG)
    # nulls, all equal to each other, go to a last cell of their own
    last = len(borders) - 1
    points = points | {last: n}
    if number is not None:
        tie_borders = _edges(quantiles[1])[0]
        df, most = _bucket(df, looked_at, [borders, tie_borders], [CELL, SUB]), len(tie_borders)
        part = F.coalesce(F.col(SUB), F.lit(0))
    else:
        df, most = _bucket(df, [KEY], [borders], [CELL]), n
        if tie is None:
            part = F.pmod(F.xxhash64(*[F.col(c) for c in rows]), F.lit(n)).cast("int")
        else:
            most = min(n, 1024)
            part = _string_part(df, tie, most)
    df = df.withColumn(CELL, F.coalesce(CELL, F.lit(last)))
    worth = _worth(points)
    # a part of the tie-break holds about 1/most of the table: neighbours go together where the value has few rows
    sub = F.when(worth.isNotNull(), F.floor(part * worth / F.lit(most)).cast("int")).otherwise(0)
    return df.withColumns({POINT: worth.isNotNull(), SUB: sub}).drop(TIE)


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str], prefix: str) -> Column:
    never_null = (CELL, SUB)
    return reduce(lambda a, b: a & b, [
        left[c] == right[prefix + c] if c in never_null else left[c].eqNullSafe(right[prefix + c]) for c in columns
    ])


def running_totals(
    df: DataFrame,
    value: str,
    ties: Sequence[str],
    by: Sequence[str] = (),
    sums: Mapping[str, str] | None = None,
    descending: bool = False,
    uniform: bool = False,
    position: str = "pos",
    size: str | None = None,
    top: int | None = None,
    ranks: bool = False,
    cells: int | None = None,
    written: bool = False,
) -> DataFrame:
    """Position (from 1) and running sums of each row in the order of ``value``, then ``ties``.

    ``sums`` maps new columns to the columns they accumulate. ``by`` starts afresh in every group.
    ``size`` names a column for the group's row count. ``top`` returns only the rows at positions up
    to it; cells that lie wholly beyond are dropped before the shuffle, so a short top list moves
    little data. ``ranks`` adds ``_rank`` and ``_ties`` as ``rank_counts`` does, in the same pass. ``written``
    says that ``df`` is a table already; anything else is written first, so that it is evaluated once. A hash
    as value (``uniform``) comes out alike every time and is not.
    """
    if not (written or uniform):
        df = materialize(df, "order")
    sums = dict(sums or {})
    by = list(by)
    order = [F.col(value).desc() if descending else F.col(value).asc(), *[F.col(t) for t in ties]]
    keep = df.columns
    key = F.col(value).cast("double")
    work = with_cells(df, -key if descending else key, tie=ties[0] if ties else None, uniform=uniform, cells=cells,
                      exact=_is_double(df, value))
    place = [*by, CELL, SUB]
    totals = work.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"),
                                      *[F.sum(c).alias(f"_sum_{out}") for out, c in sums.items()])
    # a group has no more than a few rows per cell here, so these windows are small
    group = Window.partitionBy(*by)
    before = group.orderBy(CELL, SUB).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(c).alias(f"_at_{c}") for c in place],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        F.sum("_n").over(group).alias("_size"),
        *[F.coalesce(F.sum(f"_sum_{out}").over(before), F.lit(0)).alias(f"_before_{out}") for out in sums],
        *(_cell_totals(by) if ranks else []),
    )
    if top is not None:
        starts = starts.filter(F.col("_n_before") < top)
    placed = work.join(starts, _same(work, starts, place, "_at_"))
    inside = Window.partitionBy(*place).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    result = placed.select(
        *keep,
        (F.col("_n_before") + F.row_number().over(inside)).alias(position),
        *[(F.col(f"_before_{out}") + F.coalesce(F.sum(c).over(upto), F.lit(0))).alias(out) for out, c in sums.items()],
        *([F.col("_size").alias(size)] if size else []),
        *(_ranks_in(place, value) if ranks else []),
    )
    return result if top is None else result.filter(F.col(position) <= top)


def rank_counts(df: DataFrame, value: str, by: Sequence[str], cells: int | None = None, written: bool = False) -> DataFrame:
    """Add ``_rank`` (ties share the lowest), ``_ties`` and ``_size`` of each row within its group."""
    df = df if written else materialize(df, "ranks")
    return rank_counts_in_cells(with_cells(df, F.col(value), cells=cells, exact=_is_double(df, value)), value, by)


def rank_counts_in_cells(work: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """The same for a frame that already carries its cells."""
    by = list(by)
    keep = [c for c in work.columns if c not in (KEY, CELL, SUB, POINT)]
    place = [*by, CELL, SUB]
    totals = work.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    starts = totals.select(*[F.col(c).alias(f"_at_{c}") for c in place],
                           F.sum("_n").over(Window.partitionBy(*by)).alias("_size"), *_cell_totals(by))
    return work.join(starts, _same(work, starts, place, "_at_")).select(*keep, *_ranks_in(place, value), "_size")


def _cell_totals(by: Sequence[str]) -> list[Column]:
    """Rows below a cell and rows in it, over the table of cell totals.

    All parts of a divided cell start after the cells below it, since their rows are tied.
    """
    below = Window.partitionBy(*by).orderBy(CELL).rangeBetween(Window.unboundedPreceding, -1)
    return [F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_n_below"),
            F.sum("_n").over(Window.partitionBy(*by, CELL)).alias("_n_cell")]


def _ranks_in(place: Sequence[str], value: str) -> list[Column]:
    local = F.rank().over(Window.partitionBy(*place).orderBy(value))
    tied = F.count(F.lit(1)).over(Window.partitionBy(*place, value))
    return [(F.col("_n_below") + local).alias("_rank"),
            F.when(F.col(POINT), F.col("_n_cell")).otherwise(tied).alias("_ties")]


def to_long(df: DataFrame, keep: Sequence[str], columns: Sequence[str], name: str = "column",
            value: str = "value") -> DataFrame:
    """One row per (row, column) with the value as double; nulls are left out."""
    cells = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in columns])
    return (df.select(*keep, F.explode(cells).alias("_c"))
            .select(*keep, F.col(f"_c.{name}").alias(name), F.col(f"_c.{value}").alias(value))
            .filter(F.col(value).isNotNull()))


def _columns_in_cells(df: DataFrame, keep: Sequence[str], columns: Sequence[str], n: int,
                      extra: Sequence[float] = ()) -> tuple[DataFrame, list[dict[int, int]], list[str]]:
    """Every column as double with its cell beside it, found in one pass over all columns, and the single-value cells."""
    slim = df.select(*keep, *[(F.col(c).cast("double") + F.lit(0.0)).alias(c) for c in columns])
    quantiles = slim.approxQuantile(list(columns), [i / n for i in range(1, n)], 1 / (4 * n))
    parts = [_edges(q, extra=extra) for q in quantiles]
    names = [f"_cell_{i}" for i in range(len(columns))]
    return _bucket(slim, columns, [b for b, _ in parts], names), [p for _, p in parts], names


def long_with_cells(df: DataFrame, keep: Sequence[str], columns: Sequence[str], cells: int | None = None,
                    split_signs: bool = False) -> DataFrame:
    """``to_long`` with every column cut into its own cells. ``df`` is read twice: it should be a written table."""
    n = cells or default_cells(df.sparkSession)
    columns = list(columns)
    cut, points, names = _columns_in_cells(df, keep, columns, n, extra=(0.0,) if split_signs else ())
    salt = F.abs(F.hash(*[F.col(k) for k in keep]) % (1 << 30)) if keep else F.lit(0)
    worth = [F.lit(None).cast("int") if not p else F.try_element_at(
        F.create_map(*[F.lit(int(x)) for pair in p.items() for x in pair]), F.col(cell)) for cell, p in zip(names, points)]
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), F.col(cell).alias(CELL), w.isNotNull().alias(POINT),
                 F.coalesce(salt % w, F.lit(0)).alias(SUB))
        for c, cell, w in zip(columns, names, worth)
    ])
    return cut.select(*keep, F.explode(entries).alias("_c")).select(*keep, "_c.*").filter(F.col("value").isNotNull())


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                    by: Sequence[str] = (), cells: int | None = None, written: bool = False) -> DataFrame:
    """Linearly interpolated quantiles per (group, column): columns ``column``, ``size``, ``q0``, ``q1``...

    Rows are counted per cell; the counts tell which cells hold a wanted rank, and where in them. A cell of one
    value is the answer itself. Only the values of the other cells that hold a wanted rank, a few in hundred of
    all, are counted and put in order.
    """
    by, columns = list(by), list(columns)
    n = cells or default_cells(df.sparkSession)
    if not written:
        df = materialize(df.select(*by, *[c for c in columns if c not in by]), "quantiles")
    cut, _, names = _columns_in_cells(df, by, columns, n)
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(cell).alias(CELL), F.col(c).alias("value")) for c, cell in zip(columns, names)])
    long = cut.select(*by, F.explode(entries).alias("_c")).select(*by, "_c.*").filter(F.col("value").isNotNull())
    place = [*by, "column", CELL]
    counts = long.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"), F.min("value").alias("_min"), F.max("value").alias("_max"))
    group = Window.partitionBy(*by, "column")  # a group's cells
    counts = counts.select(*place, "_n", "_min", "_max", F.sum("_n").over(group).alias("size"),
                           (F.sum("_n").over(group.orderBy(CELL).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_start"))
    at = [(F.col("size") - 1) * F.lit(float(p)) for p in probabilities]
    ranks = F.array(*[F.struct(F.lit(2 * i + side).alias("which"), f(a).cast("long").alias("rank"))
                      for i, a in enumerate(at) for side, f in enumerate((F.floor, F.ceil))])
    wanted = counts.withColumn("_ranks", F.filter(ranks, lambda r: (r["rank"] >= F.col("_start")) & (r["rank"] < F.col("_start") + F.col("_n"))))
    # written, as it is small, is joined with the rows, and gives the one-value cells; order of sums plays no part
    wanted = materialize(wanted.filter(F.size("_ranks") > 0).select(*place, "size", "_start", "_min", "_max", "_ranks"), "ranks")
    open_ = wanted.filter("_min < _max").select(*[F.col(c).alias(f"_at_{c}") for c in place], "size", "_start", "_ranks")
    values = long.join(open_, _same_place(long, open_, by))
    values = values.groupBy(*place, "size", "_start", "_ranks", "value").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*place).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)) + F.col("_start")
    inside = values.withColumn("_upto", upto).select(*by, "column", "size", "value", F.filter(
        "_ranks", lambda r: (r["rank"] < F.col("_upto")) & (r["rank"] >= F.col("_upto") - F.col("_n"))).alias("_ranks"))
    single = wanted.filter("_min = _max").select(*by, "column", "size", F.col("_min").alias("value"), "_ranks")
    picks = inside.filter(F.size("_ranks") > 0).unionByName(single).select(*by, "column", "size", "value", F.explode("_ranks.which").alias("_which"))
    ends = picks.groupBy(*by, "column", "size").agg(*[
        F.max(F.when(F.col("_which") == k, F.col("value"))).alias(f"_v{k}") for k in range(2 * len(at))])
    result = []
    for i, a in enumerate(at):
        lo, hi, part = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}"), a - F.floor(a)
        # measured from the nearer end, which loses no digits
        near_lo, near_hi = lo + (hi - lo) * part, hi - (hi - lo) * (1 - part)
        result.append(F.when(part < 0.5, near_lo).otherwise(near_hi).alias(f"q{i}"))
    return ends.select(*by, "column", "size", *result)


def _same_place(long: DataFrame, wanted: DataFrame, by: Sequence[str]) -> Column:
    same = (long["column"] == wanted["_at_column"]) & (long[CELL] == wanted[f"_at_{CELL}"])
    return reduce(lambda x, c: x & long[c].eqNullSafe(wanted[f"_at_{c}"]), by, same)
