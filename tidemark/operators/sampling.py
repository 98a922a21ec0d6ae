"""Deterministic samples, folds and canary columns.

Every random choice comes from a hash of the row's key and a seed, so it is the same whatever the
partitioning and survives task retries.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import KEYS, Keys, hash_uniform, require
from .labels import binary_target
from ..session import materialize
from .ordering import running_totals
from .panel import keep_months


def undersample_rows(df: DataFrame, target: str, fraction: float, seed: int, negative=0, keys: Keys = KEYS) -> DataFrame:
    """Every row that is not negative, and a fraction of the negative ones. No shuffle."""
    chosen = hash_uniform(keys.id, keys.month, F.lit(seed)) < fraction
    return df.filter((F.col(target) != negative) | chosen)


def undersample_customers(df: DataFrame, target: str, fraction: float, seed: int, positive=1,
                          keys: Keys = KEYS) -> DataFrame:
    """Whole histories: ever-positive customers, and an exact share of the others drawn by hash order."""
    customers = df.groupBy(keys.id).agg(
        F.coalesce(F.max((F.col(target) == positive).cast("int")), F.lit(0)).alias("_ever"))
    never = customers.filter("_ever = 0").select(keys.id, hash_uniform(keys.id, F.lit(seed)).alias("_u"))
    drawn = running_totals(never, "_u", [keys.id], uniform=True, size="_size")
    drawn = drawn.filter(F.col("pos") <= F.floor(F.col("_size") * F.lit(fraction)))
    kept = customers.filter("_ever = 1").select(keys.id).unionByName(drawn.select(keys.id))
    return df.join(kept, keys.id, "left_semi")


def split_by_month(df: DataFrame, label: str, train: Sequence[int], validate: Sequence[int], future: Sequence[int],
                   fraction: float = 1.0, seed: int = 0, target: str = "target",
                   keys: Keys = KEYS) -> dict[str, DataFrame]:
    """Train, validation and future rows by month.

    Training takes either leaving class as positive and undersamples the rest; the later sets count only
    ``BAJA+2``. An empty set is an error.
    """
    require(df, [*keys.pair, label])
    sets = {
        "train": undersample_rows(keep_months(df, train, keys.month).withColumn(target, binary_target(label, "both", 0)),
                                  target, fraction, seed, keys=keys),
        "validate": keep_months(df, validate, keys.month).withColumn(target, binary_target(label, "after", 0)),
        "future": keep_months(df, future, keys.month).withColumn(target, binary_target(label, "after", 0)),
    }
    for name, rows in sets.items():
        if rows.isEmpty():
            raise ValueError(f"no rows for {name}")
    return sets


def canaries(df: DataFrame, n: int, seed: int, prefix: str = "canarito_", keys: Keys = KEYS) -> DataFrame:
    """n uniform noise columns in front of the others."""
    noise = [hash_uniform(keys.id, keys.month, F.lit(i), F.lit(seed)).alias(f"{prefix}{i}") for i in range(1, n + 1)]
    return df.select(*noise, "*")


def canary_sources(columns: Sequence[str], seed: int, share: float = 0.2) -> list[str]:
    """The columns to shuffle: a share of the list, drawn by the hash of the name."""
    import hashlib

    drawn = sorted(columns, key=lambda c: hashlib.md5(f"{c}|{seed}".encode()).hexdigest())
    return sorted(drawn[: max(1, round(len(columns) * share))], key=list(columns).index)


def shuffled_canaries(df: DataFrame, columns: Sequence[str], seed: int, within_month: bool = False,
                      prefix: str = "canarito_", keys: Keys = KEYS) -> DataFrame:
    """Copies of columns taken together from another row, so they keep their relations to each other.

    Rows are numbered twice, by two hash orders, and joined on the number: a random one-to-one pairing over
    the whole table, or over each month.
    """
    by = [keys.month] if within_month else []
    numbers = [*by, "_at"]
    places = []
    for turn in (0, 1):
        u = df.withColumn("_u", hash_uniform(keys.id, keys.month, F.lit(seed), F.lit(turn)))
        slim = u if turn == 0 else u.select(*by, *([keys.id, keys.month] if not by else [keys.id]), "_u", *columns)
        places.append(running_totals(slim, "_u", [keys.id, keys.month], by=by, uniform=True, position="_at"))
    donors = places[1].select(*numbers, *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    return places[0].drop("_u").join(donors, numbers).drop("_at")


def partition(df: DataFrame, division: Sequence[int], strata: Sequence[str], seed: int, first: int = 1,
              out: str = "fold", keys: Keys = KEYS) -> DataFrame:
    """Folds in exact proportion inside every stratum, e.g. ``division=(3, 7)``."""
    u = df.withColumn("_u", hash_uniform(keys.id, keys.month, F.lit(seed)))
    placed = running_totals(u, "_u", keys.pair, by=strata, uniform=True, position="_pos")
    return placed.withColumn(out, _fold(F.col("_pos"), division, first)).drop("_u", "_pos")


def _fold(position: Column, division: Sequence[int], first: int) -> Column:
    slot, fold, upto = (position - 1) % sum(division), F.lit(None).cast("int"), sum(division)
    for i in reversed(range(len(division))):
        fold = F.when(slot < upto, F.lit(first + i)).otherwise(fold)
        upto -= division[i]
    return fold


def row_text(keys: Keys) -> Column:
    """The part of ``hash_uniform``'s text that a row has in every split; null where nothing of the key is known."""
    known = F.col(keys.id).isNotNull() | F.col(keys.month).isNotNull()
    return F.when(known, F.concat_ws("|", F.col(keys.id).cast("string"), F.col(keys.month).cast("string")))


def _digits(text: Column, tail: Column) -> Column:
    """The eight hex digits that ``hash_uniform`` makes a number of: they have the same order and need no conversion."""
    return F.substring(F.md5(F.concat_ws("|", text, tail)), 1, 8)


def _tail(split: Column, seed: int) -> Column:
    return F.concat(split.cast("string"), F.lit(f"|{seed}"))


def _hex(share: Column) -> Column:
    """A share of the hash's range in its digits; beyond 1 what is above all digits."""
    return F.when(share >= 1, F.lit("g")).otherwise(
        F.lpad(F.lower(F.hex(F.floor(F.greatest(share, F.lit(0.0)) * F.lit(4294967296.0)))), 8, "0"))


def drawn(text: Column, split: Column, seed: int, keys: Keys) -> Column:
    """What orders a row within a split: a hash, then its key."""
    return _drawn(_digits(text, _tail(split, seed)), keys)


def _drawn(digits: Column, keys: Keys) -> Column:
    return F.struct(digits.alias("u"), F.col(keys.id).alias("id"), F.col(keys.month).alias("month"))


def _alike(left: DataFrame, right: DataFrame, strata: Sequence[str], split: bool = False) -> Column:
    """Same stratum, named ``_of_{stratum}`` on the right, and, if asked, same split."""
    first = left["split"] == right["_split"] if split else F.lit(True)
    return reduce(lambda a, c: a & left[c].eqNullSafe(right[f"_of_{c}"]), strata, first)


def _named(df: DataFrame, strata: Sequence[str], *more: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_of_{c}") for c in strata], *[F.col(c).alias("_split") if c == "split" else c for c in more])


def _in_splits(slim: DataFrame, spans: DataFrame, strata: Sequence[str], seed: int, keys: Keys) -> DataFrame:
    """Every row once per split of its stratum's spans, with its hash ``_u``; rows are not shuffled."""
    # a row per stratum with the stretch of the hash looked at in each split: small, so written
    lists = materialize(_named(spans.groupBy(*strata).agg(F.collect_list(F.struct(
        "split", "low", "high", _tail(F.col("split"), seed).alias("tail"))).alias("_spans")), strata, "_spans"), "spans")
    texts = slim.withColumn("_text", row_text(keys))
    each = texts.join(lists, _alike(texts, lists, strata)).select(*slim.columns, "_text", F.explode("_spans").alias("_span"))
    return each.select(*slim.columns, *[F.col(f"_span.{c}").alias(n) for c, n in (("split", "split"), ("low", "_low"), ("high", "_high"))],
                       _digits(F.col("_text"), F.col("_span.tail")).alias("_u"))


def _groups_in(slim: DataFrame, spans: DataFrame, wanted: DataFrame, strata: Sequence[str], seed: int, sums: Sequence[str],
               keys: Keys) -> tuple[DataFrame, DataFrame]:
    """Groups of the test sides whose border lies in its stretch, and the borders.

    One pass over the hashes: a group per key within the stretch, one for all rows below it, one for those above.
    """
    inside = (F.col("_u") >= F.col("_low")) & (F.col("_u") < F.col("_high"))
    rows = _in_splits(slim, spans, strata, seed, keys).select(
        "split", *strata, *sums, F.when(F.col("_u") < F.col("_low"), 0).when(inside, 1).otherwise(2).alias("_side"),
        F.when(inside, _drawn(F.col("_u"), keys)).alias("border"))
    counts = materialize(rows.groupBy("split", *strata, "_side", "border").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in sums]), "counts")
    upto = Window.partitionBy("split", *strata).orderBy("_side", "border").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.filter("_side < 2").withColumn("_upto", F.sum("_n").over(upto))
    wants = _named(wanted, strata, "_want")
    placed = placed.join(wants, _alike(placed, wants, strata)).filter(F.col("_upto") - F.col("_n") < F.col("_want"))
    borders = placed.filter((F.col("_side") == 1) & (F.col("_upto") >= F.col("_want")))
    borders = materialize(borders.select("split", *strata, "border"), "borders")
    known = _named(borders, strata, "split")
    return placed.join(known, _alike(placed, known, strata, True), "left_semi").select("split", *strata, *sums), borders


def _test_sides(df: DataFrame, n_splits: int, test_share: float, seed: int, strata: Sequence[str], sums: Sequence[str],
                keys: Keys) -> tuple[DataFrame, DataFrame]:
    """Groups of the test sides, with their sums, and their borders.

    Hashes spread evenly, so the border of n rows lies within a few times 1 / sqrt(n) of the share: rows below that
    stretch are counted and those in it put in order. Where the hashes do not spread (a key that many rows share)
    counts per cell of the hash tell the stretch.
    """
    strata = list(strata)
    slim = materialize(df.select(*dict.fromkeys([*keys.pair, *strata, *sums])), "splits")
    wanted = slim.groupBy(*strata).agg(F.count(F.lit(1)).alias("_size")).withColumn("_want", F.round(F.col("_size") * F.lit(test_share)))
    wanted = materialize(wanted.filter("_want > 0"), "wanted")
    share = F.col("_want") / F.col("_size")
    margin = 6 * F.sqrt(share * (1 - share) / F.col("_size")) + 4 / F.col("_size")
    every = wanted.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    spans = every.select(*strata, "split", _hex(share - margin).alias("low"), _hex(share + margin).alias("high"))
    groups, borders = _groups_in(slim, spans, wanted, strata, seed, sums, keys)
    known = _named(borders, strata, "split")
    missed = materialize(every.join(known, _alike(every, known, strata, True), "left_anti").select(*strata, "split", "_want"), "missed")
    if missed.isEmpty():
        return groups, borders
    whole = missed.select(*strata, "split", F.lit("").alias("low"), F.lit("g").alias("high"))
    cells = _in_splits(slim, whole, strata, seed, keys).groupBy("split", *strata, F.substring("_u", 1, 3).alias("low")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("split", *strata).orderBy("low").rowsBetween(Window.unboundedPreceding, 0)  # the cells of a stratum
    cells = cells.withColumn("_upto", F.sum("_n").over(upto))
    wants = _named(missed, strata, "split", "_want")
    cells = cells.join(wants, _alike(cells, wants, strata, True))
    at = cells.filter((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want")))
    spans = at.select(*strata, "split", "low", F.concat("low", F.lit("g")).alias("high"))
    more = _groups_in(slim, spans, wanted, strata, seed, sums, keys)
    return groups.unionByName(more[0]), borders.unionByName(more[1])


def split_borders(df: DataFrame, n_splits: int, test_share: float, seed: int, strata: Sequence[str] = (),
                  keys: Keys = KEYS) -> DataFrame:
    """The last row of the test side of every split and stratum: ``split, *strata, border`` (no row where there is none)."""
    return _test_sides(df, n_splits, test_share, seed, strata, (), keys)[1]


def split_sums(df: DataFrame, n_splits: int, test_share: float, seed: int, sums: Sequence[str], strata: Sequence[str] = (),
               keys: Keys = KEYS) -> DataFrame:
    """Sums of columns over the test side of every split, found in the same pass as the borders."""
    groups, _ = _test_sides(df, n_splits, test_share, seed, strata, sums, keys)
    return groups.groupBy("split").agg(*[F.sum(c).alias(c) for c in sums])


def shuffle_splits(df: DataFrame, n_splits: int, test_share: float, seed: int, strata: Sequence[str] = (),
                   keys: Keys = KEYS) -> DataFrame:
    """Repeated random splits: every row once per ``split`` with its ``side`` (``train`` or ``test``).

    The test side of a stratum holds the rounded share of its rows. Rows are compared with the borders in place:
    neither they nor their copies are sorted.
    """
    in_test = F.coalesce(F.col("_drawn") <= F.col("_border"), F.lit(False))
    each = over_splits(df, border_lists(df, n_splits, test_share, seed, strata, keys), seed, strata, keys)
    return each.withColumn("side", F.when(in_test, "test").otherwise("train")).drop("_border", "_drawn")


def over_splits(df: DataFrame, lists: DataFrame, seed: int, strata: Sequence[str], keys: Keys) -> DataFrame:
    """Every row once per ``split`` with its ``_drawn`` and the ``_border`` of its stratum."""
    columns = df.columns
    texts = df.withColumn("_text", row_text(keys))
    joined = texts.join(lists, reduce(lambda a, c: a & texts[c].eqNullSafe(lists[f"_of_{c}"]), strata, F.lit(True)), "left")
    each = joined.select(*[texts[c] for c in columns], "_text", F.posexplode("_borders").alias("split", "_border"))
    return each.withColumn("_drawn", drawn(F.col("_text"), F.col("split"), seed, keys)).drop("_text")


def border_lists(df: DataFrame, n_splits: int, test_share: float, seed: int, strata: Sequence[str], keys: Keys) -> DataFrame:
    """One row per stratum with the borders of all splits in order: small whatever the rows."""
    strata = list(strata)
    borders = split_borders(df, n_splits, test_share, seed, strata, keys)
    empty = F.lit(None).cast(borders.schema["border"].dataType)
    # a split without border has an empty test side
    lists = borders.groupBy(*strata).agg(F.map_from_entries(F.collect_list(F.struct("split", "border"))).alias("_m"))
    if strata:
        lists = df.select(*strata).distinct().join(lists.select(*[F.col(c).alias(f"_of_{c}") for c in strata], "_m"), reduce(
            lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in strata]), "left").drop(*[f"_of_{c}" for c in strata])
    values = F.array(*[F.coalesce(F.try_element_at("_m", F.lit(s)), empty) for s in range(n_splits)])
    return materialize(lists.select(*[F.col(c).alias(f"_of_{c}") for c in strata], values.alias("_borders")), "borders")


def balanced_sample(df: DataFrame, target: str, negatives: int, seed: int, negative=0, keys: Keys = KEYS) -> DataFrame:
    """All rows that are not negative and a fixed number of negative ones."""
    pool = df.filter(F.col(target) == negative).withColumn("_u", hash_uniform(keys.id, keys.month, F.lit(seed)))
    drawn = running_totals(pool, "_u", keys.pair, uniform=True, top=negatives).select(*df.columns)
    return df.filter(F.col(target) != negative).unionByName(drawn)
