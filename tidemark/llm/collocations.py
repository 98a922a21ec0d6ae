"""Phrases whose words stand together more often than their parts would by chance.

Every word of a piece of text starts one window of the longest size, held in one column per word and padded where
the piece ends. Only these windows are counted and shuffled. How often a shorter phrase occurs is the sum over the
windows that begin with it: sums over prefixes, then ``ROLLUP``, give all shorter phrases, single words and the
number of words. What can matter later, phrases that are frequent enough, is written once: each part of a
frequent phrase is at least as frequent as the phrase.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, arrow_map

#: Bytes that end a piece become line ends, A-Z lower case; words are then what white space splits.
FOLD = bytes.maketrans(b".,;:!?\x0b\x0c\rABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * 9 + b"abcdefghijklmnopqrstuvwxyz")
HELD = 1_000_000  # words that a task counts together before it sends them
SAMPLE, HOT = 2000, 2000  # documents in which hot fronts are looked for; a front is hot from a share of 1/HOT on
MILLION = 1_000_000


def windows(docs: DataFrame, longest: int, parts: int, hot: dict[str, set[bytes]], *, text_col: str, group_col: str, missing: str) -> DataFrame:
    """``part, grp, lines``: the windows that start at every word, counted by batches, a line each (words, count).

    A window is ``longest`` words, empty where its piece has ended. All windows with the same two words in front are
    in one part; those whose front is ``hot`` are spread by all their words, over parts from ``parts`` on. Lines of
    a part travel together and in order, so they share their beginnings and take little room.
    """
    slim = docs.select(F.coalesce(F.col(group_col).cast("string"), F.lit(missing)).alias("grp"), F.col(text_col).alias("text"))
    pad = [b""] * (longest - 1)

    def counted(group: str, flat: list[bytes]):
        distinct = sorted(set(flat))
        number = {w: k for k, w in enumerate(distinct)}  # the padding is number 0
        ids, total = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat)), len(distinct)
        columns, times = _distinct([ids[k : len(ids) - longest + 1 + k][ids[: len(ids) - longest + 1] != 0] for k in range(longest)], total)
        hashes = np.array([zlib.crc32(w) for w in distinct], np.uint64)
        mixed = np.full(len(times), zlib.crc32(group.encode()), np.uint64)
        fronts = [f.split(b" ") for f in hot.get(group, ())]
        fronts = np.array([number[x] * total + number[y] for x, y in fronts if x in number and y in number], np.int64)
        is_hot = np.isin(columns[0] * total + columns[1], fronts)
        for k, c in enumerate(columns):
            mixed = (mixed ^ hashes[c]) * np.uint64(0x9E3779B97F4A7C15)
            if k == 1:
                part = (mixed >> np.uint64(32)).astype(np.int64) % parts
        part[is_hot] = parts + (mixed[is_hot] >> np.uint64(32)).astype(np.int64) % parts
        order = np.argsort(part.astype(np.uint16) if 2 * parts < 1 << 16 else part, kind="stable")
        part, words = part[order], pa.array(distinct, pa.string())
        fields = [words.take(pa.array(c[order])) for c in columns] + [pa.array(times[order]).cast(pa.string())]
        lines = pc.binary_join_element_wise(*fields, " ")
        ends = np.flatnonzero(np.diff(part, append=-1)) + 1
        blocks = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), lines)
        yield from zip(part[ends - 1].tolist(), [group] * len(ends), pc.binary_join(blocks, "\n").to_pylist())

    def rows(source):
        held: dict[str, list[bytes]] = {}
        size = 0
        for r in source:
            flat = held.setdefault(r["grp"], [])
            for piece in (r["text"] or "").encode("utf-8", "replace").translate(FOLD).split(b"\n"):
                words = piece.split()
                if words:
                    flat += words
                    flat += pad
                    size += len(words) + len(piece) // 64  # long words count for more
                if size > HELD:  # also inside a very long text
                    for group in held:
                        yield from counted(group, held[group])
                    held, size = {r["grp"]: (flat := [])}, 0
        for group in held:
            if held[group]:
                yield from counted(group, held[group])

    return arrow_map(slim, "part int, grp string, lines string", rows, size=200)


def _distinct(columns: list[np.ndarray], total: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of columns of numbers below ``total``, each once and in order, and how often they occur."""
    if total ** len(columns) < 1 << 62:
        code = columns[0]
        for c in columns[1:]:
            code = code * total + c
        code, times = np.unique(code, return_counts=True)
        out = []
        for _ in columns:
            code, last = np.divmod(code, total)
            out.append(last)
        return out[::-1], times
    code = columns[0]
    for c in columns[1:]:
        code = np.unique(code * total + c, return_inverse=True)[1]
    _, first, times = np.unique(code, return_index=True, return_counts=True)
    return [c[first] for c in columns], times


def _hot_fronts(docs: DataFrame, options: dict) -> dict[str, set[bytes]]:
    """Two words that many windows begin with, by a sample; they decide only how even the parts are."""
    total = docs.count()
    some = docs.sample(min(1.0, SAMPLE / max(total, 1)), seed=1).limit(2 * SAMPLE)
    pairs = _opened(windows(some, 2, 1, {}, **options), 2).groupBy("grp", "key").agg(F.sum("f").alias("f")).where("key not like '% '")
    n = F.sum("f").over(Window.partitionBy())  # sums of a bounded sample
    out: dict[str, set[bytes]] = {}
    for r in pairs.withColumn("n", n).where(f"f * {HOT} >= n").orderBy(F.desc("f")).limit(HOT).collect():
        out.setdefault(r["grp"], set()).add(r["key"].encode())
    return out


def _opened(sent: DataFrame, longest: int) -> DataFrame:
    """``part, grp, key, f``: a row per line; ``key`` are its words."""
    lines = sent.select("part", "grp", F.explode(F.split("lines", "\n")).alias("line"))
    return lines.select("part", "grp", F.substring_index("line", " ", longest).alias("key"), F.substring_index("line", " ", -1).cast("long").alias("f"))


def phrase_counts(docs: DataFrame, longest: int, least: int, **options) -> DataFrame:
    """``grp, size, phrase, f`` of all phrases of up to ``longest`` words that occur ``least`` times; size 0 counts all words.

    One shuffle brings equal windows, and equal fronts of two words, to one task. There, from the longest size down,
    rows are summed to their fronts, and those that are too rare to matter themselves go on as fronts only. What is
    left is summed by ``ROLLUP`` to phrases (also of fronts that were spread over parts), single words and groups.
    """
    parts = max(64, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sent = windows(docs, longest, parts, _hot_fronts(docs, options), **options).repartition(max(32, parts // 4), "part")
    found = _opened(sent, longest).groupBy("part", "grp", "key").agg(F.sum("f").alias("f")).withColumn("size", F.lit(longest))
    matters = ((F.col("f") >= least) | (F.col("part") >= parts)) & ~F.col("key").endswith(" ")
    none = F.lit(None).cast("struct<size:int,key:string,f:bigint>")
    for size in range(longest - 1, 1, -1):
        front = F.when(F.col("size") == size + 1, F.struct(F.lit(size).alias("size"), F.substring_index("key", " ", size).alias("key"), "f"))
        own = F.when((F.col("size") > size + 1) | matters, F.struct("size", "key", "f")).otherwise(none)
        found = found.select("part", "grp", F.explode(F.array(front, own)).alias("row")).where("row is not null").select("part", "grp", "row.*")
        found = found.groupBy("part", "grp", "size", "key").agg(F.sum("f").alias("f"))
    # only fronts of two words count for what is shorter: each word starts exactly one
    rest = F.when(matters, F.expr("substring(key, length(substring_index(key, ' ', 1)) + 2)")).otherwise("")
    rows = found.select("grp", F.substring_index("key", " ", 1).alias("word"), rest.alias("rest"), "f", F.when(F.col("size") == 2, F.col("f")).otherwise(0).alias("starts"))
    sums = rows.rollup("grp", "word", "rest").agg(F.sum("f").alias("whole"), F.sum("starts").alias("starts"), F.grouping_id().alias("level"))
    # one condition for all levels, so that they are summed together
    size = F.when(F.col("level") == 0, F.size(F.split("rest", " ")) + 1).when(F.col("level") == 1, 1).otherwise(0)
    sums = sums.select("grp", "level", size.alias("size"), F.concat_ws(" ", "word", "rest").alias("phrase"), F.expr("if(level = 0, whole, starts)").alias("f"), "rest")
    return sums.where(f"level = 3 or (level < 2 and f >= {int(least)} and (level = 1 or rest <> ''))").select("grp", "size", "phrase", "f")


def score(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(10^6 a^2 / (l r)) of three counts, exact below 10^15: products of 128 bits, divided without a rest."""
    wide = lambda c: f"cast({c} as decimal(15,0))"
    return F.expr(f"(cast({MILLION} as decimal(7,0)) * {wide(a)} * {wide(a)}) div ({wide(l)} * {wide(r)})")


def collocations(
    docs: DataFrame, *, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000, text_col: str = "text", group_col: str = "lang", missing: str = "und"
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of every group: ``<group_col>, rank, phrase, a, l, r, n, score``.

    Words are split at blanks and tabs inside pieces between ``. , ; : ! ?`` and line ends, A-Z in lower case. ``a`` counts the
    phrase, ``l`` and ``r`` the parts of its weakest cut, ``n`` the group's words; ``score`` is
    floor(10^6 a^2 / (l r)), exact for counts below 10^15. A phrase goes if a longer one with at least ``share``
    percent of its count holds it. Order: score and ``a`` falling, phrase by its bytes. Null groups are
    ``missing``; null, empty and blank texts have no words; repeated rows count each; other columns are not read.
    """
    if longest < 2 or least < 1:
        raise ValueError("phrases have two words or more and occur")
    scratch = Scratch(docs.sparkSession, "collocations")
    counts = scratch.keep(phrase_counts(docs, longest, least, text_col=text_col, group_col=group_col, missing=missing))
    phrases = counts.where("size >= 2").select("grp", "size", "phrase", F.col("f").alias("a"))
    parts = counts.where("size >= 1").select("grp", "phrase", "f")

    words = F.split("phrase", " ")
    part = lambda start, size: F.array_join(F.slice(words, start, size), " ")
    cuts = phrases.select("grp", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("grp", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    # a word may be the left or right part of very many phrases: sides are read from shuffles that can be split
    left, right = parts.toDF("grp", "left", "l"), parts.toDF("grp", "right", "r")
    cuts = cuts.join(left, ["grp", "left"]).join(right, ["grp", "right"])
    weakest = cuts.select("grp", "phrase", "a", F.struct(score("a", "l", "r").alias("score"), "k", "l", "r").alias("cut")).groupBy("grp", "phrase", "a").agg(F.min("cut").alias("cut"))

    inner_of = lambda size: F.transform(F.sequence(F.lit(1), F.col("size") - size + 1), lambda at: part(at, F.lit(size)))
    if longest > 2:
        none = F.array().cast("array<string>")
        inner = F.flatten(F.array(*(F.when(F.col("size") > s, inner_of(s)).otherwise(none) for s in range(2, longest))))
        inside = phrases.where("size > 2").select("grp", F.explode(inner).alias("phrase"), "a").groupBy("grp", "phrase").agg(F.max("a").alias("longer"))
        weakest = weakest.join(inside, ["grp", "phrase"], "left").where(f"longer is null or 100 * longer < {int(share)} * a")
    kept = scratch.keep(weakest.select("grp", "phrase", "a", "cut.score", "cut.l", "cut.r"))

    # the first of every slice of a group, then the first of what the slices kept
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slices = max(32, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    some = kept.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
    first = some.withColumn("rank", place("grp", "slice")).where(F.col("rank") <= top).drop("slice")
    first = first.withColumn("rank", place("grp").cast("long")).where(F.col("rank") <= top)
    total = counts.where("size = 0").select("grp", F.col("f").alias("n"))
    return first.join(total, "grp").select(F.col("grp").alias(group_col), "rank", "phrase", "a", "l", "r", "n", "score")
