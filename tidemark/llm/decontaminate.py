"""Benchmark passages in documents: prefix-filtered containment join over item-sized windows.

A window is ``width`` consecutive words of an item (all words of a shorter item). A document holds it only
if it holds every two-word shingle of it, so the rarest one is a sufficient prefix: documents are joined
with windows on that shingle alone. Its place in the window gives the only possible start, which must lie
inside the document (length and positional bound); then every word of the window is compared.

Documents are read once per block of windows. The pass keeps, for each document, the places of shingles
that occur in the block; rarity (in how many documents a shingle occurs) and the join use only these.
A block is bounded by ``BLOCK`` window words and sent to all tasks; more windows give more blocks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_map

BLOCK = 500_000
#: Words are runs of ASCII letters and digits and of all bytes beyond ASCII; A-Z are lower-cased.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def windows(items: DataFrame, *, id_col: str, text_col: str, width: int) -> DataFrame:
    """item (as string), window (array of words): the distinct windows of every item; null texts have none, items without id give theirs to nobody."""
    def rows(source):
        for r in source:
            w = words(r["text"])
            n = min(width, len(w))
            if n:
                for x in {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}:
                    yield r["item"], [b.decode("utf-8", "surrogatepass") for b in x]

    return arrow_map(items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")), "item string, window array<string>", rows)


def shingles(w: np.ndarray) -> np.ndarray:
    """Exact numbers of neighbouring words; the word itself in a window of one word."""
    return w << 32 if len(w) == 1 else (w[:-1] << 32) | w[1:]


def block_of(rows: list[tuple[int, list[str]]]) -> dict:
    """Windows of one block: their numbers, numbers of their words, shingles and lengths, as plain arrays and dictionaries."""
    word: dict[bytes, int] = {}
    windows_ = [np.array([word.setdefault(w.encode("utf-8", "surrogatepass"), len(word) + 1) for w in window], np.int64) for _, window in rows]
    keys = [shingles(w) for w in windows_]
    all_keys = np.unique(np.concatenate(keys)) if keys else np.empty(0, np.int64)
    return {
        "numbers": [number for number, _ in rows], "word": word, "keys": all_keys, "lengths": [len(w) for w in windows_],
        "places": [np.searchsorted(all_keys, k) for k in keys], "single": bool((all_keys & 0xFFFFFFFF == 0).any()),
    }


def block_hits(block: dict, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a document and shingle numbers, of shingles in the block; word by word where windows of one word exist."""
    found_at, found, known = [], [], block["keys"]
    for keys in [(numbers[:-1] << 32) | numbers[1:]] + [numbers << 32] * block["single"]:
        if len(keys) and len(known):
            slot = np.searchsorted(known, keys)
            slot[slot == len(known)] = 0
            at = np.flatnonzero(known[slot] == keys)
            found_at.append(at)
            found.append(slot[at])
    return (np.concatenate(found_at), np.concatenate(found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))


def contamination(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 10, block: int = BLOCK) -> DataFrame:
    """``id_col, n_words, n_hit, items`` (sorted array of item ids as strings) for every row of ``docs``.

    A word is hit if it lies in an occurrence of a window. Null and empty texts have no words. Rows with
    a null or repeated id are rows of their own. Items without words have no window; windows of items without
    id are hit but name no item; an empty benchmark hits nothing; repeated items count once. Other columns are
    not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    pairs = scratch.keep(windows(items, id_col=item_col, text_col=item_text_col, width=width))
    # a window is one row however many items hold it; their names are joined to what was hit
    distinct = scratch.keep(pairs.select("window").distinct().withColumn("number", F.monotonically_increasing_id()))
    named = scratch.keep(pairs.where("item is not null").join(distinct, "window").select("number", "item").distinct())
    total = distinct.agg(F.sum(F.size("window"))).first()[0] or 0
    blocks = max(1, -(-total // block))
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    if blocks > 1:  # the row numbers must be the same in every pass
        source = scratch.keep(source)
    found = None
    for b in range(blocks):
        part = distinct.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b) if blocks > 1 else distinct
        one = _block(source, block_of([(r["number"], r["window"]) for r in part.collect()]), scratch)
        found = one if found is None else found.unionByName(one)
    if blocks > 1:
        # intervals of the blocks are joined per document; they are at most as many as its words
        found = found.groupBy("row").agg(F.first("doc").alias("doc"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("hit")).alias("hit"))
    found = scratch.keep(found)
    none = F.array().cast("array<string>")
    hit = found.where(F.size("hit") > 0)
    names = hit.select("row", F.explode("hit").alias("number")).join(named, "number").groupBy("row").agg(F.collect_set("item").alias("items"))
    hit = hit.join(names, "row", "left").withColumn("items", F.coalesce("items", none))
    found = found.where(F.size("hit") == 0).withColumn("items", none).unionByName(hit)
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda a, s: F.struct((a.n + F.greatest(F.lit(0).cast("long"), s.stop - F.greatest(s.start, a.upto))).alias("n"), F.greatest(a.upto, s.stop).alias("upto")),
        lambda a: a.n,
    )
    return found.select(F.col("doc").alias(id_col), "n_words", covered.alias("n_hit"), F.array_sort("items").alias("items"))


def _block(source: DataFrame, block: dict, scratch: Scratch) -> DataFrame:
    """row, doc, n_words, spans, hit (numbers of windows) of one block of windows."""
    context = source.sparkSession.sparkContext
    sent = context.broadcast(block)

    def places(rows):
        known = sent.value
        number = known["word"]
        for r in rows:
            w = words(r["text"])
            if known["numbers"]:
                at, what = block_hits(known, np.fromiter((number.get(x, 0) for x in w), np.int64, len(w)))
                yield r["row"], r["doc"], len(w), at.astype(np.int32).tobytes(), what.astype(np.int32).tobytes(), np.unique(what).tolist()
            else:
                yield r["row"], r["doc"], len(w), b"", b"", []

    kind = source.schema["doc"].dataType.simpleString()
    held = scratch.keep(arrow_map(source, f"row long, doc {kind}, n_words long, at binary, what binary, seen array<int>", places, size=200))
    counts = held.select(F.explode("seen").alias("s")).groupBy("s").agg(F.count("*").alias("n")).collect()
    rarity = np.zeros(len(block["keys"]), np.int64)
    for r in counts:
        rarity[r["s"]] = r["n"]
    prefix: dict[int, list[tuple[int, int]]] = {}
    for k, own in enumerate(block["places"]):
        if rarity[own].min() > 0:  # a window with a shingle in no document occurs nowhere
            j = int(rarity[own].argmin())
            prefix.setdefault(int(own[j]), []).append((k, j))
    plan = context.broadcast((prefix, np.array(sorted(prefix), np.int32)))

    def verify(rows):
        windows_, numbers, lengths = (sent.value[k] for k in ("places", "numbers", "lengths"))
        by, wanted = plan.value
        for r in rows:
            at, what = np.frombuffer(r["at"], np.int32), np.frombuffer(r["what"], np.int32)
            spans, hit = set(), set()
            if len(at) and len(wanted):
                slot = np.searchsorted(wanted, what)
                slot[slot == len(wanted)] = 0
                candidates = np.flatnonzero(wanted[slot] == what)
                if len(candidates):
                    code = np.sort((at.astype(np.int64) << 32) | what)
                    for c in candidates.tolist():
                        for k, j in by[int(what[c])]:
                            start = int(at[c]) - j
                            if start < 0 or start + lengths[k] > r["n_words"]:
                                continue
                            need = ((start + np.arange(len(windows_[k]), dtype=np.int64)) << 32) | windows_[k]
                            slots = np.minimum(np.searchsorted(code, need), len(code) - 1)
                            if (code[slots] == need).all():
                                spans.add((start, start + lengths[k]))
                                hit.add(numbers[k])
            yield r["row"], r["doc"], r["n_words"], [{"start": a, "stop": z} for a, z in sorted(spans)], sorted(hit)

    schema = f"row long, doc {kind}, n_words long, spans array<struct<start:long,stop:long>>, hit array<long>"
    return arrow_map(held.select("row", "doc", "n_words", "at", "what"), schema, verify, size=200)
