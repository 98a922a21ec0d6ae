"""Stretches of words that repeat with a period, found by seeds on diagonals and extended once each.

A run of period q holds at least 4q words, so the words at i and i + q agree over at least 3q places. Periods
from 2^b to 2^(b+1)-1 therefore all show up as two equal k-grams q apart with k = 3 * 2^b (5 for period 1, whose
runs hold six words). As k is no smaller than the period, the two are neighbours among the places of their
k-gram: each place pairs with the next one only, however often a k-gram occurs. Names of k-grams come from names
of the 1-, 2-, 4-, ... grams, and only places whose gram occurs again in the document go on.

A seed is extended to the left and right along its diagonal unless the table of its lag says that an earlier
extension got that far already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

WORDS = 1 << 17  # words that are searched together; a longer document is searched alone
SHORTEST, TIMES = 6, 4


def _named(keys: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A name for every place whose key occurs again, -1 for all others, and those places in order."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.diff(ordered, prepend=ordered[:1] - 1) != 0 if len(ordered) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    again = np.bincount(group, minlength=1)[group] > 1 if len(group) else new
    names = np.full(n, -1, np.int64)
    names[places[order[again]]] = group[again]
    return names, np.flatnonzero(names >= 0)


def _joined(left: np.ndarray, right: np.ndarray, places: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the grams made of the one at a place and the one ``gap`` words on, where both have names."""
    places = places[places + gap < len(right)]
    places = places[right[places + gap] >= 0]
    return left[places] * np.int64(len(left) + 1) + right[places + gap], places


def _seeds(x: np.ndarray, document: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(lag, place, k): equal k-grams of one document a lag apart, with no equal one between them."""
    n = len(x)
    places = np.flatnonzero(x >= 0)
    first, places = _named(document[places] * np.int64(int(x.max(initial=0)) + 1) + x[places], places, n)
    short, size = first, 1  # names of grams of ``size`` words, and of twice as many
    wide, places = _named(*_joined(short, short, places, 1), n)
    if len(places):  # period 1: grams of four words and one more
        four = _named(*_joined(wide, wide, places, 2), n)
        yield from _neighbours(*_joined(four[0], first, four[1], 4), 1, 2, 5)
    while len(places):
        short, size = wide, 2 * size
        wide, places = _named(*_joined(short, short, places, size), n)
        yield from _neighbours(*_joined(wide, short, places, 2 * size), size, 2 * size, 3 * size)


def _neighbours(keys: np.ndarray, places: np.ndarray, low: int, high: int, k: int) -> Iterator[tuple[int, int, int]]:
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order]
    lag = np.diff(places)
    near = np.flatnonzero((keys[1:] == keys[:-1]) & (lag >= low) & (lag < high))
    lag, places = lag[near], places[near]
    order = np.lexsort((places, lag))
    lag, places = lag[order], places[order]
    # of seeds side by side on a diagonal one is enough
    fresh = np.ones(len(lag), bool)
    fresh[1:] = (np.diff(lag) != 0) | (np.diff(places) != 1)
    yield from zip(lag[fresh].tolist(), places[fresh].tolist(), [k] * int(fresh.sum()))


def _extend(x: np.ndarray, place: int, lag: int, step: int) -> int:
    """First place from ``place`` on, upwards or downwards, whose word and the one a lag on differ."""
    block = 64
    while True:
        a, b = (place, min(place + block, len(x) - lag)) if step > 0 else (max(place - block + 1, 0), place + 1)
        if a >= b:
            return place
        unlike = np.flatnonzero(x[a:b] != x[a + lag : b + lag])
        if len(unlike):
            return a + int(unlike[0] if step > 0 else unlike[-1])
        place, block = (b if step > 0 else a - 1), 4 * block


def runs(x: np.ndarray, document: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of every run in ``x``; places of -1 end a document, ``document`` numbers them.

    A run holds at least four periods and six words, its period is the smallest one, and neither
    neighbouring word keeps it.
    """
    x = x.copy()
    x[x < 0] = -1 - np.arange(int((x < 0).sum()))  # an end is like nothing else
    furthest: dict[int, int] = {}
    for lag, place, k in _seeds(x, document):
        if place < furthest.get(lag, 0):
            continue
        stop = _extend(x, place + k, lag, 1)
        start = _extend(x, place - 1, lag, -1) + 1 if place else 0
        furthest[lag] = stop
        if stop - start + lag >= max(SHORTEST, TIMES * lag):
            yield start, stop - start + lag, lag


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8: what splitting bytes at their white space gives."""
    return (text or "").encode("utf-8", "replace").split()


def _together(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs of each document, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    lengths = np.array([len(w) + 1 for w in documents])
    starts = np.cumsum(lengths) - lengths
    numbers, end = _Numbers(), [b""]  # a word is never empty
    numbers[b""] = -1
    flat = chain.from_iterable(chain(w, end) for w in documents)
    x = np.fromiter(map(numbers.__getitem__, flat), np.int64, int(lengths.sum()))
    document = np.repeat(np.arange(len(documents)), lengths)
    for start, length, period in runs(x, document):
        of = int(document[start])
        out[of].append((start - int(starts[of]), length, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words without those that any run holds after its first period, joined by one space."""
    if not found:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(keep)])


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, of equal ones the first, then the one of shorter period."""
    best = None
    for r in found:  # in order of start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", edit: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``id_col, runs, best, text``: every run of each whole text, the strongest one, and the text without repeats.

    ``runs`` holds (start, length, period) in words, by start, then period; ``text`` are the words outside the
    repeats joined by one space. ``edit`` may change a row's words first. Null, empty and blank texts have no
    runs, a null ``best`` and an empty text; rows are independent, so repeated rows and null ids give a row each.
    Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    run = "struct<start: long, length: long, period: long>"
    named = lambda r: r and dict(zip(("start", "length", "period"), r))

    def rows(source):
        held, size = [], 0

        def flush():
            for (key, words), found in zip(held, _together([w for _, w in held])):
                yield key, [named(r) for r in found], named(strongest(found)), collapsed(words, found).decode("utf-8")

        for r in source:
            words = words_of(r["text"])
            held.append((r["doc"], edit(r["doc"], words) if edit else words))
            size += len(words)
            if size >= WORDS:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    slim = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    return arrow_map(slim, f"doc {kind}, runs array<{run}>, best {run}, text string", rows, size=200).withColumnRenamed("doc", id_col)
