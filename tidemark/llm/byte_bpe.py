"""Byte-level byte-pair encoding in padded matrices, and decoding by a table of byte strings.

A rank file gives every token's bytes and rank, and the rank is the id. A text is cut by a pattern; a piece
that is a token stands for itself, any other starts as its bytes and merges, again and again, the leftmost of
its neighbouring pairs whose joined bytes have the lowest rank.

Pieces of similar length are the rows of one matrix. Every round each row merges its leftmost pair of lowest
rank; the matrix gets a column narrower, and rows without a pair leave it. Ranks of pairs are looked up in a
hash table held in two arrays, and only for the two pairs that a merge makes. Very long pieces are first cut
where no token has these two bytes side by side, and what is still long is a matrix of one row that merges
all places of the lowest rank in a round, where this equals merging them one after the other.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, worker_state

#: White space of the pattern language in which the rank files state their rules.
SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
NONE = np.int64(1) << 40
CELLS, WIDE, BLOCK, REMEMBERED = 1 << 20, 512, 1 << 20, 64


class Pairs:
    """Hash table from two neighbouring ids to the id of their joined bytes: two arrays, linear probing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int64)
        self.probes, slot = 0, self.slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]  # of several for one slot, one stays
            placed = self.keys[slot] == keys
            self.values[slot[placed]] = values[placed]
            keys, values = keys[~placed], values[~placed]
            slot = (slot[~placed] + 1) & (len(self.keys) - 1)
            self.probes += 1

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of joined neighbours; ``NONE`` where there is none or one side is padding (-1)."""
        keys = np.where((left < 0) | (right < 0), np.int64(-2), left << 32 | right)
        slot = self.slot(keys)
        out = np.where(self.keys[slot] == keys, self.values[slot], NONE)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != -1) & (keys != -2))
        for step in range(1, self.probes):
            if not len(open_):
                break
            at = (slot[open_] + step) & (len(self.keys) - 1)
            hit = self.keys[at] == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (self.keys[at] != -1)]
        return out


class Ranks:
    """Tables of a rank file: bytes by id, ids of single bytes, joined pairs, and neighbouring bytes inside tokens."""

    def __init__(self, text: bytes):
        lines = (line.split() for line in text.splitlines())
        self.ids = {base64.b64decode(line[0]): int(line[1]) for line in lines if line}
        missing = [b for b in range(256) if bytes([b]) not in self.ids]
        if missing or len(set(self.ids.values())) < len(self.ids) or not 0 <= min(self.ids.values()) <= max(self.ids.values()) < 1 << 31:
            raise ValueError("a rank file needs every single byte, and ranks of their own below 2^31")
        self.bytes = {i: t for t, i in self.ids.items()}
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        keys, values, self.inside = [], [], np.zeros((256, 256), bool)
        for token, rank in self.ids.items():
            for k in range(1, len(token)):
                left, right = self.ids.get(token[:k]), self.ids.get(token[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
            codes = np.frombuffer(token, np.uint8)
            self.inside[codes[:-1], codes[1:]] = True
        self.pairs = Pairs(np.array(keys, np.int64), np.array(values, np.int64))

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of every piece, four bytes each."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            whole = self.ids.get(piece)
            if whole is not None:
                out[k] = np.uint32(whole).tobytes()
            else:
                buckets.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(k)
        for width, members in sorted(buckets.items()):
            if width > WIDE:
                for k in members:
                    out[k] = b"".join(self._cut(pieces[k]))
                continue
            step = max(1, CELLS // width)
            for start in range(0, len(members), step):
                some = members[start : start + step]
                for k, ids in zip(some, self._merge([pieces[k] for k in some])):
                    out[k] = ids
        return out

    def _merge(self, pieces: list[bytes]) -> list[bytes]:
        """The rows of one matrix, each merged to its end."""
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths.max(initial=0))
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)
        ids = np.where(np.arange(width) < lengths[:, None], self.single[flat], -1)
        joined = self.pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), max(width - 1, 0))
        rows, out = np.arange(len(pieces)), [b""] * len(pieces)
        while len(rows):
            at = joined.argmin(axis=1) if joined.shape[1] else np.zeros(len(rows), np.int64)
            rank = joined[np.arange(len(rows)), at] if joined.shape[1] else np.full(len(rows), NONE)
            live = rank < NONE
            if not live.all():  # rows at their end leave the matrix
                for row, done in zip(rows[~live], ids[~live]):
                    out[row] = done[done >= 0].astype("<u4").tobytes()
                rows, ids, joined, at, rank, lengths = rows[live], ids[live], joined[live], at[live], rank[live], lengths[live]
                if not len(rows):
                    break
            n = np.arange(len(rows))
            lengths = lengths - 1
            ids[n, at] = rank
            ids = _without(ids, at + 1)
            joined = _without(joined, at)
            wide = int(lengths.max())  # padding shared by all rows goes too
            ids, joined = ids[:, :wide], joined[:, : max(wide - 1, 0)]
            if wide > 1:
                left, right = np.flatnonzero(at > 0), np.flatnonzero(at < wide - 1)
                joined[left, at[left] - 1] = self.pairs(ids[left, at[left] - 1], rank[left])
                joined[right, at[right]] = self.pairs(rank[right], ids[right, at[right] + 1])
        return out

    def _cut(self, piece: bytes) -> Iterator[bytes]:
        """A long piece in parts that no token joins."""
        codes = np.frombuffer(piece, np.uint8)
        ends = [*(np.flatnonzero(~self.inside[codes[:-1], codes[1:]]) + 1).tolist(), len(piece)]
        parts = [piece[a:b] for a, b in zip([0, *ends], ends)]
        start = 0
        while start < len(parts):
            if len(parts[start]) > WIDE:
                yield self._merge_long(parts[start])
                start += 1
                continue
            stop, longest = start, 0
            while stop < len(parts) and len(parts[stop]) <= WIDE and (stop - start + 1) * max(longest, len(parts[stop])) <= CELLS:
                longest = max(longest, len(parts[stop]))
                stop += 1
            yield from self._merge(parts[start:stop])
            start = stop

    def _merge_long(self, piece: bytes) -> bytes:
        """One row; a round merges all places of the lowest rank unless a merge makes a pair of lower rank."""
        ids = self.single[np.frombuffer(piece, np.uint8)]
        joined = self.pairs(ids[:-1], ids[1:])
        while len(joined):
            rank = joined.min()
            if rank == NONE:
                break
            at = np.flatnonzero(joined == rank)
            first = np.flatnonzero(np.diff(at, prepend=-2) != 1)  # of overlapping places every other one is merged
            run = np.repeat(first, np.diff(np.append(first, len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            before = np.where(np.diff(at, prepend=-2) == 2, rank, ids[at - 1])
            before[at == 0] = -1
            after = np.where(at + 2 < len(ids), ids[np.minimum(at + 2, len(ids) - 1)], -1)
            new = np.full(len(at), rank)
            if min(self.pairs(before, new).min(), self.pairs(new, after).min()) < rank:
                at = at[:1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids[at] = rank
            ids = ids[keep]
            rest = np.ones(len(joined), bool)
            rest[at] = False
            joined = joined[rest]
            at = at - np.arange(len(at))
            for places in (at[at > 0] - 1, at[at < len(ids) - 1]):
                joined[places] = self.pairs(ids[places], ids[places + 1])
        return ids.astype("<u4").tobytes()


def _without(matrix: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Every row without its own one of the columns."""
    keep = np.ones(matrix.shape, bool)
    keep[np.arange(len(matrix)), column] = False
    return matrix[keep].reshape(len(matrix), matrix.shape[1] - 1)


class Encoder:
    """Ids of whole texts, several at a time; short pieces seen lately are remembered."""

    def __init__(self, ranks: Ranks, pattern: str, cache: int = 100_000):
        self.ranks, self.cache, self.known = ranks, cache, {}
        own = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")
        self.pieces = regex.compile(own).findall
        self.gap = regex.compile(f"(?<=[^{SPACE}]) (?=[^{SPACE}])")

    def blocks(self, text: str) -> Iterator[str]:
        """A long text in parts: a piece always begins at a lone space between other characters."""
        start = 0
        while len(text) - start > BLOCK:
            found = self.gap.search(text, start + BLOCK)
            if found is None:
                break
            yield text[start : found.start()]
            start = found.start()
        yield text[start:] if start else text

    def __call__(self, texts: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > self.cache:  # the older half goes
            self.known = known = dict(islice(known.items(), self.cache // 2, None))
        split = [self.pieces(t) for t in texts]
        fresh = list({p for pieces in split for p in pieces if p not in known})
        known.update(zip(fresh, self.ranks.encode([p.encode("utf-8", "replace") for p in fresh])))
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in split]
        for p in fresh:
            if len(p) > REMEMBERED:
                del known[p]
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.ranks.bytes.__getitem__, ids))


def _groups(source, encoder: Encoder, size: int = BLOCK):
    """Rows with the ids of their texts as parts; small texts are encoded together, long ones part by part."""
    held, chars = [], 0

    def flush():
        return zip((r for r, _ in held), ([ids] for ids in encoder([t for _, t in held])))

    for r in source:
        text = r["text"] or ""
        if len(text) > size:
            yield r, (ids for block in encoder.blocks(text) for ids in encoder([block]))
            continue
        held.append((r, text))
        chars += len(text)
        if chars > size:
            yield from flush()
            held, chars = [], 0
    yield from flush()


def _tables(df: DataFrame, path: str):
    """The rank file travels with the job: a megabyte whatever the input."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _worker(spec, pattern: str) -> Encoder:
    return worker_state("byte_bpe", (hash(spec.value), pattern), lambda: Encoder(Ranks(spec.value), pattern))


def _slim(df: DataFrame, id_col: str, value: str, name: str) -> tuple[DataFrame, str]:
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("doc"), F.col(value).alias(name)), f"doc {kind}"


def encode(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids``: the token ids of every whole text; null and empty texts have none.

    Rows are independent: repeated rows and null ids give a row each, other columns are not read.
    """
    spec = _tables(docs, path)
    slim, key = _slim(docs, id_col, text_col, "text")

    def rows(source):
        for r, parts in _groups(source, _worker(spec, pattern)):
            yield r["doc"], np.frombuffer(b"".join(parts), "<u4").astype(np.int32).tolist()

    return arrow_map(slim, f"{key}, ids array<int>", rows, size=100, state="byte_bpe").withColumnRenamed("doc", id_col)


def decode(tokens: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, bytes`` from token ids; null and empty lists give no bytes, an unknown id is an error."""
    spec = _tables(tokens, path)
    slim, key = _slim(tokens, id_col, ids_col, "ids")

    def rows(source):
        encoder = _worker(spec, pattern)
        for r in source:
            yield r["doc"], encoder.decode(r["ids"] or [])

    return arrow_map(slim, f"{key}, bytes binary", rows, size=100, state="byte_bpe").withColumnRenamed("doc", id_col)


def digests(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of every whole text, encoded and decoded in parts.

    Same defined results as ``encode``: null and empty texts have no tokens and decode to nothing.
    """
    spec = _tables(docs, path)
    slim, key = _slim(docs, id_col, text_col, "text")

    def rows(source):
        encoder = _worker(spec, pattern)
        for r, parts in _groups(source, encoder):
            n, a, b = 0, hashlib.sha256(), hashlib.sha256()
            for part in parts:
                n += len(part) // 4
                a.update(part)
                b.update(encoder.decode(memoryview(part).cast("I")))
            yield r["doc"], n, a.hexdigest(), b.hexdigest()

    schema = f"{key}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_map(slim, schema, rows, state="byte_bpe").withColumnRenamed("doc", id_col)
