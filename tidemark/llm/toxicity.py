"""Toxicity of restored text: noisy-channel deobfuscation, then a score learned from labels.

A token is read as a lattice: every character may be itself, a letter it imitates, a letter said once or
twice in a longer run, noise to be dropped, or a border between words; single characters that follow one
another are read as one token with droppable spaces. Viterbi search picks the reading that is likeliest
under a character trigram model, counted over all documents, and the costs of the channel. A token of plain
letters has only one reading.

The score looks at the words of the restored text. Evidence is the log-odds of a word or word beginning
between toxic and other training documents; a document is described by its strongest pieces of evidence
(left-one-out while training) and a logistic regression maps them to a probability. Labels of training
rows only are read, and labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

import math
import zlib
from itertools import islice
from operator import eq

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, batch_map, worker_state

#: Labelled rows used for training, of each label those with the smallest hashes.
TRAINING_TOXIC, TRAINING_OTHER = 6_000, 10_000
#: Toxic training documents that must hold a piece of evidence, and the most pieces kept (by log-odds).
SUPPORT, EVIDENCE = 2, 200_000
PREFIXES = range(3, 9)
#: Documents' worth of doubt in the share of toxic documents among those that hold a piece.
PRIOR = 4.0
TOP = 5
#: Smallest word hashes that must all agree in copies; below 0.9 of shared words that has a chance under 4 %, below 0.5 under 10^-9.
MINIMA = 32
#: Tokens whose evidence a worker remembers, twice.
CACHED = 150_000

#: Letters that a character may stand for.
IMITATED = {"@": "a", "4": "a", "3": "e", "€": "e", "1": "il", "!": "il", "|": "il", "0": "o", "$": "s", "5": "s", "7": "t", "+": "t", "8": "b", "9": "g", "6": "g", "(": "c", "2": "z", "µ": "u"}
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
NUMBER = {c: k + 1 for k, c in enumerate(LETTERS)}
SIZE = len(LETTERS) + 2  # 0: no letter; the last number: any other letter
#: Costs of the channel: characters that seldom mean anything else inside a word, punctuation, joints, other noise.
STRONG, JOINTS = frozenset("@$€0123456789"), frozenset(".-_*' ")
COST_IMITATED, COST_TWICE = 1.0, 1.0


def costs(c: str) -> tuple[float, float, float]:
    """Of a character that is no letter: to imitate one, to be dropped inside a word, to be a border."""
    if c in STRONG:
        return COST_IMITATED, 3.0, 2.0
    if c == " ":
        return 0.0, 0.2, 0.0
    return 2.5, 0.6 if c in JOINTS else 2.0, 0.7


def number(c: str) -> int:
    return NUMBER.get(c) or (SIZE - 1 if c.isalpha() else 0)


# Character model


def _letter_table() -> np.ndarray:
    return np.array([number(chr(c).lower()[:1]) if chr(c).isalpha() else 0 for c in range(0x250)], np.int64)


def trigram_counts(text: str, table: np.ndarray) -> np.ndarray:
    """Numbers of letter trigrams; a word is preceded by two borders and followed by one."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(c < len(table), table[np.minimum(c, len(table) - 1)], SIZE - 1)
    c = np.concatenate([[0], c, [0]])
    c = c[(c > 0) | np.concatenate([[True], c[:-1] > 0])]
    c = np.repeat(c, 1 + (c == 0))
    code = (c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:]
    return code[(c[2:] > 0) | (c[1:-1] > 0)]


def character_model(docs: DataFrame) -> np.ndarray:
    """Log-probabilities [before last, last, next] from all texts; smoothed with shorter contexts."""
    def rows(batches):
        import pyarrow as pa

        table, total = _letter_table(), np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for start in range(0, len(text or ""), 1 << 20):
                    code = trigram_counts(text[start : start + (1 << 20)], table)
                    if len(code) > 2000:
                        total += np.bincount(code, minlength=SIZE**3)
                    else:
                        np.add.at(total, code, 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["code", "n"])

    counts = batch_map(docs.select("text"), rows, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(SIZE**3)
    for r in counts:  # at most SIZE**3 rows
        n[r["code"]] = r["n"]
    n = n.reshape(SIZE, SIZE, SIZE)
    one = n.sum((0, 1)) + 1
    one /= one.sum()
    two = n.sum(0)
    two = (two + 5 * one) / (two.sum(1, keepdims=True) + 5)
    return np.log((n + 5 * two[None]) / (n.sum(2, keepdims=True) + 5)).astype(np.float32)


# Channel


def plain(token: str) -> bool:
    """Only letters, and no letter three times in a row: a single reading."""
    return token.isalpha() and not any(a == b == c for a, b, c in zip(token, token[1:], token[2:]))


def restore(token: str, model: list, beam: int = 40) -> list[str]:
    """Words of the likeliest reading of a token (lower case)."""
    units: list[tuple[str, int]] = []
    for c in token:
        if units and units[-1][0] == c:
            units[-1] = (c, units[-1][1] + 1)
        else:
            units.append((c, 1))
    # state: last two letter numbers -> (score, chain of emitted characters)
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}

    def step(a: int, b: int, score: float, chain, letter: str | None):
        """One emitted letter, or a border (None)."""
        k = number(letter) if letter else 0
        if not k and b == 0:
            return (0, 0), score, chain  # no empty words
        score += model[a][b][k]
        return ((b, k) if k else (0, 0)), score, (chain, letter or " ")

    for c, run in units:
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        if run == 1 and c.isalpha():  # a single letter is itself: the case of almost all characters
            k = number(c)
            for (a, b), (score, chain) in states.items():
                score += model[a][b][k]
                held = new.get((b, k))
                if held is None or score > held[0]:
                    new[b, k] = (score, (chain, c))
            states = new if len(new) <= beam else dict(sorted(new.items(), key=lambda x: -x[1][0])[:beam])
            continue

        def offer(state, score, chain, new=new):
            if state not in new or score > new[state][0]:
                new[state] = (score, chain)

        for (a, b), (score, chain) in states.items():
            if c.isalpha():
                readings = [(c, 0.0, 1)] if run == 1 else [(c, 0.0 if run == 2 else COST_TWICE, 2), (c, COST_TWICE, 1)]
            else:
                imitated, dropped, border = costs(c)
                readings = [(x, imitated * run, run) for x in IMITATED.get(c, "")] if run <= 2 else []
                strong = run <= 2 and c in STRONG  # also before a word
                offer((a, b), score - (dropped if b or strong else 0.0), chain)
                s, v, ch = step(a, b, score, chain, None)
                offer(s, v - (border if b or strong else 0.0), ch)
            for letter, cost, times in readings:
                s, v, ch = (a, b), score - cost, chain
                for _ in range(times):
                    s, v, ch = step(*s, v, ch, letter)
                offer(s, v, ch)
        if len(new) > beam:
            new = dict(sorted(new.items(), key=lambda x: -x[1][0])[:beam])
        states = new
    best = max((step(a, b, score, chain, None)[1:] for (a, b), (score, chain) in states.items()), key=lambda x: x[0])[1]
    out = []
    while best is not None:
        best, letter = best
        out.append(letter)
    return "".join(reversed(out)).split()


#: Characters that may be read as letters; any other one that is no letter says nothing at the ends of a token.
READ = STRONG | frozenset(IMITATED)


def framed(token: str) -> tuple[str, ...] | None:
    """What ``restore`` gives for letters, none of them doubled, between characters that can't be letters: the letters."""
    i, j = 0, len(token)
    while i < j and not (token[i].isalpha() or token[i] in READ):
        i += 1
    while i < j and not (token[j - 1].isalpha() or token[j - 1] in READ):
        j -= 1
    core = token[i:j]
    if not core:
        return ()
    return (core,) if core.isalpha() and not any(map(eq, core, core[1:])) else None


class Restorer:
    """Words of tokens; remembers readings for the life of the worker, in bounded memory."""

    def __init__(self, model: np.ndarray, cache: int = 20_000):
        self.model, self.cache, self.known = model.tolist(), cache, {}

    def words(self, token: str) -> tuple[str, ...]:
        if plain(token):
            return (token,)
        held = framed(token)
        if held is not None:
            return held
        held = self.known.get(token)
        if held is None:
            if len(self.known) > self.cache:
                self.known = dict(islice(self.known.items(), self.cache // 2, None))
            # very long tokens are read in parts, so the chain of a reading stays short
            held = tuple(w for k in range(0, len(token), 4096) for w in restore(token[k : k + 4096], self.model))
            if len(token) <= 64:
                self.known[token] = held
        return held


def tokens_of(text: str | None) -> set[str]:
    """Distinct tokens of a text in lower case; runs of four or more single characters are one token."""
    tokens = (text or "").lower().split()
    single = [k for k, t in enumerate(tokens) if len(t) == 1]
    out = set(tokens)
    start = 0
    for k in range(1, len(single) + 1):
        if k == len(single) or single[k] != single[k - 1] + 1:
            if k - start >= 4:
                out.add(" ".join(tokens[single[start] : single[k - 1] + 1]))
            start = k
    return out


def sketch(words: list[str]) -> bytes:
    """The ``MINIMA`` smallest hashes of distinct words: all of them in a shorter text, so only equal sets agree."""
    return b"".join(h.to_bytes(8, "big") for h in sorted(map(xxhash.xxh3_64_intdigest, words))[:MINIMA])


# Evidence


def pieces(word: str) -> list[str]:
    return [word[:k] for k in PREFIXES if k < len(word)] + [word + "$"]


class Evidence:
    """Log-odds of the pieces, and the strongest evidence of a document."""

    def __init__(self, counts: dict[str, tuple[float, float]], toxic: float, other: float, restorer: Restorer):
        self.counts, self.toxic, self.other, self.restorer = counts, max(toxic, 1.0), max(other, 1.0), restorer
        self.odds = {f: self._odds(t, o) for f, (t, o) in counts.items()}
        self.known: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def _odds(self, t: float, o: float) -> float:
        """Log-odds over those of a document as such; few documents count as little evidence."""
        base = self.toxic / (self.toxic + self.other)
        share = (t + PRIOR * base) / (t + o + PRIOR)
        return math.log(share / (1 - share)) - math.log(base / (1 - base))

    def values(self, tokens) -> list[float]:
        """The evidence of each token that is some."""
        known, out = self.known, []
        for t in tokens:
            v = known.get(t)
            if v is None:
                v = self.token(t)
                known = self.known
            if v > 0:
                out.append(v)
        return out

    def token(self, token: str) -> float:
        """Strongest evidence of a token; remembered while it is seen now and then: a full table becomes the old one."""
        held = self.old.get(token)
        if held is None:
            odds, held = self.odds, 0.0
            for w in self.restorer.words(token):
                for f in pieces(w):
                    v = odds.get(f)
                    if v is not None and v > held:
                        held = v
        if len(token) <= 64:
            if len(self.known) >= CACHED:
                self.known, self.old = {}, self.known
            self.known[token] = held
        return held

    def without(self, words: list[str], toxic: bool) -> float:
        """As ``token`` for the restored words of one, the document's own counts taken off."""
        best = 0.0
        for w in words:
            for f in pieces(w):
                if f in self.counts:
                    t, o = self.counts[f]
                    best = max(best, self._odds(t - 1, o) if toxic else self._odds(t, o - 1))
        return best

    @staticmethod
    def describe(values: list[float], n: int) -> list[float]:
        """Numbers that describe a document of ``n`` tokens, of which some are evidence."""
        top = sorted((v for v in values if v > 0), reverse=True)[:TOP] + [0.0] * TOP
        return [1.0, top[0], max(0.0, top[0] - 1.5), max(0.0, top[0] - 2.5), top[1], sum(top[:TOP]) / TOP, math.log1p(n)]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights by Newton's method with a small ridge on all but the constant."""
    w = np.zeros(x.shape[1])
    keep = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def training_rows(labels: DataFrame, id_col: str) -> DataFrame:
    """id, toxic of the labelled rows that may be learned from, bounded; conflicting labels of an id count as toxic."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col(id_col)))
    rows = rows.groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").alias("toxic")).withColumn("h", F.xxhash64("id"))
    toxic = rows.where("toxic = 1").orderBy("h", "id").limit(TRAINING_TOXIC)
    return toxic.unionByName(rows.where("toxic <> 1").orderBy("h", "id").limit(TRAINING_OTHER)).select("id", "toxic")


def held_out(doc):
    return F.crc32(doc.cast("string").cast("binary")) % 3 == 1


class Model:
    """All that scoring needs; of bounded size."""

    def __init__(self, letters, counts, toxic, other, weights):
        self.letters, self.counts, self.toxic, self.other, self.weights = letters, counts, toxic, other, weights

    def plain(self) -> tuple:
        """What is sent to tasks: arrays, dictionaries and numbers, as executors need not have this package."""
        return self.letters, self.counts, self.toxic, self.other, self.weights.tolist(), getattr(self, "tag", None)


def evidence_of(sent: tuple) -> Evidence:
    letters, counts, toxic, other = sent[:4]
    return Evidence(counts, toxic, other, Restorer(letters))


def worker_evidence(sent: tuple) -> Evidence:
    """The evidence tables of this worker process for a model that was sent."""
    return worker_state("toxicity", sent[5], lambda: evidence_of(sent))


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch, *, id_col: str, text_col: str) -> Model:
    letters = character_model(docs.select(F.col(text_col).alias("text")))
    spark = docs.sparkSession
    chosen = scratch.keep(training_rows(labels, id_col))
    # TRAINING_TOXIC + TRAINING_OTHER rows of two numbers: bounded, whatever the documents
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    sent = spark.sparkContext.broadcast(letters)

    def read(rows):
        restorer = Restorer(sent.value)
        for r in rows:
            tokens = tokens_of(r["text"])
            restored = [list(restorer.words(t)) for t in sorted(tokens)]
            yield r["toxic"], sketch(sorted({w for words in restored for w in words})), r["order"], restored

    # copies count as one document: the one whose id has the smallest hash, of repeated ids the smallest words;
    # the words of each token are restored once and kept
    kind = docs.schema[id_col].dataType.simpleString()
    ordered = sample.withColumn("order", F.struct(F.xxhash64("id").alias("h"), "id"))
    read_docs = arrow_map(ordered, f"toxic int, sketch binary, order struct<h:long,id:{kind}>, tokens array<array<string>>", read, size=100)
    read_docs = scratch.keep(read_docs.groupBy("toxic", "sketch").agg(F.min(F.struct("order", "tokens")).alias("first")).select("toxic", "first.tokens"))

    def count(rows):
        seen = {}

        def flush():
            for f, (t, o) in seen.items():
                yield f, t, o
            seen.clear()

        for r in rows:
            for f in {f for words in r["tokens"] for w in words for f in pieces(w)}:
                pair = seen.setdefault(f, [0, 0])
                pair[r["toxic"] != 1] += 1
            if len(seen) > 1_000_000:
                yield from flush()
        yield from flush()

    sizes = {r["toxic"] == 1: r["n"] for r in read_docs.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, other = sizes.get(True, 0), sizes.get(False, 0)
    counted = arrow_map(read_docs.select("toxic", "tokens"), "f string, t long, o long", count, size=20_000).groupBy("f").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    ratio = (F.col("t") + 0.3) / (F.col("o") + 0.3)
    best = counted.where((F.col("t") >= SUPPORT) & (ratio * (other + 1) > (toxic + 1) * 2)).orderBy(ratio.desc(), "f").limit(EVIDENCE)
    counts = {r["f"]: (float(r["t"]), float(r["o"])) for r in best.collect()}

    model = Model(letters, counts, toxic, other, np.zeros(7))
    if not toxic or not other:
        model.weights = np.array([3.0 if toxic else -3.0] + [0.0] * 6)
        return _tagged(model)
    table = spark.sparkContext.broadcast(model.plain())

    def describe(rows):
        evidence = evidence_of(table.value)
        for r in rows:
            values = [evidence.without(words, r["toxic"] == 1) for words in r["tokens"]]
            yield r["toxic"], Evidence.describe(values, len(values))

    described = arrow_map(read_docs.select("toxic", "tokens"), "toxic int, x array<double>", describe).collect()
    x, y = np.array([r["x"] for r in described]), np.array([float(r["toxic"] == 1) for r in described])
    model.weights = logistic(x, y)
    scratch.drop(read_docs, chosen)
    for done in (sent, table):
        done.unpersist()
    return _tagged(model)


def _tagged(model: Model) -> Model:
    model.tag = zlib.crc32(repr((sorted(model.counts.items())[:1000], model.weights.tolist(), model.toxic, model.other, float(model.letters.sum()))).encode())
    return model


def score(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """``id_col, held_out, score, predicted`` for every row of ``docs``, and ``key_col`` carried along if given.

    Empty and null texts have no evidence and get the score that belongs to none. Rows with null ids are
    not held out, learn nothing and are scored like all others; repeated rows get a row each. Labels that
    are null, or whose document is missing, teach nothing; without labels of both kinds the score is a
    constant near the kind there is. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, scratch, id_col=id_col, text_col=text_col).plain())
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(source):
        evidence, w = worker_evidence(sent.value), sent.value[4]
        for r in source:
            tokens = tokens_of(r["text"])
            x = Evidence.describe(evidence.values(tokens), len(tokens))
            z = sum(a * b for a, b in zip(w, x))
            yield r["doc"], 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), *((r["key"],) if key_col else ())

    source, schema = [F.col(id_col).alias("doc"), F.col(text_col).alias("text")], f"doc {kind}, score double"
    if key_col:
        source, schema = [*source, F.col(key_col).alias("key")], f"{schema}, key {docs.schema[key_col].dataType.simpleString()}"
    out = arrow_map(docs.select(source), schema, rows, state="toxicity")
    return out.select(F.col("doc").alias(id_col), F.coalesce(held_out(F.col("doc")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), *([F.col("key").alias(key_col)] if key_col else []))
