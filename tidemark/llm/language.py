"""Language model scores: a unigram base and a log-bilinear model trained by noise-contrastive estimation.

The model predicts one of ``FREQUENT`` words, the end, or one of ``CLASSES`` classes of all other words (by
their last two bytes) from the two tokens before. A word of a class has the class's probability times its
add-one share of the class's training tokens; one more share is left for words never seen, so the
probabilities of a place sum to one. The score of a token is a sum of two inner products, one per token of
context, so the sum over all outcomes is a matrix product as well: exp(A1) @ exp(A2).T holds the
normaliser of every context, and a text is scored by lookups.

Training reads all training tokens once. In each of a few rounds, every task improves a copy of the
parameters on its part of the round's documents by noise-contrastive steps on batches that share their
noise words; the copies are averaged by the number of tokens. Word counts of the whole training corpus
stay in a table; only the most frequent words go to the tasks, all others are looked up by a join.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, batch_map, worker_state

FREQUENT, CLASSES, HELD = 1500, 256, 200_000
OUTCOMES = FREQUENT + 1 + CLASSES
END = FREQUENT
WIDTH = 24
NOISE, BATCH, RATE = 64, 1024, 0.15
#: Shares of the training documents read in each round; together all of them.
ROUNDS = (1, 3, 4)
SEED = 17


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def class_of(word: bytes) -> int:
    return FREQUENT + 1 + zlib.crc32(word[-2:]) % CLASSES


class Parameters:
    """Context vectors of the two places, outcome vectors, and biases."""

    def __init__(self, u1, u2, r, b):
        self.u1, self.u2, self.r, self.b = u1, u2, r, b

    @classmethod
    def start(cls, counts: np.ndarray) -> "Parameters":
        rng = np.random.default_rng(SEED)
        draw = lambda: (rng.standard_normal((OUTCOMES, WIDTH)) * 0.1).astype(np.float32)
        return cls(draw(), draw(), draw(), np.log(unigram(counts)).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.u1, self.u2, self.r, self.b)])

    @classmethod
    def of(cls, flat: np.ndarray) -> "Parameters":
        n = OUTCOMES * WIDTH
        flat = flat.astype(np.float32)
        return cls(*(flat[k * n : (k + 1) * n].reshape(OUTCOMES, WIDTH).copy() for k in range(3)), flat[3 * n :].copy())


def unigram(counts: np.ndarray) -> np.ndarray:
    return (counts + 0.5) / (counts + 0.5).sum()


class Trainer:
    """Noise-contrastive steps on batches of (last, one before, token)."""

    def __init__(self, p: Parameters, noise: np.ndarray, seed: int):
        self.p, self.rng = p, np.random.default_rng(seed)
        self.edges = np.cumsum(noise)
        self.log_noise = (np.log(noise) + math.log(NOISE)).astype(np.float32)
        self.past = [np.full_like(x, 1e-2) for x in (p.u1, p.u2, p.r, p.b)]
        self.seen = 0

    def step(self, c1: np.ndarray, c2: np.ndarray, w: np.ndarray) -> None:
        p, n = self.p, len(w)
        noise = np.minimum(np.searchsorted(self.edges, self.rng.random(NOISE)), OUTCOMES - 1)
        q, rw, rn = p.u1[c1] + p.u2[c2], p.r[w], p.r[noise]
        real = 1 - _sigmoid((q * rw).sum(1) + p.b[w] - self.log_noise[w])
        false = -_sigmoid(q @ rn.T + p.b[noise] - self.log_noise[noise])
        dq = (real[:, None] * rw + false @ rn) / n
        du1, du2 = _spread(c1, dq), _spread(c2, dq)
        dr = _spread(w, real[:, None] * q / n)
        np.add.at(dr, noise, false.T @ q / n)
        db = np.bincount(w, real, OUTCOMES)
        np.add.at(db, noise, false.sum(0))
        for x, g, past in zip((p.u1, p.u2, p.r, p.b), (du1, du2, dr, (db / n).astype(np.float32)), self.past):
            past += g * g * n
            x += RATE * g * math.sqrt(n) / np.sqrt(past)
        self.seen += n


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _spread(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of rows by number."""
    flat = (at[:, None] * WIDTH + np.arange(WIDTH)).ravel()
    return np.bincount(flat, rows.ravel(), OUTCOMES * WIDTH).reshape(OUTCOMES, WIDTH).astype(np.float32)


def contexts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The token before each, and the one before that; the end stands for what precedes a text."""
    before = np.concatenate([[END, END], ids[:-1]])
    return before[1:], before[:-1]


class Scorer:
    """Normalised log-probabilities by lookup."""

    def __init__(self, p: Parameters):
        self.a1, self.a2 = p.u1 @ p.r.T + p.b, p.u2 @ p.r.T
        top1, top2 = self.a1.max(1, keepdims=True), self.a2.max(1, keepdims=True)
        self.z = np.log(np.exp(self.a1 - top1) @ np.exp(self.a2 - top2).T) + top1 + top2.T

    def __call__(self, ids: np.ndarray) -> float:
        """Natural log-probability of a token sequence."""
        c1, c2 = contexts(ids)
        return float((self.a1[c1, ids].astype(np.float64) + self.a2[c2, ids] - self.z[c1, c2]).sum())


def count_words(docs: DataFrame) -> DataFrame:
    """word (bytes), n over all rows of ``text``; the end of a text is not among them."""
    def rows(source):
        seen: Counter = Counter()
        for r in source:
            seen.update(words_of(r["text"]))
            if len(seen) > 1_000_000:
                yield from seen.items()
                seen = Counter()
        yield from seen.items()

    return arrow_map(docs, "word binary, n long", rows, size=50_000).groupBy("word").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame) -> list[tuple[bytes, int]]:
    """At most ``HELD`` words, the most frequent first: all from the least count that so many words reach.

    That count is found from the numbers of words per step of counts, so only the words kept are sent.
    """
    step = F.floor(F.log2("n") * 16)
    sizes = sorted(((r["s"], r["words"], r["least"]) for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()), reverse=True)
    total, least = 0, None
    for _, words, low in sizes:
        total += words
        if total > HELD:
            break
        least = low
    if least is None:
        return []
    return sorted(((bytes(r["word"]), r["n"]) for r in counts.where(F.col("n") >= least).collect()), key=lambda x: (-x[1], x[0]))


def scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row; scores are log10.

    Null and empty texts are one token, the end. Rows without id are not held out; repeated rows are learned
    from and scored as often as they occur. With no training text every token is unknown. Other columns are
    not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "language")
    context = spark.sparkContext
    kind = docs.schema[id_col].dataType.simpleString()
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))
    source = docs.select(F.col(id_col).alias("doc"), held.alias("held"), F.col(text_col).alias("text"))

    counts = scratch.keep(count_words(source.where("not held").select("text")))
    ends = source.where("not held").count()
    total = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    tokens, distinct = total["n"] + ends, total["v"] + (ends > 0)
    top = _most_frequent(counts)
    frequent = {w for w, _ in top[:FREQUENT]}

    # sizes of the classes: all words less the frequent ones
    group = F.crc32(F.when(F.octet_length("word") <= 2, F.col("word")).otherwise(F.substring("word", -2, 2))) % CLASSES
    class_n, class_v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in counts.groupBy(group.cast("int").alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        class_n[r["k"]], class_v[r["k"]] = r["n"], r["v"]
    for w, n in top[:FREQUENT]:
        class_n[class_of(w) - FREQUENT - 1] -= n
        class_v[class_of(w) - FREQUENT - 1] -= 1
    outcome_n = np.zeros(OUTCOMES, np.int64)
    outcome_n[: len(frequent)] = [n for _, n in top[:FREQUENT]]
    outcome_n[END], outcome_n[END + 1 :] = ends, class_n
    sent = context.broadcast(([w for w, _ in top], [n for _, n in top], np.log10(class_n + class_v + 1.0)))
    end_log = math.log10(ends + 1)

    def encode(rows):
        known, ns, room = worker_words(sent)
        for r in rows:
            words = words_of(r["text"])
            at = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
            log_n = ns[0][at]  # the last entry stands for words that are not held
            outcome = ns[1][at]
            rare = Counter(w for w, k in zip(words, at.tolist()) if k < 0)
            if rare:
                outcome[at < 0] = [class_of(w) for w, k in zip(words, at.tolist()) if k < 0]
            in_class = outcome > END
            yield (
                r["row"], r["doc"], r["held"], r["part"], len(words) + 1, int((at >= 0).sum()) + (ends > 0),
                float(log_n.sum()) + end_log, float(log_n[in_class].sum() - room[outcome[in_class] - END - 1].sum()),
                np.append(outcome, END).astype(np.uint16).tobytes(), [{"word": w, "n": n} for w, n in rare.items()],
            )

    rows = source.withColumn("row", F.monotonically_increasing_id()).withColumn("part", F.pmod(F.xxhash64("text", "doc"), F.lit(sum(ROUNDS))))
    schema = f"row long, doc {kind}, held boolean, part long, n_tokens long, n_held long, log_n double, log_share double, ids binary, rare array<struct<word:binary,n:int>>"
    coded = scratch.keep(arrow_map(rows, schema, encode, size=200, state="lm_words"))

    params = Parameters.start(outcome_n.astype(float))
    done = 0
    for share in ROUNDS if ends else ():
        params = _round(coded.where((~F.col("held")) & F.col("part").between(done, done + share - 1)), params, unigram(outcome_n.astype(float)))
        done += share
    model = context.broadcast(params.flat())

    def score(rows_):
        scorer = worker_scorer(model)
        for r in rows_:
            yield r["row"], r["doc"], r["held"], r["n_tokens"], r["n_held"], r["log_n"], r["log_share"] + scorer(np.frombuffer(r["ids"], np.uint16).astype(np.int64)) / math.log(10)

    schema = f"row long, doc {kind}, held boolean, n_tokens long, n_held long, log_n double, score double"
    scored = arrow_map(coded.select("row", "doc", "held", "n_tokens", "n_held", "log_n", "log_share", "ids"), schema, score, state="lm_scorer")
    rare = coded.select("row", F.explode("rare").alias("w")).select("row", F.col("w.word").alias("word"), F.col("w.n").alias("times"))
    rare = rare.join(counts, "word", "left").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("rare_log"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"))
    out = scored.join(rare, "row", "left")
    more = F.coalesce("rare_log", F.lit(0.0))
    return out.select(
        F.col("doc").alias(id_col), F.col("held").alias("held_out"), "n_tokens", (F.col("n_held") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), (F.col("log_n") + more - F.col("n_tokens") * math.log10(tokens + distinct + 1)).alias("base_score"), (F.col("score") + more).alias("score"),
    )


def worker_words(sent):
    words, ns, room = sent.value
    log_n = np.append(np.log10(np.array(ns, np.float64) + 1), 0.0)

    def make():
        return {w: k for k, w in enumerate(words)}, np.array([k if k < FREQUENT else class_of(w) for k, w in enumerate(words)] + [END], np.int64)

    known, outcome = worker_state("lm_words", (len(words), zlib.crc32(b" ".join(words))), make)
    return known, (log_n, outcome), room


def worker_scorer(model) -> Scorer:
    return worker_state("lm_scorer", zlib.crc32(model.value.tobytes()), lambda: Scorer(Parameters.of(model.value)))


def _round(coded: DataFrame, params: Parameters, noise: np.ndarray) -> Parameters:
    """Train a copy in every task and average them; the tasks send sums that Spark adds up."""
    start = coded.sparkSession.sparkContext.broadcast((params.flat(), noise))

    def run(batches):
        import pyarrow as pa

        flat, q = start.value
        trainer = Trainer(Parameters.of(flat), q, SEED)
        held, size = [], 0

        def steps(last: bool):
            nonlocal held, size
            c1, c2, w = (np.concatenate([h[k] for h in held]) for k in range(3))
            order = np.random.default_rng(SEED + trainer.seen).permutation(len(w))
            full = len(w) if last else len(w) - len(w) % BATCH
            for at in range(0, full, BATCH):
                part = order[at : at + BATCH]
                trainer.step(c1[part], c2[part], w[part])
            rest = order[full:]
            held, size = [(c1[rest], c2[rest], w[rest])], len(rest)

        for batch in batches:
            for raw in batch.column(0).to_pylist():
                ids = np.frombuffer(raw, np.uint16).astype(np.int64)
                held.append((*contexts(ids), ids))
                size += len(ids)
                if size >= 64 * BATCH:
                    steps(False)
        if held:
            steps(True)
        if trainer.seen:
            out = np.append(trainer.p.flat().astype(np.float64), 1.0) * trainer.seen
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out), dtype=np.int32)), pa.array(out)], names=["at", "v"])

    sums = batch_map(coded.select("ids"), run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    if not sums:
        return params
    out = np.zeros(len(params.flat()) + 1)
    for r in sums:
        out[r["at"]] = r["v"]
    return Parameters.of(out[:-1] / out[-1])
