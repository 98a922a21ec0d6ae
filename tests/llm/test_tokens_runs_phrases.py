"""Byte-level tokens against the public library, periodic runs and phrases against brute force, and odd input for all three."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import byte_bpe, collocations, queries, repeats

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
EXTRA = "doc string, ids string, runs int, f int, grp string, phrase string, piece string, a string, w1 string, k int, size string, best string"
LONG = " ".join(f"word{k % 997} of" for k in range(60_000))
TEXTS = [(1, "A b a b, c a b"), (2, None), (3, ""), (4, "  \n\t "), (5, LONG), (6, "A b a b, c a b"), (6, "A b a b, c a b"), (None, "x x x x x x x"), (None, None), (7, "x"), (8, "y" * 100_000), (9, "é É ü 中 😀")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i == 7 else "en", "src", len(t or ""), "z", "z", 1, 2, "z", "z", "z", "z", "z", 3, "z", "z") for i, t in TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}").repartition(3)


# --- byte-level tokens

@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as f:
        return byte_bpe.Ranks(f.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ids, special_tokens={})


def test_byte_tokens_of_documents(spark, library):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op11_byte_bpe"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids, r = library.encode_ordinary(d["text"] or ""), rows[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_byte_tokens_of_random_texts(ranks, library):
    rng, encoder = random.Random(1), byte_bpe.Encoder(ranks, public_tokenizers.PATTERN, cache=500)
    letters = ["abehinrst", "a", "ab ", " \n\t　\x1c\x85x", " 'sStdlm", "0123456789 ", "=-_. ", "éüñßЖ中ا😀 ", "aAbB1,.!? \n"]
    texts = ["".join(rng.choice(letters[k % 9]) for _ in range(rng.choice([1, 5, 30, 300, 3000]))) for k in range(400)]
    want = [library.encode_ordinary(t) for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for k in range(0, 400, 7) for b in encoder(texts[k : k + 7])] == want
    for text in ("haha" * 20_000, "".join(rng.choice("abcdefghij") for _ in range(50_000)), "".join(rng.choice("Aa0+/Zz9") for _ in range(50_000))):
        assert np.frombuffer(encoder([text])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_parts_of_a_long_text_give_the_same_tokens(ranks, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK", 50)
    rng, encoder = random.Random(2), byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    for _ in range(50):
        text = "".join(rng.choice("ab  \n.1'é") for _ in range(1000))
        parts = list(encoder.blocks(text))
        assert "".join(parts) == text and len(parts) > 1
        assert [i for p in parts for i in np.frombuffer(encoder([p])[0], "<u4").tolist()] == library.encode_ordinary(text)


def test_other_merge_orders(spark):
    """Random rank files, where a merge can make a pair of lower rank, against merging step by step."""
    import base64

    rng = random.Random(3)
    for trial in range(60):
        tokens = [bytes([b]) for b in range(256)]
        made = {bytes(rng.choice(b"ab") for _ in range(rng.randint(2, 5))) for _ in range(12)}
        rest = sorted(made)
        rng.shuffle(rest)
        table = byte_bpe.Ranks(b"\n".join(base64.b64encode(t) + b" %d" % k for k, t in enumerate(rest + tokens)))
        pieces = [bytes(rng.choice(b"ab") for _ in range(rng.choice([2, 9, 40]))) for _ in range(20)]

        def slow(piece):
            parts = [piece[k : k + 1] for k in range(len(piece))]
            while True:
                best = min(((table.ids.get(a + b, 1 << 40), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 40, 0))
                if best[0] == 1 << 40:
                    return [table.ids[p] for p in parts]
                parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

        want = [[table.ids[p]] if p in table.ids else slow(p) for p in pieces]
        assert [np.frombuffer(b, "<u4").tolist() for b in table.encode(pieces)] == want
        assert [np.frombuffer(table._merge_long(p), "<u4").tolist() for p in pieces] == [slow(p) for p in pieces]


def test_byte_tokens_of_odd_rows(docs, library):
    rows = byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == len(TEXTS)
    assert all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (0, empty, empty) for r in rows if r["doc_id"] in (2, 3))
    tokens = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    got = sorted(((r["doc_id"], r["ids"]) for r in tokens.collect()), key=str)
    assert got == sorted(((i, library.encode_ordinary(t or "")) for i, t in TEXTS), key=str)
    back = byte_bpe.decode(tokens, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["bytes"])) for r in back) == sorted((i or 0, (t or "").encode()) for i, t in TEXTS)
    assert byte_bpe.digests(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    named = byte_bpe.encode(docs.selectExpr("source as doc_id", "text"), RANKS, public_tokenizers.PATTERN)
    assert {r["doc_id"] for r in named.collect()} == {"src"}


# --- periodic runs

def slow_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q) and not any(all(w[t] == w[t + d] for t in range(i, i + size - d)) for d in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng, documents = random.Random(2), []
    for k in range(1500):
        n = rng.choice([0, 1, 5, 6, 8, 20, 60, 120])
        w = [rng.choice("ab" if k % 3 else "abcd").encode() for _ in range(n)]
        if n and k % 2:
            a, p = rng.randrange(n), rng.randint(1, max(1, n // 3))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        documents.append(w)
    want = [slow_runs(w) for w in documents]
    assert sum(map(len, want)) > 500
    assert [f for k in range(0, 1500, 100) for f in repeats._together(documents[k : k + 100])] == want
    assert [repeats._together([w])[0] for w in documents[:200]] == want[:200]
    for w, found in zip(documents, want):
        keep = [x for k, x in enumerate(w) if not any(s + q <= k < s + n for s, n, q in found)]
        assert repeats.collapsed(w, found) == b" ".join(keep)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        assert repeats.strongest(found) == best


def test_hot_words_make_few_seeds():
    x = np.zeros(300_000, np.int64)
    assert len(list(repeats._seeds(np.append(x, -1), np.zeros(300_001, np.int64)))) == 1
    assert list(repeats.runs(np.append(x, -1), np.zeros(300_001, np.int64))) == [(0, 300_000, 1)]


def test_periodic_runs_query(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_periodic_runs"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    planted = 0
    for d in docs:
        words = [m.encode() for m in re.findall("[^\x20\x09-\x0d]+", d["text"] or "")]
        edited = queries.planted(d["doc_id"], words)
        planted += edited != words
        found = slow_runs(edited)
        r = got[d["doc_id"]]
        assert r["n_runs"] == len(found)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(repeats.collapsed(edited, found)).hexdigest()
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
    assert len(got) == len(docs) and planted > 5


def test_periodic_runs_of_odd_rows(docs):
    rows = repeats.periodic_runs(docs).collect()
    assert len(rows) == len(TEXTS)
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert all(got[i]["runs"] == [] and got[i]["best"] is None and got[i]["text"] == "" for i in (2, 3, 4))
    assert [tuple(r) for r in got[5]["runs"]] == [(0, 120_000, 1994)] and len(got[5]["text"].split()) == 1994
    assert sorted(r["text"] for r in rows if r["doc_id"] is None) == ["", "x"]
    assert got[9]["text"] == "é É ü 中 😀"
    assert repeats.periodic_runs(docs.limit(0)).count() == 0


# --- phrases

def slow_phrases(rows, least, share, top, longest=3):
    counts, total = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            counts.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, w), a in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[lang, w[i : i + k]] = max(inside[lang, w[i : i + k]], a)
    out = {}
    for (lang, w), a in candidates.items():
        if 100 * inside[lang, w] >= share * a:
            continue
        cuts = [(10**6 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        s, k = min(cuts)
        out.setdefault(lang, []).append((-s, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return sorted((lang, k + 1, p.decode(), -a, lf, r, total[lang], -s) for lang, found in out.items() for k, (s, a, p, lf, r) in enumerate(sorted(found)[:top]))


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def test_phrases_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = slow_phrases([(r["lang"], r["text"]) for r in docs.collect()], 10, 50, 2000)
    assert rows_of(queries.QUERIES["op13_collocations"](spark, FOLDER)) == want


@pytest.mark.parametrize("longest, top", [(2, 5), (3, 7), (4, 1000)])
def test_phrases_of_random_words(spark, longest, top):
    rng = random.Random(longest)
    words = ["the", "The", "new", "york", "é", "É", "x\x0bb", "a\x1cb", "c\xa0d", "ß"]
    rows = [(rng.choice(["en", "en", "de", None, "und", ""]), "".join(rng.choice(words) + rng.choice([" ", " ", "\t ", ", ", "\n", ".", " ! "]) for _ in range(60))) for _ in range(80)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = collocations.collocations(df, longest=longest, least=3, share=60, top=top)
    assert rows_of(got) == slow_phrases(rows, 3, 60, top, longest)


def test_phrases_of_odd_rows(spark, docs):
    got = rows_of(collocations.collocations(docs, least=3))
    assert got == slow_phrases([(None if i == 7 else "en", t) for i, t in TEXTS], 3, 50, 2000)
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs.where("doc_id in (2, 3, 4)")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    rng = random.Random(4)
    rows = [(a := rng.randint(1, 10**15 - 1), rng.randint(a, 10**15 - 1), rng.randint(a, 10**15 - 1)) for _ in range(500)]
    df = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", collocations.score("a", "l", "r").alias("s"))
    assert all(r["s"] == 10**6 * r["a"] ** 2 // (r["l"] * r["r"]) for r in df.collect())
