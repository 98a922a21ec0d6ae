"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns, for every operator."""

import hashlib

import pytest

import corpus_pipeline
from tidemark.llm import bpe, decontaminate, embeddings, html_text, language, pii, toxicity, urls, warc
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.queries import tokenizer

LONG = " ".join(f"word{k % 997} of" for k in range(60_000))
EXTRA = "doc string, id string, row int, n int, component string, key string, label string, rule string, gone string, ids string, spans int, score double, held string"
TEXTS = [(1, "a b c d e f"), (2, None), (3, ""), (4, "  \n\t "), (5, LONG), (6, "a b c d e f"), (6, "a b c d e f"), (None, "a b c d e f"), (None, None), (7, "x"), (8, "x" * 100_000), (9, "mail a@b.com now")]


@pytest.fixture(scope="module")
def docs(spark):
    extra = ("z",) * 2 + (1, 2) + ("z",) * 6 + (3, 0.5, "z")
    rows = [(i, t, "en", "src", len(t or "")) + extra for i, t in TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}").repartition(3)


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r)))


def test_minhash(docs):
    rows = near_duplicates(docs, width=2).collect()
    assert len(rows) == len(TEXTS)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows if r["doc_id"] is not None}
    assert got[1] == (5, 1, True) and got[6] == (5, 1, False)
    assert got[2] == (0, 2, True) and got[3] == (0, 3, True) and got[4] == (0, 4, True)
    assert got[7] == (1, 7, True) and got[8] == (1, 8, True) and got[5][1:] == (5, True)
    assert [(r["n_shingles"], r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None and r["n_shingles"]] == [(5, None, None)]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_minhash_rows_of_one_id(spark):
    a, b = " ".join(f"a{k}" for k in range(50)), " ".join(f"b{k}" for k in range(50))
    rows = near_duplicates(spark.createDataFrame([(3, a), (5, a), (5, b), (9, b)], "doc_id long, text string")).collect()
    assert {r["component_id"] for r in rows} == {3}


def test_decontaminate(spark, docs):
    items = spark.createDataFrame([(10, "b c d"), (11, None), (12, ""), (None, "a b"), (13, "X"), (10, "b c d"), (14, LONG), (15, "not there")], "item_id long, text string")
    rows = decontaminate.contamination(docs, items).collect()
    assert len(rows) == len(TEXTS)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows if r["doc_id"] is not None}
    assert got[1] == (6, 4, ["10"]) and got[2] == (0, 0, []) and got[7] == (1, 1, ["13"]) and got[5] == (120_000, 120_000, ["14"])
    few = items.where("item_id <> 14")
    assert by_id(decontaminate.contamination(docs, few, block=5).collect()) == by_id(decontaminate.contamination(docs, few).collect())
    assert all(r["n_hit"] == 0 for r in decontaminate.contamination(docs, items.limit(0)).collect())
    assert decontaminate.contamination(docs.limit(0), items).count() == 0


def test_bpe(docs):
    rows = bpe.digests(docs, tokenizer()).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == len(TEXTS)
    assert all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (0, empty, empty) for r in rows if r["doc_id"] in (2, 3, 4))
    tokens = bpe.encode(docs, tokenizer())
    assert sorted((r["doc_id"] or 0, len(r["ids"])) for r in tokens.collect()) == sorted((r["doc_id"] or 0, r["n_tokens"]) for r in rows)
    back = {r["doc_id"]: r["text"] for r in bpe.decode(tokens, tokenizer(), mode="text").collect()}
    assert back[1] == "a b c d e f " and back[2] == "" and len(back[8]) == 100_001
    assert bpe.digests(docs.limit(0), tokenizer()).count() == 0


def test_pii(docs):
    rows = pii.detect(docs).collect()
    assert len(rows) == len(TEXTS)
    got = {r["doc_id"]: [(s["kind"], s["start"], s["stop"]) for s in r["spans"]] for r in rows}
    assert got[9] == [("email", 5, 12)] and got[2] == [] and got[8] == []
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in clean.collect()}[9] == "mail <EMAIL> now"
    assert pii.detect(docs.limit(0)).count() == 0


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(1, 1), (6, 0), (5, 0), (None, 1), (7, None), (99, 1), (8, 0), (1, 1)], "doc_id long, toxic int")
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] is False for r in rows if r["doc_id"] is None)
    none = toxicity.score(docs, labels.limit(0)).collect()
    assert len({r["score"] for r in none}) == 1 and none[0]["predicted"] == 0
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_language(docs):
    rows = language.scores(docs).collect()
    assert len(rows) == len(TEXTS)
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert got[2]["n_tokens"] == 1 and got[2]["score"] < 0 and got[2]["base_score"] == got[3]["base_score"] == got[4]["base_score"]
    assert got[5]["n_tokens"] == 120_001 and len({r["train_tokens"] for r in rows}) == 1
    assert language.scores(docs.limit(0)).count() == 0


def test_embeddings(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (None, [1.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1), (1, [1.0, 0.0], 1), (12, [0.0, 1.0], 1), (13, [1e-300, 0.0], 1), (14, [1e300, 0.0], 1)]
    frame = spark.createDataFrame([(*r, "z", 5) for r in rows], "vec_id long, embedding array<double>, label int, k string, links int")
    got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_vectors(frame).collect()]
    assert len(got) == len(rows)
    linked = {g[0]: g[1:] for g in got if g[0] is not None}
    assert linked[1] == (4, 1, True) and linked[2] == (4, 1, False) and linked[13] == (4, 1, False) and linked[14] == (4, 1, False)
    assert all(linked[k] == (0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10, 11, 12))
    assert embeddings.near_vectors(frame.limit(0)).count() == 0


def test_pages(spark):
    body = "<article><p>some text of a page</p></article>"
    rows = [(1, "http://a.com/x", body), (2, None, None), (3, "", ""), (4, "no scheme", body), (4, "no scheme", body), (None, "http://b.net/es/1", body), (5, "http://c.org/\r\nx: y", "<p>\x00 broken <b <!-- <script>"), (6, "HTTP://Example.COM", "<div>" * 5000 + "deep"), (7, "://", "é" * 200_000)]
    pages = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, n int, path string")
    text = html_text.extract(pages).collect()
    assert len(text) == len(rows) and {r["page_id"]: r["text"] for r in text}[1] == "some text of a page"
    assert all(r["n_chars"] == len(r["text"]) for r in text)
    archive = warc.round_trip(pages).collect()
    assert len(archive) == len(rows)
    got = {r["page_id"]: r for r in archive if r["page_id"] is not None}
    assert got[1]["record_type"] == "revisit" and got[1]["refers_to"] == 4 and got[4]["record_type"] == "response"
    assert got[2]["payload_bytes"] == 0 and got[2]["refers_to"] == 3 and got[7]["payload_bytes"] == 400_000
    judged = {r["page_id"]: r for r in urls.judge(pages).collect()}
    assert len(judged) == len({r[0] for r in rows})
    assert (judged[2]["host"], judged[2]["path"], judged[2]["rule"]) == ("", "", None) and judged[6]["host"] == "example.com" and judged[None]["rule"] == "net/es/"
    assert all(r["verdict"] in ("allow", "block") for r in judged.values())
    for run in (html_text.extract, warc.round_trip, urls.judge):
        assert run(pages.limit(0)).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    spark.createDataFrame([(1, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "mail a")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, left, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        left = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "bpe":
            assert left.columns == docs.columns
        ids = sorted(r[0] for r in left.select("doc_id").collect() if r[0] is not None)
        if name == "minhash":
            assert ids == [1, 2, 3, 4, 5, 7, 8, 9]
        if name == "decontamination":
            assert ids == [1, 2, 3, 4, 5, 7, 8]
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
