"""Registered queries of the operators, and their SQL where it can state the result."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, byte_bpe, collocations, decontaminate, embeddings, html_text, language, pii, repeats, toxicity, urls, warc
from .common import table
from .minhash import near_duplicates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def tokenizer() -> str:
    """Place of the public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP1 = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('{warc.BASE32}', 1 + CAST((CAST('0x' || substr(h, CAST(1 + 10 * (i // 8) AS INT), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM p"""

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_OP4 = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, w[k:k + n - 1] AS x, n FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM (SELECT item, w, least(10, len(w)) AS n FROM item WHERE len(w) > 0))),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
place AS (SELECT doc_id, n, k, w[k:k + n - 1] AS x FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, item, k, place.n FROM place JOIN win ON place.x = win.x),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

_OP5 = f"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) < 2 THEN [w] ELSE list_transform(range(1, len(w)), lambda k: w[k:k + 1]) END) AS s FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM doc UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT doc.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c AS component_id, doc.doc_id = c AS kept
FROM doc LEFT JOIN size USING (doc_id) JOIN comp ON comp.a = doc.doc_id"""

_OP6 = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM edge GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, c AS component_id, vec_id = c AS kept
FROM v LEFT JOIN deg ON deg.a = vec_id JOIN comp ON comp.a = vec_id"""

_OP13 = f"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
ws AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM piece),
win AS (SELECT lang, w[k] AS w1, w[k + 1] AS w2, w[k + 2] AS w3 FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS k FROM ws)),
cnt AS (SELECT lang, w1, w2, w3, count(*) AS f FROM win GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM cnt GROUP BY lang),
one AS (SELECT lang, w1, sum(f) AS f FROM cnt GROUP BY ALL),
two AS (SELECT lang, w1, w2, sum(f) AS f FROM cnt WHERE w2 IS NOT NULL GROUP BY ALL),
three AS (SELECT * FROM cnt WHERE w3 IS NOT NULL AND f >= 10),
cut AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r FROM two t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN one y ON y.lang = t.lang AND y.w1 = t.w2 WHERE t.f >= 10
  UNION ALL SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f FROM three t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN one y ON y.lang = t.lang AND y.w1 = t.w3),
scored AS (SELECT *, CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS score FROM cut),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, phrase, max(f) AS longer FROM (SELECT lang, w1 || ' ' || w2 AS phrase, f FROM three UNION ALL SELECT lang, w2 || ' ' || w3, f FROM three) GROUP BY ALL),
kept AS (SELECT weakest.* FROM weakest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000"""


@query("op1_warc", _OP1)
def op1(spark, folder):
    return warc.round_trip(table(spark, folder, "pages"))


@query("op2_html_text")
def op2(spark, folder):
    return html_text.extract(table(spark, folder, "pages"))


@query("op3_bpe")
def op3(spark, folder):
    return bpe.digests(table(spark, folder, "documents"), tokenizer())


@query("op4_decontaminate", _OP4)
def op4(spark, folder):
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


@query("op5_minhash", _OP5)
def op5(spark, folder):
    return near_duplicates(table(spark, folder, "documents"), width=2)


@query("op6_embedding", _OP6)
def op6(spark, folder):
    return embeddings.near_vectors(table(spark, folder, "embeddings"))


@query("op7_toxicity")
def op7(spark, folder):
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_language")
def op8(spark, folder):
    return language.scores(table(spark, folder, "documents"))


@query("op9_pii")
def op9(spark, folder):
    found = pii.detect(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


@query("op10_urls")
def op10(spark, folder):
    return urls.judge(table(spark, folder, "pages"))


@query("op11_byte_bpe")
def op11(spark, folder):
    import public_tokenizers

    return byte_bpe.digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with which the query of op12 judges a document: every tenth, by a hash of its id, repeats from a word on."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


@query("op12_periodic_runs")
def op12(spark, folder):
    found = repeats.periodic_runs(table(spark, folder, "documents"), edit=planted)
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )


@query("op13_collocations", _OP13)
def op13(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))
