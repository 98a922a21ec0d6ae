"""Corpus preparation: stages applied one after the other to ``documents``.

Every stage works on all that the one before kept, is written and read again, and takes effect: toxic
documents go, one document of each group of near duplicates stays, documents that hold benchmark passages
go, personal data is replaced by its kind, and the rest is encoded. Decisions come back by id and digest of
the text, so they hold for rows without id, and for each of the unlike rows that repeat one. Rows that a stage
cannot judge stay: a row without id has no near duplicates. Extra columns are carried along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, pii, toxicity
from tidemark.llm.common import Scratch, table
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.queries import tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.7 or more go."""
    found = toxicity.score(_keyed(docs), table(spark, sf_dir, "labels"), key_col=KEY)
    return _without(docs, found.where("predicted = 1"), "toxic")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays (five-word shingles, similarity 0.8).

    Rows that repeat id and text are one document; unlike texts of one id are documents of their own.
    """
    scratch = Scratch(spark, "pipeline")
    key = _keyed(docs).select(f"{KEY}.*").where("doc_id is not null")
    again = scratch.keep(key.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1"))
    if again.isEmpty():
        gone = _gone(scratch, near_duplicates(docs).where("not kept").select("doc_id"))
        return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    # numbers in the order of the ids stand for id and text; written, so that all passes see the same
    key = scratch.keep(key.distinct().orderBy("doc_id", "digest").withColumn(ROW, F.monotonically_increasing_id()))
    tagged = _keyed(docs).alias("d").join(key.alias("k"), F.expr(f"d.{KEY}.doc_id = k.doc_id and d.{KEY}.digest = k.digest"), "left")
    tagged = scratch.keep(tagged.select("d.*", f"k.{ROW}").drop(KEY))
    kept = tagged.join(_gone(scratch, near_duplicates(tagged, id_col=ROW).where("not kept").select(ROW)), ROW, "left_anti")
    same = scratch.keep(kept.where(f"{ROW} is not null").groupBy(ROW).agg(F.count("*").alias("n")).where("n > 1").select(ROW))
    once = kept.join(same, ROW, "left_semi").dropDuplicates([ROW])
    return kept.join(same, ROW, "left_anti").select(docs.columns).unionByName(once.select(docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word window of a benchmark item go."""
    found = decontaminate.contamination(_keyed(docs), table(spark, sf_dir, "benchmark"), id_col=KEY)
    return _without(docs, found.where("n_hit > 0"), "contaminated")


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emails, addresses, card and phone numbers become their kind in angle brackets."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with digests of ids and decoded text."""
    return bpe.digests(docs, tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", replace_personal_data),
    ("bpe", encode),
]

#: Learned scores and byte-pair encoding can't be stated in SQL; the tests compare with brute force.
ORACLE_SQL = None


#: Columns that the stages add for themselves: what a row is known by, and its number.
KEY, ROW = "_pipeline_key", "_pipeline_row"


def _keyed(docs: DataFrame) -> DataFrame:
    """With id and digest of the text: rows that agree in both are judged alike, wherever they are read."""
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    return docs.withColumn(KEY, F.struct("doc_id", digest.alias("digest")))


def _gone(scratch: Scratch, found: DataFrame) -> DataFrame:
    """What was found, written first, so either side of a join can be split."""
    return scratch.keep(found.distinct())


def _without(docs: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """Rows whose id and text were not found; a missing id is one of its own."""
    gone = _gone(Scratch(docs.sparkSession, name), found.select(f"{KEY}.*")).alias("g")
    same = F.expr(f"d.{KEY}.doc_id <=> g.doc_id and d.{KEY}.digest = g.digest")
    return _keyed(docs).alias("d").join(gone, same, "left_anti").select("d.*").drop(KEY)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
