"""URL filter: rules by host and path, and gradient-boosted trees on lexical features for all other URLs.

The trees are trained on URLs that the rules decide, with features that leave the host's own name out:
lengths, depth, shares of digits and marks, entropy, parameter counts and how often the host's suffix and
the first path part are blocked. Those shares count all distinct labelled URLs; while the trees are fitted, those
of one half by hash serve the URLs of the other. Features, training and scoring are DataFrame and MLlib jobs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, by_hash

#: Distinct labelled URLs used to fit the trees; beyond it about as many, chosen by hash.
TRAINING_ROWS = 100_000
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: Keys of the block rates, and the number of URLs the base rate counts for in each.
KEYS, WEIGHT = ("suffix", "part"), 10
FEATURES = ["length", "host_length", "path_length", "depth", "labels", "digits", "marks", "entropy", "parameters", "query_length", "has_fragment", "hyphens", "suffix_rate", "part_rate", "page_suffix"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, upper.lower()), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null if none fits. The rules are few and part of the plan."""
    rule = verdict = None
    for text, says in sorted(rules, key=lambda r: -len(r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(says)) if verdict is None else verdict.when(fits, F.lit(says))
    return rule, verdict


def lexical(urls: DataFrame) -> DataFrame:
    """Lexical features of url, host, path; ``suffix`` and ``part`` are the keys of the block rates."""
    url = F.coalesce("url", F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    letters = F.split(url, "")
    share = F.transform(F.array_distinct(letters), lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size)
    entropy = F.aggregate(share, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    return urls.withColumns({
        "length": F.length(url).cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": count(F.col("path"), "/[^/]"),
        "labels": count(F.col("host"), r"\."),
        "digits": count(url, "[0-9]") / size,
        "marks": count(url, "[^A-Za-z0-9]") / size,
        "entropy": entropy,
        "parameters": F.when(query == "", 0.0).otherwise(count(query, "&") + 1),
        "query_length": F.length(query).cast("double"),
        "has_fragment": F.contains(url, F.lit("#")).cast("double"),
        "hyphens": count(F.col("host"), "-"),
        "page_suffix": F.col("path").rlike(r"\.[A-Za-z0-9]+$").cast("double"),
        "suffix": F.substring_index("host", ".", -1),
        "part": F.regexp_extract("path", "^/([^/]{0,32})/", 1),
    })


def block_counts(known: DataFrame, key: str) -> DataFrame:
    """``key``, how many labelled URLs hold it and how many of those are blocked."""
    return known.where(F.col(key) != "").groupBy(key).agg(F.count("*").alias(f"{key}_n"), F.sum("label").alias(f"{key}_blocked"))


def with_rates(df: DataFrame, counts: dict[str, DataFrame], base: float) -> DataFrame:
    """Smoothed block rate of each key as ``{key}_rate``; unseen keys have the base rate."""
    for key, table in counts.items():
        n, blocked = F.coalesce(f"{key}_n", F.lit(0)), F.coalesce(f"{key}_blocked", F.lit(0.0))
        df = df.join(table, key, "left").withColumn(f"{key}_rate", (blocked + WEIGHT * base) / (n + WEIGHT)).drop(f"{key}_n", f"{key}_blocked")
    return df


def learned(ruled: DataFrame, scratch: Scratch, training_rows: int = TRAINING_ROWS, trees: int = 12, depth: int = 4) -> Callable[[DataFrame], DataFrame]:
    """Learn from rows with ``label``; what is returned adds ``p_block`` to rows with lexical features.

    If one half of the URLs holds labels of one kind only, both halves fit the trees, with the rates of all.
    """
    known = scratch.keep(ruled.select("url", "label", *KEYS).dropDuplicates(["url"]))
    seen = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked")).first()
    if seen["blocked"] in (0, seen["n"]):
        return lambda rows: rows.withColumn("p_block", F.lit(1.0 if seen["n"] and seen["blocked"] else 0.0))
    base = seen["blocked"] / seen["n"]
    counts = {key: scratch.keep(block_counts(known, key)) for key in KEYS}
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    # a rate must not hold the label that it helps to learn: one half of the URLs fits the trees, with the rates of the
    # other half. (Taking off a row's own label alone would give the label away, as its rate is then the lower one.)
    fits = F.crc32(F.col("url").cast("binary")) % 2 == 0
    half = known.where(fits).agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked")).first()
    rows, rates = ruled.where(fits), {key: scratch.keep(block_counts(known.where(~fits), key)) for key in KEYS}
    if half["blocked"] in (0, half["n"]):
        rows, rates, half = ruled, counts, seen
    train = by_hash(rows.dropDuplicates(["url"]), F.col("url"), training_rows, half["n"])
    train = scratch.keep(assembler.transform(with_rates(train, rates, base)).select("label", "features"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, maxBins=32, seed=7, cacheNodeIds=False, checkpointInterval=-1).fit(train)
    return lambda rows: model.transform(assembler.transform(with_rates(rows, counts, base))).withColumn("p_block", vector_to_array("probability")[1])


def judge(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules=RULES, training_rows: int = TRAINING_ROWS, trees: int = 12, depth: int = 4) -> DataFrame:
    """``id_col, host, path, rule, verdict, p_block`` for every row of ``pages``.

    Null URLs and URLs without ``://`` have an empty host and path, fit no rule and are judged by the
    trees like all others without a rule. With no labelled URL, or labels of one kind only, every such URL
    gets that kind (``allow`` without any). Repeated rows and null ids give a row each; other columns are
    not read. At most ``training_rows`` distinct labelled URLs train the trees, chosen by hash; rates count all.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = scratch.keep(lexical(rows.withColumn("rule", rule).withColumn("ruled", verdict)))

    ruled = rows.where("ruled is not null").withColumn("label", (F.col("ruled") == "block").cast("double"))
    columns = ["id", "host", "path", "rule", "ruled", "p_block"]
    free = learned(ruled, scratch, training_rows, trees, depth)(rows.where("ruled is null")).select(columns)
    out = free.unionByName(rows.where("ruled is not null").withColumn("p_block", F.lit(None).cast("double")).select(columns))
    verdict = F.coalesce("ruled", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "p_block")
