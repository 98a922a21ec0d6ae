"""Reading panels, index tables and prediction files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import nan_to_null, period_index

CORRUPT = "_corrupt_record"


def read_panel(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, sep: str = ",",
               partitions: int | None = None, month: str | None = None, period: str = "periodo") -> DataFrame:
    """Panel from CSV, plain or gzipped.

    Without a schema the types are inferred from all rows. With one, malformed rows are kept and their text
    goes to ``_corrupt_record``. A gzipped file is read by one task, so state ``partitions`` for it. With
    ``month`` the consecutive period number is added.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
    if schema is None:
        df = reader.option("inferSchema", True).csv(path)
    else:
        wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        df = reader.schema(wide).option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    if partitions:
        df = df.repartition(partitions)
    df = nan_to_null(df)
    return df.withColumn(period, period_index(month)) if month else df


def csv_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """CSV file as a table for SQL."""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY VIEW {name}
                  USING csv OPTIONS (path '{path}', header 'true', inferSchema 'true')""")
    return spark.table(name)


def read_index(spark: SparkSession, path: str, month: str = "foto_mes", value: str = "valor_ipc",
               rename: dict[str, str] | None = None, sep: str = ",") -> DataFrame:
    """Monthly index table: renamed, cast, other columns dropped."""
    raw = spark.read.option("header", True).option("sep", sep).csv(path).withColumnsRenamed(rename or {})
    return raw.select(F.col(month).cast("int").alias(month), F.col(value).cast("double").alias(value))


def _listing(spark: SparkSession, root: str, pattern: str):
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)


def read_predictions(spark: SparkSession, root: str, pattern: str = "*", sep: str = "\t",
                     model: str = "modelo") -> DataFrame:
    """All prediction files below a folder, each row tagged with the folder its file lies in.

    Files may have different columns, in any order: those with the same first line are read together, the few
    layouts are stacked, and columns a layout lacks are null. Empty files have no rows.
    """
    path = F.col("_metadata.file_path")
    # the rows of a file's first part are numbered in their order
    lines = _listing(spark, root, pattern).text(root).filter("_metadata.file_block_start = 0")
    lines = lines.select("value", path.alias("path"), F.monotonically_increasing_id().alias("at"))
    # by counting slashes: a pattern would try every start of the path anew, in every row
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    layouts: dict[str, list[str]] = {}
    for name, header in lines.groupBy("path").agg(F.min_by("value", "at")).collect():
        layouts.setdefault(header, []).append(name)
    stacked = None
    for _, files in sorted(layouts.items()):
        rows = (spark.read.option("header", True).option("sep", sep).option("inferSchema", True).csv(sorted(files))
                .withColumn(model, folder))
        stacked = rows if stacked is None else stacked.unionByName(rows, allowMissingColumns=True)
    if stacked is None:
        raise FileNotFoundError(f"no file {pattern} with a header below {root}")
    return stacked


def rows_per_file(spark: SparkSession, root: str, pattern: str = "*", sep: str = "\t") -> DataFrame:
    """Data rows of every file below a folder; 0 for files with a header only, or with nothing."""
    path = F.regexp_replace("_metadata.file_path", "^file:/+", "file:///").alias("archivo")
    # the listing that the driver holds for any read names empty files too
    names = _listing(spark, root, pattern).text(root).inputFiles()
    files = spark.createDataFrame([(re.sub("^file:/+", "file:///", n),) for n in names], "archivo string")
    df = _listing(spark, root, pattern).option("header", True).option("sep", sep).csv(root)
    counts = df.groupBy(path).agg(F.count(F.lit(1)).alias("filas"))
    return files.join(counts, "archivo", "left").select("archivo", F.coalesce("filas", F.lit(0)).alias("filas"))


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """Trial log written by ``append_json``."""
    return spark.read.json(path)


def top_trials(trials: DataFrame, n: int, value: str = "value", *ties: str) -> DataFrame:
    """Best trials with the parameters searched on a log scale (``*_exp``) brought back.

    Whole-number sizes are rounded, with a least value of 2 leaves and 1 row per leaf.
    """
    best = trials.orderBy(F.desc(value), *ties).limit(n)
    floors = {"num_leaves": 2, "min_child_samples": 1}
    for c in [c for c in best.columns if c.endswith("_exp")]:
        name = re.sub("_exp$", "", c)
        back = F.pow(F.lit(2.0), F.col(c))
        if name in (*floors, "num_boost_round"):
            back = F.greatest(F.lit(floors.get(name, 0)), F.rint(back)).cast("int")
        best = best.withColumn(name, back).drop(c)
    return best
