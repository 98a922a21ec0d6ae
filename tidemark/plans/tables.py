"""The monthly customer panel derived from orders, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import hash_uniform
from ..operators.history import tenure
from ..operators.labels import churn_label
from ..operators.panel import densify

AMOUNTS = ["m_total", "m_final", "m_net"]
COUNTS = ["c_total", "c_final"]
MEASURES = [*AMOUNTS, *COUNTS]
TRAIN_MONTH, SCORE_MONTH = 199806, 199906
MODELS = 5


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def panel(self) -> DataFrame:
        """One row per customer and month; a hot customer's orders are combined before the shuffle."""
        day, cents = F.col("o_orderdate"), F.round(F.col("o_totalprice") * 100).cast("long")
        final, open_ = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
        rows = self.table("orders").select(
            F.col("o_custkey").alias("id"), (F.year(day) * 100 + F.month(day)).alias("mes"),
            (F.year(day) * 12 + F.month(day)).alias("periodo"), cents.alias("cents"), final.alias("f"), open_.alias("o"))
        return rows.groupBy("id", "mes", "periodo").agg(
            F.sum("cents").alias("m_total"),
            F.sum(F.when(F.col("f"), F.col("cents"))).alias("m_final"),
            F.sum(F.when(F.col("f"), F.col("cents")).when(F.col("o"), -F.col("cents")).otherwise(0)).alias("m_net"),
            F.count(F.lit(1)).alias("c_total"), F.count_if("f").alias("c_final"))

    def labelled(self) -> DataFrame:
        return churn_label(self.panel())

    def dense(self) -> DataFrame:
        return densify(self.panel(), MEASURES)

    def with_age(self) -> DataFrame:
        """Panel with an age (the customer's nation number, 0 included) and a tenure."""
        age = self.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("edad"))
        return tenure(self.panel().join(age, "id", "left"))

    def scored(self, seed: int = 1) -> DataFrame:
        """Panel keys with a probability and the truth."""
        return self.panel().select("id", "mes", hash_uniform("id", "mes", F.lit(seed)).alias("prob"),
                                   F.col("m_final").isNotNull().cast("int").alias("y"))

    def scores(self, models: int = MODELS) -> DataFrame:
        """The same for several models, in long form."""
        base = self.panel().select("id", "mes", F.col("m_final").isNotNull().cast("int").alias("y"))
        return base.withColumn("model", F.explode(F.sequence(F.lit(1), F.lit(models)))).select(
            "model", "id", "mes", hash_uniform("id", "mes", F.col("model")).alias("prob"), "y")


def u(*parts: object) -> str:
    """SQL of ``hash_uniform``."""
    text = ", ".join(str(p) for p in parts)
    return f"(CAST(CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296e0)"


_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"

PANEL = f"""panel AS (
  SELECT o_custkey AS id, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS mes,
         CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS periodo,
         CAST(sum({_CENTS}) AS BIGINT) AS m_total,
         CAST(sum(CASE WHEN o_orderstatus = 'F' THEN {_CENTS} END) AS BIGINT) AS m_final,
         CAST(sum(CASE o_orderstatus WHEN 'F' THEN {_CENTS} WHEN 'O' THEN -{_CENTS} ELSE 0 END) AS BIGINT) AS m_net,
         count(*) AS c_total, count(*) FILTER (o_orderstatus = 'F') AS c_final
  FROM orders GROUP BY 1, 2, 3)"""

LABELLED = """leads AS (
  SELECT *, lead(periodo, 1) OVER w AS p1, lead(periodo, 2) OVER w AS p2, max(periodo) OVER () AS fin
  FROM panel WINDOW w AS (PARTITION BY id ORDER BY periodo)),
labelled AS (
  SELECT id, mes, periodo, m_total, m_final, m_net, c_total, c_final,
    CASE WHEN periodo >= fin THEN NULL
         WHEN p1 IS NULL OR p1 <> periodo + 1 THEN 'BAJA+1'
         WHEN periodo + 1 >= fin THEN NULL
         WHEN p2 IS NULL OR p2 <> periodo + 2 THEN 'BAJA+2'
         ELSE 'CONTINUA' END AS clase_ternaria
  FROM leads)"""

DENSE = """spans AS (SELECT id, unnest(range(min(periodo), max(periodo) + 1)) AS p FROM panel GROUP BY id),
dense AS (
  SELECT s.id, CAST((s.p - 1) // 12 * 100 + (s.p - 1) % 12 + 1 AS INTEGER) AS mes, CAST(s.p AS INTEGER) AS periodo,
         coalesce(m_total, 0) AS m_total, coalesce(m_final, 0) AS m_final, coalesce(m_net, 0) AS m_net,
         coalesce(c_total, 0) AS c_total, coalesce(c_final, 0) AS c_final
  FROM spans s LEFT JOIN panel x ON x.id = s.id AND x.periodo = s.p)"""

AGED = """aged AS (
  SELECT panel.*, c_nationkey AS edad,
         CAST(row_number() OVER (PARTITION BY id ORDER BY periodo) AS INTEGER) AS antiguedad
  FROM panel LEFT JOIN customer ON c_custkey = id)"""

SCORED = f"""scored AS (
  SELECT id, mes, {u('id', 'mes', 1)} AS prob, CAST(m_final IS NOT NULL AS INTEGER) AS y FROM panel)"""

SCORES = f"""scores AS (
  SELECT CAST(model AS INTEGER) AS model, id, mes, {u('id', 'mes', 'model')} AS prob,
         CAST(m_final IS NOT NULL AS INTEGER) AS y
  FROM panel, (SELECT unnest(range(1, {MODELS + 1})) AS model))"""

GAIN = "CASE WHEN y = 1 THEN 780000 ELSE -20000 END"


def sql(body: str, *ctes: str) -> str:
    """Oracle query over the panel and further named tables."""
    return "WITH " + ",\n".join([PANEL, *ctes]) + "\n" + body
