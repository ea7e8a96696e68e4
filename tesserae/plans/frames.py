"""Cells, pixels and other frames that the queries derive from the given tables, with the same in SQL.

Cells come from orders: 1,000 to a sample, spread over 1,024 x 1,024 pixels in eighths, so that
samples grow in number, not in density. Pixels come from lineitem, labelled by their cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, cell_id, patient, source, kind, x, y, probability, area)."""
    return table(spark, sf_dir, "orders").select(
        F.expr("o_orderkey div 1000").alias("sample_id"),
        F.col("o_orderkey").alias("cell_id"),
        (F.col("o_custkey") % 50).alias("patient"),
        F.col("o_orderstatus").alias("source"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("kind"),
        (F.expr("(o_orderkey * 7919 + o_custkey * 31) % 8192") / 8.0).alias("x"),
        (F.expr("(o_orderkey * 104729 + o_custkey * 17) % 8192") / 8.0).alias("y"),
        (F.col("o_custkey") % 101 / 100.0).alias("probability"),
        F.expr("o_custkey % 64 + 1").alias("area"),
    )


CELLS = """cells AS (
  SELECT o_orderkey // 1000 AS sample_id, o_orderkey AS cell_id, o_custkey % 50 AS patient, o_orderstatus AS source,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS kind, ((o_orderkey * 7919 + o_custkey * 31) % 8192) / 8.0 AS x,
    ((o_orderkey * 104729 + o_custkey * 17) % 8192) / 8.0 AS y, (o_custkey % 101) / 100.0 AS probability, o_custkey % 64 + 1 AS area
  FROM orders)"""


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, label, y, x, nucleus, score, other): pixels with two integer channels; label 0 is background."""
    return table(spark, sf_dir, "lineitem").select(
        F.expr("l_orderkey div 1000").alias("sample_id"),
        F.expr("CASE WHEN l_partkey % 5 = 0 THEN 0 ELSE l_orderkey END").alias("label"),
        F.expr("l_partkey % 64").alias("y"),
        F.expr("l_suppkey % 64").alias("x"),
        F.expr("CASE WHEN l_linenumber < 3 AND l_partkey % 5 <> 0 THEN l_orderkey ELSE 0 END").alias("nucleus"),
        F.col("l_quantity").cast("int").alias("score"),
        F.rint(F.col("l_discount") * 100).cast("int").alias("other"),
    )


PIXELS = """pixels AS (
  SELECT l_orderkey // 1000 AS sample_id, CASE WHEN l_partkey % 5 = 0 THEN 0 ELSE l_orderkey END AS label, l_partkey % 64 AS y, l_suppkey % 64 AS x,
    CASE WHEN l_linenumber < 3 AND l_partkey % 5 <> 0 THEN l_orderkey ELSE 0 END AS nucleus,
    CAST(l_quantity AS INTEGER) AS score, CAST(round(l_discount * 100) AS INTEGER) AS other
  FROM lineitem)"""


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, y, x, label): one label for each pixel that has any, the smallest."""
    return pixels(spark, sf_dir).where("label > 0").groupBy("sample_id", "y", "x").agg(F.min(F.expr("label % 7 + 1")).alias("label"))


def tissue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, y, x): the raster's pixels without their labels, as often as the table has them; masks take each once."""
    return pixels(spark, sf_dir).where("label > 0").select("sample_id", "y", "x")


RASTER = PIXELS + """, raster AS (SELECT sample_id, y, x, min(label % 7 + 1) AS label FROM pixels WHERE label > 0 GROUP BY sample_id, y, x)"""


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(split, detector, tissue, site, patient, roi, tp, fp, fn): counts for each region of interest and detector."""
    return (
        cells(spark, sf_dir)
        .withColumn("roi", F.expr("cell_id div 20"))
        .groupBy(
            F.expr("CASE WHEN patient < 35 THEN 'train' ELSE 'test' END").alias("split"),
            F.col("source").alias("detector"),
            F.expr("patient % 3").alias("tissue"),
            F.expr("patient % 2").alias("site"),
            "patient",
            "roi",
        )
        .agg(F.sum("kind").alias("tp"), F.count_if(F.col("kind") == 1).alias("fp"), F.count_if(F.col("probability") < 0.2).alias("fn"))
    )


OUTCOMES = CELLS + """, outcomes AS (
  SELECT CASE WHEN patient < 35 THEN 'train' ELSE 'test' END AS split, source AS detector, patient % 3 AS tissue, patient % 2 AS site, patient, cell_id // 20 AS roi,
    CAST(sum(kind) AS BIGINT) AS tp, count(*) FILTER (kind = 1) AS fp, count(*) FILTER (probability < 0.2) AS fn
  FROM cells GROUP BY ALL)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(grp, id, truth, score, measured): events as scored observations."""
    return table(spark, sf_dir, "events").select(
        F.expr("user_id % 5").alias("grp"), F.col("event_id").alias("id"), F.expr("CAST(event_type IN ('click', 'purchase') AS INT)").alias("truth"), F.floor("value").cast("long").alias("score"), F.expr("(user_id * 37 + event_id * 11) % 200").alias("measured")
    )


SCORES = """scores AS (
  SELECT user_id % 5 AS grp, event_id AS id, CAST(event_type IN ('click', 'purchase') AS INTEGER) AS truth,
    CAST(floor(value) AS BIGINT) AS score, (user_id * 37 + event_id * 11) % 200 AS measured FROM events)"""
