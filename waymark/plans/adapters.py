"""The star-schema tables in the shape of the road network; the SQL texts build the same for DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TABLES = r"\b(region|nation|customer|supplier|part|orders|lineitem|events|documents|embeddings|pages|benchmark|labels|conversations)\b"


def made(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The result of a SQL text, in words that DuckDB reads as well, over the tables it names."""
    frames = {t: read(spark, sf_dir, t) for t in set(re.findall(_TABLES, sql))}
    return spark.sql(re.sub(_TABLES, r"{\1}", sql), **frames)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road segments of ``lineitem``: a route per order (pairs of INC and DEC), lengths from quantities."""
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    way = F.when(k % 2 == 0, "INC").otherwise("DEC")
    route = F.concat(F.lpad(F.floor(k / 2).cast("string"), 10, "0"), way)
    # dealt by route once, for the aggregate, the window and whatever works on routes
    rows = read(spark, sf_dir, "lineitem").withColumn("ROUTE_ID", route).repartition("ROUTE_ID").groupBy("ROUTE_ID", "l_orderkey", "l_linenumber").agg(
        F.sum("l_quantity").alias("len"), F.min("l_extendedprice").alias("price"), F.min("l_returnflag").alias("flag"), F.min("l_linestatus").alias("status"), F.min("l_tax").alias("tax")
    )
    end = F.sum("len").over(Window.partitionBy("ROUTE_ID", "l_orderkey").orderBy("l_linenumber"))
    rows = rows.select(
        "ROUTE_ID", n.cast("int").alias("seq"), (end - F.col("len")).alias("from_mp"), end.alias("to_mp"),
        F.when(F.col("flag") != "R", F.floor("price").cast("bigint")).alias("AADT"), (F.bround(F.col("tax") * 100).cast("bigint") * 1000 + k % 1000).alias("HPMS_AADT"),
        (1 + (k + n) % 7).cast("int").alias("FUNCTIONAL_CLASS"), (1 + k % 5).cast("int").alias("DISTRICT"), (k % 40).cast("int").alias("COUNTY"), F.when(n % 3 == 0, 99999).otherwise(100).cast("int").alias("URBAN_CODE"),
        F.col("status").alias("STATUS"), F.col("len").alias("miles"),
    )
    return rows.withColumn("unique_id", F.concat_ws("_", "ROUTE_ID", F.col("seq").cast("string")))


SEGMENTS_SQL = """
seg0 AS (
  SELECT l_orderkey AS k, l_linenumber AS n, sum(l_quantity) AS len, min(l_extendedprice) AS price, min(l_returnflag) AS flag, min(l_linestatus) AS status, min(l_tax) AS tax
  FROM lineitem GROUP BY 1, 2
), seg AS (
  SELECT lpad(CAST(k // 2 AS VARCHAR), 10, '0') || CASE WHEN k % 2 = 0 THEN 'INC' ELSE 'DEC' END AS ROUTE_ID, n AS seq,
    sum(len) OVER w - len AS from_mp, sum(len) OVER w AS to_mp,
    CASE WHEN flag <> 'R' THEN CAST(floor(price) AS BIGINT) END AS AADT, CAST(round_even(tax * 100, 0) AS BIGINT) * 1000 + k % 1000 AS HPMS_AADT,
    CAST(1 + (k + n) % 7 AS INTEGER) AS FUNCTIONAL_CLASS, CAST(1 + k % 5 AS INTEGER) AS DISTRICT, CAST(k % 40 AS INTEGER) AS COUNTY, CASE WHEN n % 3 = 0 THEN 99999 ELSE 100 END AS URBAN_CODE,
    status AS STATUS, len AS miles,
    lpad(CAST(k // 2 AS VARCHAR), 10, '0') || CASE WHEN k % 2 = 0 THEN 'INC' ELSE 'DEC' END || '_' || CAST(n AS VARCHAR) AS unique_id
  FROM seg0 WINDOW w AS (PARTITION BY k ORDER BY n)
)"""


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference intervals: the segments moved along their route by 0 to 2 miles, with values of their own."""
    s = segments(spark, sf_dir)
    move = F.col("seq") % 3
    return s.select("ROUTE_ID", F.col("seq").alias("ref_seq"), (F.col("from_mp") + move).alias("from_mp"), (F.col("to_mp") + move).alias("to_mp"), F.col("HPMS_AADT").alias("ref_aadt"))


REFERENCE_SQL = "ref AS (SELECT ROUTE_ID, seq AS ref_seq, from_mp + seq % 3 AS from_mp, to_mp + seq % 3 AS to_mp, HPMS_AADT AS ref_aadt FROM seg)"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment midpoints in metres, one per customer in each of five years; every 97th has no place."""
    k = F.col("c_custkey")
    rows = read(spark, sf_dir, "customer").withColumn("year", F.explode(F.sequence(F.lit(2020), F.lit(2024))))
    return rows.select(k.alias("unique_id"), F.col("year").cast("int").alias("year"), F.when(k % 97 == 0, F.lit(float("nan"))).otherwise(((k * 7919) % 50_000).cast("double")).alias("x"), ((k * 104_729) % 50_000).cast("double").alias("y"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count stations in metres, one per supplier and year."""
    k = F.col("s_suppkey")
    rows = read(spark, sf_dir, "supplier").withColumn("year", F.explode(F.sequence(F.lit(2020), F.lit(2024))))
    return rows.select(
        k.alias("tc_number"), F.col("year").cast("int").alias("year"), ((k * 3571 + F.col("year") % 3 * 100) % 50_000).cast("double").alias("x"), ((k * 15_485) % 50_000).cast("double").alias("y"),
        F.when((k + F.col("year")) % 11 != 0, F.floor(F.abs("s_acctbal")).cast("bigint") + (F.col("year") - 2020) * 37).alias("aadt"), (k % 7 + 1).cast("int").alias("FUNCTIONAL_CLASS"),
    )


POINTS_SQL = """
pts AS (
  SELECT c_custkey AS unique_id, CAST(yr AS INTEGER) AS year, CASE WHEN c_custkey % 97 <> 0 THEN CAST((c_custkey * 7919) % 50000 AS DOUBLE) END AS x, CAST((c_custkey * 104729) % 50000 AS DOUBLE) AS y FROM customer, generate_series(2020, 2024) g(yr)
), sta AS (
  SELECT s_suppkey AS tc_number, CAST(yr AS INTEGER) AS year, CAST((s_suppkey * 3571 + yr % 3 * 100) % 50000 AS DOUBLE) AS x, CAST((s_suppkey * 15485) % 50000 AS DOUBLE) AS y,
    CASE WHEN (s_suppkey + yr) % 11 <> 0 THEN CAST(floor(abs(s_acctbal)) AS BIGINT) + (yr - 2020) * 37 END AS aadt, CAST(s_suppkey % 7 + 1 AS INTEGER) AS FUNCTIONAL_CLASS
  FROM supplier, generate_series(2020, 2024) g(yr)
)"""
