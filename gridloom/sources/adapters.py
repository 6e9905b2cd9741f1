"""Stand-ins that read the synthetic tables as rasters, calibration pairs and scenes. The SQL twins stand beside them."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PX_SQL = """px AS (SELECT CAST(vec_id AS BIGINT) AS r, CAST(i - 1 AS BIGINT) AS c,
  CAST(greatest(0, least(255, round_even((CAST(embedding[i] AS DOUBLE) + 0.6) * 200, 0))) AS INTEGER) AS dn
  FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))"""

FLIGHTS_SQL = PX_SQL + """, dim AS (SELECT max(r) + 1 AS h FROM px),
flights AS (SELECT CAST(src AS INTEGER) AS src, r, c, CAST(least(255, dn + 3 * src) AS INTEGER) AS dn,
  CASE src WHEN 0 THEN c < 40 WHEN 1 THEN c >= 24 AND r < h // 2 + 20 ELSE c >= 24 AND r >= h // 2 - 20 END AS valid
  FROM px, dim, (SELECT unnest([0, 1, 2]) AS src))"""

PAIRS_SQL = """pairs AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS id,
  CAST(l_partkey AS DOUBLE) AS x, CAST(l_suppkey AS DOUBLE) AS y, CAST(l_quantity AS DOUBLE) AS d0, floor(l_extendedprice / 100) AS d1,
  3 * CAST(l_quantity AS DOUBLE) + floor(l_extendedprice / 200) + l_linenumber AS s0, 2 * CAST(l_quantity AS DOUBLE) - l_linenumber + 300 AS s1,
  CAST((l_orderkey * 7 + l_linenumber) % 5 AS INTEGER) AS fold FROM lineitem)"""

SCENES_SQL = """days AS (SELECT CAST(ts AS DATE) AS date, 100.0 * avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS cloud, count(*) AS n FROM events GROUP BY 1)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def px(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(r, c, dn): vectors as rows of a raster, each component as a value of 0..255."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("r"), F.posexplode("embedding").alias("c", "v"))
    dn = F.least(F.lit(255.0), F.greatest(F.lit(0.0), F.rint((F.col("v").cast("double") + 0.6) * 200))).cast("int")
    return rows.select("r", F.col("c").cast("long").alias("c"), dn.alias("dn"))


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """px with valid: dn not a multiple of 17."""
    return px(spark, sf_dir).withColumn("valid", F.col("dn") % 17 != 0)


def shifted(pixels: DataFrame, rows: int, cols: int) -> DataFrame:
    """The same values moved by whole pixels."""
    return pixels.withColumn("r", F.col("r") + rows).withColumn("c", F.col("c") + cols)


def height(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0] + 1


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three overlapping sources with a triple junction: (src, r, c, dn, valid) on the whole lattice."""
    half = height(spark, sf_dir) // 2
    src, r, c = F.col("src"), F.col("r"), F.col("c")
    valid = F.when(src == 0, c < 40).when(src == 1, (c >= 24) & (r < half + 20)).otherwise((c >= 24) & (r >= half - 20))
    rows = px(spark, sf_dir).withColumn("src", F.explode(F.array(*map(F.lit, (0, 1, 2)))))
    return rows.select("src", "r", "c", F.least(F.lit(255), F.col("dn") + 3 * src).cast("int").alias("dn"), valid.alias("valid"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibration pairs: position, two drone bands d0 d1, two reference bands s0 s1, and an arithmetic fold."""
    rows = table(spark, sf_dir, "lineitem")
    q, price, line = F.col("l_quantity").cast("double"), F.col("l_extendedprice"), F.col("l_linenumber")
    return rows.select(
        F.col("l_partkey").cast("double").alias("x"), F.col("l_suppkey").cast("double").alias("y"), q.alias("d0"), F.floor(price / 100).cast("double").alias("d1"),
        (3 * q + F.floor(price / 200) + line).alias("s0"), (2 * q - line + 300).alias("s1"), F.pmod(F.col("l_orderkey") * 7 + line, F.lit(5)).cast("int").alias("fold"),
    )


def scene_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, cloud, n): events of a UTC day as the granule's pixels, errors as cloud."""
    rows = table(spark, sf_dir, "events")
    flag: Column = (F.col("event_type") == "error").cast("double")
    return rows.groupBy(F.to_date("ts").alias("date")).agg((F.avg(flag) * 100).alias("cloud"), F.count("*").alias("n"))
