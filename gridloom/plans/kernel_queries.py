"""Queries of the grouped kernels; SQL cannot express them, known-answer tests hold them."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import kernels, seams
from ..operators import register as reg
from ..sources import adapters as src
from ..sources.tables import cut_lineage
from . import cell_queries
from .registry import query

SETTINGS = {"radii": (8, 4), "iterations": 4, "rank_radius": 2, "levels": 2}


def _pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = src.px(spark, sf_dir)
    moving = src.shifted(p, 1, 1).withColumnRenamed("dn", "moving")
    return p.withColumnRenamed("dn", "reference").join(moving, ["r", "c"], "left")


@query()
def dense_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kernels.dense_flow(_pair(spark, sf_dir), 64, 16, **SETTINGS)
    return out.select("r", "c", F.round("u", 3).alias("u"), F.round("v", 3).alias("v"))


def _cubic_warp_sql() -> str:
    taps = ("CAST(floor(y) AS BIGINT) + a.i AS sr", "CAST(floor(x) AS BIGINT) + b.i AS sc")
    return f"""WITH {src.PX_SQL}, t AS (SELECT r, c, c + 0.5::DOUBLE AS x, r + (r % 3 - 1) / 4.0::DOUBLE AS y FROM px), k AS (SELECT t.*, {', '.join(taps)} FROM t, range(-1, 3) a(i), range(-1, 3) b(i))
 SELECT k.r, k.c, CAST(greatest(0, least(255, round_even(round(sum(dn * ({cell_queries._cubic_sql('y - sr')}) * ({cell_queries._cubic_sql('x - sc')})), 9), 0))) AS INTEGER) AS dn FROM k JOIN px ON px.r = sr AND px.c = sc GROUP BY 1, 2"""


@query(_cubic_warp_sql())
def cubic_warp(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = src.px(spark, sf_dir)
    return kernels.cubic_warp(p.withColumn("u", F.lit(0.5)).withColumn("v", (F.col("r") % 3 - 1) / 4.0), 64, 8)


@query()
def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole registration: fill, stretch, flow, trust, keep, one warp; cells with agreement before and after, and the shift."""
    pair = _pair(spark, sf_dir).select("r", "c", "reference", (F.col("reference") % 17 != 0).alias("ref_valid"), F.coalesce("moving", F.lit(0)).alias("moving"), F.col("moving").isNotNull().alias("mov_valid"))
    out = reg.register(cut_lineage(pair), src.height(spark, sf_dir), 64, cut_lineage, 64, 16, 0.5, 8, **SETTINGS)["cells"]
    return out.select("crow", "ccol", *[F.round(x, 3).alias(x) for x in ("r_before", "r_after", "mean_u", "mean_v")])


@query()
def seam_merge_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole stitch with the flow of each seam's pair, its split and the shifted sources."""
    flights = cut_lineage(src.flights(spark, sf_dir))
    out = seams.merge(flights, 6.0, cut_lineage, measure={"block": 64, "reach": 32, "halo": 16} | SETTINGS)["mosaic"]
    return out.select("r", "c", "dn", "alpha")
