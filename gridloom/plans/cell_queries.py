"""Queries of agreement, validity, pixel functions and resampling."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pixel
from ..grid import Grid
from ..operators import cells, resample
from ..operators.kernels import CUBIC
from ..sources import adapters as src
from ..sources.adapters import PX_SQL
from .registry import query, sql_typed, typed

CELL = 8
_R = "CASE WHEN ({p}n * {p}sxx - {p}sx * {p}sx) * ({p}n * {p}syy - {p}sy * {p}sy) > 0 THEN ({p}n * {p}sxy - {p}sx * {p}sy) / sqrt(({p}n * {p}sxx - {p}sx * {p}sx) * ({p}n * {p}syy - {p}sy * {p}sy)) END"


def r_sql(p: str = "") -> str:
    return _R.format(p=p)


def sums_sql(x: str, y: str, p: str = "", where: str = "true") -> str:
    x, y = f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"
    f = f"FILTER ({x} IS NOT NULL AND {y} IS NOT NULL AND ({where}))"
    return f"count(*) {f} AS {p}n, sum({x}) {f} AS {p}sx, sum({y}) {f} AS {p}sy, sum({x} * {x}) {f} AS {p}sxx, sum({y} * {y}) {f} AS {p}syy, sum({x} * {y}) {f} AS {p}sxy"


RASTER = PX_SQL + ", ras AS (SELECT *, dn % 17 <> 0 AS valid FROM px)"
AGREE = RASTER + f""", cell AS (SELECT a.r // {CELL} AS crow, a.c // {CELL} AS ccol, {sums_sql('b.dn', 'a.dn')}, count(*) AS n_ref
  FROM (SELECT * FROM ras WHERE valid) a LEFT JOIN (SELECT r + 1 AS r, c, dn FROM ras WHERE valid) b ON a.r = b.r AND a.c = b.c GROUP BY 1, 2)"""


def _agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    ras = src.raster(spark, sf_dir)
    return cells.agreement(src.shifted(ras, 1, 0), ras, CELL)


@query(f"WITH {AGREE} SELECT {sql_typed('crow ccol n', 'r miss')} FROM (SELECT *, {r_sql()} AS r, 1.0 - n / n_ref AS miss FROM cell)")
def cell_pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(_agreement(spark, sf_dir), "crow ccol n", "r miss")


@query(f"WITH {RASTER} SELECT {sql_typed('crow ccol n s')} FROM (SELECT r // {CELL} AS crow, c // {CELL} AS ccol, count(*) AS n, sum(dn) AS s FROM px GROUP BY 1, 2)")
def block_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = src.px(spark, sf_dir)
    out = p.groupBy(cells.cell_of(F.col("r"), CELL).alias("crow"), cells.cell_of(F.col("c"), CELL).alias("ccol")).agg(F.count("*").alias("n"), F.sum("dn").alias("s"))
    return typed(out, "crow ccol n s")


QUALITY = RASTER + f""", joined AS (SELECT a.r, a.c, a.dn AS reference, b.dn AS before, d.dn AS after, CAST((a.r + a.c) % 3 - 1 AS DOUBLE) AS u, CAST(a.c % 4 - 2 AS DOUBLE) AS v
  FROM (SELECT * FROM ras WHERE valid) a LEFT JOIN (SELECT r + 1 AS r, c, dn FROM ras WHERE valid) b ON a.r = b.r AND a.c = b.c
  LEFT JOIN (SELECT r, c + 1 AS c, dn FROM ras WHERE valid) d ON a.r = d.r AND a.c = d.c),
 qsum AS (SELECT r // {CELL} AS crow, c // {CELL} AS ccol, {sums_sql('before', 'reference', 'b_')}, {sums_sql('after', 'reference', 'a_')}, avg(u) AS mean_u, avg(v) AS mean_v FROM joined GROUP BY 1, 2),
 quality AS (SELECT *, CASE WHEN b_n >= {0.25 * CELL * CELL} THEN {r_sql('b_')} END AS r_before, CASE WHEN a_n >= {0.25 * CELL * CELL} THEN {r_sql('a_')} END AS r_after FROM qsum)"""


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ras = src.raster(spark, sf_dir)
    live = ras.where("valid").select("r", "c", "dn")
    before, after = src.shifted(live, 1, 0).withColumnRenamed("dn", "before"), src.shifted(live, 0, 1).withColumnRenamed("dn", "after")
    joined = live.withColumnRenamed("dn", "reference").join(before, ["r", "c"], "left").join(after, ["r", "c"], "left")
    fields = joined.withColumn("u", ((F.col("r") + F.col("c")) % 3 - 1).cast("double")).withColumn("v", (F.col("c") % 4 - 2).cast("double"))
    return cells.quality_cells(fields, CELL)


@query(f"WITH {QUALITY} SELECT {sql_typed('crow ccol b_n a_n', 'r_before r_after mean_u mean_v')} FROM quality")
def cell_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(_quality(spark, sf_dir), "crow ccol b_n a_n", "r_before r_after mean_u mean_v")


_POOL = ", ".join(f"sum({p}{k}) AS {p}{k}" for p in ("b_", "a_") for k in cells.SUMS)


@query(f"WITH {QUALITY} SELECT {sql_typed('n', 'r')} FROM (SELECT a_n AS n, {r_sql('a_')} AS r FROM (SELECT {_POOL} FROM quality))")
def pooled_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(cells.pooled(_quality(spark, sf_dir), "a_"), "n", "r")


@query(f"""WITH {QUALITY}, mapped AS (SELECT *, sqrt(mean_u * mean_u + mean_v * mean_v) * 0.5 * 100 AS move FROM quality WHERE r_after IS NOT NULL),
 one AS (SELECT median(move) AS median_move_cm, count(*) * {(CELL * 0.5) ** 2 / 10000} AS mapped_ha, count(*) FILTER (move > 50) * {(CELL * 0.5) ** 2 / 10000} AS far_ha,
  count(*) FILTER (move > 50) * 100.0 / count(*) AS far_pct, {_POOL} FROM mapped)
 SELECT {sql_typed('', 'median_move_cm mapped_ha far_ha far_pct r_before r_after', look='BOOLEAN')} FROM (SELECT *, far_pct > 0.5 OR NOT coalesce(r_after > r_before, false) AS look
  FROM (SELECT *, {r_sql('b_')} AS r_before, {r_sql('a_')} AS r_after FROM one))""")
def map_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(cells.map_summary(_quality(spark, sf_dir), 0.5, CELL), "", "median_move_cm mapped_ha far_ha far_pct r_before r_after", look="boolean")


def _grad(at: str, across: str, keys: str = "") -> str:
    w = f"OVER (PARTITION BY {keys}{across} ORDER BY {at})"
    return f"CASE WHEN lag(dn) {w} IS NOT NULL AND lead(dn) {w} IS NOT NULL THEN (lead(dn) {w} - lag(dn) {w}) / 2.0 WHEN lead(dn) {w} IS NOT NULL THEN CAST(lead(dn) {w} - dn AS DOUBLE) ELSE CAST(dn - lag(dn) {w} AS DOUBLE) END"


@query(f"""WITH {RASTER}, g AS (SELECT *, r // 16 AS br, c // 16 AS bc FROM ras), m AS (SELECT *, sqrt(pow(coalesce(gr, 0), 2) + pow(coalesce(gc, 0), 2)) AS mag
  FROM (SELECT *, {_grad('r', 'c', 'br, bc, ')} AS gr, {_grad('c', 'r', 'br, bc, ')} AS gc FROM g)),
 j AS (SELECT m.r, m.c, br, bc, mag, m.dn AS y, b.dn AS x FROM (SELECT * FROM m WHERE valid) m LEFT JOIN (SELECT r, c + 1 AS c, dn FROM ras WHERE valid) b ON m.r = b.r AND m.c = b.c),
 mid AS (SELECT br, bc, median(mag) AS mid FROM j WHERE x IS NOT NULL GROUP BY br, bc),
 s AS (SELECT r // {CELL} AS crow, c // {CELL} AS ccol, {sums_sql('x', 'y', '', 'mag > mid')}, 1.0 - count(x) / count(*) AS miss FROM j LEFT JOIN mid USING (br, bc) GROUP BY 1, 2)
 SELECT {sql_typed('crow ccol n', 'r miss')} FROM (SELECT *, CASE WHEN n >= 10 THEN {r_sql()} END AS r FROM s)""")
def texture_r_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    ras = src.raster(spark, sf_dir)
    return typed(cells.texture_cells(src.shifted(ras, 0, 1), ras, CELL, 16, 10), "crow ccol n", "r miss")


@query(f"WITH {RASTER} SELECT r, c, round({_grad('r', 'c')}, 6) AS gr, round({_grad('c', 'r')}, 6) AS gc FROM px")
def gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(cells.gradient(src.px(spark, sf_dir), "dn"), "r c", "gr gc")


@query(f"WITH {PX_SQL} SELECT r, c, dn > 127 AS valid, dn > 200 AS pair_valid, dn > 0 AS apply_valid FROM px")
def validity_alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("dn")
    return src.px(spark, sf_dir).select("r", "c", pixel.alpha_valid(a).alias("valid"), pixel.alpha_valid(a, pixel.ALPHA_PAIR).alias("pair_valid"), pixel.alpha_valid(a, pixel.ALPHA_APPLY).alias("apply_valid"))


@query(f"WITH {PX_SQL} SELECT r, c, dn % 5 <> 0 OR dn % 7 <> 0 OR dn % 2 <> 0 AS valid FROM px")
def validity_any_nonzero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.px(spark, sf_dir).select("r", "c", pixel.any_nonzero(F.col("dn") % 5, F.col("dn") % 7, F.col("dn") % 2).alias("valid"))


_BANDS = "dn AS b1, (dn * 7) % 256 AS b2, (dn * 13) % 256 AS b3, (dn * 31) % 256 AS b4"


def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("dn")
    return src.px(spark, sf_dir).select("r", "c", d.alias("b1"), (d * 7 % 256).alias("b2"), (d * 13 % 256).alias("b3"), (d * 31 % 256).alias("b4"))


BANDS = f"{PX_SQL}, bands AS (SELECT r, c, {_BANDS} FROM px)"


@query(f"WITH {BANDS} SELECT r, c, round((b1 + b2 + b3) / 3, 6) AS gray FROM bands")
def gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands(spark, sf_dir).select("r", "c", F.round(pixel.gray(*[F.col(f"b{k}") for k in range(1, 5)]), 6).alias("gray"))


@query(f"""WITH {BANDS}, g AS (SELECT r, c, (b1 + b2 + b3) / 3 AS g FROM bands), p AS (SELECT r // 64 AS box, quantile_cont(g, 0.02) AS lo, quantile_cont(g, 0.98) AS hi, count(*) AS n FROM g WHERE g > 0 GROUP BY 1)
 SELECT r, c, round(CASE WHEN coalesce(n, 0) < 100 THEN 0.0 ELSE greatest(0.0, least(1.0, (g - lo) / (hi - lo + 1e-6))) END, 6) AS g FROM g LEFT JOIN p ON g.r // 64 = p.box""")
def gray_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = bands(spark, sf_dir).select("r", "c", pixel.gray(F.col("b1"), F.col("b2"), F.col("b3")).alias("g"), F.floor(F.col("r") / 64).alias("box"))
    p = g.where("g > 0").groupBy("box").agg(F.percentile("g", 0.02).alias("lo"), F.percentile("g", 0.98).alias("hi"), F.count("*").alias("n"))
    out = g.join(p, "box", "left").withColumn("g", F.when(F.coalesce("n", F.lit(0)) < 100, 0.0).otherwise(pixel.stretch(F.col("g"), F.col("lo"), F.col("hi"))))
    return typed(out, "r c", "g")


@query(f"""WITH {BANDS}, p AS (SELECT quantile_cont(b2, 0.02) FILTER (b2 > 0) AS lo, quantile_cont(b2, 0.98) FILTER (b2 > 0) AS hi FROM bands)
 SELECT r, c, round(greatest(0.0, least(1.0, (b2 - lo) / greatest(hi - lo, 1e-9))), 6) AS v FROM bands, p""")
def thumbnail_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bands(spark, sf_dir)
    p = b.where("b2 > 0").agg(F.percentile("b2", 0.02).alias("lo"), F.percentile("b2", 0.98).alias("hi"))
    v = (F.col("b2") - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1e-9))
    return typed(b.crossJoin(F.broadcast(p)).withColumn("v", F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))), "r c", "v")


@query(f"WITH {PX_SQL} SELECT r, c, CAST(greatest(0, least(255, round_even(dn * 1.5 - 20.5, 0))) AS INTEGER) AS v FROM px")
def round_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.px(spark, sf_dir).select("r", "c", pixel.round_clip(F.col("dn") * 1.5 - 20.5).alias("v"))


@query(f"""WITH {BANDS} SELECT r, c, round(CASE WHEN b3 + b1 > 1 THEN (b3 - b1) / CAST(b3 + b1 AS DOUBLE) END, 6) AS ndvi, round(CASE WHEN b3 + b4 > 1 THEN (b3 - b4) / CAST(b3 + b4 AS DOUBLE) END, 6) AS ndre,
 round(CASE WHEN b4 > 1 THEN b3 / CAST(b4 AS DOUBLE) - 1 END, 6) AS cire FROM bands""")
def veg_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    red, nir, edge = F.col("b1"), F.col("b3"), F.col("b4")
    out = bands(spark, sf_dir).select("r", "c", pixel.normalised_difference(nir, red).alias("ndvi"), pixel.normalised_difference(nir, edge).alias("ndre"), pixel.ratio_less_one(nir, edge).alias("cire"))
    return typed(out, "r c", "ndvi ndre cire")


@query(f"""WITH {BANDS} SELECT r, c, round(sqrt(pow(b1 - 128, 2) + pow(b2 - 128, 2)) * 0.05 * 100, 6) AS move, CAST(floor((b1 - 128) / 10.0) AS BIGINT) AS tx, CAST(floor((b2 - 128) / 10.0) AS BIGINT) AS ty,
 round(CAST(100 + (c + 0.5) * 0.05 AS DOUBLE), 6) AS x, round(CAST(200 - (r + 0.5) * 0.05 AS DOUBLE), 6) AS y FROM bands""")
def move_and_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..grid import Grid

    u, v = (F.col("b1") - 128).cast("double"), (F.col("b2") - 128).cast("double")
    x, y = Grid(100.0, 200.0, 0.05, 0, 0).world(F.col("r"), F.col("c"))
    out = bands(spark, sf_dir).select("r", "c", pixel.move_cm(u, v, 0.05).alias("move"), pixel.tile_key(u, 10).alias("tx"), pixel.tile_key(v, 10).alias("ty"), x.alias("x"), y.alias("y"))
    return typed(out, "r c tx ty", "move x y")


@query(f"WITH {BANDS} SELECT r, c, b1 <> 34 AND b2 <> 34 AND b3 <> 34 AND (b1 <> 0 OR b2 <> 0 OR b3 <> 0) AS is_data, ((b1 * 64) & 1024) <> 0 OR ((b1 * 64) & 2048) <> 0 AS cloud FROM bands")
def reference_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = [F.col(f"b{k}") for k in (1, 2, 3)]
    return bands(spark, sf_dir).select("r", "c", pixel.is_reference_data(b, 34).alias("is_data"), pixel.cloud_flag(b[0] * 64).alias("cloud"))


@query(f"""WITH {RASTER}, bound AS (SELECT DISTINCT r // 8 AS br, c // 8 AS bc FROM ras WHERE valid AND dn > 60), s AS (SELECT r, c, dn, (dn % 9 - 4) AS u, (dn % 5 - 2) AS v FROM px)
 SELECT s.r, s.c, s.u * s.u + s.v * s.v <= 16 AND t.valid IS TRUE AND b.br IS NOT NULL AS keep FROM s LEFT JOIN ras t ON t.r = s.r + s.v AND t.c = s.c + s.u LEFT JOIN bound b ON b.br = (s.r + s.v) // 8 AND b.bc = (s.c + s.u) // 8""")
def warp_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    ras = src.raster(spark, sf_dir)
    bound = ras.where("valid AND dn > 60").select(F.floor(F.col("r") / 8).alias("br"), F.floor(F.col("c") / 8).alias("bc")).distinct().withColumn("bound", F.lit(True))
    moved = src.px(spark, sf_dir).select(F.col("r").alias("r0"), F.col("c").alias("c0"), (F.col("dn") % 9 - 4).alias("u"), (F.col("dn") % 5 - 2).alias("v"))
    moved = moved.withColumn("r", F.col("r0") + F.col("v")).withColumn("c", F.col("c0") + F.col("u")).withColumn("br", F.floor(F.col("r") / 8)).withColumn("bc", F.floor(F.col("c") / 8))
    met = moved.join(ras.select("r", "c", "valid"), ["r", "c"], "left").join(bound, ["br", "bc"], "left")
    keep = (F.col("u") * F.col("u") + F.col("v") * F.col("v") <= 16) & F.coalesce("valid", F.lit(False)) & F.coalesce("bound", F.lit(False))
    return met.select(F.col("r0").alias("r"), F.col("c0").alias("c"), keep.alias("keep"))


@query(f"WITH {RASTER}, bound AS (SELECT DISTINCT r // 8 AS br, c // 8 AS bc FROM ras WHERE valid AND dn > 190) SELECT r, c, dn FROM px SEMI JOIN bound ON r // 8 = br AND c // 8 = bc")
def bound_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [F.floor(F.col("r") / 8).alias("br"), F.floor(F.col("c") / 8).alias("bc")]
    bound = src.raster(spark, sf_dir).where("valid AND dn > 190").select(*keys).distinct()
    return src.px(spark, sf_dir).select("*", *keys).join(bound, ["br", "bc"], "left_semi").select("r", "c", "dn")


@query(f"WITH {RASTER} SELECT r // 4 AS r, c // 4 AS c, round(avg(dn), 6) AS dn, count(*) AS n FROM ras WHERE valid GROUP BY 1, 2")
def average_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(resample.average_down(src.raster(spark, sf_dir), 4, ["dn"]), "r c n", "dn")


@query(f"WITH {PX_SQL}, dim AS (SELECT max(r) + 1 AS h FROM px) SELECT r * 50 // h AS r, c * 20 // 64 AS c, round(avg(dn), 6) AS dn FROM px, dim GROUP BY 1, 2")
def decimated_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(resample.decimated(src.px(spark, sf_dir), src.height(spark, sf_dir), 64, 50, 20), "r c", "dn")


@query(f"WITH {PX_SQL} SELECT r * 3 + i AS r, c * 3 + j AS c, dn FROM px, (SELECT unnest([0, 1, 2]) AS i), (SELECT unnest([0, 1, 2]) AS j)")
def upsample_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.upsample_nearest(src.px(spark, sf_dir), 3).select("r", "c", "dn")


def _axis(size: str, name: str) -> str:
    return f"greatest(0, least({size} - 1, ({name} + 0.5) / 4 - 0.5))"


@query(f"""WITH {PX_SQL}, dim AS (SELECT max(r) + 1 AS h FROM px), lines AS (SELECT i AS r, {_axis('h', 'i')} AS y FROM dim, (SELECT unnest(range(h * 4)) AS i FROM dim)),
 f AS (SELECT r, y, j AS c, {_axis('64', 'j')} AS x FROM lines, range(256) t(j)),
 k AS (SELECT r, c, x, y, CAST(floor(y) AS BIGINT) + a.i AS sr, CAST(floor(x) AS BIGINT) + b.i AS sc FROM f, range(2) a(i), range(2) b(i))
 SELECT k.r, k.c, round(sum((1 - abs(y - sr)) * (1 - abs(x - sc)) * dn) / sum((1 - abs(y - sr)) * (1 - abs(x - sc))), 6) AS dn
 FROM k JOIN px ON px.r = sr AND px.c = sc GROUP BY 1, 2""")
def upsample_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(resample.upsample_bilinear(src.px(spark, sf_dir), 4, src.height(spark, sf_dir), 64), "r c", "dn")


@query(f"""WITH {PX_SQL}, d AS (SELECT r, c, sum(dn) OVER (PARTITION BY c ORDER BY r RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS s FROM px)
 SELECT r, c, round(sum(s) OVER (PARTITION BY r ORDER BY c RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) / 49.0, 6) AS mean FROM d""")
def box_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(resample.box_mean(src.px(spark, sf_dir), 3), "r c", "mean")


def _burt(at: str, across: str) -> str:
    w = f"OVER (PARTITION BY {across} ORDER BY {at})"
    return f"0.05 * coalesce(lag(v, 2) {w}, 0) + 0.25 * coalesce(lag(v, 1) {w}, 0) + 0.4 * v + 0.25 * coalesce(lead(v, 1) {w}, 0) + 0.05 * coalesce(lead(v, 2) {w}, 0)"


@query(f"""WITH {PX_SQL}, a AS (SELECT r, c, CAST(dn AS DOUBLE) AS v FROM px), b AS (SELECT r, c, {_burt('r', 'c')} AS v FROM a), e AS (SELECT * FROM b WHERE r % 2 = 0)
 SELECT r // 2 AS r, c // 2 AS c, round(w, 6) AS dn FROM (SELECT r, c, {_burt('c', 'r')} AS w FROM e) WHERE c % 2 = 0""")
def pyramid_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(resample.pyramid_up(src.px(spark, sf_dir)), "r c", "dn")


@query(f"WITH {PX_SQL} SELECT r * 2 + i AS r, c * 2 + j AS c, CAST(dn * 2.0 AS DOUBLE) AS dn FROM px, (SELECT max(r) + 1 AS h FROM px), range(2) a(i), range(2) b(j) WHERE r * 2 + i < 2 * h - 1 AND c * 2 + j < 127")
def pyramid_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(resample.pyramid_down(src.px(spark, sf_dir), 2 * src.height(spark, sf_dir) - 1, 127, scale=2.0), "r c", "dn")


@query(f"""WITH {PX_SQL}, dim AS (SELECT max(r) AS m FROM px), f AS (SELECT r, c, m, greatest(0, least(63, c + (dn % 7 - 3) / 2.0)) AS x, greatest(0, least(m, r + (dn % 5 - 2) / 4.0)) AS y FROM px, dim),
 k AS (SELECT r, c, least(CAST(floor(y) AS BIGINT) + i, m) AS sr, least(CAST(floor(x) AS BIGINT) + j, 63) AS sc, (CASE i WHEN 1 THEN y - floor(y) ELSE 1 - y + floor(y) END) * (CASE j WHEN 1 THEN x - floor(x) ELSE 1 - x + floor(x) END) AS w
  FROM f, range(2) a(i), range(2) b(j))
 SELECT k.r, k.c, round(sum(w * px.dn), 6) AS dn FROM k JOIN px ON px.r = sr AND px.c = sc GROUP BY 1, 2""")
def bilinear_warp(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = src.px(spark, sf_dir)
    shifts = p.select("r", "c", ((F.col("dn") % 7 - 3) / 2.0).alias("u"), ((F.col("dn") % 5 - 2) / 4.0).alias("v"))
    return typed(resample.bilinear_warp(p, shifts, src.height(spark, sf_dir), 64), "r c", "dn")


@query(f"""WITH {PX_SQL}, o AS (SELECT r + k AS r, c, dn FROM px, (SELECT unnest(range(-4, 5)) AS k)) SELECT a.r, a.c, count(*) FILTER (b.dn > a.dn) AS rank
 FROM px a JOIN o b ON b.r = a.r AND b.c BETWEEN a.c - 4 AND a.c + 4 GROUP BY 1, 2""")
def rank_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(resample.rank_transform(src.px(spark, sf_dir), 4), "r c rank")


# Reading through a grid whose origin lies 0.61 rows below and 0.37 columns beside the raster's.
_TARGET = f"{PX_SQL}, dim AS (SELECT max(r) + 1 AS h FROM px), t AS (SELECT r, c, r + 0.61::DOUBLE AS y, c + 0.37::DOUBLE AS x FROM px, dim WHERE r < h - 1 AND c < 63)"


def _cubic_sql(t: str) -> str:
    a, t = CUBIC, f"abs({t})"
    return f"CASE WHEN {t} <= 1 THEN ({a} + 2) * {t} * {t} * {t} - ({a} + 3) * {t} * {t} + 1 WHEN {t} < 2 THEN {a} * {t} * {t} * {t} - 5 * {a} * {t} * {t} + 8 * {a} * {t} - 4 * {a} ELSE 0 END"


def _through(spark: SparkSession, sf_dir: str, kind: str, res: float = 1.0) -> DataFrame:
    h = src.height(spark, sf_dir)
    own = Grid(0.0, float(h), 1.0, h, 64)
    onto = Grid(0.37, h - 0.61, res, int((h - 1) // res), int(63 // res))
    return typed(resample.read_through(src.px(spark, sf_dir), own, onto, kind), "r c", "dn")


@query(f"WITH {_TARGET} SELECT t.r, t.c, round(CAST(p.dn AS DOUBLE), 6) AS dn FROM t JOIN px p ON p.r = floor(y + 0.5) AND p.c = floor(x + 0.5)")
def read_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, sf_dir, "nearest")


@query(f"""WITH {_TARGET}, k AS (SELECT t.*, CAST(floor(y) AS BIGINT) + a.i AS sr, CAST(floor(x) AS BIGINT) + b.i AS sc FROM t, range(2) a(i), range(2) b(i))
 SELECT k.r, k.c, round(sum(dn * (1 - abs(y - sr)) * (1 - abs(x - sc))), 6) AS dn FROM k JOIN px ON px.r = sr AND px.c = sc GROUP BY 1, 2""")
def read_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, sf_dir, "bilinear")


@query(f"""WITH {_TARGET}, k AS (SELECT t.*, CAST(floor(y) AS BIGINT) + a.i AS sr, CAST(floor(x) AS BIGINT) + b.i AS sc FROM t, range(-1, 3) a(i), range(-1, 3) b(i))
 SELECT k.r, k.c, round(sum(dn * ({_cubic_sql('y - sr')}) * ({_cubic_sql('x - sc')})), 6) AS dn FROM k JOIN px ON px.r = sr AND px.c = sc GROUP BY 1, 2""")
def read_cubic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, sf_dir, "cubic")


@query(f"WITH {PX_SQL}, dim AS (SELECT max(r) + 1 AS h FROM px), a AS (SELECT CAST(floor((r + 0.5 - 0.61) / 3) AS BIGINT) AS r, CAST(floor((c + 0.5 - 0.37) / 3) AS BIGINT) AS c, avg(dn) AS dn FROM px GROUP BY 1, 2) SELECT r, c, round(dn, 6) AS dn FROM a, dim WHERE r >= 0 AND c >= 0 AND r < (h - 1) // 3 AND c < 21")
def read_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, sf_dir, "average", 3.0)
