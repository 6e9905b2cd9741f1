"""Queries of calibration, scenes, headers, tiles, sets and the work queue."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pixel
from ..operators import calibrate, scenes
from ..sources import adapters as src
from ..sources.adapters import PAIRS_SQL, PX_SQL, SCENES_SQL
from .registry import query, sql_typed, typed

SIZE, ALPHA = 100.0, calibrate.ALPHA
TILED = f"{PAIRS_SQL}, tiled AS (SELECT *, CAST(floor(y / {SIZE}) AS BIGINT) AS gr, CAST(floor(x / {SIZE}) AS BIGINT) AS gc FROM pairs)"


def _sums(keys: str, source: str) -> str:
    return f"SELECT {keys}, CAST(count(*) AS DOUBLE) AS n, sum(d0) AS x, sum(d1) AS z, sum(s0) AS y, sum(d0 * d0) AS xx, sum(d0 * d1) AS xz, sum(d1 * d1) AS zz, sum(d0 * s0) AS xy, sum(d1 * s0) AS zy FROM {source} GROUP BY {keys}"


#: Ridge of s0 on (d0, d1) in closed form, from the sums above.
_CENTRED = "*, xx - x * x / n AS a, xz - x * z / n AS b, zz - z * z / n AS d, xy - x * y / n AS e, zy - z * y / n AS f"
_REG = f"*, a + {ALPHA} * a + 1e-6 * (greatest(a, d) + 1) AS p, d + {ALPHA} * d + 1e-6 * (greatest(a, d) + 1) AS q"
_COEF = "*, (e * q - b * f) / (p * q - b * b) AS k0, (p * f - b * e) / (p * q - b * b) AS k1"


def _fit2(sums: str) -> str:
    return f"SELECT *, y / n - x / n * k0 - z / n * k1 AS icpt FROM (SELECT {_COEF} FROM (SELECT {_REG} FROM (SELECT {_CENTRED} FROM ({sums}))))"


@query(f"""WITH {TILED}, s AS ({_sums('gr, gc', 'tiled')}), f AS (SELECT *, (xy - x * y / n) / ((xx - x * x / n) * (1 + {ALPHA}) + 1e-6 * (xx - x * x / n + 1)) AS k FROM s WHERE n >= 20)
 SELECT gr, gc, round(k, 4) AS slope, round(y / n - x / n * k, 3) AS intercept FROM f""")
def ridge_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = calibrate.fit_tiles(src.pairs(spark, sf_dir), ["d0"], ["s0"], SIZE)
    return out.select("gr", "gc", F.round(F.get("coef", F.lit(0)), 4).alias("slope"), F.round("intercept", 3).alias("intercept"))


@query(f"WITH {TILED}, m AS ({_fit2(_sums('gr, gc', 'tiled'))}) SELECT gr, gc, round(k0, 4) AS k0, round(k1, 4) AS k1, round(icpt, 3) AS intercept FROM m WHERE n >= 20")
def ridge_fit_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = calibrate.fit_tiles(src.pairs(spark, sf_dir), ["d0", "d1"], ["s0"], SIZE)
    return out.select("gr", "gc", F.round(F.get("coef", F.lit(0)), 4).alias("k0"), F.round(F.get("coef", F.lit(1)), 4).alias("k1"), F.round("intercept", 3).alias("intercept"))


@query(f"WITH {PAIRS_SQL} SELECT CAST(0 AS INTEGER) AS band, greatest(1.0, min(s0)) AS lo, max(s0) AS hi FROM pairs UNION ALL SELECT 1, greatest(1.0, min(s1)), max(s1) FROM pairs".replace("greatest(1.0,", "greatest(CAST(1 AS DOUBLE),"))
def clip_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibrate.clip_range(src.pairs(spark, sf_dir), ["s0", "s1"])


OOF = f"""{TILED}, own AS ({_sums('gr, gc, fold', 'tiled')}), tot AS ({_sums('gr, gc', 'tiled')}),
 tr AS (SELECT o.gr, o.gc, o.fold, t.n - o.n AS n, {', '.join(f't.{c} - o.{c} AS {c}' for c in 'x z y xx xz zz xy zy'.split())} FROM own o JOIN tot t ON o.gr = t.gr AND o.gc = t.gc WHERE t.n >= 20),
 model AS (SELECT * FROM ({_fit2('SELECT * FROM tr')}) WHERE n >= 5), oof AS (SELECT t.gr, t.gc, t.s0 AS y, m.icpt + m.k0 * t.d0 + m.k1 * t.d1 AS p FROM tiled t JOIN model m ON t.gr = m.gr AND t.gc = m.gc AND t.fold = m.fold)"""


def _oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibrate.out_of_fold(src.pairs(spark, sf_dir), ["d0", "d1"], ["s0"], SIZE, F.col("fold"))


@query(f"WITH {OOF} SELECT gr, gc, CAST(0 AS INTEGER) AS band, count(*) AS n, round(avg(abs(y - p)), 4) AS mae FROM oof GROUP BY gr, gc HAVING count(*) >= 10")
def cv_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibrate.tile_errors(_oof(spark, sf_dir)).withColumn("mae", F.round("mae", 4))


@query(f"WITH {OOF} SELECT CAST(0 AS INTEGER) AS band, round(1 - sum((y - p) * (y - p)) / (sum(y * y) - sum(y) * sum(y) / count(*)), 3) AS r2 FROM oof")
def oof_r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibrate.pooled_r2(_oof(spark, sf_dir)).withColumn("r2", F.round("r2", 3))


@query(f"WITH {OOF}, e AS (SELECT gr, gc, avg(abs(y - p)) AS mae FROM oof GROUP BY gr, gc HAVING count(*) >= 10) SELECT CAST(0 AS INTEGER) AS band, round(quantile_cont(mae, 0.5), 4) AS median, round(quantile_cont(mae, 0.9), 4) AS p90 FROM e")
def qa_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = calibrate.summary(calibrate.tile_errors(_oof(spark, sf_dir)))
    return out.select("band", F.round("median", 4).alias("median"), F.round("p90", 4).alias("p90"))


@query(f"""WITH {TILED}, m AS (SELECT * FROM ({_fit2(_sums('gr, gc', 'tiled'))}) WHERE n >= 20), lim AS (SELECT greatest(CAST(1 AS DOUBLE), min(s0)) AS lo, max(s0) AS hi FROM pairs),
 pt AS (SELECT *, x / {SIZE} - 0.5 - floor(x / {SIZE} - 0.5) AS fx, y / {SIZE} - 0.5 - floor(y / {SIZE} - 0.5) AS fy, floor(x / {SIZE} - 0.5) AS c0, floor(y / {SIZE} - 0.5) AS r0 FROM pairs),
 k AS (SELECT id, d0, d1, r0 + i AS gr, c0 + j AS gc, (CASE i WHEN 1 THEN fy ELSE 1 - fy END) * (CASE j WHEN 1 THEN fx ELSE 1 - fx END) AS w FROM pt, range(2) a(i), range(2) b(j) WHERE CAST(d0 AS BIGINT) % 10 > 0),
 v AS (SELECT id, sum(w * (icpt + k0 * d0 + k1 * d1)) / sum(w) AS v FROM k JOIN m USING (gr, gc) WHERE w > 0 GROUP BY id)
 SELECT x, y, d0, d1, CAST(CASE WHEN v IS NULL THEN 0 ELSE round_even(least(hi, greatest(lo, v)), 0) END AS INTEGER) AS value FROM pairs LEFT JOIN v USING (id), lim""")
def ridge_apply_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = src.pairs(spark, sf_dir)
    rows = p.withColumn("id", F.struct("x", "y", "d0", "d1", "s0", "s1", "fold")).withColumn("alpha", F.col("d0").cast("long") % 10)
    unique = rows.groupBy("id").agg(F.count("*").alias("copies"), F.first("x").alias("x"), F.first("y").alias("y"), F.first("d0").alias("d0"), F.first("d1").alias("d1"), F.first("alpha").alias("alpha"))
    out = calibrate.apply_bilinear(unique, calibrate.fit_tiles(p, ["d0", "d1"], ["s0"], SIZE), calibrate.clip_range(p, ["s0"]), ["d0", "d1"], SIZE)
    return out.join(unique.select("id", "copies"), "id").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("id.x", "id.y", "id.d0", "id.d1", "value")


@query(f"WITH {PX_SQL}, dn AS (SELECT r // 4 AS r, c // 4 AS c, avg(dn) AS b1, avg((dn * 7) % 256) AS b2 FROM px WHERE (dn * 5) % 256 > 200 GROUP BY 1, 2), ref AS (SELECT r, c, dn AS s1 FROM px WHERE dn % 11 <> 0) SELECT r, c, s1, round(b1, 6) AS b1, round(b2, 6) AS b2 FROM ref JOIN dn USING (r, c)")
def build_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, dn = src.px(spark, sf_dir), F.col("dn")
    drone = p.select("r", "c", dn.alias("b1"), (dn * 7 % 256).alias("b2"), (dn * 5 % 256).alias("alpha"))
    ref = p.where(dn % 11 != 0).select("r", "c", dn.alias("s1"))
    return calibrate.build_pairs(drone, ref, 4, ["b1", "b2"]).select("r", "c", "s1", F.round("b1", 6).alias("b1"), F.round("b2", 6).alias("b2"))


TARGET = f"{SCENES_SQL}, target AS (SELECT quantile_disc(date, 0.5) AS target FROM days)"
CAND = f"{TARGET}, cand AS (SELECT date, cloud, n, CAST(date - target AS INTEGER) AS days_from_target FROM days, target WHERE abs(date - target) <= 10)"


@query(f"WITH {SCENES_SQL} SELECT date, round(cloud, 6) AS cloud, n FROM days")
def aoi_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.scene_days(spark, sf_dir).select("date", F.round("cloud", 6).alias("cloud"), "n")


@query("SELECT date, event_id AS id, event_type FROM (SELECT CAST(ts AS DATE) AS date, event_id, event_type, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def first_granule_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.table(spark, sf_dir, "events").select("ts", F.col("event_id").alias("id"), "event_type")
    return scenes.first_per_day(rows).select("date", "id", "event_type")


@query(f"WITH {TARGET} SELECT target FROM target")
def lower_median_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.lower_median(src.scene_days(spark, sf_dir))


@query(f"WITH {CAND} SELECT date, round(cloud, 6) AS cloud, n, days_from_target FROM cand")
def scene_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = src.scene_days(spark, sf_dir)
    return scenes.candidates(days, scenes.lower_median(days), 10).select("date", F.round("cloud", 6).alias("cloud"), "n", "days_from_target")


@query(f"WITH {CAND} SELECT date, round(cloud, 6) AS cloud, days_from_target, cloud > 20 AS over_limit FROM cand ORDER BY cloud > 20, CASE WHEN cloud <= 20 THEN abs(days_from_target) ELSE 0 END, cloud, abs(days_from_target), date LIMIT 1")
def scene_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = src.scene_days(spark, sf_dir)
    return scenes.pick_scene(days, days, 10, 20.0).select("date", F.round("cloud", 6).alias("cloud"), "days_from_target", "over_limit")


@query("""SELECT page_id, CASE WHEN regexp_matches(p, 'batch_\\d+') THEN regexp_extract(p, 'batch_\\d+') ELSE regexp_replace(regexp_extract(p, '([^/]*)$', 1), '\\.[^.]*$', '') END AS mission
 FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url || '/batch_' || page_id || '/ortho.tif' ELSE url || '/flight' || page_id || '.tif' END AS p FROM pages)""")
def mission_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("page_id").cast("string")
    path = F.when(F.col("page_id") % 3 == 0, F.concat("url", F.lit("/batch_"), n, F.lit("/ortho.tif"))).otherwise(F.concat("url", F.lit("/flight"), n, F.lit(".tif")))
    return src.table(spark, sf_dir, "pages").select("page_id", pixel.mission_name(path).alias("mission"))


@query("""SELECT o_orderkey, coalesce(try_strptime(CASE WHEN o_orderkey % 3 = 0 THEN 'unknown' END, '%Y-%m-%d'), try_strptime(translate(substr(t, 1, 10), ':', '-'), '%Y-%m-%d'))::DATE AS acquired
 FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y:%m:%d') || ' 10:00:00' END AS t FROM orders)""")
def tag_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.when(F.col("o_orderkey") % 3 == 0, F.lit("unknown"))
    second = F.when(F.col("o_orderkey") % 5 == 0, F.lit("n/a")).otherwise(F.concat(F.date_format("o_orderdate", "yyyy:MM:dd"), F.lit(" 10:00:00")))
    return src.table(spark, sf_dir, "orders").select("o_orderkey", pixel.first_date(first, second).alias("acquired"))


@query("SELECT p_partkey, replace(regexp_replace(printf('%.4f', round(p_retailprice / 100000, 6) * 100), '\\.?0+$', ''), '.', 'p') || 'cm' AS slug FROM part")
def gsd_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.table(spark, sf_dir, "part").select("p_partkey", pixel.gsd_slug(F.round(F.col("p_retailprice") / 100000, 6)).alias("slug"))


@query("SELECT round(median(p_retailprice / 10000), 3) AS gsd FROM part")
def auto_gsd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.table(spark, sf_dir, "part").agg(F.round(F.median(F.col("p_retailprice") / 10000), 3).alias("gsd"))


HEADERS = "head AS (SELECT l_suppkey AS src, min(l_partkey) - 0.25 AS minx, max(l_partkey) + 0.25 AS maxx, min(l_quantity) AS miny, max(l_quantity) + 3.5 AS maxy FROM lineitem GROUP BY 1)"


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("src")).agg(
        (F.min("l_partkey") - 0.25).alias("minx"), (F.max("l_partkey") + 0.25).alias("maxx"), F.min("l_quantity").cast("double").alias("miny"), (F.max("l_quantity") + 3.5).cast("double").alias("maxy"))


@query(f"WITH {HEADERS} SELECT {sql_typed('', 'minx miny maxx maxy')} FROM (SELECT min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM head)")
def union_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(_headers(spark, sf_dir).agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy")), "", "minx miny maxx maxy")


@query(f"""WITH {HEADERS}, b AS (SELECT floor(min(minx) / 0.5) * 0.5 AS x0, ceil(max(maxy) / 0.5) * 0.5 AS y0, max(maxx) AS x1, min(miny) AS y1 FROM head)
 SELECT {sql_typed('height width', 'x0 y0')} FROM (SELECT x0 - 3 * 0.5 AS x0, y0 + 3 * 0.5 AS y0, ceil((y0 - y1) / 0.5) + 6 AS height, ceil((x1 - x0) / 0.5) + 6 AS width FROM b)""")
def union_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..grid import Grid

    b = union_bounds(spark, sf_dir).first()
    g = Grid.union(b["minx"], b["miny"], b["maxx"], b["maxy"], 0.5).grown(3)
    return spark.createDataFrame([(g.height, g.width, g.x0, g.y0)], "height long, width long, x0 double, y0 double")


@query(f"WITH {HEADERS} SELECT a.src, count(*) AS n FROM head a JOIN head b ON a.minx < b.maxx AND b.minx < a.maxx AND a.miny < b.maxy AND b.miny < a.maxy GROUP BY a.src")
def covers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of each box with all boxes. The SQL looks only inside hundreds of src: it tells less from 100 sources on."""
    return scenes.count_overlaps(_headers(spark, sf_dir), "src")


@query("""WITH RECURSIVE t AS (SELECT CAST(l_orderkey * 7 % 64 AS BIGINT) AS x, CAST(l_partkey * 3 % 64 AS BIGINT) AS y FROM lineitem GROUP BY 1, 2),
 h(x0, y0, x, y, level, d) AS (SELECT x, y, x, y, 5, CAST(1365 AS BIGINT) FROM t UNION ALL
  SELECT x0, y0, CASE WHEN ry = 0 THEN gy ELSE fx END, CASE WHEN ry = 0 THEN gx ELSE fy END, level - 1, d + (1 << (2 * level)) * xor(3 * rx, ry)
  FROM (SELECT *, CASE WHEN rx = 1 THEN (1 << level) - 1 - fx ELSE fx END AS gx, CASE WHEN rx = 1 THEN (1 << level) - 1 - fy ELSE fy END AS gy
   FROM (SELECT *, (x >> level) & 1 AS rx, (y >> level) & 1 AS ry, x & ((1 << level) - 1) AS fx, y & ((1 << level) - 1) AS fy FROM h WHERE level >= 0)))
 SELECT x0 AS x, y0 AS y, d AS tile_id FROM h WHERE level = -1""")
def hilbert_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 7 % 64).alias("x"), (F.col("l_partkey") * 3 % 64).alias("y")).distinct()
    return rows.select("x", "y", pixel.hilbert_tile_id(6, "x", "y").alias("tile_id"))


@query(f"WITH {PX_SQL} SELECT z, r // (8 << (4 - z)) AS ty, c // (8 << (4 - z)) AS tx, count(*) AS n, round(avg(dn), 6) AS dn FROM px, (SELECT unnest([2, 3, 4]) AS z) GROUP BY 1, 2, 3".replace("SELECT z,", "SELECT CAST(z AS INTEGER) AS z,"))
def tile_pyramid(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = src.px(spark, sf_dir)
    sums = p.groupBy(F.floor(F.col("r") / 8).alias("ty"), F.floor(F.col("c") / 8).alias("tx")).agg(F.count("*").alias("n"), F.sum("dn").alias("s"))
    levels = sums.select(F.lit(4).alias("z"), "ty", "tx", "n", "s")
    for z in (3, 2):  # each level from the finest one's sums: no pixel is read twice
        up = sums.groupBy(F.shiftright("ty", 4 - z).alias("ty"), F.shiftright("tx", 4 - z).alias("tx")).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        levels = levels.unionByName(up.select(F.lit(z).alias("z"), "ty", "tx", "n", "s"))
    return levels.select("z", "ty", "tx", "n", F.round(F.col("s") / F.col("n"), 6).alias("dn"))


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def todo_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = src.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return scenes.still_to_do(src.table(spark, sf_dir, "orders"), done, "o_orderkey").select("o_orderkey")


@query("""WITH RECURSIVE e AS (SELECT user_id AS key, event_type AS worker, epoch(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY epoch(ts), event_type) AS k FROM events),
 f(key, k, held) AS (SELECT key, k, t FROM e WHERE k = 1 UNION ALL SELECT e.key, e.k, CASE WHEN e.t - f.held >= 86400 THEN e.t ELSE f.held END FROM f JOIN e ON e.key = f.key AND e.k = f.k + 1)
 SELECT e.key, e.worker, CAST(e.t AS DOUBLE) AS t, f.held = e.t AND (e.k = 1 OR e.t - lag(f.held) OVER (PARTITION BY e.key ORDER BY e.k) >= 86400) AS granted FROM e JOIN f USING (key, k)""")
def lease_takeover(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = src.table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_type").alias("worker"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return scenes.lease_audit(claims.select("key", "worker", (F.col("us") / 1e6).alias("t")), 86400.0).select("key", "worker", "t", "granted")


@query("""SELECT event_id, CAST(json_extract_string(props, '$.page') AS VARCHAR) AS page, CAST(json_array_length(json_keys(props)) AS INTEGER) AS n_keys FROM events""")
def tag_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = F.json_object_keys("props")
    return src.table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.page").alias("page"), F.size(keys).alias("n_keys"))


@query("""SELECT kind, name FROM (
 SELECT 'difference' AS kind, n_name AS name FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000) UNION ALL
 SELECT 'intersection', n_name FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000) AND n_nationkey IN (SELECT s_nationkey FROM supplier) UNION ALL
 SELECT 'union', n_name FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000) OR n_nationkey IN (SELECT s_nationkey FROM supplier))""")
def key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = src.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    rich = src.table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k"))
    sold = src.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    parts = {"difference": nation.select("k").exceptAll(rich.distinct()), "intersection": rich.intersect(sold), "union": rich.union(sold).distinct()}
    out = None
    for kind, keys in parts.items():
        part = nation.join(keys, "k", "left_semi").select(F.lit(kind).alias("kind"), "name")
        out = part if out is None else out.unionByName(part)
    return out


@query("""WITH a AS (SELECT DISTINCT n_name FROM nation JOIN customer ON c_nationkey = n_nationkey), b AS (SELECT DISTINCT n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey)
 SELECT NOT EXISTS (SELECT n_name FROM a EXCEPT SELECT n_name FROM b) AND NOT EXISTS (SELECT n_name FROM b EXCEPT SELECT n_name FROM a) AS same_names, NOT EXISTS (SELECT n_name FROM b EXCEPT SELECT n_name FROM a) AS is_subset""")
def name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = src.table(spark, sf_dir, "nation")
    a = nation.join(src.table(spark, sf_dir, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("n_name")
    b = nation.join(src.table(spark, sf_dir, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi").select("n_name")
    one = a.exceptAll(b).agg((F.count("*") == 0).alias("x")).crossJoin(b.exceptAll(a).agg((F.count("*") == 0).alias("is_subset")))  # two single rows
    return one.select((F.col("x") & F.col("is_subset")).alias("same_names"), "is_subset")


@query()
def sample_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("src"), "l_orderkey", "l_partkey").distinct()
    return scenes.sample_windows(rows, "src", 8, 1234)
