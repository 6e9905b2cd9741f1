"""Queries of ownership geometry, seams and gates on three overlapping flights."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cells, geometry, seams
from ..sources import adapters as src
from ..sources.adapters import FLIGHTS_SQL, PX_SQL
from ..sources.tables import cut_lineage
from .cell_queries import RASTER
from .registry import query, typed

BAND = 6.0
FAR = 1e9


def _gap_sql(by: str, keys: str) -> str:
    w = f"OVER (PARTITION BY {keys}c ORDER BY r ROWS BETWEEN"
    return f"least(coalesce(r - max(CASE WHEN NOT {by} THEN r END) {w} UNBOUNDED PRECEDING AND CURRENT ROW), {FAR}), coalesce(min(CASE WHEN NOT {by} THEN r END) {w} CURRENT ROW AND UNBOUNDED FOLLOWING) - r, {FAR}))"


def _dist_sql(name: str, table: str, keys: str, by: str, out: str) -> str:
    """Two common table expressions: column gaps, then the least over the row."""
    on = "a.r = b.r" + "".join(f" AND a.{k} = b.{k}" for k in keys.split(",") if k.strip())
    lead = "".join(f"a.{k}, " for k in keys.split(",") if k.strip())
    return f"""{name}_g AS MATERIALIZED (SELECT {keys}r, c, {_gap_sql(by, keys)} AS g FROM {table}),
 {name} AS MATERIALIZED (SELECT {lead}a.r, a.c, least({FAR}, sqrt(min(b.g * b.g + (a.c - b.c) * (a.c - b.c)))) AS {out} FROM {name}_g a JOIN {name}_g b ON {on} GROUP BY ALL)"""


DIST = f"{FLIGHTS_SQL}, {_dist_sql('dist', 'flights', 'src, '.replace(' ', ''), 'valid', 'dist')}"
COVER = "cover AS (SELECT r, c, count(*) FILTER (valid) AS n FROM flights GROUP BY r, c)"
OWNER = f"{DIST}, {COVER}, own AS (SELECT r, c, CASE WHEN max(dist) > 0 THEN arg_max(src, dist * 10 - src * 1e-7) ELSE -1 END AS owner, max(dist) AS best FROM dist GROUP BY r, c)"


def _beside(col: str) -> str:
    parts = []
    for along, across in (("c", "r"), ("r", "c")):
        w = f"OVER (PARTITION BY {across} ORDER BY {along})"
        parts += [f"CASE WHEN lag({along}) {w} = {along} - 1 THEN lag({col}) {w} END", f"CASE WHEN lead({along}) {w} = {along} + 1 THEN lead({col}) {w} END"]
    return ", ".join(f"{p} AS k{i}" for i, p in enumerate(parts))


FAULT = f"""{OWNER}, keyed AS (SELECT own.*, n, CASE WHEN n >= 2 THEN owner END AS key FROM own JOIN cover USING (r, c)),
 near AS (SELECT *, {_beside('key')} FROM keyed),
 fault AS (SELECT r, c, owner, best, n, key, k0, k1, k2, k3, coalesce(k0 <> key, false) OR coalesce(k1 <> key, false) OR coalesce(k2 <> key, false) OR coalesce(k3 <> key, false) AS fault FROM near)"""
BANDED = f"""{FAULT}, offline AS (SELECT r, c, NOT fault AS off FROM fault), {_dist_sql('fd', 'offline', '', 'off', 'd')},
 banded AS (SELECT fault.*, d, d <= {BAND} AND n >= 2 AS in_band, CASE WHEN d <= {BAND} AND n >= 2 THEN greatest(0.0, 1 - d / {BAND}) ELSE 0.0 END AS taper FROM fault JOIN fd USING (r, c))"""
PIXELS = f"""{BANDED}, fpx AS (SELECT DISTINCT r, c, least(key, k) AS a, greatest(key, k) AS b FROM (SELECT r, c, key, unnest([k0, k1, k2, k3]) AS k FROM fault) WHERE key >= 0 AND k >= 0 AND key <> k)"""


def _flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.flights(spark, sf_dir)


def _geometry(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    f = cut_lineage(_flights(spark, sf_dir))
    return f, *seams.geometry(f, BAND, cut_lineage)


@query(f"WITH {FLIGHTS_SQL}, {COVER} SELECT r, c, n FROM cover")
def coverage_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.coverage(_flights(spark, sf_dir))


@query(f"WITH {FLIGHTS_SQL} SELECT r, c, count(*) AS n, string_agg(src || ':' || dn, ',' ORDER BY src) AS stack FROM flights WHERE valid GROUP BY r, c")
def overlap_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = geometry.overlap_stack(_flights(spark, sf_dir))
    return out.select("r", "c", "n", F.array_join(F.transform("stack", lambda s: F.concat_ws(":", s["src"].cast("string"), s["value"].cast("string"))), ",").alias("stack"))


_EDT = f"WITH {RASTER}, {_dist_sql('e', 'ras', '', 'valid', 'd')} SELECT r, c, round(d, 6) AS dist FROM e"


@query(_EDT)
def edt(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = geometry.distance(src.raster(spark, sf_dir).withColumn("one", F.lit(0)), ["one"])
    return typed(out, "r c", "dist")


@query(f"WITH {OWNER} SELECT r, c, CAST(owner AS INTEGER) AS owner, round(best, 6) AS best FROM own")
def owner_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = geometry.owners(geometry.distance(_flights(spark, sf_dir), ["src"]))
    return typed(out, "r c", "best", owner="int")


@query(f"WITH {FAULT} SELECT r, c, CAST(owner AS INTEGER) AS owner, n, fault FROM fault")
def faultline(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _flights(spark, sf_dir)
    own = geometry.owners(geometry.distance(f, ["src"]))
    return geometry.faultline(own, geometry.coverage(f)).select("r", "c", "owner", "n", "fault")


@query(f"WITH {BANDED} SELECT r, c, round(d, 6) AS d, in_band, round(taper, 6) AS taper FROM banded")
def band_taper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(_geometry(spark, sf_dir)[2], "r c", "d taper", in_band="boolean")


@query(f"WITH {BANDED} SELECT r, c, CAST(CASE WHEN in_band THEN 4 ELSE owner + 1 END AS INTEGER) AS cat, CAST(owner + 1 AS INTEGER) AS owner FROM banded")
def ownership_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.ownership_raster(_geometry(spark, sf_dir)[2], 3)


@query(f"""WITH {OWNER}, old AS (SELECT r, c, CAST(CASE WHEN c < 30 THEN 1 WHEN c < 34 THEN 0 ELSE 2 END AS INTEGER) AS o FROM px)
 SELECT own.r, own.c, CAST(CASE WHEN f.valid AND o > 0 THEN o - 1 ELSE owner END AS INTEGER) AS owner, coalesce(f.valid, false) AND o > 0 AS kept
 FROM own JOIN old USING (r, c) LEFT JOIN flights f ON f.r = own.r AND f.c = own.c AND f.src = o - 1""")
def recycle_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _flights(spark, sf_dir)
    own = geometry.owners(geometry.distance(f, ["src"]))
    c = F.col("c")
    earlier = src.px(spark, sf_dir).select("r", "c", F.when(c < 30, 1).when(c < 34, 0).otherwise(2).cast("int").alias("owner"))
    names = spark.createDataFrame([(1, 0), (2, 1)], "owner int, src int")
    return geometry.recycle(own.select("r", "c", "owner"), earlier, names, f)


@query(f"WITH {RASTER}, on_ AS (SELECT r, c FROM px WHERE dn % 41 = 0) SELECT px.r, px.c, EXISTS (SELECT 1 FROM on_ o WHERE o.r BETWEEN px.r - 2 AND px.r + 2 AND abs(o.r - px.r) + abs(o.c - px.c) <= 2) AS \"on\" FROM px")
def dilate_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = src.px(spark, sf_dir).select("r", "c", (F.col("dn") % 41 == 0).alias("on"))
    return geometry.dilate(mask, 2).select("r", "c", "on")


@query(f'WITH {RASTER} SELECT r // 8 AS r, c // 8 AS c, bool_or(dn % 97 = 0) AS "on" FROM px GROUP BY 1, 2')
def any_reduce_8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.any_reduce(src.px(spark, sf_dir).select("r", "c", (F.col("dn") % 97 == 0).alias("valid")), 8)


@query(f"""WITH {PX_SQL}, v AS (SELECT *, dn % 3 <> 0 AS valid FROM px), best AS (SELECT a.r, a.c, arg_min(b.dn, (a.r - b.r) * (a.r - b.r) * 1000000000000 + (a.c - b.c) * (a.c - b.c) * 1000000000000 + b.r * 1000 + b.c) AS near
  FROM (SELECT * FROM v WHERE NOT valid) a JOIN (SELECT v.*, v.r + k AS rr FROM v, (SELECT unnest(range(-8, 9)) AS k) WHERE valid) b ON b.rr = a.r AND b.c BETWEEN a.c - 8 AND a.c + 8 GROUP BY 1, 2)
 SELECT v.r, v.c, dn, CASE WHEN valid THEN dn ELSE near END AS filled FROM v LEFT JOIN best USING (r, c)""")
def nearest_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.px(spark, sf_dir).withColumn("valid", F.col("dn") % 3 != 0)
    return geometry.nearest_fill(rows).select("r", "c", "dn", "filled")


@query(f"WITH {RASTER}, {_dist_sql('e', 'ras', '', 'valid', 'd')} SELECT r, c, d > 2 AS trusted FROM e")
def trust_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.trust_region(src.raster(spark, sf_dir), 2.0).select("r", "c", "trusted")


@query(f"""WITH RECURSIVE {PX_SQL}, dim AS (SELECT max(r) AS mr, max(c) AS mc FROM px), zero AS (SELECT r, c, r = 0 OR c = 0 OR r = mr OR c = mc AS border FROM px, dim WHERE dn % 3 = 0),
 reach AS (SELECT r, c FROM zero WHERE border UNION SELECT z.r, z.c FROM reach p, (SELECT unnest([-1, 0, 1]) AS i), (SELECT unnest([-1, 0, 1]) AS j), zero z WHERE z.r = p.r + i AND z.c = p.c + j)
 SELECT zero.r, zero.c, reach.r IS NOT NULL AS nodata FROM zero LEFT JOIN reach ON reach.r = zero.r AND reach.c = zero.c""")
def validity_border_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = src.px(spark, sf_dir)
    last = src.height(spark, sf_dir) - 1
    border = (F.col("r") == 0) | (F.col("c") == 0) | (F.col("r") == last) | (F.col("c") == 63)
    zero = p.where("dn % 3 = 0").select("r", "c", border.alias("border"))
    return geometry.border_components(zero, cut_lineage, 32).select("r", "c", F.col("border").alias("nodata"))


@query(f"WITH {PIXELS}, meet AS (SELECT key, unnest([k1, k3]) AS k FROM fault) SELECT CAST(least(key, k) AS INTEGER) AS a, CAST(greatest(key, k) AS INTEGER) AS b, count(*) AS n FROM meet WHERE key >= 0 AND k >= 0 AND key <> k GROUP BY 1, 2")
def seam_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(seams.seam_pairs(_geometry(spark, sf_dir)[2]), "n", "", a="int", b="int")


@query(f"""WITH {PIXELS}, sent AS (SELECT f.*, x.br, y.bc FROM fpx f, LATERAL (SELECT unnest(range(CAST(floor((f.r - 4) / 32) AS BIGINT), CAST(floor((f.r + 4) / 32) AS BIGINT) + 1)) AS br) x,
   LATERAL (SELECT unnest(range(CAST(floor((f.c - 4) / 32) AS BIGINT), CAST(floor((f.c + 4) / 32) AS BIGINT) + 1)) AS bc) y WHERE br >= 0 AND bc >= 0)
 SELECT br, bc, CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, greatest(min(r) - 10, br * 32 - 4, 0) AS r0, least(max(r) + 10, (br + 1) * 32 + 3) AS r1, greatest(min(c) - 10, bc * 32 - 4, 0) AS c0, least(max(c) + 10, (bc + 1) * 32 + 3) AS c1 FROM sent GROUP BY br, bc, a, b""")
def seam_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(seams.seam_boxes(seams.fault_pixels(_geometry(spark, sf_dir)[2]), 32, 10, 4), "br bc r0 r1 c0 c1", "", a="int", b="int")


_E = {"eu": "CAST((r * 3 + c + a * 5 + b * 7) % 11 - 5 AS DOUBLE)", "ev": "CAST((r + c * 2 + a * 3 + b) % 7 - 3 AS DOUBLE)"}
OFFS = f"""{BANDED}, pres AS (SELECT r, c, list(src ORDER BY src) AS fl FROM flights JOIN banded USING (r, c) WHERE valid AND in_band GROUP BY r, c),
 offs AS (SELECT r, c, a, b, {_E['eu']} AS eu, {_E['ev']} AS ev FROM pres, (SELECT unnest([0, 0, 1]) AS a, unnest([1, 2, 2]) AS b) WHERE list_contains(fl, a) AND list_contains(fl, b) AND NOT (len(fl) = 3 AND a = 0 AND b = 2 AND (r + c) % 7 = 0)),
 wide AS (SELECT r, c, any_value(fl) AS fl, count(*) AS m, max(eu) FILTER (a = 0 AND b = 1) AS u01, max(eu) FILTER (a = 0 AND b = 2) AS u02, max(eu) FILTER (a = 1 AND b = 2) AS u12,
   max(ev) FILTER (a = 0 AND b = 1) AS v01, max(ev) FILTER (a = 0 AND b = 2) AS v02, max(ev) FILTER (a = 1 AND b = 2) AS v12 FROM pres JOIN offs USING (r, c) GROUP BY r, c)"""


def _free(e: str) -> str:
    return f"""CASE WHEN len(fl) = 2 THEN (CASE WHEN flight = fl[1] THEN -1 ELSE 1 END) * coalesce({e}01, {e}02, {e}12) / 2
  WHEN m = 3 THEN CASE flight WHEN 0 THEN -{e}01 - {e}02 WHEN 1 THEN {e}01 - {e}12 ELSE {e}02 + {e}12 END / 3
  ELSE CASE flight WHEN 0 THEN -2 * {e}01 - {e}12 WHEN 1 THEN {e}01 - {e}12 ELSE {e}01 + 2 * {e}12 END / 3 END"""


def _anchored(e: str) -> str:
    return f"""CASE WHEN flight = 0 THEN 0.0 WHEN len(fl) = 2 AND fl[1] = 0 THEN coalesce({e}01, {e}02) WHEN len(fl) = 2 THEN (CASE WHEN flight = 1 THEN -1 ELSE 1 END) * {e}12 / 2
  WHEN m = 3 THEN CASE flight WHEN 1 THEN 2 * {e}01 + {e}02 - {e}12 ELSE {e}01 + 2 * {e}02 + {e}12 END / 3 ELSE CASE flight WHEN 1 THEN {e}01 ELSE {e}01 + {e}12 END END"""


def _split_sql(rule) -> str:
    return f"split AS (SELECT r, c, CAST(flight AS INTEGER) AS flight, {rule('u')} AS u, {rule('v')} AS v FROM (SELECT *, unnest(fl) AS flight FROM wide))"


def _offsets(f: DataFrame, banded: DataFrame) -> tuple[DataFrame, DataFrame]:
    present = f.where("valid").join(banded.where("in_band").select("r", "c"), ["r", "c"], "left_semi").groupBy("r", "c").agg(F.array_sort(F.collect_list("src")).alias("flights"))
    a, b, r, c = F.col("a"), F.col("b"), F.col("r"), F.col("c")
    rows = present.select("r", "c", "flights", F.inline(F.array(*[F.struct(F.lit(i).alias("a"), F.lit(j).alias("b")) for i, j in seams.all_pairs_of([0, 1, 2])])))
    rows = rows.where(F.array_contains("flights", a) & F.array_contains("flights", b) & ~((F.size("flights") == 3) & (a == 0) & (b == 2) & ((r + c) % 7 == 0)))
    return present, rows.select("r", "c", "a", "b", ((r * 3 + c + a * 5 + b * 7) % 11 - 5).cast("double").alias("eu"), ((r + c * 2 + a * 3 + b) % 7 - 3).cast("double").alias("ev"))


@query(f"WITH {OFFS}, {_split_sql(_free)} SELECT r, c, flight, round(u, 6) + 0.0 AS u, round(v, 6) + 0.0 AS v FROM split")
def seam_split_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, _, banded = _geometry(spark, sf_dir)
    return typed(seams.split_offsets(*_offsets(f, banded)), "r c", "u v", flight="int")


@query(f"WITH {OFFS}, {_split_sql(_anchored)} SELECT r, c, flight, round(u, 6) + 0.0 AS u, round(v, 6) + 0.0 AS v FROM split")
def seam_split_anchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, _, banded = _geometry(spark, sf_dir)
    return typed(seams.split_offsets(*_offsets(f, banded), anchor=0), "r c", "u v", flight="int")


COMPOSITE = f"""{BANDED}, comp AS (SELECT f.r, f.c, CAST(CASE WHEN any_value(in_band) THEN coalesce(round_even(sum(w * dn) / nullif(sum(w), 0), 0), 0) ELSE coalesce(max(dn) FILTER (f.src = owner), 0) END AS INTEGER) AS dn, 255 AS alpha
  FROM (SELECT f.src, f.r, f.c, f.dn, owner, in_band, greatest(0.0, least(1.0, 1 - (best - dist) / {BAND})) AS w FROM flights f JOIN dist USING (src, r, c) JOIN banded b ON b.r = f.r AND b.c = f.c WHERE valid) f GROUP BY f.r, f.c)"""


@query(f"WITH {COMPOSITE} SELECT r, c, dn, CAST(alpha AS INTEGER) AS alpha FROM comp")
def seam_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, dist, banded = _geometry(spark, sf_dir)
    return seams.composite(f, dist, banded, BAND)


STATS = f"""{OFFS}, {_split_sql(_free)}, {PIXELS.rpartition(', fpx AS ')[2].join(['fpx AS ', ''])},
 mis AS (SELECT o.*, sqrt(pow(y.u - x.u - eu, 2) + pow(y.v - x.v - ev, 2)) AS misfit FROM offs o JOIN split x ON x.r = o.r AND x.c = o.c AND x.flight = a JOIN split y ON y.r = o.r AND y.c = o.c AND y.flight = b),
 stat AS (SELECT a, b, CAST(count(*) * 0.5 AS DOUBLE) AS length_m, median(cm) AS med_offset_cm, coalesce(count(*) FILTER (cm > 50) / nullif(count(cm), 0), 0) * count(*) * 0.5 AS far_m, median(misfit) * 50 AS residual_cm
  FROM (SELECT fpx.*, misfit, sqrt(eu * eu + ev * ev) * 50 AS cm FROM fpx LEFT JOIN mis USING (r, c, a, b)) GROUP BY a, b)"""


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, _, banded = _geometry(spark, sf_dir)
    present, offsets = _offsets(f, banded)
    return seams.seam_statistics(seams.fault_pixels(banded), seams.split_misfit(offsets, seams.split_offsets(present, offsets)), 0.5)


@query(f"WITH {STATS} SELECT CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, round(length_m, 6) AS length_m, round(med_offset_cm, 6) AS med_offset_cm, round(far_m, 6) AS far_m, round(residual_cm, 6) AS residual_cm FROM stat")
def seam_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(_stats(spark, sf_dir), "", "length_m med_offset_cm far_m residual_cm", a="int", b="int")


@query(f"WITH {STATS} SELECT count(*) FILTER (residual_cm > 20) = 0 AS passed, round(max(residual_cm), 6) AS worst_cm, count(*) AS n_seams FROM stat")
def seam_tripwire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(seams.tripwire(_stats(spark, sf_dir)), "n_seams", "worst_cm", passed="boolean")


@query(f"""WITH {COMPOSITE}, d AS (SELECT abs(comp.dn - f.dn) AS x FROM banded b JOIN flights f ON f.src = b.owner AND f.r = b.r AND f.c = b.c AND f.valid JOIN comp ON comp.r = b.r AND comp.c = b.c WHERE NOT in_band AND owner >= 0)
 SELECT count(*) AS n, count(*) FILTER (x > 0) AS changed, CAST(coalesce(max(x), 0) AS INTEGER) AS most, CASE WHEN count(*) = 0 THEN 'fail' WHEN count(*) FILTER (x > 0) = 0 THEN 'identical' WHEN max(x) <= 1 AND count(*) FILTER (x > 0) <= 0.001 * count(*) THEN 'dust' ELSE 'fail' END AS verdict FROM d""")
def interiors_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, dist, banded = _geometry(spark, sf_dir)
    return seams.interiors_gate(seams.composite(f, dist, banded, BAND), f, banded)


@query(f"WITH {COMPOSITE} SELECT r, c, dn, CAST(alpha AS INTEGER) AS alpha FROM comp")
def seam_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seams.merge(_flights(spark, sf_dir), BAND, cut_lineage)["mosaic"]


@query(f"WITH {BANDED} SELECT count(*) AS n FROM banded WHERE fault")
def geometry_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seams.merge(_flights(spark, sf_dir), BAND, cut_lineage, geometry_only=True)["faultline_cells"]


@query(f"WITH {BANDED} SELECT kind, count(*) AS n FROM (SELECT r // 16, c // 16, CASE WHEN max(n) = 0 THEN 'skip' WHEN bool_or(in_band) THEN 'seam' WHEN count(DISTINCT owner) = 1 AND min(owner) >= 0 THEN 'copy' ELSE 'own' END AS kind FROM banded GROUP BY 1, 2) GROUP BY kind")
def block_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    banded = _geometry(spark, sf_dir)[2]
    kind = F.when(F.max("n") == 0, "skip").when(F.bool_or("in_band"), "seam").when((F.min("owner") == F.max("owner")) & (F.min("owner") >= 0), "copy").otherwise("own")
    return banded.groupBy(cells.cell_of(F.col("r"), 16), cells.cell_of(F.col("c"), 16)).agg(kind.alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))
