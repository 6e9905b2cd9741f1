"""Per-tile ridge calibration to a reference: sums by tile, small solves on aggregated rows, blended coefficients."""
from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.pixel import tile_key

ALPHA = 1e-3
MIN_PIXELS = 20


def build_pairs(drone: DataFrame, reference: DataFrame, factor: int, bands: list[str]) -> DataFrame:
    """Reference pixels with the mean of the drone pixels that fall on each. drone: r, c, bands, alpha; reference: r, c, ...."""
    down = drone.where("alpha > 200").groupBy(F.floor(F.col("r") / factor).cast("long").alias("r"), F.floor(F.col("c") / factor).cast("long").alias("c")).agg(*[F.avg(b).alias(b) for b in bands])
    return reference.join(down, ["r", "c"])


def tile_sums(pairs: DataFrame, keys: list[str], xs: list[str], ys: list[str]) -> DataFrame:
    """keys, n and the sums and products from which any ridge fit of ys on xs follows; combinable."""
    d = lambda x: F.col(x).cast("double")
    aggs = [F.count("*").alias("n")] + [F.sum(d(x)).alias(f"s_{x}") for x in [*xs, *ys]]
    aggs += [F.sum(d(a) * d(b)).alias(f"s_{a}_{b}") for a, b in combinations_with_replacement(xs, 2)]
    aggs += [F.sum(d(x) * d(y)).alias(f"s_{x}_{y}") for x in xs for y in ys]
    return pairs.groupBy(*keys).agg(*aggs)


def solve_ridge(n: np.ndarray, sx: np.ndarray, sy: np.ndarray, sxx: np.ndarray, sxy: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients (t, k, b), intercepts (t, b)) of t tiles from their sums; a singular tile has zeros and its mean."""
    a = sxx - sx[:, :, None] * sx[:, None, :] / n[:, None, None]
    cross = sxy - sx[:, :, None] * sy[:, None, :] / n[:, None, None]
    diag = np.einsum("tii->ti", a)
    ridge = alpha * diag + 1e-6 * (diag.max(axis=1, keepdims=True) + 1)
    reg = a + np.einsum("ti,ij->tij", ridge, np.eye(a.shape[1]))
    out = np.zeros_like(cross)
    for t in range(len(n)):
        try:
            out[t] = np.linalg.solve(reg[t], cross[t])
        except np.linalg.LinAlgError:
            pass
    return out, sy / n[:, None] - np.einsum("tk,tkb->tb", sx / n[:, None], out)


def fit_from_sums(sums: DataFrame, keys: list[str], xs: list[str], ys: list[str], alpha: float = ALPHA, min_n: int = MIN_PIXELS) -> DataFrame:
    """keys, band (0-based), coef (array), intercept: one row a tile and band, tiles below min_n left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, m = len(xs), len(ys)
        for batch in batches:
            if not batch.num_rows:
                continue
            col = lambda name: batch.column(name).to_numpy(zero_copy_only=False).astype(float)
            n, sx, sy = col("n"), np.stack([col(f"s_{x}") for x in xs], 1), np.stack([col(f"s_{y}") for y in ys], 1)
            sxx, sxy = np.zeros((len(n), k, k)), np.zeros((len(n), k, m))
            for (i, a), (j, b) in combinations_with_replacement(enumerate(xs), 2):
                sxx[:, i, j] = sxx[:, j, i] = col(f"s_{a}_{b}")
            for i, x in enumerate(xs):
                for j, y in enumerate(ys):
                    sxy[:, i, j] = col(f"s_{x}_{y}")
            coef, icpt = solve_ridge(n, sx, sy, sxx, sxy, alpha)
            rows = np.repeat(np.arange(len(n)), m)
            out = {key: batch.column(key).take(pa.array(rows)) for key in keys}
            yield pa.RecordBatch.from_pydict(out | {
                "band": pa.array(np.tile(np.arange(m, dtype=np.int32), len(n))),
                "coef": pa.array(coef.transpose(0, 2, 1).reshape(-1, k).tolist(), pa.list_(pa.float64())), "intercept": pa.array(icpt.reshape(-1)),
            })

    types = dict(sums.dtypes)
    schema = ", ".join(f"{key} {types[key]}" for key in keys) + ", band int, coef array<double>, intercept double"
    return sums.where(F.col("n") >= min_n).mapInArrow(run, schema)


def with_tiles(pairs: DataFrame, size: float) -> DataFrame:
    """pairs with tile keys gr (northward) and gc of their x and y."""
    return pairs.withColumn("gr", tile_key(F.col("y"), size)).withColumn("gc", tile_key(F.col("x"), size))


def fit_tiles(pairs: DataFrame, xs: list[str], ys: list[str], size: float, alpha: float = ALPHA, min_n: int = MIN_PIXELS) -> DataFrame:
    """(gr, gc, band, coef, intercept) of every tile with enough pairs."""
    return fit_from_sums(tile_sums(with_tiles(pairs, size), ["gr", "gc"], xs, ys), ["gr", "gc"], xs, ys, alpha, min_n)


def clip_range(pairs: DataFrame, ys: list[str]) -> DataFrame:
    """(band, lo, hi): least value, 1 at least, and greatest of each reference band over the scene."""
    one = pairs.agg(*[F.struct(F.greatest(F.lit(1.0), F.min(y).cast("double")).alias("lo"), F.max(y).cast("double").alias("hi")).alias(y) for y in ys])
    return one.select(F.posexplode(F.array(*ys)).alias("band", "v")).select("band", "v.lo", "v.hi")


def predict(coef: Column, intercept: Column, xs: list[Column]) -> Column:
    out = intercept
    for k, x in enumerate(xs):
        out = out + F.get(coef, F.lit(k)) * x.cast("double")
    return out


#: Tiles of a model up to which it is broadcast (a few hundred bytes each); larger models are joined by a shuffle.
BROADCAST_TILES = 200_000


def apply_bilinear(pixels: DataFrame, model: DataFrame, clip: DataFrame, xs: list[str], size: float, alpha: str = "alpha", broadcast_tiles: int = BROADCAST_TILES) -> DataFrame:
    """(id, band, value): coefficients blended between the four nearest tile centres, absent tiles left out.

    0 where alpha is 0 or no tile has weight; else clipped to the band's range and rounded half to even. Each pixel meets
    its four tiles by four left joins and is blended in its own row: pixels don't move while the model is broadcast.
    """
    tiles = model.groupBy("gr", "gc").agg(F.collect_list(F.struct("band", "coef", "intercept")).alias("bands"))  # a row a band
    if tiles.count() <= broadcast_tiles:
        tiles = F.broadcast(tiles)
    gx, gy = F.col("x") / size - 0.5, F.col("y") / size - 0.5
    at = pixels.select("id", *xs, (F.col(alpha) > 0).alias("on"), (gx - F.floor(gx)).alias("fx"), (gy - F.floor(gy)).alias("fy"), F.floor(gx).alias("c0"), F.floor(gy).alias("r0"))
    corners = [(i, j) for i in (0, 1) for j in (0, 1)]
    for k, (i, j) in enumerate(corners):
        near = tiles.select((F.col("gr") - i).alias("r0"), (F.col("gc") - j).alias("c0"), F.col("bands").alias(f"m{k}"))
        at = at.join(near, ["r0", "c0"], "left")
    fx, fy = F.col("fx"), F.col("fy")
    parts = [F.struct((F.col("fy") if i else 1 - fy).alias("wy"), (F.col("fx") if j else 1 - fx).alias("wx"), F.col(f"m{k}").alias("bands")) for k, (i, j) in enumerate(corners)]
    every = at.crossJoin(F.broadcast(clip)).withColumn("parts", F.array(*parts))  # a row for each band, a handful

    def blend(total: Column, part: Column) -> Column:
        own = F.filter(part["bands"], lambda b: b["band"] == F.col("band"))
        tile = F.get(own, F.lit(0))
        w = F.when(tile.isNotNull(), part["wx"] * part["wy"]).otherwise(F.lit(0.0))
        value = F.coalesce(predict(tile["coef"], tile["intercept"], [F.col(x) for x in xs]), F.lit(0.0))
        return F.struct((total["v"] + w * value).alias("v"), (total["w"] + w).alias("w"))

    some = F.aggregate("parts", F.struct(F.lit(0.0).alias("v"), F.lit(0.0).alias("w")), blend)
    out = every.withColumn("sum", some)
    clipped = F.rint(F.least("hi", F.greatest("lo", F.col("sum.v") / F.col("sum.w")))).cast("int")
    return out.select("id", "band", F.when(F.col("on") & (F.col("sum.w") > 0), clipped).otherwise(0).alias("value"))


def save_model(model: DataFrame, clip: DataFrame, path: str, size: float, alpha: float, xs: list[str], ys: list[str]) -> None:
    """Tiles and band ranges as Parquet, settings as one JSON row beside them."""
    model.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/tiles")
    clip.coalesce(1).write.mode("overwrite").parquet(f"{path}/clip")
    settings = json.dumps({"block_m": size, "alpha": alpha, "inputs": xs, "bands": ys})
    model.sparkSession.createDataFrame([(settings,)], "settings string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")


def load_model(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, dict]:
    """(tiles, band ranges, settings) as saved."""
    return spark.read.parquet(f"{path}/tiles"), spark.read.parquet(f"{path}/clip"), json.loads(spark.read.text(f"{path}/settings").first()[0])


#: Vegetation indices by name, of the bands red, near infrared and red edge, and where each is defined.
INDICES = {"NDVI": ("nir", "red"), "NDRE": ("nir", "edge"), "CIre": ("nir", "edge")}


def index_columns(bands: dict[str, Column]) -> dict[str, Column]:
    """The three indices of a pixel's bands; null where a denominator is too small."""
    def normal(a: Column, b: Column) -> Column:
        return F.when(a + b > 1, (a - b) / (a + b))

    out = {name: normal(bands[a], bands[b]) for name, (a, b) in INDICES.items() if name != "CIre"}
    return out | {"CIre": F.when(bands["edge"] > 1, bands["nir"] / bands["edge"] - 1)}


def _wide(oof: DataFrame, roles: dict[str, int], key: str) -> DataFrame:
    """One row a pair (key) with its bands by role, as they are (t) and as predicted (p)."""
    pick = lambda k, name: F.max(F.when(F.col("band") == k, F.col(name)))
    aggs = [pick(k, name).alias(f"{short}_{role}") for role, k in roles.items() for short, name in (("t", "y_true"), ("p", "y_pred"))]
    return oof.where(F.col("band").isin(*roles.values())).groupBy(key, "gr", "gc").agg(*aggs)


def _indexed(oof: DataFrame, roles: dict[str, int], key: str) -> DataFrame:
    """(gr, gc, name, t, p): each index of each pair where it is defined on both sides."""
    wide = _wide(oof, roles, key)
    true, found = (index_columns({r: F.col(f"{s}_{r}") for r in roles}) for s in "tp")
    rows = F.array(*[F.struct(F.lit(n).alias("name"), true[n].alias("t"), found[n].alias("p")) for n in true])
    return wide.select("gr", "gc", F.inline(rows)).where("t IS NOT NULL AND p IS NOT NULL")


def index_errors(oof: DataFrame, roles: dict[str, int], key: str, min_rows: int = 8) -> DataFrame:
    """(gr, gc, name, n, mae): mean error of each vegetation index by tile, out of fold. roles: red, nir, edge to band numbers."""
    return _indexed(oof, roles, key).groupBy("gr", "gc", "name").agg(F.count("*").alias("n"), F.avg(F.abs(F.col("t") - F.col("p"))).alias("mae")).where(F.col("n") >= min_rows)


def index_r2(oof: DataFrame, roles: dict[str, int], key: str) -> DataFrame:
    """(name, r2): one less squared error over spread of each index, over all pairs."""
    t, n = F.col("t"), F.count("*")
    sums = _indexed(oof, roles, key).groupBy("name").agg(F.sum(F.pow(t - F.col("p"), 2)).alias("sse"), (F.sum(t * t) - F.sum(t) * F.sum(t) / n).alias("sst"))
    return sums.select("name", F.when(F.col("sst") > 0, 1 - F.col("sse") / F.col("sst")).alias("r2"))


def mean_r2(r2: DataFrame) -> DataFrame:
    """(mean_r2): the mean of the bands' values."""
    return r2.agg(F.avg("r2").alias("mean_r2"))


def out_of_fold(pairs: DataFrame, xs: list[str], ys: list[str], size: float, fold: Column, alpha: float = ALPHA, min_n: int = MIN_PIXELS, min_train: int = 5) -> DataFrame:
    """pairs of tiles of min_n or more with fold and, per band, predicted: by the fit of the tile's other folds.

    One aggregation by (tile, fold); the sums of a tile's other folds are its total less the fold's own.
    """
    rows = with_tiles(pairs, size).withColumn("fold", fold.cast("int"))
    own = tile_sums(rows, ["gr", "gc", "fold"], xs, ys)
    names = [c for c in own.columns if c not in ("gr", "gc", "fold")]
    total = own.groupBy("gr", "gc").agg(*[F.sum(c).alias(f"t_{c}") for c in names]).where(F.col("t_n") >= min_n)
    train = own.join(total, ["gr", "gc"]).select("gr", "gc", "fold", *[(F.col(f"t_{c}") - F.col(c)).alias(c) for c in names])
    model = fit_from_sums(train, ["gr", "gc", "fold"], xs, ys, alpha, min_train)
    target = F.get(F.array(*[F.col(y).cast("double") for y in ys]), F.col("band"))
    return rows.join(model, ["gr", "gc", "fold"]).withColumn("y_true", target).withColumn("y_pred", predict(F.col("coef"), F.col("intercept"), [F.col(x) for x in xs]))


def tile_errors(oof: DataFrame, min_rows: int = 10) -> DataFrame:
    """(gr, gc, band, n, mae) of tiles with enough out-of-fold rows."""
    return oof.groupBy("gr", "gc", "band").agg(F.count("*").alias("n"), F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("mae")).where(F.col("n") >= min_rows)


def pooled_r2(oof: DataFrame) -> DataFrame:
    """(band, r2): one less squared error over spread about the band's mean, over all out-of-fold rows; null if no spread."""
    y = F.col("y_true")
    sse, n = F.sum(F.pow(y - F.col("y_pred"), 2)), F.count("*")
    return oof.groupBy("band").agg(sse.alias("sse"), (F.sum(y * y) - F.sum(y) * F.sum(y) / n).alias("sst")).select("band", F.when(F.col("sst") > 0, 1 - F.col("sse") / F.col("sst")).alias("r2"))


def summary(errors: DataFrame, value: str = "mae") -> DataFrame:
    """(band, median, p90) of a tile statistic."""
    return errors.groupBy("band").agg(F.percentile(value, 0.5).alias("median"), F.percentile(value, 0.9).alias("p90"))
