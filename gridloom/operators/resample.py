"""Resampling on the lattice: equi-joins on derived keys and RANGE windows, no neighbourhood joins."""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..grid import Grid
from .kernels import CUBIC, rank
from .tiles import map_tiles

KEY = ["r", "c"]
BURT = {-2: 0.05, -1: 0.25, 0: 0.4, 1: 0.25, 2: 0.05}


def _div(name: str, k: int) -> Column:
    return F.floor(F.col(name) / k).cast("long")


def average_down(px: DataFrame, factor: int, bands: list[str], where: str = "valid") -> DataFrame:
    """(r, c, bands, n): area mean of the valid pixels of each coarse cell."""
    return px.where(where).groupBy(_div("r", factor).alias("r"), _div("c", factor).alias("c")).agg(*[F.avg(b).alias(b) for b in bands], F.count("*").alias("n"))


def decimated(px: DataFrame, height: int, width: int, out_height: int, out_width: int, band: str = "dn") -> DataFrame:
    """(r, c, band): mean of the pixels that fall on each pixel of a smaller overview."""
    r, c = F.floor(F.col("r") * out_height / height).cast("long"), F.floor(F.col("c") * out_width / width).cast("long")
    return px.groupBy(r.alias("r"), c.alias("c")).agg(F.avg(band).alias(band))


def upsample_nearest(coarse: DataFrame, factor: int) -> DataFrame:
    """Each coarse pixel repeated factor times in both directions."""
    steps = F.sequence(F.lit(0), F.lit(factor - 1))
    rows = coarse.withColumn("__i", F.explode(steps)).withColumn("__j", F.explode(steps))
    return rows.withColumn("r", F.col("r") * factor + F.col("__i")).withColumn("c", F.col("c") * factor + F.col("__j")).drop("__i", "__j")


def upsample_bilinear(coarse: DataFrame, factor: int, height: int, width: int, band: str = "dn") -> DataFrame:
    """(r, c, band): half-pixel centred bilinear, clamped at the edges; height and width are the coarse grid's.

    Each coarse pixel is sent to the fine pixels it has weight on; their weighted values add up. No join.
    """
    reach = F.sequence(F.lit(-(factor // 2) - 1), F.lit(factor + factor // 2))  # fine pixels within one coarse pixel of its centre

    def part(name: str, size: int, out: str) -> tuple[Column, Column]:
        at = (F.col(out) + 0.5) / factor - 0.5
        at = F.least(F.lit(float(size - 1)), F.greatest(F.lit(0.0), at))
        return at, F.greatest(F.lit(0.0), 1 - F.abs(at - F.col(name)))

    fine = coarse.withColumn("fr", F.explode(reach)).withColumn("fr", F.col("r") * factor + F.col("fr")).where((F.col("fr") >= 0) & (F.col("fr") < height * factor))
    fine = fine.withColumn("wr", part("r", height, "fr")[1]).where("wr > 0")
    fine = fine.withColumn("fc", F.explode(reach)).withColumn("fc", F.col("c") * factor + F.col("fc")).where((F.col("fc") >= 0) & (F.col("fc") < width * factor))
    fine = fine.withColumn("wc", part("c", width, "fc")[1]).where("wc > 0")
    return fine.groupBy(F.col("fr").alias("r"), F.col("fc").alias("c")).agg((F.sum(F.col("wr") * F.col("wc") * F.col(band)) / F.sum(F.col("wr") * F.col("wc"))).alias(band))


def box_mean(px: DataFrame, radius: int, band: str = "dn") -> DataFrame:
    """px with mean: sum of the square window, pixels outside counting as zero, divided by its whole area."""
    down = Window.partitionBy("c").orderBy("r").rangeBetween(-radius, radius)
    along = Window.partitionBy("r").orderBy("c").rangeBetween(-radius, radius)
    return px.withColumn("__s", F.sum(band).over(down)).withColumn("mean", F.sum("__s").over(along) / float((2 * radius + 1) ** 2)).drop("__s")


def _weighted(band: str, along: str, across: str) -> Column:
    w = Window.partitionBy(across).orderBy(along)
    out = F.lit(0.0)
    for k, weight in BURT.items():
        value = F.col(band) if k == 0 else F.lag(band, -k).over(w) if k < 0 else F.lead(band, k).over(w)
        at = F.col(along) if k == 0 else F.lag(along, -k).over(w) if k < 0 else F.lead(along, k).over(w)
        out = out + F.coalesce(F.when(at == F.col(along) + k, value * weight), F.lit(0.0))
    return out


def pyramid_up(px: DataFrame, band: str = "dn") -> DataFrame:
    """(r, c, band) at half size: five-tap smoothing both ways, zeros outside, even rows and columns."""
    rows = px.select(*KEY, F.col(band).cast("double").alias("v"))
    one = rows.withColumn("v", _weighted("v", "r", "c")).where("r % 2 = 0")
    two = one.withColumn("v", _weighted("v", "c", "r")).where("c % 2 = 0")
    return two.select(_div("r", 2).alias("r"), _div("c", 2).alias("c"), F.col("v").alias(band))


def pyramid_down(coarse: DataFrame, height: int, width: int, band: str = "dn", scale: float = 1.0) -> DataFrame:
    """Each pixel repeated 2x2 and cropped to height and width; scale 2 for shifts."""
    return upsample_nearest(coarse, 2).where((F.col("r") < height) & (F.col("c") < width)).withColumn(band, F.col(band) * scale)


def bilinear_warp(px: DataFrame, shifts: DataFrame, height: int, width: int, band: str = "dn") -> DataFrame:
    """(r, c, band): px sampled at (c + u, r + v), coordinates clamped to the edge. shifts: r, c, u, v.

    The four corners are exploded on the shift side and met by one equi-join.
    """
    x = F.least(F.lit(float(width - 1)), F.greatest(F.lit(0.0), F.col("c") + F.col("u")))
    y = F.least(F.lit(float(height - 1)), F.greatest(F.lit(0.0), F.col("r") + F.col("v")))
    at = shifts.select(*KEY, x.alias("x"), y.alias("y")).withColumn("x0", F.floor("x")).withColumn("y0", F.floor("y"))
    fx, fy = F.col("x") - F.col("x0"), F.col("y") - F.col("y0")
    corner = lambda i, j: F.struct(F.least(F.col("y0") + i, F.lit(height - 1)).alias("sr"), F.least(F.col("x0") + j, F.lit(width - 1)).alias("sc"), ((fy if i else 1 - fy) * (fx if j else 1 - fx)).alias("w"))
    four = at.select(*KEY, F.explode(F.array(*[corner(i, j) for i in (0, 1) for j in (0, 1)])).alias("k")).select(*KEY, "k.*")
    src = px.select(F.col("r").cast("long").alias("sr"), F.col("c").cast("long").alias("sc"), F.col(band).alias("value"))
    return four.where("w > 0").join(src, ["sr", "sc"]).groupBy(*KEY).agg(F.sum(F.col("w") * F.col("value")).alias(band))


def rank_transform(px: DataFrame, radius: int, band: str = "dn", size: int = 512) -> DataFrame:
    """(r, c, rank): neighbours in the square window strictly above the centre; pixels outside count as zero.

    Tiles with a halo of radius go to one kernel of shifted comparisons.
    """

    def kernel(a: dict, here: np.ndarray, r0: int, c0: int) -> dict:
        return {"rank": rank(a[band], radius).astype(np.int32)}

    return map_tiles(px, [band], size, radius, kernel, "rank int")


def _tap(kind: str, t: Column) -> Column:
    """Weight of a source pixel t pixels from the sampled point."""
    t = F.abs(t)
    if kind == "bilinear":
        return F.greatest(F.lit(0.0), 1 - t)
    near = (CUBIC + 2) * t * t * t - (CUBIC + 3) * t * t + 1
    far = CUBIC * t * t * t - 5 * CUBIC * t * t + 8 * CUBIC * t - 4 * CUBIC
    return F.when(t <= 1, near).when(t < 2, far).otherwise(0.0)


def read_through(px: DataFrame, own: Grid, onto: Grid, kind: str = "cubic", band: str = "dn") -> DataFrame:
    """(r, c, band) of the pixels of another grid, as doubles: any raster read through a target grid.

    kind: nearest, bilinear or cubic, zeros outside the raster; average, the mean of the pixels whose centres fall in each
    target pixel, for coarser targets. Grids on one lattice are an exact crop whatever the kind. Each source pixel is sent
    to the target pixels that it has weight on, and weighted values add up: no join.
    """
    value = F.col(band).cast("double")
    moved = onto.shift_to(own)
    if moved is not None:
        out = px.select((F.col("r") + moved[0]).cast("long").alias("r"), (F.col("c") + moved[1]).cast("long").alias("c"), value.alias(band))
    else:
        # a source pixel's centre in target pixels, and a target pixel's size in source pixels
        y, x = (own.y0 - onto.y0) / -onto.res, (own.x0 - onto.x0) / onto.res
        scale = onto.res / own.res
        at = lambda name, start: F.lit(start) + (F.col(name) + 0.5) / scale - 0.5
        rows = px.select(at("r", y).alias("y"), at("c", x).alias("x"), value.alias("v"))
        if kind == "average":
            out = rows.groupBy(F.floor(F.col("y") + 0.5).alias("r"), F.floor(F.col("x") + 0.5).alias("c")).agg(F.avg("v").alias(band))
        elif kind in ("nearest", "bilinear", "cubic"):
            reach = {"nearest": 0.5, "bilinear": 1.0, "cubic": 2.0}[kind] / scale  # target pixels around a source pixel's centre
            span = lambda name: F.sequence(F.ceil(F.col(name) - reach), F.floor(F.col(name) + reach))
            sent = rows.withColumn("r", F.explode(span("y"))).withColumn("c", F.explode(span("x")))
            dy, dx = (F.col("r") - F.col("y")) * scale, (F.col("c") - F.col("x")) * scale
            if kind == "nearest":  # of two as near, the later row and column, as rounding up takes it
                inside = (dy >= -0.5) & (dy < 0.5) & (dx >= -0.5) & (dx < 0.5)
                out = sent.where(inside).select("r", "c", F.col("v").alias(band))
            else:
                out = sent.groupBy("r", "c").agg(F.sum(F.col("v") * _tap(kind, dy) * _tap(kind, dx)).alias(band))
        else:
            raise ValueError(f"no kind {kind!r}")
    return out.where(F.col("r").between(0, onto.height - 1) & F.col("c").between(0, onto.width - 1))
