"""Registration of a raster to a reference: measure the shift of each pixel, trust it where it can be, warp once, score."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import cells, geometry, kernels

KEY = ["r", "c"]
MAX_SHIFT = 256.0


def measure(pair: DataFrame, cut: Callable[[DataFrame], DataFrame], size: int = 2048, halo: int = 512, margin: float = 32.0, flow_fn: Callable = kernels.flow, **settings) -> DataFrame:
    """(r, c, u, v) of pair (r, c, reference, ref_valid, moving, mov_valid): the shift of each pixel.

    Invalid pixels of either image take the nearest valid value first, and tiles are stretched. A shift counts only more than
    margin pixels from where either image is invalid; elsewhere the nearest shift that counts holds, and 0 if none does.
    """
    filled = pair.select(*KEY)
    for band, mask in (("reference", "ref_valid"), ("moving", "mov_valid")):
        one = pair.select(*KEY, F.col(band).cast("double").alias(band), F.col(mask).alias("valid"))
        filled = filled.join(geometry.nearest_fill(one, band).select(*KEY, F.coalesce("filled", F.lit(0.0)).alias(band)), KEY)
    shift = cut(kernels.dense_flow(cut(filled), size, halo, flow_fn, True, **settings))
    both = pair.select(*KEY, (F.col("ref_valid") & F.col("mov_valid")).alias("valid"))
    trusted = shift.join(geometry.trust_region(both, margin).select(*KEY, F.col("trusted").alias("valid")), KEY)
    trusted = cut(trusted.withColumn("uv", F.col("u")))
    out = shift.select(*KEY)
    for axis in ("u", "v"):
        one = geometry.nearest_fill(trusted.select(*KEY, axis, "valid"), axis).select(*KEY, F.coalesce("filled", F.lit(0.0)).alias(axis))
        out = out.join(one, KEY)
    return cut(out)


def kept(shift: DataFrame, moving: DataFrame, height: int, width: int, max_shift: float = MAX_SHIFT) -> DataFrame:
    """(r, c, keep): the shift is at most max_shift, its target lies in the grid, and the pixel there is valid."""
    at = lambda x, d: F.floor(F.col(x) + F.col(d) + 0.5).cast("long")
    target = shift.select(*KEY, "u", "v", at("r", "v").alias("tr"), at("c", "u").alias("tc"))
    there = moving.where("mov_valid").select(F.col("r").cast("long").alias("tr"), F.col("c").cast("long").alias("tc"), F.lit(True).alias("there"))
    inside = F.col("tr").between(0, height - 1) & F.col("tc").between(0, width - 1) & (F.col("u") * F.col("u") + F.col("v") * F.col("v") <= max_shift * max_shift)
    return target.join(there, ["tr", "tc"], "left").select(*KEY, (inside & F.coalesce("there", F.lit(False))).alias("keep"))


def register(pair: DataFrame, height: int, width: int, cut: Callable[[DataFrame], DataFrame], size: int = 2048, halo: int = 512, margin: float = 32.0, cell: int = 64, max_shift: float = MAX_SHIFT, flow_fn: Callable = kernels.flow, **settings) -> dict[str, DataFrame]:
    """moved (r, c, dn, alpha), shift, and cells with agreement before and after.

    pair: r, c, reference, ref_valid, moving, mov_valid on one lattice. Pixels that are not kept are 0 with alpha 0.
    """
    shift = measure(pair, cut, size, halo, margin, flow_fn, **settings)
    ask = pair.select(*KEY, F.when(F.col("mov_valid"), F.col("moving")).otherwise(0).alias("dn")).join(shift, KEY)
    keep = kept(shift, pair, height, width, max_shift)
    warped = kernels.cubic_warp(ask, size, halo).join(keep, KEY)
    moved = cut(warped.select(*KEY, F.when(F.col("keep"), F.col("dn")).otherwise(0).alias("dn"), F.when(F.col("keep"), 255).otherwise(0).alias("alpha")))
    after = moved.select(*KEY, F.when(F.col("alpha") > 0, F.col("dn")).alias("after"))
    before = pair.select(*KEY, F.when(F.col("ref_valid"), F.col("reference")).alias("reference"), F.when(F.col("mov_valid"), F.col("moving")).alias("before"))
    scored = cells.quality_cells(before.join(after, KEY).join(shift, KEY), cell)
    return {"moved": moved, "shift": shift, "cells": scored}


def register_by_chips(*args: object, engine: str = "dense", **kwargs: object) -> dict[str, DataFrame]:
    """The older signature: only the dense engine is left."""
    if engine != "dense":
        raise NotImplementedError(f"engine {engine!r} is gone; use dense")
    return register(*args, **kwargs)
