"""Seams between owners: pairs, boxes, offset split, composite, statistics and gates."""
from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels
from .geometry import KEY, band_taper, coverage, distance, faultline, neighbours, ownership_raster, owners, recycle


def seam_pairs(fault: DataFrame) -> DataFrame:
    """(a, b, n): pairs of owners, a < b, that meet along 4-neighbours with two sources or more, and how often."""
    key = fault.withColumn("key", F.when(F.col("n") >= 2, F.col("owner")))
    right, down = neighbours(key, "key")[1::2]
    meets = key.select("key", F.array(right, down).alias("others")).select("key", F.explode("others").alias("other")).where("key >= 0 AND other >= 0 AND key <> other")
    return meets.groupBy(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).agg(F.count("*").alias("n"))


def fault_pixels(fault: DataFrame) -> DataFrame:
    """(r, c, a, b): fault pixels of each pair of owners they part."""
    key = fault.withColumn("key", F.when(F.col("n") >= 2, F.col("owner")))
    around = key.select(*KEY, "key", F.array(*neighbours(key, "key")).alias("others")).select(*KEY, "key", F.explode(F.array_distinct("others")).alias("other"))
    return around.where("key >= 0 AND other >= 0 AND key <> other").select(*KEY, F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b"))


def seam_boxes(pixels: DataFrame, block: int, reach: int, halo: int) -> DataFrame:
    """(br, bc, a, b, r0, r1, c0, c1): per block and pair, the box of its fault pixels grown by reach, within block and halo.

    Fault pixels within the halo of a block belong to it too, so each is sent to the blocks it can reach.
    """
    def blocks(name: str) -> Column:
        return F.sequence(F.floor((F.col(name) - halo) / block).cast("long"), F.floor((F.col(name) + halo) / block).cast("long"))

    sent = pixels.withColumn("br", F.explode(blocks("r"))).withColumn("bc", F.explode(blocks("c"))).where("br >= 0 AND bc >= 0")
    box = sent.groupBy("br", "bc", "a", "b").agg(F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1"))
    low = lambda x, k: F.greatest(F.col(x) - reach, F.col(k) * block - halo, F.lit(0))
    high = lambda x, k: F.least(F.col(x) + reach, (F.col(k) + 1) * block + halo - 1)
    return box.select("br", "bc", "a", "b", low("r0", "br").alias("r0"), high("r1", "br").alias("r1"), low("c0", "bc").alias("c0"), high("c1", "bc").alias("c1"))


def split_coefficients(have: list[int], measured: list[tuple[int, int]], anchor: int | None = None) -> list[tuple[int, int, int, float]]:
    """(flight, a, b, coefficient): each flight's shift as a sum over measured offsets, of least norm among least squares."""
    a = np.zeros((len(measured), len(have)))
    for k, (i, j) in enumerate(measured):
        a[k, have.index(i)], a[k, have.index(j)] = -1.0, 1.0
    if anchor in have:
        a[:, have.index(anchor)] = 0.0
    solved = np.linalg.pinv(a) if measured else np.zeros((len(have), 0))
    return [(f, i, j, float(solved[n, k])) for n, f in enumerate(have) for k, (i, j) in enumerate(measured) if abs(solved[n, k]) > 1e-12]


def _solve_patterns(anchor: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"flights": [], "measured": [], "coefs": []}
            for flights, measured in zip(batch.column("flights").to_pylist(), batch.column("measured").to_pylist()):
                solved = split_coefficients(flights, [(m["a"], m["b"]) for m in measured], anchor)
                for k, v in zip(out, (flights, measured, [dict(zip(("flight", "a", "b", "coef"), x)) for x in solved])):
                    out[k].append(v)
            pair = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            coef = pa.list_(pa.struct([("flight", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("coef", pa.float64())]))
            yield pa.RecordBatch.from_pydict({"flights": pa.array(out["flights"], pa.list_(pa.int32())), "measured": pa.array(out["measured"], pair), "coefs": pa.array(out["coefs"], coef)})

    return run


def split_offsets(present: DataFrame, offsets: DataFrame, anchor: int | None = None) -> DataFrame:
    """(r, c, flight, u, v): the shift of each flight at each pixel that parts its measured pair offsets.

    present: r, c, flights (sorted array). offsets: r, c, a, b, eu, ev, a < b. Pixels share patterns of flights and measured
    pairs: each distinct pattern is solved once, on the executors, and pixels meet its coefficients by a join.
    """
    pair = F.struct(F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"), "eu", "ev")
    every = offsets.groupBy(*KEY).agg(F.array_sort(F.collect_list(pair)).alias("pairs"))
    rows = present.select(*KEY, F.col("flights").cast("array<int>").alias("flights")).join(every, KEY)
    rows = rows.withColumn("measured", F.transform("pairs", lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b"))))
    solved = rows.select("flights", "measured").distinct().mapInArrow(_solve_patterns(anchor), "flights array<int>, measured array<struct<a:int,b:int>>, coefs array<struct<flight:int,a:int,b:int,coef:double>>")
    both = rows.join(solved, ["flights", "measured"])
    offset = lambda k, name: F.filter("pairs", lambda p: (p["a"] == k["a"]) & (p["b"] == k["b"]))[0][name]
    moved = lambda f, name: F.aggregate(F.filter("coefs", lambda k: k["flight"] == f), F.lit(0.0), lambda t, k: t + k["coef"] * offset(k, name)) + 0.0
    one = F.transform("flights", lambda f: F.struct(f.alias("flight"), moved(f, "eu").alias("u"), moved(f, "ev").alias("v")))
    return both.select(*KEY, F.inline(one))


def split_misfit(offsets: DataFrame, split: DataFrame) -> DataFrame:
    """offsets with misfit: pixels between a pair's measured offset and that of its split shifts."""
    side = lambda k: split.select(*KEY, F.col("flight").alias(k), F.col("u").alias("u" + k), F.col("v").alias("v" + k))
    both = offsets.join(side("a"), [*KEY, "a"]).join(side("b"), [*KEY, "b"])
    return both.select(*KEY, "a", "b", "eu", "ev", F.hypot(F.col("ub") - F.col("ua") - F.col("eu"), F.col("vb") - F.col("va") - F.col("ev")).alias("misfit"))


def composite(flights: DataFrame, dist: DataFrame, banded: DataFrame, band_px: float, band: str = "dn") -> DataFrame:
    """(r, c, band, alpha): outside the band the owner's value, inside the mean weighted by nearness to the farthest source.

    Weight: 1 - (greatest distance - own distance) / band_px, clipped to 0..1. Values are rounded half to even; alpha is
    255 where any source is valid; a band pixel without weight is 0 with its alpha. One join on (src, r, c), one on (r, c).
    """
    width = max(float(band_px), 1.0)
    rows = flights.where("valid").join(dist, ["src", *KEY]).join(banded.select(*KEY, "owner", "best", "in_band"), KEY)
    weight = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - (F.col("best") - F.col("dist")) / width))
    out = rows.groupBy(*KEY).agg(
        F.first("in_band").alias("in_band"), F.max(F.when(F.col("src") == F.col("owner"), F.col(band))).alias("own"),
        F.sum(weight * F.col(band)).alias("wv"), F.sum(weight).alias("w"),
    )
    blended = F.when(F.col("w") > 0, F.least(F.lit(255.0), F.greatest(F.lit(0.0), F.rint(F.col("wv") / F.col("w"))))).otherwise(0.0)
    return out.select(*KEY, F.when(F.col("in_band"), blended.cast("int")).otherwise(F.coalesce(F.col("own"), F.lit(0)).cast("int")).alias(band), F.lit(255).alias("alpha"))


def measure_pairs(flights: DataFrame, banded: DataFrame, cut: Callable[[DataFrame], DataFrame], block: int = 512, reach: int = 512, halo: int = 64, band: str = "dn", flow_fn: Callable = kernels.flow, **settings) -> DataFrame:
    """(r, c, a, b, eu, ev): the flow between the two flights of each seam, at band pixels where both are valid.

    Each pair is measured only in the blocks that its fault line reaches, block by block with a halo; both flights of a
    block are stretched alike first. flight b at (c + eu, r + ev) shows what flight a shows at (c, r).
    """
    boxes = cut(seam_boxes(fault_pixels(banded), block, reach, halo))
    pairs = boxes.select(F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"), F.col("br").cast("long").alias("tr"), F.col("bc").cast("long").alias("tc"))
    few = F.broadcast(pairs.select("a", "b").distinct())
    rows = flights.where("valid").select(F.col("src").cast("int").alias("src"), *KEY, F.col(band).cast("double").alias("v"))
    one = rows.join(few, F.col("src") == F.col("a")).select("a", "b", *KEY, F.col("v").alias("reference"))
    both = one.join(rows.select(F.col("src").alias("b"), *KEY, F.col("v").alias("moving")), ["b", *KEY])
    found = kernels.dense_flow(both, block, halo, flow_fn, True, ("a", "b"), pairs, **settings)
    inside = banded.where("in_band").select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"))
    return found.join(inside, KEY, "left_semi").select(*KEY, "a", "b", F.col("u").alias("eu"), F.col("v").alias("ev"))


def moved_sources(flights: DataFrame, split: DataFrame, banded: DataFrame, size: int = 512, halo: int = 64, band: str = "dn") -> DataFrame:
    """flights (src, r, c, band, valid) with band sampled anew inside the seam band: once, by cubic convolution, at the flight's
    shift times the taper, so that pixels move fully on the fault line and not at all at the band's edge."""
    taper = banded.where("in_band").select(*KEY, "taper")
    field = split.join(taper, KEY).select(F.col("flight").alias("src"), *KEY, (F.col("u") * F.col("taper")).alias("u"), (F.col("v") * F.col("taper")).alias("v"))
    kind = dict(flights.dtypes)
    rows = flights.select(F.col("src").cast("int").alias("src"), *KEY, F.col(band).alias("dn"), "valid")
    near = F.broadcast(_blocks(taper, size, halo)) if size >= 256 else _blocks(taper, size, halo)  # a block list is a 65,536th of its pixels
    block = lambda x: F.floor(F.col(x) / size).cast("long")
    used = rows.withColumn("tr", block("r")).withColumn("tc", block("c")).join(near, ["tr", "tc"], "left_semi").drop("tr", "tc")
    at = used.where("valid").join(field, ["src", *KEY], "left").select("src", *KEY, "dn", F.coalesce("u", F.lit(0.0)).alias("u"), F.coalesce("v", F.lit(0.0)).alias("v"))
    warped = kernels.cubic_warp(at, size, halo, ("src",)).withColumnRenamed("dn", "moved")
    some = field.where("u <> 0 OR v <> 0").select("src", *KEY).withColumn("shifts", F.lit(True))
    out = rows.join(warped, ["src", *KEY], "left").join(some, ["src", *KEY], "left")
    value = F.when(F.col("shifts"), F.coalesce("moved", "dn")).otherwise(F.col("dn"))
    return out.select(F.col("src").cast(kind["src"]).alias("src"), *KEY, value.cast(kind[band]).alias(band), "valid")


def _blocks(pixels: DataFrame, size: int, halo: int) -> DataFrame:
    """(tr, tc): blocks that a pixel or its halo reaches."""
    reach = lambda x: F.sequence(F.floor((F.col(x) - halo) / size).cast("long"), F.floor((F.col(x) + halo) / size).cast("long"))
    return pixels.select(F.explode(reach("r")).alias("tr"), "c").select("tr", F.explode(reach("c")).alias("tc")).distinct()


def seam_statistics(pixels: DataFrame, misfit: DataFrame, res: float, far_cm: float = 50.0) -> DataFrame:
    """(a, b, length_m, med_offset_cm, far_m, residual_cm): length of each seam, its offsets and the misfit of their split."""
    size = F.hypot("eu", "ev") * res * 100
    at = pixels.join(misfit, [*KEY, "a", "b"], "left").withColumn("cm", size)
    length = F.count("*") * F.lit(res)
    return at.groupBy("a", "b").agg(
        length.alias("length_m"), F.median("cm").alias("med_offset_cm"),
        (F.coalesce(F.count_if(F.col("cm") > far_cm) / F.nullif(F.count("cm"), F.lit(0)), F.lit(0.0)) * length).alias("far_m"),
        (F.median("misfit") * res * 100).alias("residual_cm"),
    )


def tripwire(stats: DataFrame, max_cm: float = 20.0) -> DataFrame:
    """One row: passed (every residual at most max_cm; unknown ones pass), worst_cm, n_seams."""
    over = F.count_if(F.col("residual_cm") > max_cm)
    return stats.agg((over == 0).alias("passed"), F.max("residual_cm").alias("worst_cm"), F.count("*").alias("n_seams"))


def interiors_gate(mosaic: DataFrame, flights: DataFrame, banded: DataFrame, band: str = "dn", dust_dn: int = 1, dust_share: float = 0.001) -> DataFrame:
    """One row: n pixels outside the band, how many differ from their owner, most, and verdict identical, dust or fail.

    Every pixel is compared, so nothing rests on sampled windows. No pixel outside the band: fail.
    """
    inside = banded.where("NOT in_band AND owner >= 0").select(*KEY, F.col("owner").alias("src"))
    both = inside.join(flights.where("valid").select("src", *KEY, F.col(band).alias("own")), ["src", *KEY]).join(mosaic.select(*KEY, F.col(band).alias("out")), KEY)
    diff = F.abs(F.col("out") - F.col("own"))
    out = both.agg(F.count("*").alias("n"), F.count_if(diff > 0).alias("changed"), F.coalesce(F.max(diff), F.lit(0)).cast("int").alias("most"))
    verdict = F.when(F.col("n") == 0, "fail").when(F.col("changed") == 0, "identical").when((F.col("most") <= dust_dn) & (F.col("changed") <= dust_share * F.col("n")), "dust").otherwise("fail")
    return out.withColumn("verdict", verdict)


def geometry(flights: DataFrame, band_px: float, cut: Callable[[DataFrame], DataFrame], earlier: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(distances, banded), both cut: per source its distance, and per pixel owner, coverage, fault, band and taper.

    Each step is planned on the written result of the one before, so that no transform runs twice.
    """
    dist = cut(distance(flights.select("src", *KEY, "valid"), ["src"]))
    own = owners(dist)
    if earlier:
        own = recycle(own.select(*KEY, "owner"), earlier[0], earlier[1], flights).select(*KEY, "owner").join(own.select(*KEY, "best"), KEY)
    return dist, cut(band_taper(cut(faultline(own, coverage(flights))), band_px))


def merge(flights: DataFrame, band_px: float, checkpoint: Callable[[DataFrame], DataFrame], res: float = 1.0, offsets: DataFrame | None = None, earlier: tuple[DataFrame, DataFrame] | None = None, geometry_only: bool = False, measure: dict | None = None, anchor: int | None = None) -> dict[str, DataFrame]:
    """The whole stitch: ownership, pair offsets, their split, the mosaic of shifted sources, seam statistics and gates.

    offsets (r, c, a, b, eu, ev) may be given; else they are measured by flow with the settings in measure, or are zero if
    measure is None. checkpoint(df) cuts lineage after each part. A stitch without any fault line has no seam and is refused.
    """
    dist, banded = geometry(flights, band_px, checkpoint, earlier)
    n = flights.select("src").distinct().count()
    if not banded.where("fault").limit(1).count():
        raise RuntimeError("no fault line: the sources do not meet")
    out = {"ownership": ownership_raster(banded, n), "faultline_cells": banded.where("fault").agg(F.count("*").alias("n")), "distances": dist, "banded": banded}
    if geometry_only:
        return out
    pixels = fault_pixels(banded)
    still = offsets is None and measure is None
    if still:
        offsets = pixels.select(*KEY, "a", "b", F.lit(0.0).alias("eu"), F.lit(0.0).alias("ev"))
    elif offsets is None:
        offsets = checkpoint(measure_pairs(flights, banded, checkpoint, **measure))
    present = flights.where("valid").groupBy(*KEY).agg(F.array_sort(F.collect_list(F.col("src").cast("int"))).alias("flights"))
    split = checkpoint(split_offsets(present.join(banded.where("in_band").select(*KEY), KEY, "left_semi"), offsets, anchor))
    tiling = {k: v for k, v in (measure or {}).items() if k == "halo"} | ({"size": measure["block"]} if measure and "block" in measure else {})
    moved = flights if still else checkpoint(moved_sources(flights, split, banded, **tiling))
    mosaic = composite(moved, dist, banded, band_px)
    stats = seam_statistics(pixels, split_misfit(offsets, split), res)
    return out | {"mosaic": mosaic, "offsets": offsets, "split": split, "seams": stats, "tripwire": tripwire(stats), "interiors": interiors_gate(mosaic, flights, banded)}


def all_pairs_of(flights: list[int]) -> list[tuple[int, int]]:
    return [*combinations(sorted(flights), 2)]
