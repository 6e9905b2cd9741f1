"""The stages of a survey file on rasters: align, stitch, calibrate and tiles, each with the report that it leaves.

Missions are GeoTIFF files or rasters stored by an earlier stage, on lattices of one pixel size. A stored raster is a tile
table with its grid and band names beside it, so a stage that is cut short or whose executors are lost starts from files.
"""
from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.pixel import alpha_valid, any_nonzero, gray
from ..grid import Grid
from ..operators import calibrate, cells, kernels, register, seams
from ..sources import bands as band_rules
from ..sources import geotiff, tables, webtiles
from .survey import Survey, write_json

KEY = ["r", "c"]


@dataclass(frozen=True)
class Raster:
    """Pixels (r, c, band_1.., valid) on a grid."""

    pixels: DataFrame
    grid: Grid
    names: tuple[str, ...]

    @property
    def bands(self) -> list[str]:
        return [f"band_{k}" for k in range(1, len(self.names) + 1)]

    def on(self, grid: Grid) -> Raster:
        """The same pixels keyed on another grid: an exact crop on one lattice, else band by band by cubic convolution."""
        if grid.shift_to(self.grid) is not None:
            return Raster(tables.crop(self.pixels, self.grid, grid), grid, self.names)
        from ..operators.resample import read_through

        out = read_through(self.pixels.select(*KEY, F.col("valid").cast("int").alias("valid")), self.grid, grid, "nearest", "valid").withColumn("valid", F.col("valid") > 0)
        for b in self.bands:
            one = read_through(self.pixels.select(*KEY, F.when(F.col("valid"), F.col(b)).otherwise(0).alias(b)), self.grid, grid, "cubic", b)
            out = out.join(one.select(*KEY, F.least(F.lit(255.0), F.greatest(F.lit(0.0), F.rint(b))).alias(b)), KEY)
        return Raster(out, grid, self.names)

    def gray(self) -> DataFrame:
        """(r, c, dn, valid): the mean of the first three bands."""
        return self.pixels.select(*KEY, gray(*map(F.col, self.bands)).alias("dn"), "valid")


def open_raster(spark: SparkSession, path: str, names: list[str] | None = None) -> Raster:
    """A stored raster, or a GeoTIFF by the band rules."""
    if os.path.exists(f"{path}/grid.json"):
        about = json.loads(open(f"{path}/grid.json").read())
        return Raster(spark.read.parquet(f"{path}/tiles").drop("tr", "tc"), Grid(**about["grid"]), tuple(about["names"]))
    geotiff.register(spark)
    header = geotiff.open_layout(path).header
    law = band_rules.resolve_bands(header, names)
    columns = geotiff.column_names(header)
    rows = spark.read.format("gridloom_geotiff").option("path", path).load()
    column = lambda k: F.col(f"`{columns[k - 1]}`")
    spectral = [column(k) for k in law.spectral]
    valid = alpha_valid(column(law.alpha)) if law.alpha else any_nonzero(*spectral)
    pixels = rows.select(*KEY, *[b.alias(f"band_{k}") for k, b in enumerate(spectral, 1)], valid.alias("valid"))
    return Raster(pixels, Grid(header.x0, header.y0, header.res, header.height, header.width), law.names)


def store_raster(raster: Raster, path: str, size: int = 512) -> None:
    tables.write_tiles(raster.pixels, f"{path}/tiles", size)
    write_json(f"{path}/grid.json", {"grid": asdict(raster.grid), "names": list(raster.names)})


def union_of(rasters: list[Raster]) -> Grid:
    """The grid that covers all of them, at the first one's pixel size."""
    edges = [(r.grid.x0, r.grid.y0 - r.grid.height * r.grid.res, r.grid.x0 + r.grid.width * r.grid.res, r.grid.y0) for r in rasters]
    return Grid.union(*(f(e[k] for e in edges) for k, f in enumerate((min, min, max, max))), rasters[0].grid.res)


def _rows(df: DataFrame) -> list[dict]:
    """Rows of a small result (a seam, gate or summary a row) for a report."""
    return [r.asDict() for r in df.collect()]


def align(spark: SparkSession, mission: str, anchor: str, out: str, tiling: dict | None = None, cell: int = 64) -> dict:
    """Register a mission to the anchor, store its bands warped once, and report the agreement."""
    ref, mov = open_raster(spark, anchor), open_raster(spark, mission)
    grid = ref.grid
    mov = mov.on(grid)
    both = ref.gray().select(*KEY, F.col("dn").alias("reference"), F.col("valid").alias("ref_valid")).join(mov.gray().select(*KEY, F.col("dn").alias("moving"), F.col("valid").alias("mov_valid")), KEY, "left")
    pair = tables.cut_lineage(both.select(*KEY, "reference", "ref_valid", F.coalesce("moving", F.lit(0.0)).alias("moving"), F.coalesce("mov_valid", F.lit(False)).alias("mov_valid")))
    settings = {"size": 2048, "halo": 512} | (tiling or {})
    found = register.register(pair, grid.height, grid.width, tables.cut_lineage, cell=cell, **settings)
    warped = found["moved"].select(*KEY, (F.col("alpha") > 0).alias("valid"))
    for b in mov.bands:
        source = mov.pixels.select(*KEY, F.when(F.col("valid"), F.col(b)).otherwise(0).alias("dn")).join(found["shift"], KEY, "right").fillna({"dn": 0})
        warped = warped.join(kernels.cubic_warp(source, settings["size"], settings["halo"]).withColumnRenamed("dn", b), KEY)
    pixels = warped.select(*KEY, *[F.when(F.col("valid"), F.col(b)).otherwise(0).cast("double").alias(b) for b in mov.bands], "valid")
    store_raster(Raster(pixels, grid, mov.names), out)
    return {"kind": "registration", "mission": mission, "summary": _rows(cells.map_summary(found["cells"], grid.res, cell))[0]}


def stitch(spark: SparkSession, missions: list[str], out: str, band_m: float = 1.0, measure: dict | None = None, names: list[str] | None = None) -> dict:
    """Stitch missions to one raster with its ownership beside it; the report has seams, trip wire and interiors."""
    opened = [open_raster(spark, m, names) for m in missions]
    grid = union_of(opened)
    flights = None
    for k, raster in enumerate(x.on(grid) for x in opened):
        one = raster.pixels.select(F.lit(k).alias("src"), *[F.col(x).cast("long").alias(x) for x in KEY], F.rint(gray(*map(F.col, raster.bands))).cast("int").alias("dn"), *raster.bands, "valid")
        flights = one if flights is None else flights.unionByName(one)
    frame = spark.range(grid.height).select(F.col("id").alias("r")).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(grid.width - 1)))).select("r", F.col("c").cast("long").alias("c"))
    every = frame.withColumn("src", F.explode(F.array(*map(F.lit, range(len(opened))))))
    whole = every.join(flights, ["src", *KEY], "left").fillna(0, ["dn", *opened[0].bands]).withColumn("valid", F.coalesce("valid", F.lit(False)))
    whole = tables.cut_lineage(whole)
    band_px = max(band_m / grid.res, 1.0)
    made = seams.merge(whole.select("src", *KEY, "dn", "valid"), band_px, tables.cut_lineage, grid.res, measure=measure or {})
    mosaic = frame
    tiling = {k: v for k, v in (measure or {}).items() if k == "halo"} | ({"size": measure["block"]} if measure and "block" in measure else {})
    for b in opened[0].bands:
        moved = seams.moved_sources(whole.select("src", *KEY, b, "valid"), made["split"], made["banded"], band=b, **tiling)
        mosaic = mosaic.join(seams.composite(moved, made["distances"], made["banded"], band_px, b).select(*KEY, b, "alpha").withColumnRenamed("alpha", f"alpha_{b}"), KEY, "left")
    pixels = mosaic.select(*KEY, *[F.coalesce(b, F.lit(0)).cast("double").alias(b) for b in opened[0].bands], F.coalesce(F.col(f"alpha_{opened[0].bands[0]}") > 0, F.lit(False)).alias("valid"))
    store_raster(Raster(pixels, grid, opened[0].names), out)
    made["ownership"].write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/ownership")
    return {"kind": "stitch", "inputs": missions, "seams": _rows(made["seams"]), "tripwire": _rows(made["tripwire"])[0], "interiors": _rows(made["interiors"])[0]}


def fit_reference(spark: SparkSession, mosaic: str, reference: str, out: str, block_m: float = 500.0) -> dict:
    """Fit the mosaic's bands to a coarser reference by tile, store the model, and report its out-of-fold errors."""
    ours, ref = open_raster(spark, mosaic), open_raster(spark, reference)
    factor = ref.grid.res / ours.grid.res
    if abs(factor - round(factor)) > 1e-6:
        raise ValueError("the reference's pixels are not whole numbers of the mosaic's")
    whole = Grid(ref.grid.x0, ref.grid.y0, ours.grid.res, ref.grid.height * round(factor), ref.grid.width * round(factor))
    drone = ours.on(whole).pixels.withColumn("alpha", F.when(F.col("valid"), 255).otherwise(0))
    ys = [f"ref_{b}" for b in ref.bands]
    target = ref.pixels.where("valid").select(*[F.col(k).cast("long").alias(k) for k in KEY], *[F.col(b).alias(y) for b, y in zip(ref.bands, ys)])
    x, y = ref.grid.world(F.col("r"), F.col("c"))
    pairs = tables.cut_lineage(calibrate.build_pairs(drone, target, round(factor), ours.bands).withColumn("x", x).withColumn("y", y))
    model, clip = calibrate.fit_tiles(pairs, ours.bands, ys, block_m), calibrate.clip_range(pairs, ys)
    calibrate.save_model(model, clip, out, block_m, calibrate.ALPHA, ours.bands, ys)
    oof = calibrate.out_of_fold(pairs, ours.bands, ys, block_m, F.pmod(F.col("r") * 7 + F.col("c"), F.lit(5)))
    return {"kind": "calibration", "r2": _rows(calibrate.pooled_r2(oof)), "mae": _rows(calibrate.summary(calibrate.tile_errors(oof)))}


def tile_archive(spark: SparkSession, mosaic: str, out: str, zoom: int, least: int, bounds: tuple[float, float, float, float], side: int = webtiles.SIDE) -> dict:
    """An archive and a page for a mosaic whose lattice is the web lattice of zoom (its first pixel, tile 0 0's corner)."""
    raster = open_raster(spark, mosaic)
    three = (raster.bands * 3)[:3] if len(raster.bands) < 3 else raster.bands[:3]
    px = raster.pixels.select(*KEY, *[F.col(b).alias(n) for b, n in zip(three, webtiles.BANDS)], F.when(F.col("valid"), 255.0).otherwise(0.0).alias("alpha"))
    told = webtiles.write_archive(webtiles.pyramid(px, zoom, least, tables.cut_lineage, side), out, bounds, {"name": os.path.basename(mosaic)})
    webtiles.write_viewer(f"{os.path.splitext(out)[0]}.html", os.path.basename(mosaic), os.path.basename(out), bounds, zoom)
    return {"kind": "tiles", **told}


def steps(spark: SparkSession, tiling: dict | None = None, measure: dict | None = None) -> dict:
    """Stages by name, for survey.run(); a stage of a kind aligns or stitches that kind's missions."""

    def aligned(kind: str):
        def stage(s: Survey) -> dict:
            missions = s.visible if kind == "visible" else s.multispectral
            anchor = s.anchor if kind == "visible" else f"{s.run_dir}/visible"
            return {m.name: align(spark, m.path, anchor, f"{s.run_dir}/aligned/{kind}/{m.name}", tiling) for m in missions}

        return stage

    def stitched(kind: str):
        def stage(s: Survey) -> dict:
            missions = s.visible if kind == "visible" else s.multispectral
            moved = [f"{s.run_dir}/aligned/{kind}/{m.name}" for m in missions]
            paths = [a if os.path.exists(f"{a}/grid.json") else m.path for a, m in zip(moved, missions)]
            return stitch(spark, paths, f"{s.run_dir}/{kind}", measure=measure)

        return stage

    calibrated = lambda s: fit_reference(spark, f"{s.run_dir}/ms", s.reference, f"{s.run_dir}/model")
    return {f"{what}/{kind}": make(kind) for what, make in (("align", aligned), ("stitch", stitched)) for kind in ("visible", "ms")} | {"calibrate": calibrated}
