"""Tiles as binary rows: the shape in which pixels reach NumPy kernels, with a halo copied from the neighbours.

A raster row's pixels of one tile are packed into a struct of two arrays by an aggregation, so a tile reaches Python as a
few hundred arrays, not as a dictionary a pixel.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tile_rows(px: DataFrame, bands: list[str], size: int, halo: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, tr, tc, rows): one row a tile that holds pixels; rows are (r, pixels), pixels (c, bands), halo included."""
    reach = lambda x: F.sequence(F.floor((F.col(x) - halo) / size).cast("long"), F.floor((F.col(x) + halo) / size).cast("long"))
    sent = px.withColumn("tr", F.explode(reach("r"))).withColumn("tc", F.explode(reach("c")))
    values = [F.col(b).cast("double").alias(b) for b in bands]
    lines = sent.groupBy(*keys, "tr", "tc", F.col("r").cast("long").alias("r")).agg(F.collect_list(F.struct(F.col("c").cast("long").alias("c"), *values)).alias("pixels"))
    own = F.floor(F.col("r") / size).cast("long") == F.col("tr")
    lines = lines.withColumn("own", own & F.exists("pixels", lambda p: F.floor(p["c"] / size).cast("long") == F.col("tc")))
    tiles = lines.groupBy(*keys, "tr", "tc").agg(F.collect_list(F.struct("r", "pixels")).alias("rows"), F.bool_or("own").alias("own"))  # a tile and its halo: bounded
    return tiles.where("own").drop("own")


def dense(rows: pa.StructScalar | pa.ListScalar, bands: list[str]) -> tuple[dict[str, np.ndarray], np.ndarray, int, int]:
    """Arrays of the bands over the tile's box, zeros where there is no pixel or value, where there is one, and the first r, c."""
    lines = rows.values
    pixels = lines.field("pixels")
    counts = np.diff(pixels.offsets.to_numpy())
    flat = pixels.flatten()
    r, c = np.repeat(lines.field("r").to_numpy(), counts), flat.field("c").to_numpy()
    r0, c0 = int(r.min()), int(c.min())
    shape = int(r.max()) - r0 + 1, int(c.max()) - c0 + 1
    here, out = np.zeros(shape, bool), {}
    here[r - r0, c - c0] = True
    for b in bands:
        out[b] = np.zeros(shape)
        out[b][r - r0, c - c0] = flat.field(b).fill_null(0).to_numpy()
    return out, here, r0, c0


def map_tiles(px: DataFrame, bands: list[str], size: int, halo: int, kernel: Callable[[dict[str, np.ndarray], np.ndarray, int, int], dict[str, np.ndarray]], schema: str, keys: tuple[str, ...] = (), only: DataFrame | None = None) -> DataFrame:
    """(keys, r, c, schema) of each pixel in px: kernel gets a tile with its halo and gives arrays of that shape; the halo is cut off.

    keys, if given, are columns by which rasters are told apart; only, if given, lists the tiles (keys, tr, tc) to make.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (tr, tc, rows) in enumerate(zip(batch.column("tr").to_pylist(), batch.column("tc").to_pylist(), batch.column("rows"))):
                arrays, here, r0, c0 = dense(rows, bands)
                out = kernel(arrays, here, r0, c0)
                at_r, at_c = np.meshgrid(np.arange(here.shape[0]) + r0, np.arange(here.shape[1]) + c0, indexing="ij")
                own = here & (at_r // size == tr) & (at_c // size == tc)
                named = {key: batch.column(key).take(pa.array(np.full(int(own.sum()), k))) for key in keys}
                yield pa.RecordBatch.from_pydict(named | {"r": at_r[own].astype(np.int64), "c": at_c[own].astype(np.int64)} | {k: v[own] for k, v in out.items()})

    tiles = tile_rows(px, bands, size, halo, keys)
    if only is not None:
        tiles = tiles.join(F.broadcast(only), [*keys, "tr", "tc"], "left_semi")
    types = dict(px.dtypes)
    return tiles.select(*keys, "tr", "tc", "rows").mapInArrow(run, ", ".join([*(f"{k} {types[k]}" for k in keys), "r long", "c long", schema]))
