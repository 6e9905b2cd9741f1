"""A Python data source of raster tiles: one input partition a tile, with window filters pushed into the plan of partitions.

Format: a folder with ``grid.json`` (height, width, size, bands) and one ``.npy`` array (bands, rows, columns) a tile, named
``<row>_<column>.npy``. Options: path, and optionally r0, r1, c0, c1. The folder must be one that every executor reads.
"""
from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


def write_tile_folder(path: str, bands: dict[str, np.ndarray], size: int) -> None:
    """Store arrays of equal shape as a tile folder."""
    os.makedirs(path, exist_ok=True)
    height, width = next(iter(bands.values())).shape
    for r in range(0, height, size):
        for c in range(0, width, size):
            np.save(f"{path}/{r // size}_{c // size}.npy", np.stack([b[r : r + size, c : c + size] for b in bands.values()]))
    with open(f"{path}/grid.json", "w") as file:
        json.dump({"height": height, "width": width, "size": size, "bands": list(bands)}, file)


class Tile(InputPartition):
    def __init__(self, row: int, column: int):
        super().__init__((row, column))
        self.row, self.column = row, column


class TileReader(DataSourceReader):
    def __init__(self, options: dict[str, str], names: list[str]):
        self.path, self.names = options["path"], names
        with open(f"{self.path}/grid.json") as file:
            self.grid = json.load(file)
        bound = lambda k, default: int(options.get(k, default))
        self.window = bound("r0", 0), bound("r1", self.grid["height"] - 1), bound("c0", 0), bound("c1", self.grid["width"] - 1)

    def partitions(self) -> list[Tile]:
        r0, r1, c0, c1 = self.window
        size = self.grid["size"]
        return [Tile(r, c) for r in range(r0 // size, r1 // size + 1) for c in range(c0 // size, c1 // size + 1) if os.path.exists(f"{self.path}/{r}_{c}.npy")]

    def read(self, tile: Tile) -> Iterator[pa.RecordBatch]:
        r0, r1, c0, c1 = self.window
        data, size = np.load(f"{self.path}/{tile.row}_{tile.column}.npy"), self.grid["size"]
        rows, cols = np.meshgrid(np.arange(data.shape[1]) + tile.row * size, np.arange(data.shape[2]) + tile.column * size, indexing="ij")
        keep = (rows >= r0) & (rows <= r1) & (cols >= c0) & (cols <= c1)
        columns = [pa.array(rows[keep].astype(np.int64)), pa.array(cols[keep].astype(np.int64)), *(pa.array(b[keep].astype(float)) for b in data)]
        yield pa.RecordBatch.from_arrays(columns, names=self.names)


class TileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gridloom_tiles"

    def schema(self) -> str:
        with open(f"{self.options['path']}/grid.json") as file:
            return "r long, c long, " + ", ".join(f"{b} double" for b in json.load(file)["bands"])

    def reader(self, schema: StructType) -> TileReader:
        return TileReader(dict(self.options), schema.names)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TileSource)
