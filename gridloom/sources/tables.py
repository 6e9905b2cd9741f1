"""Tables in the shared folder: cutting lineage, and rasters stored as pixel tables partitioned by tile."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..grid import Grid


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one is set only where that is unset, in local mode alone."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="gridloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """df, written to the shared folder as Parquet now: later steps and lost executors start from the files, columns pruned."""
    path = f"{shared_dir(df.sparkSession)}/gridloom-{df.sparkSession.sparkContext.applicationId}/raster-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_tiles(pixels: DataFrame, path: str, size: int) -> None:
    """Pixels as Parquet, one folder a tile column and row, sorted within: readers prune by tr, tc, then by r, c statistics."""
    tiled = pixels.withColumn("tr", F.floor(F.col("r") / size).cast("int")).withColumn("tc", F.floor(F.col("c") / size).cast("int"))
    tiled.repartition("tr", "tc").sortWithinPartitions("r", "c").write.option("compression", "zstd").partitionBy("tr", "tc").parquet(path)


def read_window(spark: SparkSession, path: str, size: int, r0: int, r1: int, c0: int, c1: int) -> DataFrame:
    """Pixels of rows r0..r1 and columns c0..c1; only the tiles that meet the window are listed."""
    rows = spark.read.parquet(path)
    return rows.where(F.col("tr").between(r0 // size, r1 // size) & F.col("tc").between(c0 // size, c1 // size) & F.col("r").between(r0, r1) & F.col("c").between(c0, c1)).drop("tr", "tc")


def crop(pixels: DataFrame, own: Grid, onto: Grid) -> DataFrame:
    """pixels of one grid keyed on another of the same lattice, those outside it left out: a shift of keys, no resampling."""
    moved = onto.shift_to(own)
    if moved is None:
        raise ValueError("the grids are not on one lattice: resample first")
    shifted = pixels.withColumn("r", F.col("r") + moved[0]).withColumn("c", F.col("c") + moved[1])
    return shifted.where(F.col("r").between(0, onto.height - 1) & F.col("c").between(0, onto.width - 1))


def tagged(pixels: DataFrame, names: dict[str, str], alpha: str | None = None) -> DataFrame:
    """pixels with each band's description and colour in its column's metadata: red, green, blue for three bands, else gray first."""
    colours = ["red", "green", "blue"] if len(names) == 3 else ["gray"] + ["undefined"] * (len(names) - 1)
    for (column, name), colour in zip(names.items(), colours):
        pixels = pixels.withMetadata(column, {"description": name, "colour": colour})
    return pixels if alpha is None else pixels.withMetadata(alpha, {"description": "alpha", "colour": "alpha"})


def prewarp(pixels: DataFrame, own: Grid, onto: Grid, path: str, size: int = 4096) -> None:
    """Store a raster on another grid's extent as tiles, so that later windows read only what they meet; tags stay."""
    write_tiles(crop(pixels, own, onto), path, size)
