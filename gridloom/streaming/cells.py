"""An extension beyond batch: cell sums kept up to date over a stream of pixels, and late claims dropped by watermark."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cells import cell_of, six_sums


def running_cells(stream: DataFrame, cell: int) -> DataFrame:
    """Six sums by cell of a stream of (r, c, x, y); write in update or complete mode. A static table gives the batch result."""
    return stream.groupBy(cell_of(F.col("r"), cell).alias("crow"), cell_of(F.col("c"), cell).alias("ccol")).agg(*six_sums(F.col("x"), F.col("y")))


def windowed_cells(stream: DataFrame, cell: int, at: str, window: str, late: str) -> DataFrame:
    """The same by event-time window; rows later than ``late`` behind the newest are dropped."""
    keys = [F.window(at, window).alias("window"), cell_of(F.col("r"), cell).alias("crow"), cell_of(F.col("c"), cell).alias("ccol")]
    return stream.withWatermark(at, late).groupBy(*keys).agg(*six_sums(F.col("x"), F.col("y")))
