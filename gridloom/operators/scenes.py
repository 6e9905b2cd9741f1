"""Scene candidates, choice of the scene to calibrate to, and the leased work queue as queries."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import pixel


def first_per_day(granules: DataFrame, at: str = "ts", tie: str = "id") -> DataFrame:
    """The earliest granule of each UTC day: one combinable minimum a day."""
    others = [c for c in granules.columns if c not in (at, tie)]
    return granules.groupBy(F.to_date(at).alias("date")).agg(F.min(F.struct(at, tie, *others)).alias("g")).select("date", "g.*")


def cloud_percent(flag: Column) -> Column:
    """Mean of a cloud flag in percent, 0 without pixels."""
    return F.coalesce(F.avg(flag.cast("double")), F.lit(0.0)) * 100


def lower_median(dates: DataFrame, column: str = "date") -> DataFrame:
    """(target): the middle date, the earlier of two."""
    return dates.agg(F.expr(f"date_from_unix_date(cast(percentile_disc(0.5) WITHIN GROUP (ORDER BY unix_date({column})) as int))").alias("target"))


def candidates(days: DataFrame, target: DataFrame, search_days: int) -> DataFrame:
    """days (date, cloud) within search_days of the target, with days_from_target, nearest and clearest first."""
    near = F.datediff("date", "target")
    return days.crossJoin(F.broadcast(target)).withColumn("days_from_target", near).where(F.abs(near) <= search_days).drop("target")


def choose(found: DataFrame, limit_pct: float) -> DataFrame:
    """The scene: nearest to the target, then clearest, of those at most limit_pct cloudy; if none is, the clearest of all."""
    clean = F.col("cloud") <= limit_pct
    order = [(~clean).cast("int"), F.when(clean, F.abs("days_from_target")).otherwise(F.lit(0)), "cloud", F.abs("days_from_target"), "date"]
    return found.withColumn("over_limit", ~clean).orderBy(*order).limit(1)


def pick_scene(missions: DataFrame, days: DataFrame, search_days: int, limit_pct: float) -> DataFrame:
    """From mission dates and days with their cloud: target, window and choice."""
    return choose(candidates(days, lower_median(missions), search_days), limit_pct)


def lease_audit(claims: DataFrame, lease_s: float) -> DataFrame:
    """claims (key, worker, t) with granted: a key's first claim, or one lease_s or more after the last granted.

    A claim extends nothing unless it is granted, so each key's claims are followed in time order: a streamed pass over
    sorted rows that holds one time, however many claims a key has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = object(), 0.0
        for batch in batches:
            granted = []
            for k, t in zip(batch.column("key").to_pylist(), batch.column("t").to_pylist()):
                new = k != key or t - held >= lease_s
                key, held = (k, t) if new else (key, held)
                granted.append(new)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(granted, pa.bool_())], [*batch.schema.names, "granted"])

    rows = claims.select("key", "worker", F.col("t").cast("double").alias("t")).repartition("key").sortWithinPartitions("key", "t", "worker")
    types = dict(claims.dtypes)
    return rows.mapInArrow(run, f"key {types['key']}, worker {types['worker']}, t double, granted boolean")


def still_to_do(boxes: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return boxes.join(done.select(key).distinct(), key, "left_anti")


def sample_windows(windows: DataFrame, group: str, at_most: int, seed: int) -> DataFrame:
    """At most at_most windows of each group, by a seeded hash of their keys."""
    others = [c for c in windows.columns if c != group]
    order = F.xxhash64(F.lit(seed), *others)
    return windows.withColumn("__k", F.row_number().over(Window.partitionBy(group).orderBy(order, *others))).where(F.col("__k") <= at_most).drop("__k")


def count_overlaps(boxes: DataFrame, key: str) -> DataFrame:
    """(key, n): boxes (minx, miny, maxx, maxy) that strictly overlap the key's, itself included.

    Each box goes to the cells of a grid of mean box size that it touches, 256 a side of the extent at most; a pair
    counts in the one cell that holds the corner (greatest minx, greatest miny) of its overlap.
    """
    size = lambda lo, hi: F.greatest(F.avg(F.col(hi) - F.col(lo)), (F.max(hi) - F.min(lo)) / 256, F.lit(1e-9))
    grid = boxes.agg(size("minx", "maxx").alias("w"), size("miny", "maxy").alias("h"))
    at = lambda c, step: F.floor(F.col(c) / F.col(step))
    dealt = boxes.crossJoin(F.broadcast(grid))  # one row
    dealt = dealt.withColumn("cx", F.explode(F.sequence(at("minx", "w"), at("maxx", "w")))).withColumn("cy", F.explode(F.sequence(at("miny", "h"), at("maxy", "h"))))
    sides = ("minx", "miny", "maxx", "maxy")
    other = dealt.select("cx", "cy", *[F.col(c).alias(f"o_{c}") for c in sides])
    meet = pixel.boxes_meet(tuple(F.col(c) for c in sides), tuple(F.col(f"o_{c}") for c in sides))
    home = (F.floor(F.greatest("minx", "o_minx") / F.col("w")) == F.col("cx")) & (F.floor(F.greatest("miny", "o_miny") / F.col("h")) == F.col("cy"))
    return dealt.join(other, ["cx", "cy"]).where(meet & home).groupBy(key).agg(F.count("*").alias("n"))
