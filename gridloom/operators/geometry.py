"""Ownership geometry of overlapping rasters: validity, distance transforms, owners, fault lines, bands."""
from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import graph, tiles

FAR = 1e9  # distance where there is nothing to be far from
KEY = ["r", "c"]


def coverage(flights: DataFrame) -> DataFrame:
    """(r, c, n): valid sources of each pixel."""
    return flights.groupBy(*KEY).agg(F.count_if("valid").alias("n"))


def overlap_stack(flights: DataFrame, band: str = "dn", bounds: DataFrame | None = None) -> DataFrame:
    """(r, c, n, stack): the valid sources of each pixel with their values, in source order.

    bounds (src, r0, r1, c0, c1), if given, prunes sources by box before the pixels meet.
    """
    rows = flights.where("valid")
    if bounds is not None:
        rows = rows.join(bounds, "src").where("r BETWEEN r0 AND r1 AND c BETWEEN c0 AND c1")
    return rows.groupBy(*KEY).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("src", F.col(band).alias("value")))).alias("stack"))


def column_gaps(mask: DataFrame, keys: list[str], by: str = "valid") -> DataFrame:
    """mask with g: pixels to the nearest false one in the same column, FAR if there is none; 0 where by is false."""
    down = Window.partitionBy(*keys, "c").orderBy("r")
    at = F.when(~F.col(by), F.col("r"))
    before = F.last(at, ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(at, ignorenulls=True).over(down.rowsBetween(0, Window.unboundedFollowing))
    near = F.least(F.coalesce(F.col("r") - before, F.lit(FAR)), F.coalesce(after - F.col("r"), F.lit(FAR)))
    return mask.withColumn("g", near.cast("double"))


def row_envelope(g: np.ndarray) -> np.ndarray:
    """Squared distances along one row of column gaps, by the lower envelope of parabolas (Felzenszwalb and Huttenlocher)."""
    n = len(g)
    sites = np.nonzero(g < FAR)[0]
    if not len(sites):
        return np.full(n, FAR * FAR)
    f = g * g
    hull, starts = [int(sites[0])], [-np.inf]
    for q in sites[1:].tolist():
        while True:
            p = hull[-1]
            meet = ((f[q] + q * q) - (f[p] + p * p)) / (2 * (q - p))
            if meet > starts[-1] or len(hull) == 1:
                break
            hull.pop()
            starts.pop()
        if meet <= starts[-1]:
            hull, starts = [], []
            meet = -np.inf
        hull.append(q)
        starts.append(meet)
    who = np.array(hull)[np.searchsorted(np.array(starts), np.arange(n), side="right") - 1]
    return f[who] + (np.arange(n) - who) ** 2


def _lines(column: pa.ListArray) -> Iterator[pa.StructArray]:
    """The structs of each row of a list column, without a Python object a struct."""
    for k in range(len(column)):
        yield column[k].values


def _distances(lines: pa.ListArray) -> list[np.ndarray]:
    out = []
    for line in _lines(lines):
        cols = line.field("c").to_numpy()
        far = np.full(cols.max() - cols.min() + 1, FAR)
        far[cols - cols.min()] = line.field("g").to_numpy()
        d2 = row_envelope(far)[cols - cols.min()]
        out.append(np.where(d2 >= FAR, FAR, np.sqrt(d2)))
    return out


def _envelope_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = [line.field("c").to_numpy() for line in _lines(batch.column("line"))]
        counts = [len(x) for x in cols]
        rows = np.repeat(np.arange(batch.num_rows), counts)
        others = {n: batch.column(n).take(pa.array(rows)) for n in batch.schema.names if n != "line"}
        whole = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        yield pa.RecordBatch.from_pydict(others | {"c": whole(cols, pa.int64()), "dist": whole(_distances(batch.column("line")), pa.float64())})


def distance(mask: DataFrame, keys: list[str], by: str = "valid") -> DataFrame:
    """(keys, r, c, dist): Euclidean pixels to the nearest pixel where by is false; the border of the grid is not false.

    Two exact passes, both linear: gaps along columns by windows, then rows by a lower-envelope kernel. FAR where there is
    no false pixel.
    """
    gaps = column_gaps(mask, keys, by)
    lines = gaps.groupBy(*keys, "r").agg(F.collect_list(F.struct(F.col("c").cast("long").alias("c"), "g")).alias("line"))
    types = dict(gaps.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in [*keys, "r"]) + ", c long, dist double"
    out = lines.select(*keys, "r", "line").mapInArrow(_envelope_rows, schema)
    return out.select(*keys, "r", F.col("c").cast(types["c"]).alias("c"), "dist")


def owners(dist: DataFrame) -> DataFrame:
    """(r, c, owner, best): the source of greatest distance, the first of equals, -1 where no source has any."""
    pick = F.max_by("src", F.struct("dist", (-F.col("src")).alias("k")))
    return dist.groupBy(*KEY).agg(pick.alias("src"), F.max("dist").alias("best")).select(*KEY, F.when(F.col("best") > 0, F.col("src")).otherwise(-1).cast("int").alias("owner"), "best")


def neighbours(values: DataFrame, column: str) -> list[Column]:
    """Values of the four lattice neighbours; null where that pixel is absent."""
    out = []
    for along, across in (("c", "r"), ("r", "c")):
        w = Window.partitionBy(across).orderBy(along)
        out += [F.when(F.lag(along).over(w) == F.col(along) - 1, F.lag(column).over(w)), F.when(F.lead(along).over(w) == F.col(along) + 1, F.lead(column).over(w))]
    return out


def faultline(owner: DataFrame, cover: DataFrame) -> DataFrame:
    """owner with n (coverage) and fault: a 4-neighbour has another owner, and both pixels have two sources or more."""
    both = owner.join(cover, KEY).withColumn("key", F.when(F.col("n") >= 2, F.col("owner")))
    differs = [F.coalesce(x != F.col("key"), F.lit(False)) for x in neighbours(both, "key")]
    return both.withColumn("fault", reduce(lambda a, b: a | b, differs)).drop("key")


def band_taper(fault: DataFrame, band_px: float) -> DataFrame:
    """fault with d (distance to the fault line), in_band and taper: 1 on the line, 0 at band_px and outside the band."""
    band = max(float(band_px), 1.0)
    off = fault.select("r", "c", (~F.col("fault")).alias("off"), F.lit(0).alias("one"))
    out = fault.join(distance(off, ["one"], "off").select("r", "c", F.col("dist").alias("d")), KEY)
    inside = (F.col("d") <= band) & (F.col("n") >= 2)
    return out.withColumn("in_band", inside).withColumn("taper", F.when(inside, F.greatest(F.lit(0.0), 1 - F.col("d") / band)).otherwise(0.0))


def ownership_raster(banded: DataFrame, n_sources: int) -> DataFrame:
    """(r, c, cat, owner): owner 1..N, 0 uncovered; cat is N+1 in the seam band, else the owner."""
    owner = (F.col("owner") + 1).cast("int")
    return banded.select(*KEY, F.when(F.col("in_band"), n_sources + 1).otherwise(owner).cast("int").alias("cat"), owner.alias("owner"))


def recycle(owner: DataFrame, earlier: DataFrame, names: DataFrame, flights: DataFrame) -> DataFrame:
    """owner with the owner of an earlier run where that one is covered and its source still valid, and kept.

    earlier: r, c, owner 1..N with its names table names (owner, src). Every earlier name must be known.
    """
    if earlier.where("owner > 0").select("owner").distinct().join(names, "owner", "left_anti").limit(1).count():
        raise ValueError("the earlier ownership names a source that is not among the inputs")
    old = earlier.join(F.broadcast(names), "owner").select(*KEY, F.col("src").alias("old"))
    live = flights.where("valid").select(*KEY, F.col("src").alias("old"), F.lit(True).alias("live"))
    joined = owner.join(old, KEY, "left").join(live, [*KEY, "old"], "left")
    kept = F.coalesce("live", F.lit(False))
    return joined.select(*KEY, F.when(kept, F.col("old")).otherwise(F.col("owner")).cast("int").alias("owner"), kept.alias("kept"))


def dilate(mask: DataFrame, steps: int, by: str = "on") -> DataFrame:
    """mask after steps dilations by a cross: true within steps of a true pixel along rows and columns together."""
    reach = column_gaps(mask.withColumn("__off", ~F.col(by)).withColumn("__one", F.lit(0)), ["__one"], "__off")
    w = Window.partitionBy("r").orderBy("c")
    g = F.least(F.col("g"), F.lit(float(FAR)))
    left = F.min(g - F.col("c")).over(w.rangeBetween(-steps, 0)) + F.col("c")
    right = F.min(g + F.col("c")).over(w.rangeBetween(0, steps)) - F.col("c")
    return reach.withColumn(by, F.least(left, right) <= steps).drop("g", "__off", "__one")


def any_reduce(mask: DataFrame, factor: int, by: str = "valid") -> DataFrame:
    """(r, c, on): a coarse cell is on if any of its pixels is."""
    return mask.groupBy(F.floor(F.col("r") / factor).cast("long").alias("r"), F.floor(F.col("c") / factor).cast("long").alias("c")).agg(F.bool_or(by).alias("on"))


def _nearest_in_row(gap: np.ndarray, above: bool) -> np.ndarray:
    """For each place of a row, the column whose site is nearest: of equals that of least row, then of least column.

    The envelope gives the distance; the winner is looked for within it, so a place costs the sites around it.
    """
    n = len(gap)
    sites = np.nonzero(gap < FAR)[0]
    out = np.full(n, -1)
    if not len(sites):
        return out
    reach = np.sqrt(row_envelope(gap)).astype(int) + 1
    first, last = np.searchsorted(sites, np.arange(n) - reach), np.searchsorted(sites, np.arange(n) + reach, side="right")
    rows = -gap if above else gap
    for k in range(n):
        near = sites[first[k] : last[k]]
        cost = gap[near] ** 2 + (near - k) ** 2
        equal = near[cost == cost.min()]
        out[k] = equal[int(np.argmin(rows[equal]))]
    return out


def _fill_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per raster row: each pixel's nearest valid one, among the nearest ones above and below in every column."""
    for batch in batches:
        out: dict[str, list] = {"r": [], "c": [], "near": []}
        for r, line in zip(batch.column("r").to_pylist(), _lines(batch.column("line"))):
            c = line.field("c").to_numpy()
            order = np.argsort(c, kind="stable")
            cols, width = c[order], int(c.max() - c.min() + 1)
            at = cols - cols[0]
            up, low, uv, lv = (line.field(k).fill_null(np.nan).to_numpy()[order] for k in ("up", "low", "up_v", "low_v"))
            above, below = (np.full(width, np.nan) for _ in range(2))
            value_above, value_below = (np.full(width, np.nan) for _ in range(2))
            above[at], below[at], value_above[at], value_below[at] = up, low, uv, lv
            gap_above, gap_below = np.where(np.isnan(above), FAR, r - above), np.where(np.isnan(below), FAR, below - r)
            picks = []
            for gap, row, value in ((gap_above, above, value_above), (gap_below, below, value_below)):
                k = _nearest_in_row(gap, gap is gap_above)[at]
                d2 = np.where(k >= 0, gap[k] ** 2 + (k - at) ** 2, FAR * FAR)
                picks.append((d2, row[k], k, value[k]))
            (da, ra, ka, va), (db, rb, kb, vb) = picks
            first = (da < db) | ((da == db) & ((ra < rb) | ((ra == rb) & (ka <= kb))))
            near = np.where(np.minimum(da, db) >= FAR * FAR, np.nan, np.where(first, va, vb))
            for k, v in zip(out, (np.full(len(cols), r), cols, near)):
                out[k].append(v)
        whole = {k: np.concatenate(v) if v else np.zeros(0) for k, v in out.items()}
        yield pa.RecordBatch.from_pydict({"r": whole["r"].astype(np.int64), "c": whole["c"].astype(np.int64), "near": pa.array(whole["near"], pa.float64(), from_pandas=True)})


def nearest_fill(px: DataFrame, band: str = "dn") -> DataFrame:
    """px with filled: each invalid pixel takes the value of its nearest valid one, the least (row, column) of equals.

    Feature transform: per column the nearest valid rows on both sides by windows, then per raster row the best column by a
    lower envelope; null without any valid pixel.
    """
    down = Window.partitionBy("c").orderBy("r")
    row, value = F.when(F.col("valid"), F.col("r").cast("double")), F.when(F.col("valid"), F.col(band).cast("double"))
    before, after = down.rowsBetween(Window.unboundedPreceding, 0), down.rowsBetween(0, Window.unboundedFollowing)
    sided = px.select("r", "c", *[F.last(x, ignorenulls=True).over(before).alias(n) for x, n in ((row, "up"), (value, "up_v"))], *[F.first(x, ignorenulls=True).over(after).alias(n) for x, n in ((row, "low"), (value, "low_v"))])
    lines = sided.groupBy(F.col("r").cast("long").alias("r")).agg(F.collect_list(F.struct(F.col("c").cast("long").alias("c"), "up", "low", "up_v", "low_v")).alias("line"))
    near = lines.mapInArrow(_fill_rows, "r long, c long, near double")
    kind = dict(px.dtypes)[band]
    return px.join(near, KEY, "left").withColumn("filled", F.when(F.col("valid"), F.col(band)).otherwise(F.col("near").cast(kind))).drop("near")


def trust_region(both_valid: DataFrame, margin: float, by: str = "valid") -> DataFrame:
    """(r, c, dist, trusted): a shift is trusted more than margin pixels from where either raster is invalid."""
    one = both_valid.select("r", "c", by, F.lit(0).alias("one"))
    return distance(one, ["one"], by).select("r", "c", "dist", (F.col("dist") > margin).alias("trusted"))


def _labelled(on: np.ndarray) -> np.ndarray:
    """8-connected regions of a mask: for each true place the number of its region's first place, else -1."""
    height, width = on.shape
    edge = np.diff(np.pad(on, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    (row, start), (_, end) = np.nonzero(edge == 1), np.nonzero(edge == -1)
    root = np.arange(len(row))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    first = np.searchsorted(row, np.arange(height + 1))
    for r in range(1, height):
        a, b = first[r - 1], first[r]
        while a < first[r] and b < first[r + 1]:
            if start[a] <= end[b] and start[b] <= end[a]:  # ends are one past: corners touch
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
            a, b = (a + 1, b) if end[a] < end[b] else (a, b + 1)
    tops = np.array([find(k) for k in range(len(row))], np.int64)
    out = np.full(on.shape, -1, np.int64)
    out[on] = np.repeat(row[tops] * width + start[tops], end - start) if len(row) else 0
    return out


def regions(mask: DataFrame, cut: Callable[[DataFrame], DataFrame], size: int = 1024, columns: int = 1 << 31) -> DataFrame:
    """(r, c, region) of the pixels (r, c) of mask: the number r * columns + c of the first pixel of their 8-connected region.

    Each tile is labelled alone by one kernel; only labels that meet across a tile's edge become links, and their
    components are found on that small graph. cut(df) must end the lineage.
    """

    def label(_: dict, here: np.ndarray, r0: int, c0: int) -> dict[str, np.ndarray]:
        own = _labelled(here)
        return {"label": np.where(own >= 0, (own // here.shape[1] + r0) * columns + own % here.shape[1] + c0, -1)}

    labelled = cut(tiles.map_tiles(mask.select("r", "c"), [], size, 0, label, "label long"))
    on_edge = lambda x: F.pmod(F.col(x), F.lit(size)).isin(0, size - 1)
    edge = labelled.where(on_edge("r") | on_edge("c"))
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 1), (1, -1), (1, 0), (1, 1))])
    sent = edge.select("r", "c", "label", F.explode(around).alias("k")).select((F.col("r") + F.col("k.i")).alias("r"), (F.col("c") + F.col("k.j")).alias("c"), F.col("label").alias("a"))
    links = sent.join(edge, KEY).where("a <> label").select("a", F.col("label").alias("b")).distinct()
    roots = graph.components(links, cut).withColumnRenamed("node", "label")
    return labelled.join(F.broadcast(roots) if roots.count() <= 1_000_000 else roots, "label", "left").select(*KEY, F.coalesce("root", "label").alias("region"))


def border_components(zero: DataFrame, cut: Callable[[DataFrame], DataFrame], size: int = 1024) -> DataFrame:
    """(r, c, border): for zero pixels, whether their 8-connected region reaches the grid's border.

    zero: r, c of zero pixels, border true for those on the border. cut(df) must end the lineage.
    """
    found = cut(regions(zero, cut, size).join(zero.select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), "border"), KEY))
    reach = found.where("border").select("region").distinct().withColumn("reaches", F.lit(True))
    return found.join(reach, "region", "left").select(*KEY, F.coalesce("reaches", F.lit(False)).alias("border"))
