"""Outlines of labelled pixels: hulls, seam polygons and survey boundaries, and their GeoJSON form.

A polygon is found where its label ends: each pixel side whose other side has another label is an edge, by window functions;
collinear edges become one run before anything is grouped, and a kernel joins a label's runs to rings. Tasks so hold
perimeters, not areas.
"""
from __future__ import annotations

import json
import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..grid import Grid
from .geometry import KEY, any_reduce, distance, neighbours, owners

#: Sides of a pixel in the order of neighbours(): left, right, up, down; (dr, dc) of the edge's first corner, and its course.
_SIDES = (((1, 0), (-1, 0)), ((0, 1), (1, 0)), ((0, 0), (0, 1)), ((1, 1), (0, -1)))


def closed(mask: DataFrame, reach: int, by: str = "on") -> DataFrame:
    """mask (r, c, by) grown by reach pixels and shrunk again: gaps and slits narrower than twice reach are filled."""
    away = lambda df, of: distance(df.select(*KEY, of.alias("off"), F.lit(0).alias("one")), ["one"], "off").select(*KEY, "dist")
    grown = away(mask, ~F.col(by)).select(*KEY, (F.col("dist") <= reach).alias("big"))
    return away(grown, F.col("big")).select(*KEY, (F.col("dist") > reach).alias(by))


def hull_mask(px: DataFrame, factor: int, reach: int = 1, by: str = "valid") -> DataFrame:
    """(r, c, on): coarse cells with a valid pixel, on the whole coarse box, slits closed."""
    coarse = any_reduce(px, factor, by)
    return closed(coarse, reach)


def seam_labels(masks: DataFrame) -> DataFrame:
    """(r, c, label) of masks (src, r, c, on): the source whose edge is farthest, -1 where none covers."""
    return owners(distance(masks, ["src"], "on")).select(*KEY, F.col("owner").alias("label"))


def edge_runs(labels: DataFrame) -> DataFrame:
    """(label, r0, c0, r1, c1): the sides at which a label (>= 0) ends, with the label on the right hand, straight ones joined."""
    around = labels.withColumn("around", F.array(*[F.coalesce(x, F.lit(-1)) for x in neighbours(labels, "label")]))
    sides = F.array(*[F.struct(F.lit(k).alias("side"), (F.col("r") + dr).alias("r0"), (F.col("c") + dc).alias("c0")) for k, ((dr, dc), _) in enumerate(_SIDES)])
    open_ = F.filter(sides, lambda s: F.get("around", s["side"]) != F.col("label"))
    edges = around.where("label >= 0").select("label", F.inline(open_))
    along, across = F.when(F.col("side") < 2, F.col("r0")).otherwise(F.col("c0")), F.when(F.col("side") < 2, F.col("c0")).otherwise(F.col("r0"))
    lined = edges.select("label", "side", along.alias("at"), across.alias("line"))
    order = Window.partitionBy("label", "side", "line").orderBy("at")
    runs = lined.withColumn("run", F.col("at") - F.row_number().over(order)).groupBy("label", "side", "line", "run").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    forward = F.col("side").isin(1, 2)  # these go with rising coordinates
    start, end = F.when(forward, F.col("low")).otherwise(F.col("high")), F.when(forward, F.col("high") + 1).otherwise(F.col("low") - 1)
    upright = F.col("side") < 2
    corner = lambda v: (F.when(upright, v).otherwise(F.col("line")), F.when(upright, F.col("line")).otherwise(v))
    (r0, c0), (r1, c1) = corner(start), corner(end)
    return runs.select("label", *[x.cast("long").alias(n) for x, n in ((r0, "r0"), (c0, "c0"), (r1, "r1"), (c1, "c1"))])


def rings_of(runs: list[tuple[int, int, int, int]]) -> list[list[tuple[int, int]]]:
    """Closed rings (row, column corners, first not repeated) from directed runs; where two runs leave a corner, the right turn goes first."""
    leave: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for r0, c0, r1, c1 in sorted(runs):
        leave.setdefault((r0, c0), []).append((r1, c1))
    rings = []
    while leave:
        first = at = min(leave)
        ring, course = [], (0, 0)
        while True:
            ways = leave[at]
            step = lambda to: (int(np.sign(to[0] - at[0])), int(np.sign(to[1] - at[1])))  # noqa: B023, E731
            turn = lambda to: course[1] * step(to)[0] - course[0] * step(to)[1]  # noqa: B023, E731  greatest to the right
            to = max(ways, key=turn)
            ways.remove(to)
            if not ways:
                del leave[at]
            ring.append(at)
            course, at = step(to), to
            if at == first:
                break
        rings.append(ring)
    return rings


def area_of(ring: list[tuple[float, float]]) -> float:
    """Signed area of (row, column) corners: positive where the inside is on the right hand, negative for holes."""
    r, c = np.array(ring, float).T
    return float(np.dot(c, np.roll(r, -1)) - np.dot(r, np.roll(c, -1))) / 2


def simplified(ring: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """Douglas and Peucker between the two farthest corners; never fewer than four corners, so that no ring vanishes."""
    if tolerance <= 0 or len(ring) <= 4:
        return ring
    pts = np.array(ring, float)
    far = int(np.argmax(((pts - pts[0]) ** 2).sum(axis=1)))
    keep = {0, far}
    todo = [(0, far), (far, len(pts))]
    loop = np.concatenate([pts, pts[:1]])
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        line, mid = loop[b] - loop[a], loop[a + 1 : b] - loop[a]
        size = float(np.hypot(*line))
        off = np.abs(line[0] * mid[:, 1] - line[1] * mid[:, 0]) / size if size else np.hypot(*mid.T)
        k = int(np.argmax(off))
        if off[k] > tolerance:
            keep.add(a + 1 + k)
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    out = [ring[k] for k in sorted(keep)]
    return out if len(out) >= 4 else ring


def polygons(labels: DataFrame, grid: Grid, tolerance: float = 0.0) -> DataFrame:
    """(label, parts, area, coordinates): a MultiPolygon of each label, as GeoJSON coordinates in world units.

    labels: r, c, label. Pixels of a label that meet at a corner only are parts of their own. tolerance, in pixels,
    simplifies each ring.
    """
    def assemble(table: pa.Table) -> pa.Table:
        rings = rings_of(list(zip(*(table.column(k).to_pylist() for k in ("r0", "c0", "r1", "c1")))))
        outer, holes = [r for r in rings if area_of(r) > 0], [r for r in rings if area_of(r) < 0]
        parts = [[r] for r in sorted(outer, key=lambda r: -area_of(r))]
        for hole in holes:
            home = [p for p in parts if _inside(hole, p[0])]
            (home[-1] if home else parts[0]).append(hole)  # the smallest part around it
        area = sum(map(area_of, rings)) * grid.res**2
        world = [[[[grid.x0 + c * grid.res, grid.y0 - r * grid.res] for r, c in [*s, s[0]]] for s in (simplified(x, tolerance) for x in part)] for part in parts]
        return pa.table({"label": pa.array([table.column("label")[0].as_py()], pa.int32()), "parts": pa.array([len(parts)], pa.int32()), "area": [area], "coordinates": [json.dumps(world)]})

    runs = edge_runs(labels).withColumn("label", F.col("label").cast("int"))
    return runs.groupBy("label").applyInArrow(assemble, "label int, parts int, area double, coordinates string")


def _inside(hole: list[tuple[int, int]], ring: list[tuple[int, int]]) -> bool:
    """Whether a point just inside the hole's first corner lies in the ring."""
    r, c = min(hole)
    y, x, odd = r + 0.5, c + 0.5, False
    for (r0, c0), (r1, c1) in zip(ring, [*ring[1:], ring[0]]):
        if (r0 > y) != (r1 > y) and x < c0 + (y - r0) * (c1 - c0) / (r1 - r0):
            odd = not odd
    return odd


def boundaries(flights: DataFrame, names: list[str], grid: Grid, factor: int, cut: Callable[[DataFrame], DataFrame], reach: int = 1, tolerance: float = 0.0, clip: DataFrame | None = None) -> dict[str, DataFrame]:
    """hulls and seam polygons (label, name, parts, area, coordinates) of flights (src, r, c, valid) by name.

    Each flight's hull is closed on a grid factor times as coarse; the seam polygons share out what the hulls cover, within
    clip (r, c of coarse cells) if it is given.
    """
    n = flights.select("src").distinct().count()
    if n != len(names):
        raise ValueError(f"{n} sources, {len(names)} names")
    cells = flights.groupBy("src", F.floor(F.col("r") / factor).cast("long").alias("r"), F.floor(F.col("c") / factor).cast("long").alias("c")).agg(F.bool_or("valid").alias("on"))
    away = lambda df, by: distance(df, ["src"], by)
    grown = away(cells.withColumn("off", ~F.col("on")), "off").select("src", *KEY, (F.col("dist") <= reach).alias("big"))
    masks = cut(away(grown, "big").select("src", *KEY, (F.col("dist") > reach).alias("on")))
    coarse = Grid(grid.x0, grid.y0, grid.res * factor, -(-grid.height // factor), -(-grid.width // factor))
    called = flights.sparkSession.createDataFrame(list(enumerate(names)), "label int, name string")
    inside = masks if clip is None else masks.join(clip.select(*KEY).distinct(), KEY, "left_semi")
    seams = polygons(cut(seam_labels(inside)), coarse, tolerance).join(F.broadcast(called), "label")
    one = lambda k: polygons(masks.where(F.col("src") == k).select(*KEY, F.when(F.col("on"), k).otherwise(-1).alias("label")), coarse, tolerance)
    hulls = one(0)
    for k in range(1, n):
        hulls = hulls.unionByName(one(k))
    return {"hulls": hulls.join(F.broadcast(called), "label"), "seams": seams}


def write_geojson(shapes: DataFrame, path: str) -> int:
    """One FeatureCollection of shapes (coordinates, and properties); rows are streamed to a file beside, which then replaces it."""
    part, n = f"{path}.part", 0
    with open(part, "w") as file:
        file.write('{"type": "FeatureCollection", "features": [')
        for row in shapes.toLocalIterator():
            values = row.asDict()
            geometry = {"type": "MultiPolygon", "coordinates": json.loads(values.pop("coordinates"))}
            file.write(("," if n else "") + json.dumps({"type": "Feature", "properties": values, "geometry": geometry}))
            n += 1
        file.write("]}")
    os.replace(part, path)
    return n


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(properties map, kind, coordinates): the features of GeoJSON files, coordinates as JSON text."""
    schema = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    found = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    return found.select("f.properties", F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"))
