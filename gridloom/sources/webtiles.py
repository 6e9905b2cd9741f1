"""Web tiles: images cut from a raster at each zoom, and the single-file archive (PMTiles, version 3) that holds them.

Tiles are made level by level: the finest from pixels, each coarser one from the averages of the one below, so no pixel is
read twice. Images are sorted by their place on the Hilbert curve by the cluster and streamed to the file.
"""
from __future__ import annotations

import gzip
import json
import os
import struct
import zlib
from collections.abc import Iterator
from math import ceil, cos, log2, pi, radians

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.pixel import hilbert_tile_id
from ..operators.tiles import dense, tile_rows

EQUATOR = 2 * pi * 6378137.0  # metres around the web projection's sphere
SIDE = 512
BANDS = ["red", "green", "blue", "alpha"]
ROOT_LIMIT = 16257  # fixed value: bytes that a root directory may have


def max_zoom(res: float, latitude: float, side: int = SIDE) -> int:
    """The first zoom whose pixels are no larger than the raster's."""
    return max(0, ceil(log2(EQUATOR * cos(radians(latitude)) / (res * side))))


def overview_factor(factors: list[int], need: float) -> int:
    """The greatest overview factor that is still no coarser than needed, 1 if none is."""
    return max([f for f in factors if f <= need], default=1)


def png(pixels: np.ndarray) -> bytes:
    """(rows, columns, 4) bytes as an image file."""
    raw = b"".join(b"\0" + row.tobytes() for row in pixels.astype(np.uint8))
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", pixels.shape[1], pixels.shape[0], 8, 6, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def halved(px: DataFrame) -> DataFrame:
    """(r, c, red, green, blue, alpha) at half size: colours averaged by alpha, alpha averaged over all four pixels."""
    half = [F.floor(F.col(k) / 2).cast("long").alias(k) for k in ("r", "c")]
    mean = [F.coalesce(F.sum(F.col(b) * F.col("alpha")) / F.nullif(F.sum("alpha"), F.lit(0)), F.lit(0.0)).alias(b) for b in BANDS[:3]]
    return px.groupBy(*half).agg(*mean, (F.sum("alpha") / 4.0).alias("alpha"))


def tiles_of(px: DataFrame, side: int = SIDE) -> DataFrame:
    """(y, x, image) of px (r, c, red, green, blue, alpha) on the zoom's own lattice; wholly transparent tiles are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"y": [], "x": [], "image": []}
            for ty, tx, rows in zip(batch.column("tr").to_pylist(), batch.column("tc").to_pylist(), batch.column("rows")):
                arrays, here, r0, c0 = dense(rows, BANDS)
                whole = np.zeros((side, side, 4))
                top, left = r0 - ty * side, c0 - tx * side
                whole[top : top + here.shape[0], left : left + here.shape[1]] = np.stack([arrays[b] for b in BANDS], axis=2)
                pixels = np.clip(np.rint(whole), 0, 255)
                if pixels[:, :, 3].any():
                    for k, v in zip(out, (ty, tx, png(pixels))):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict({"y": pa.array(out["y"], pa.int64()), "x": pa.array(out["x"], pa.int64()), "image": pa.array(out["image"], pa.binary())})

    return tile_rows(px, BANDS, side, 0).select("tr", "tc", "rows").mapInArrow(run, "y long, x long, image binary")


def pyramid(px: DataFrame, zoom: int, least: int, cut, side: int = SIDE) -> DataFrame:
    """(z, x, y, tile_id, image) from px at zoom down to least. cut(df) must end the lineage of a level."""
    levels, level = [], px
    for z in range(zoom, least - 1, -1):
        if z < zoom:
            level = cut(halved(level))
        levels.append(tiles_of(level, side).select(F.lit(z).alias("z"), "x", "y", hilbert_tile_id(z, "x", "y").alias("tile_id"), "image"))
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out


def _varint(n: int) -> bytes:
    out = bytearray()
    while True:
        out.append(n & 127 | (128 if n > 127 else 0))
        n >>= 7
        if not n:
            return bytes(out)


def _varints(raw: bytes) -> Iterator[int]:
    n = shift = 0
    for b in raw:
        n |= (b & 127) << shift
        shift += 7
        if b < 128:
            yield n
            n = shift = 0


Entry = tuple[int, int, int, int]  # tile id, run length (0: a leaf directory), length, offset


def pack_directory(entries: list[Entry]) -> bytes:
    """Columns of entries as variable-length numbers: ids as differences, offsets as 0 where they follow the one before."""
    out = [_varint(len(entries))]
    out += [_varint(e[0] - (entries[k - 1][0] if k else 0)) for k, e in enumerate(entries)]
    out += [_varint(e[1]) for e in entries] + [_varint(e[2]) for e in entries]
    out += [_varint(0 if k and e[3] == entries[k - 1][3] + entries[k - 1][2] else e[3] + 1) for k, e in enumerate(entries)]
    return gzip.compress(b"".join(out), mtime=0)


def unpack_directory(raw: bytes) -> list[Entry]:
    numbers = list(_varints(gzip.decompress(raw)))
    n, out, tile, end = numbers[0], [], 0, 0
    ids, runs, lengths, offsets = (numbers[1 + k * n : 1 + (k + 1) * n] for k in range(4))
    for step, run, length, offset in zip(ids, runs, lengths, offsets):
        tile += step
        at = end if not offset else offset - 1
        end = at + length
        out.append((tile, run, length, at))
    return out


def directories(entries: list[Entry]) -> tuple[bytes, bytes]:
    """(root, leaves): one directory if it fits the root's limit, else leaves of equal size below a root."""
    root, size = pack_directory(entries), 4096
    leaves = b""
    while len(root) > ROOT_LIMIT:
        top, parts, at = [], [], 0
        for k in range(0, len(entries), size):
            packed = pack_directory(entries[k : k + size])
            top.append((entries[k][0], 0, len(packed), at))
            parts.append(packed)
            at += len(packed)
        root, leaves, size = pack_directory(top), b"".join(parts), size * 2
    return root, leaves


_HEADER = "<7sBQQQQQQQQQQQBBBBBBiiiiBii"


def write_archive(tiles: DataFrame, path: str, bounds: tuple[float, float, float, float], metadata: dict | None = None) -> dict:
    """Write tiles (z, tile_id, image) as one archive; bounds are west, south, east, north in degrees.

    Images are streamed in tile order; an image that repeats the one before it is stored once, as a run.
    """
    entries: list[Entry] = []
    n = size = contents = 0
    low, high, before = 99, 0, None
    body = f"{path}.body"
    with open(body, "wb") as file:
        for row in tiles.select("z", "tile_id", "image").orderBy("tile_id").toLocalIterator(prefetchPartitions=True):
            n, low, high, image = n + 1, min(low, row.z), max(high, row.z), bytes(row.image)
            if image == before and entries[-1][0] + entries[-1][1] == row.tile_id:
                last = entries[-1]
                entries[-1] = (last[0], last[1] + 1, last[2], last[3])
                continue
            entries.append((row.tile_id, 1, len(image), size))
            contents, before = contents + 1, image
            size += len(image)
            file.write(image)
    if not n:
        os.remove(body)
        raise ValueError("no tile has a visible pixel")
    root, leaves = directories(entries)
    about = gzip.compress(json.dumps(metadata or {}).encode(), mtime=0)
    at = [127]
    for part in (len(root), len(about), len(leaves)):
        at.append(at[-1] + part)
    w, s, e, t = (round(x * 1e7) for x in bounds)
    centre = ((w + e) // 2, (s + t) // 2)
    head = struct.pack(_HEADER, b"PMTiles", 3, at[0], len(root), at[1], len(about), at[2], len(leaves), at[3], size, n, len(entries), contents, 1, 2, 1, 2, low, high, w, s, e, t, low, *centre)
    with open(f"{path}.part", "wb") as file:
        file.write(head + root + about + leaves)
        with open(body, "rb") as images:
            while piece := images.read(16 << 20):
                file.write(piece)
    os.remove(body)
    os.replace(f"{path}.part", path)
    return {"tiles": n, "contents": contents, "min_zoom": low, "max_zoom": high}


def read_tile(path: str, tile_id: int) -> bytes | None:
    """The image of a tile, or None."""
    with open(path, "rb") as file:
        head = struct.unpack(_HEADER, file.read(127))
        if head[0] != b"PMTiles" or head[1] != 3:
            raise ValueError(f"{path} is no archive of version 3")
        at, length = head[2], head[3]
        for _ in range(4):
            file.seek(at)
            entries = unpack_directory(file.read(length))
            found = [e for e in entries if e[0] <= tile_id]
            if not found:
                return None
            tile, run, length, offset = found[-1]
            if run:
                file.seek(head[8] + offset)
                return file.read(length) if tile_id < tile + run else None
            at = head[6] + offset
    return None


VIEWER = """<!doctype html><meta charset="utf-8"><title>{title}</title>
<link rel="stylesheet" href="leaflet.css"><script src="leaflet.js"></script><script src="pmtiles.js"></script>
<div id="map" style="position:absolute;inset:0"></div>
<script>const map = L.map("map").fitBounds([[{south}, {west}], [{north}, {east}]]);
pmtiles.leafletRasterLayer(new pmtiles.PMTiles("{archive}"), {{maxNativeZoom: {zoom}}}).addTo(map);</script>
"""


def write_viewer(path: str, title: str, archive: str, bounds: tuple[float, float, float, float], zoom: int) -> None:
    """A page that shows an archive beside it; scripts are looked for beside it too."""
    import html

    west, south, east, north = bounds
    with open(path, "w") as file:
        file.write(VIEWER.format(title=html.escape(title), archive=html.escape(archive, quote=True), west=west, south=south, east=east, north=north, zoom=zoom))
