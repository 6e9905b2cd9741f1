"""Tiled GeoTIFF files: headers, windows and a writer, for rasters outside Parquet.

Classic and big files, strips or tiles, planar or pixel order, uncompressed or deflated, with or without the horizontal
predictor. A read touches the header and the blocks that meet the window. ``gridloom_geotiff`` is the Spark source: one
input partition a block, pruned by the window options.
"""
from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.sax.saxutils import escape, unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .bands import Header

# Tag numbers of the TIFF and GeoTIFF standards.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_AT, SAMPLES, ROWS_PER_STRIP, STRIP_SIZE = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, SOFTWARE_DATE, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_SIZE, EXTRA, FORMAT = 284, 306, 317, 322, 323, 324, 325, 338, 339
SCALE, TIEPOINT, GEO_KEYS, METADATA, NODATA = 33550, 33922, 34735, 42112, 42113
_KINDS = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}  # field types
_FORMATS = {1: "u", 2: "i", 3: "f"}


@dataclass
class Layout:
    """Where a file's pixels are, and what its tags say."""

    height: int
    width: int
    count: int
    dtype: np.dtype
    block: tuple[int, int]
    offsets: list[int]
    sizes: list[int]
    planar: bool
    compression: int
    predictor: int
    header: Header = field(repr=False)
    nodata: float | None = None

    @property
    def grid(self) -> tuple[int, int]:
        return -(-self.height // self.block[0]), -(-self.width // self.block[1])


def _directory(file, order: str, big: bool) -> dict[int, list]:
    head, entry, inline = ("Q", "HHQ", 8) if big else ("H", "HHI", 4)
    (n,) = struct.unpack(order + head, file.read(struct.calcsize(order + head)))
    rows = [file.read(struct.calcsize(order + entry) + inline) for _ in range(n)]
    out: dict[int, list] = {}
    for row in rows:
        tag, kind, count = struct.unpack(order + entry, row[:-inline])
        if kind not in _KINDS:
            continue
        code = f"{order}{count}{_KINDS[kind]}"
        raw = row[-inline:]
        if struct.calcsize(code) > inline:
            file.seek(struct.unpack(order + ("Q" if big else "I"), raw)[0])
            raw = file.read(struct.calcsize(code))
        values = struct.unpack(code, raw[: struct.calcsize(code)])
        out[tag] = [values[0].rstrip(b"\0").decode("utf-8", "replace")] if kind == 2 else [*values]
    return out


def open_layout(path: str) -> Layout:
    """Read a file's header."""
    with open(path, "rb") as file:
        mark = file.read(4)
        order = {b"II": "<", b"MM": ">"}[mark[:2]]
        big = struct.unpack(order + "H", mark[2:])[0] == 43
        if big:
            file.read(4)
        (at,) = struct.unpack(order + ("Q" if big else "I"), file.read(8 if big else 4))
        file.seek(at)
        tags = _directory(file, order, big)
    one = lambda tag, default=None: tags.get(tag, [default])[0]
    height, width, count = one(HEIGHT), one(WIDTH), one(SAMPLES, 1)
    if one(COMPRESSION, 1) not in (1, 8, 32946):
        raise ValueError(f"{path}: compression {one(COMPRESSION)} is not read here")
    dtype = np.dtype(f"{order}{_FORMATS[one(FORMAT, 1)]}{one(BITS, 8) // 8}")
    tiled = TILE_AT in tags
    block = (one(TILE_HEIGHT), one(TILE_WIDTH)) if tiled else (min(one(ROWS_PER_STRIP, height), height), width)
    scale, tie = tags.get(SCALE, [1.0, 1.0]), tags.get(TIEPOINT, [0.0] * 6)
    items = re.findall(r'<Item name="([^"]*)"([^>]*)>([^<]*)</Item>', one(METADATA, "") or "")
    names = {int(re.search(r'sample="(\d+)"', rest).group(1)): unescape(text) for name, rest, text in items if name == "DESCRIPTION" and "sample=" in rest}
    own = [(unescape(name), unescape(text)) for name, rest, text in items if "sample=" not in rest]
    if one(SOFTWARE_DATE):
        own.append(("TIFFTAG_DATETIME", one(SOFTWARE_DATE)))
    extra = tags.get(EXTRA, [])
    alphas = tuple(count - len(extra) + k + 1 for k, x in enumerate(extra) if x in (1, 2))
    header = Header(count, tuple(names.get(k) for k in range(count)), alphas, dtype.name, float(scale[0]), tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1], height, width, tuple(own))
    nodata = one(NODATA)
    offsets, sizes = (tags[TILE_AT], tags[TILE_SIZE]) if tiled else (tags[STRIP_AT], tags[STRIP_SIZE])
    return Layout(height, width, count, dtype, block, offsets, sizes, one(PLANAR, 1) == 2, one(COMPRESSION, 1), one(PREDICTOR, 1), header, float(nodata) if nodata else None)


def read_block(path: str, layout: Layout, row: int, col: int) -> np.ndarray:
    """(bands, rows, columns) of one block, cropped to the raster."""
    down, across = layout.grid
    h, w = layout.block
    planes = layout.count if layout.planar else 1
    parts = []
    with open(path, "rb") as file:
        for plane in range(planes):
            k = (plane * down + row) * across + col
            file.seek(layout.offsets[k])
            raw = file.read(layout.sizes[k])
            if layout.sizes[k]:
                raw = zlib.decompress(raw) if layout.compression != 1 else raw
                flat = np.frombuffer(raw, layout.dtype)
            else:  # a sparse file leaves empty blocks out
                flat = np.zeros(h * w * (1 if layout.planar else layout.count), layout.dtype)
            data = flat.reshape(-1, w, 1 if layout.planar else layout.count)
            if layout.predictor == 2:
                data = np.cumsum(data, axis=1, dtype=layout.dtype.newbyteorder("="))
            parts.append(data)
    whole = np.concatenate(parts, axis=2).transpose(2, 0, 1)
    return whole[:, : min(h, layout.height - row * h), : min(w, layout.width - col * w)].astype(layout.dtype.newbyteorder("="))


def read_window(path: str, r0: int = 0, r1: int | None = None, c0: int = 0, c1: int | None = None) -> np.ndarray:
    """(bands, rows, columns) of rows r0..r1 and columns c0..c1, both inclusive."""
    layout = open_layout(path)
    r1, c1 = layout.height - 1 if r1 is None else r1, layout.width - 1 if c1 is None else c1
    h, w = layout.block
    rows = [np.concatenate([read_block(path, layout, r, c) for c in range(c0 // w, c1 // w + 1)], axis=2) for r in range(r0 // h, r1 // h + 1)]
    top, left = r0 // h * h, c0 // w * w
    return np.concatenate(rows, axis=1)[:, r0 - top : r1 - top + 1, c0 - left : c1 - left + 1]


def write(path: str, data: np.ndarray, res: float = 1.0, x0: float = 0.0, y0: float = 0.0, names: list[str] | None = None, alpha: bool = False, nodata: float | None = None, tags: dict[str, str] | None = None, block: int = 512) -> None:
    """Write (bands, rows, columns) as a tiled, deflated file with the horizontal predictor, the last band tagged as alpha if asked.

    Three colour bands are tagged as such; blocks of zeros are left out; the file is written beside and then put in place.
    """
    count, height, width = data.shape
    kind = data.dtype.newbyteorder("<")
    colour = count - alpha == 3
    items = "".join(f'<Item name="DESCRIPTION" sample="{k}" role="description">{escape(n)}</Item>' for k, n in enumerate(names or []))
    items += "".join(f'<Item name="{escape(k)}">{escape(v)}</Item>' for k, v in (tags or {}).items())
    predictor = 2 if data.dtype.kind in "ui" else 1
    down, across = -(-height // block), -(-width // block)
    offsets, sizes = [], []
    with open(f"{path}.part", "wb") as file:
        file.write(struct.pack("<2sHHHQ", b"II", 43, 8, 0, 0))
        for row in range(down):
            for col in range(across):
                tile = np.zeros((block, block, count), kind)
                part = data[:, row * block : (row + 1) * block, col * block : (col + 1) * block]
                tile[: part.shape[1], : part.shape[2]] = part.transpose(1, 2, 0)
                if predictor == 2:
                    tile[:, 1:] = tile[:, 1:] - tile[:, :-1]
                packed = zlib.compress(tile.tobytes(), 6) if tile.any() else b""
                offsets.append(file.tell() if packed else 0)
                sizes.append(len(packed))
                file.write(packed)
        extra = [0] * (count - alpha - (3 if colour else 1)) + [2] * alpha
        form = {"u": 1, "i": 2, "f": 3}[data.dtype.kind]
        fields: list[tuple[int, int, list | bytes]] = [
            (WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [kind.itemsize * 8] * count), (COMPRESSION, 3, [8]), (PHOTOMETRIC, 3, [2 if colour else 1]), (SAMPLES, 3, [count]), (PLANAR, 3, [1]),
            (PREDICTOR, 3, [predictor]), (TILE_WIDTH, 4, [block]), (TILE_HEIGHT, 4, [block]), (TILE_AT, 16, offsets), (TILE_SIZE, 16, sizes), (EXTRA, 3, extra), (FORMAT, 3, [form] * count),
            (SCALE, 12, [res, res, 0.0]), (TIEPOINT, 12, [0.0, 0.0, 0.0, x0, y0, 0.0]), (METADATA, 2, f"<GDALMetadata>{items}</GDALMetadata>\0".encode() if items else b""), (NODATA, 2, f"{nodata:g}\0".encode() if nodata is not None else b""),
        ]
        fields = [f for f in fields if len(f[2])]
        at = file.tell() + (-file.tell()) % 8
        file.seek(at)
        spill = at + 8 + 20 * len(fields) + 8
        table, tail = struct.pack("<Q", len(fields)), b""
        for tag, code, values in fields:
            raw = values if isinstance(values, bytes) else struct.pack(f"<{len(values)}{_KINDS[code]}", *values)
            inline = raw.ljust(8, b"\0") if len(raw) <= 8 else struct.pack("<Q", spill + len(tail))
            tail += b"" if len(raw) <= 8 else raw + b"\0" * (-len(raw) % 8)
            table += struct.pack("<HHQ", tag, code, len(values)) + inline
        file.write(table + struct.pack("<Q", 0) + tail)
        file.seek(8)
        file.write(struct.pack("<Q", at))
    os.replace(f"{path}.part", path)


def scan_headers(spark: SparkSession, paths: list[str]):
    """(path, count, res, x0, y0, height, width, tags map): one task a few files, each opened once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(p, open_layout(p).header) for p in batch.column("path").to_pylist()]
            cols = {"path": pa.array([p for p, _ in found])}
            for name, kind in (("count", pa.int32()), ("res", pa.float64()), ("x0", pa.float64()), ("y0", pa.float64()), ("height", pa.int64()), ("width", pa.int64())):
                cols[name] = pa.array([getattr(h, name) for _, h in found], kind)
            yield pa.RecordBatch.from_pydict(cols | {"tags": pa.array([[*h.tags] for _, h in found], pa.map_(pa.string(), pa.string()))})

    return spark.createDataFrame([(p,) for p in paths], "path string").mapInArrow(run, "path string, count int, res double, x0 double, y0 double, height long, width long, tags map<string,string>")


def column_names(header: Header) -> list[str]:
    """Bands by their descriptions; band_<number> for those without one, and where it is r or c or an earlier band's, in any case."""
    out: list[str] = []
    taken = {"r", "c"}
    for k, name in enumerate(header.names, 1):
        out.append(name.replace("`", "") if name and name.lower() not in taken else f"band_{k}")
        taken.add(out[-1].lower())
    return out


class Block(InputPartition):
    def __init__(self, row: int, column: int):
        super().__init__((row, column))
        self.row, self.column = row, column


class GeoTiffReader(DataSourceReader):
    def __init__(self, options: dict[str, str], names: list[str]):
        self.path, self.names, self.layout = options["path"], names, open_layout(options["path"])
        bound = lambda k, default: int(options.get(k, default))
        self.window = bound("r0", 0), bound("r1", self.layout.height - 1), bound("c0", 0), bound("c1", self.layout.width - 1)

    def partitions(self) -> list[Block]:
        r0, r1, c0, c1 = self.window
        h, w = self.layout.block
        return [Block(r, c) for r in range(r0 // h, r1 // h + 1) for c in range(c0 // w, c1 // w + 1)]

    def read(self, block: Block) -> Iterator[pa.RecordBatch]:
        r0, r1, c0, c1 = self.window
        h, w = self.layout.block
        data = read_block(self.path, self.layout, block.row, block.column)
        rows, cols = np.meshgrid(np.arange(data.shape[1]) + block.row * h, np.arange(data.shape[2]) + block.column * w, indexing="ij")
        keep = (rows >= r0) & (rows <= r1) & (cols >= c0) & (cols <= c1)
        columns = [pa.array(rows[keep].astype(np.int64)), pa.array(cols[keep].astype(np.int64)), *(pa.array(b[keep].astype(float)) for b in data)]
        yield pa.RecordBatch.from_arrays(columns, names=self.names)


class GeoTiffSource(DataSource):
    """(r, c, band columns): band names as column_names() gives them. Options: path, r0, r1, c0, c1."""

    @classmethod
    def name(cls) -> str:
        return "gridloom_geotiff"

    def schema(self) -> str:
        return "r long, c long, " + ", ".join(f"`{n}` double" for n in column_names(open_layout(self.options["path"]).header))

    def reader(self, schema: StructType) -> GeoTiffReader:
        return GeoTiffReader(dict(self.options), schema.names)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GeoTiffSource)
