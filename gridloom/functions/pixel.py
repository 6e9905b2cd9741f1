"""Pixel-local column functions; all stay inside generated code."""
from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Alpha thresholds by use; they differ and must not be merged.
ALPHA_VALID = 127
ALPHA_PAIR = 200
ALPHA_APPLY = 0
CLOUD_BITS = (1 << 10, 1 << 11)


def alpha_valid(alpha: Column, above: int = ALPHA_VALID) -> Column:
    return alpha > above


def any_nonzero(*bands: Column) -> Column:
    return reduce(or_, (b != 0 for b in bands))


def gray(*bands: Column) -> Column:
    """Mean of the first three spectral bands."""
    first = bands[:3]
    return reduce(lambda a, b: a + b, first) / len(first)


def stretch(value: Column, low: Column, high: Column, eps: float = 1e-6) -> Column:
    """Value between two percentiles, clipped to 0..1."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (value - low) / (high - low + eps)))


def round_clip(value: Column, low: int = 0, high: int = 255) -> Column:
    """Round half to even, then clip."""
    return F.least(F.lit(high), F.greatest(F.lit(low), F.rint(value))).cast("int")


def normalised_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b) where the sum is above 1, else null."""
    return F.when(a + b > 1, (a - b) / (a + b))


def ratio_less_one(a: Column, b: Column) -> Column:
    """a / b - 1 where b is above 1, else null."""
    return F.when(b > 1, a / b - 1)


def move_cm(u: Column, v: Column, res: float) -> Column:
    return F.hypot(u, v) * res * 100


def tile_key(at: Column, size: float) -> Column:
    """Tile of a coordinate; floors, also below zero."""
    return F.floor(at / size).cast("long")


def cloud_flag(qa: Column) -> Column:
    return reduce(or_, (qa.bitwiseAND(b) != 0 for b in CLOUD_BITS))


def is_reference_data(bands: list[Column], nodata: float) -> Column:
    """No band is nodata, all are finite, and one at least is not zero."""
    whole = reduce(lambda a, b: a & b, ((b != nodata) & ~F.isnan(b.cast("double")) & b.isNotNull() for b in bands))
    return whole & any_nonzero(*bands)


def boxes_meet(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Strict overlap of two (minx, miny, maxx, maxy) boxes."""
    return (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3])


def gsd_slug(res_m: Column) -> Column:
    """Pixel size in cm, without trailing zeros, a p for the point: 0.032 -> 3p2cm."""
    cm = F.regexp_replace(F.format_string("%.4f", F.round(res_m.cast("double") * 100, 4)), r"\.?0+$", "")
    return F.concat(F.replace(cm, F.lit("."), F.lit("p")), F.lit("cm"))


def first_date(*tags: Column) -> Column:
    """First of the tags whose first ten characters are a date; colons count as hyphens."""
    return F.coalesce(*[F.try_to_timestamp(F.translate(F.substring(t, 1, 10), ":", "-"), F.lit("yyyy-MM-dd")).cast("date") for t in tags])


def mission_name(path: Column) -> Column:
    """batch_<n> of a path, else the file's stem."""
    batch = F.regexp_extract(path, r"batch_(\d+)", 0)
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")
    return F.when(batch != "", batch).otherwise(stem)


def hilbert_tile_id(z: int, x: str, y: str) -> Column:
    """Position of tile (x, y) (columns) of zoom z on the Hilbert curve, after all tiles of lower zooms.

    One fold over the levels, from the coarsest; a quadrant's turn is applied to the coordinates that are left.
    """
    before = ((1 << (2 * z)) - 1) // 3
    if z == 0:
        return F.lit(before).cast("long")
    turn = """named_struct('d', s.d + shiftleft(1L, 2 * l) * ((3 * (shiftright(s.x, l) & 1)) ^ (shiftright(s.y, l) & 1)),
        'x', CASE WHEN (shiftright(s.y, l) & 1) = 1 THEN s.x & m WHEN (shiftright(s.x, l) & 1) = 1 THEN m - (s.y & m) ELSE s.y & m END,
        'y', CASE WHEN (shiftright(s.y, l) & 1) = 1 THEN s.y & m WHEN (shiftright(s.x, l) & 1) = 1 THEN m - (s.x & m) ELSE s.x & m END)""".replace("m)", "(shiftleft(1L, l) - 1))").replace("& m", "& (shiftleft(1L, l) - 1)").replace("THEN m -", "THEN (shiftleft(1L, l) - 1) -")
    return F.expr(f"aggregate(sequence({z - 1}, 0, -1), named_struct('d', {before}L, 'x', cast({x} as bigint), 'y', cast({y} as bigint)), (s, l) -> {turn}, s -> s.d)")
