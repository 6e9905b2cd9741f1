"""Lattice arithmetic on the driver: origins are whole multiples of the pixel size, so equal-size rasters share keys."""
from __future__ import annotations

from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """North-up grid: origin of the upper-left corner, pixel size, rows and columns."""

    x0: float
    y0: float
    res: float
    height: int
    width: int

    @classmethod
    def union(cls, minx: float, miny: float, maxx: float, maxy: float, res: float) -> Grid:
        """The snapped grid that covers the bounds."""
        if res <= 0 or maxx <= minx or maxy <= miny:
            raise ValueError("bounds must have an area and the pixel size be positive")
        x0, y0 = floor(minx / res) * res, ceil(maxy / res) * res
        return cls(x0, y0, res, ceil((y0 - miny) / res), ceil((maxx - x0) / res))

    def grown(self, pixels: int) -> Grid:
        """The same lattice with a margin on all sides."""
        return Grid(self.x0 - pixels * self.res, self.y0 + pixels * self.res, self.res, self.height + 2 * pixels, self.width + 2 * pixels)

    def shift_to(self, other: Grid) -> tuple[int, int] | None:
        """Whole (rows, columns) from other's keys to these, or None where the lattices differ and pixels must be resampled."""
        rows, cols = (self.y0 - other.y0) / self.res, (other.x0 - self.x0) / self.res
        if abs(self.res - other.res) > 1e-9 * self.res or abs(rows - round(rows)) > 1e-6 or abs(cols - round(cols)) > 1e-6:
            return None
        return round(rows), round(cols)

    def world(self, r: Column, c: Column) -> tuple[Column, Column]:
        """Pixel centre in world units."""
        return F.lit(self.x0) + (c + 0.5) * self.res, F.lit(self.y0) - (r + 0.5) * self.res

    def pixel(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Row and column that hold a world point."""
        return F.floor((F.lit(self.y0) - y) / self.res), F.floor((x - F.lit(self.x0)) / self.res)
