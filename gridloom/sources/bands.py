"""Which bands are spectral and which is validity; header tags; bounds and names from headers."""
from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Header:
    """What a raster's header tells: bands by name, colour tags, type, pixel size, corner, size, tags."""

    count: int
    names: tuple[str | None, ...] = ()
    alpha_tags: tuple[int, ...] = ()  # 1-based bands tagged as alpha
    dtype: str = "uint8"
    res: float = 1.0
    x0: float = 0.0
    y0: float = 0.0
    height: int = 0
    width: int = 0
    tags: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Bands:
    count: int
    spectral: tuple[int, ...]
    alpha: int | None
    names: tuple[str, ...]


def resolve_bands(header: Header, names: list[str] | None = None) -> Bands:
    """Alpha: the tagged band, else the last one named alpha, else band 4 of four 8-bit bands when no names are asked for.

    Spectral: as many of the others as names are asked for, all of them otherwise; too few are an error.
    """
    called = [i for i, n in enumerate(header.names, 1) if n and n.lower() == "alpha"]
    alpha = header.alpha_tags[0] if header.alpha_tags else called[-1] if called else None
    if alpha is None and header.count == 4 and header.dtype == "uint8" and not names:
        alpha = 4
    rest = [b for b in range(1, header.count + 1) if b != alpha]
    if names and len(rest) < len(names):
        raise ValueError(f"{len(names)} bands are asked for, {len(rest)} are there")
    spectral = rest[: len(names)] if names else rest
    return Bands(header.count, tuple(spectral), alpha, tuple(names) if names else tuple(f"band_{b}" for b in spectral))


def date_of(tags: dict[str, str]) -> str | None:
    """First of the acquisition tags that starts with a date."""
    for key in ("acquisitionStartDate", "acquisitionEndDate", "TIFFTAG_DATETIME"):
        text = tags.get(key, "")[:10].replace(":", "-")
        try:
            return date.fromisoformat(text).isoformat()
        except ValueError:
            continue
    return None


def median_pixel_size(headers: list[Header]) -> float:
    sizes = sorted(h.res for h in headers)
    if not sizes:
        raise ValueError("no inputs")
    mid = len(sizes) // 2
    return round(sizes[mid] if len(sizes) % 2 else (sizes[mid - 1] + sizes[mid]) / 2, 3)
