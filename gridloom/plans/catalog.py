"""Every query of the raster engine, by name, with the DuckDB SQL that checks it."""
from __future__ import annotations

from . import cell_queries, geometry_queries, kernel_queries, table_queries  # noqa: F401  (they register their queries)
from .registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
