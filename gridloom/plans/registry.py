"""Where queries are listed with the DuckDB SQL that checks them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name; sql None where SQL can't express it."""
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def typed(df: DataFrame, long: str = "", double: str = "", places: int = 6, **others: str) -> DataFrame:
    """Cast the named columns to long or rounded double, keep others (name="type"); the order is as given."""
    cols: list[Column] = [F.col(c).cast("long").alias(c) for c in long.split()]
    cols += [F.round(F.col(c).cast("double"), places).alias(c) for c in double.split()]
    return df.select(*cols, *[F.col(c).cast(t).alias(c) for c, t in others.items()])


def sql_typed(long: str = "", double: str = "", places: int = 6, **others: str) -> str:
    parts = [f"CAST({c} AS BIGINT) AS {c}" for c in long.split()] + [f"round(CAST({c} AS DOUBLE), {places}) AS {c}" for c in double.split()]
    return ", ".join(parts + [f"CAST({c} AS {t}) AS {c}" for c, t in others.items()])
