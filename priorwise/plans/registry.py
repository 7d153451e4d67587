"""Registry of the library's queries and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, dates: Sequence[str] = ()) -> Callable[[Query], Query]:
    """Register a query; ``dates`` are returned as text, which engines write alike."""

    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = (lambda spark, d: f(spark, d).withColumns({c: F.col(c).cast("string") for c in dates})) if dates else f
        if sql is not None:
            written = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in dates)
            ORACLES[name] = f"SELECT * REPLACE ({written}) FROM ({sql})" if dates else sql
        return f

    return register
