"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the last bits of float sums do not count; -0.0 becomes 0.0."""
    return df.select(*[
        (F.round(F.col(f"`{n}`"), digits) + F.lit(0.0)).alias(n) if t == "double" else F.col(f"`{n}`")
        for n, t in df.dtypes
    ])


def values(rows: list[tuple], name: str, columns: str) -> str:
    """A CTE of literal rows for DuckDB."""
    def lit(v) -> str:
        return "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"{name}({columns}) AS (VALUES {body})"
