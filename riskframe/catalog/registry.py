"""Named queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; without ``sql`` it is checked by properties in the tests."""

    def add(f: Query) -> Query:
        from riskframe.session import configure

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return add


def rounded(df: DataFrame, digits: int = 6, coarse: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded for comparison (``coarse`` ones, of great size, to 2); timestamps as text."""
    fixes = {}
    for c, t in df.dtypes:
        if t in ("double", "float"):
            fixes[c] = F.round(c, 2 if c in coarse else digits)
        elif t.startswith("timestamp"):
            fixes[c] = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(fixes) if fixes else df


def r6(*names: str) -> str:
    """SQL list ``round(c, 6) AS c, …``."""
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def r2(*names: str) -> str:
    return ", ".join(f"round({n}, 2) AS {n}" for n in names)
