"""Reading loan tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskframe.functions.text import null_tokens


def scan_loans(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    schema: StructType | str | None = None,
    na_tokens: list[str] | tuple[str, ...] = (),
    **options: str,
) -> DataFrame:
    """A loan table from CSV (with header), JSON, Parquet or ORC files; a missing path is an error.

    Give a ``schema`` for large CSV or JSON input, as inferring one costs a pass of its own.
    ``na_tokens`` (for example :data:`riskframe.schemas.NA_TOKENS`) lists texts that mean *missing*;
    by default none does, so that ``n/a`` can still be read as an employment length of 0.
    NaN becomes null.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", "true")
    return normalize_missing(reader.load(path), na_tokens)


def normalize_missing(df: DataFrame, na_tokens: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """NaN, and the given text tokens, become null."""
    fixes = {c: F.nanvl(F.col(c), F.lit(None).cast(t)) for c, t in df.dtypes if t in ("float", "double")}
    if na_tokens:
        fixes.update({c: null_tokens(F.col(c), list(na_tokens)) for c, t in df.dtypes if t == "string"})
    return df.withColumns(fixes)
