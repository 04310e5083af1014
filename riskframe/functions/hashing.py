"""Hash-based numbers that any engine can recompute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash48(text: Column) -> Column:
    """The leading 48 bits of SHA-256 as a non-negative long."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("bigint")


def hash_share(key: Column, seed: int) -> Column:
    """A reproducible number in [0, 1) with steps of 1/10000 drawn from a key."""
    return (hash48(F.concat(key.cast("string"), F.lit(f"#{seed}"))) % 10000) / F.lit(10000.0)


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a row's JSON with columns in name order; nulls are written out."""
    return F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
