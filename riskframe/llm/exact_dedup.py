"""Exact deduplication: group by a 128-bit content hash, compare bytes inside the groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PICK = {"min": F.min, "max": F.max}


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    digest: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows meet by ``digest`` (128 bits) and inside a digest by the bytes of the text, so a collision never
    joins two texts. The grouping collapses copies before its shuffle: a group with a third of all rows
    costs one row per task. Each text is shuffled once, by that grouping; the way back to the rows takes
    ids and hashes only.

    ``keep`` says which id of a group stays, the smallest or the largest. A null text counts as empty. A
    null id never wins against another one. Rows that repeat an id with the same text are one document and
    share its fate. Other columns are ignored; an empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.select("doc_id", digest(F.col("text")).alias("digest"), "text")
    sha = F.sha2(F.col("text"), 256).alias("text_sha256")
    groups = (
        base.groupBy("digest", "text")
        .agg(PICK[keep]("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("digest", sha, "keep_id", "group_size")
    )
    rows = base.select("doc_id", "digest", sha)
    return rows.join(groups, ["digest", "text_sha256"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
