"""Labelled rows for fitting: a bounded sample without the held-out fold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 4
HELD_OUT = 2


def fold(id_col: str, folds: int) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds))


def held_out(id_col: str, folds: int = FOLDS, fold_no: int = HELD_OUT) -> Column:
    return F.coalesce(fold(id_col, folds) == fold_no, F.lit(False))


def usable_labels(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, label`` of all rows labelled 0 or 1 outside the held-out fold, one per id."""
    usable = labels.filter(F.col(label).isin(0, 1) & ~held_out("doc_id") & F.col("doc_id").isNotNull())
    return usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``per_class`` rows of either label, chosen by a hash of the id.

    Rows of the held-out fold never take part. The chosen ids are few by construction, so they are
    broadcast to the documents and no text is shuffled.
    """
    usable = usable_labels(labels, label)
    order = [F.xxhash64("doc_id", F.lit(7)), "doc_id"]
    picked = reduce(
        DataFrame.unionByName, [usable.filter(F.col("label") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    )
    texts = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(picked), "doc_id")  # at most 2 * per_class ids
