"""Mixing sources to target weights: hash-random order inside a source, cut at the source's exact budget."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
ROWS_PER_RANGE = 20_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...], share: float, max_epochs: int) -> DataFrame:
    """One row per source: ``source, rank, source_size, target``.

    A common water level gives every source ``weight * level`` words, no source more than ``max_epochs``
    times its size. The sources in the order in which the rising level fills them up need one running sum,
    so no resharing loop is run. The windows hold one row per source, whatever the number of documents.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank") - 1, len(weights)) + 1).cast("int"))
    everything = Window.partitionBy(F.lit(0))
    filling = Window.partitionBy(F.lit(0)).orderBy("fills_at", "rank")
    sources = (
        sources.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
        .withColumn("fills_at", F.col("cap") / F.col("weight"))
    )
    full_before = F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    words = F.lit(share) * F.sum("source_size").over(everything)
    sources = sources.withColumn("level", (words - full_before) / weight_left)
    # the level of the first source, in filling order, that is not full
    level = F.min(F.when(F.col("fills_at") > F.col("level"), F.struct("fills_at", "rank", "level"))).over(everything)
    target = F.coalesce(F.least(F.col("cap").cast("double"), F.col("weight") * level["level"]), F.col("cap").cast("double"))
    return sources.select("source", "rank", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: the words that the mix takes of every row.

    Every row has a random key, the MD5 of its id. A source's words are taken in key order, whole epochs
    first and then up to the budget; the document at the cut gives the words that are still missing, so a
    source's taken words equal its target, rounded down. The order is a range sort: equal key ranges, about
    one per ``rows_per_range`` rows, are sorted apart and joined by the prefix sums of the range totals. A
    source with a third of all rows is spread over a third of the ranges.

    A null text has size 0 and is never taken, a null source is a source (the last), a null id has an empty
    key. Rows that repeat an id are rows of their own. Extra columns are ignored.
    """
    sized = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")),
        "mix_sizes",
    )
    ranges = max(1, math.ceil(sized.count() / rows_per_range))
    targets = source_targets(sized, weights, share, max_epochs)
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    place = F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(ranges) / F.lit(2.0**32))
    keyed = sized.withColumns({"key": key, "range": place}).join(
        targets, sized["source"].eqNullSafe(targets["source"])
    ).select("doc_id", "size", "key", "range", "rank", "source_size", "target")
    before = Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy("rank", "range")
        .agg(F.sum("size").alias("words"))
        .select("rank", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("rank", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    return (
        keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, ["rank", "range"])
        .withColumn("epochs", epochs)
        .withColumn("left", budget - F.col("epochs") * F.col("source_size") - F.col("start") - F.col("inside"))
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            (F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least("size", "left"))).cast("long").alias("taken"),
        )
    )
