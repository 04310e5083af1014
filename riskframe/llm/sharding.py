"""Balanced shards: ranges between sampled splitters, cut where the running sum of sizes reaches each shard's share."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskframe.session import materialize

SHARDS = 16
KEYS_PER_RANGE = 64
ROWS_PER_RANGE = 20_000
MAX_RANGES = 32_768
OVERFULL = 2.0
ROUNDS = 8
WHOLE_GROUP = 0.01
KEY = ["group", "member", "at"]


def digest60(value: Column) -> Column:
    """The first 60 bits of an MD5 as a non-negative long."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def group_key(text: Column) -> Column:
    return digest60(F.coalesce(text, F.lit("")))


def member_key(id_: Column) -> Column:
    return digest60(F.coalesce(id_.cast("string"), F.lit("")))


def sized_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, size, text_crc32`` and the sort key ``group, member, at`` of every row; texts are read once and left behind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        group_key(F.col(text_col)).alias("group"),
        member_key(F.col(id_col)).alias("member"),
        F.monotonically_increasing_id().alias("at"),
    )
    return materialize(rows, "shard_rows")


def sampled_keys(rows: DataFrame, total: int, wanted: int) -> np.ndarray:
    """Keys and weights of a size-weighted sample, in key order: columns ``group, member, at, weight``.

    A row comes in with a probability of its size times ``wanted`` over the total (1 at most), decided by a hash,
    and stands for its size over that probability. About ``wanted`` rows come, at most twice that many where
    every row is larger than its share.
    """
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(wanted / max(total, 1)))
    draw = F.pmod(F.xxhash64("group", "member", "at", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = rows.filter(draw < chance).select(*KEY, (F.col("size") / chance).alias("weight")).toPandas()
    picked = picked.sort_values(KEY)
    return picked


def quantile_keys(picked, ranges: int) -> list[tuple[int, int, int]]:
    """At most ``ranges - 1`` distinct boundaries at equal weights of a sample in key order."""
    if not len(picked) or ranges < 2:
        return []
    upto = picked["weight"].cumsum().to_numpy()
    spots = np.searchsorted(upto, upto[-1] * np.arange(1, ranges) / ranges)
    keys = picked[KEY].to_numpy()[np.unique(np.minimum(spots, len(picked) - 1))]
    return [tuple(int(x) for x in k) for k in keys]


KEY_TYPE = np.dtype([(c, np.int64) for c in KEY])


def range_of(columns: list[np.ndarray], bounds: np.ndarray) -> np.ndarray:
    """The number of boundaries at or below every key; keys and boundaries compare column by column."""
    lo, hi = np.zeros(len(columns[0]), np.int64), np.full(len(columns[0]), len(bounds), np.int64)
    while (open_ := lo < hi).any():
        mid = np.where(open_, (lo + hi) // 2, 0)
        above = np.zeros(len(mid), bool)  # boundary above key
        same = np.ones(len(mid), bool)
        for name, own in zip(KEY, columns):
            other = bounds[name][mid]
            above |= same & (other > own)
            same &= other == own
        lo, hi = np.where(open_ & ~above, mid + 1, lo), np.where(open_ & above, mid, hi)
    return lo


def with_range(rows: DataFrame, bounds: list[tuple[int, int, int]]) -> DataFrame:
    """``rows`` with ``range``: the place of the key between the boundaries."""
    schema = StructType([*rows.schema.fields, StructField("range", LongType())])
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array(bounds, KEY_TYPE)
        for batch in batches:
            columns = [batch.column(names.index(c)).to_numpy(zero_copy_only=False) for c in KEY]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(range_of(columns, edges))], [*names, "range"])

    return rows.mapInArrow(run, schema)


def ranged_rows(rows: DataFrame, n: int, total: int, rows_per_range: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their range, and one row per range: ``range, n, bytes``.

    Boundaries are quantiles of a size-weighted sample. A range of more than ``OVERFULL`` times the wanted rows
    (many small texts, such as a large group of equal ones) is subdivided: a sample of the overfull ranges
    alone gives boundaries inside them, round after round. No two rows share a key, so any range of two rows can
    be split. What is still overfull after ``ROUNDS`` rounds stays so, which costs time and changes no result.
    """
    ranges = max(1, min(MAX_RANGES, math.ceil(n / rows_per_range)))
    most = OVERFULL * n / ranges
    bounds = quantile_keys(sampled_keys(rows, total, ranges * KEYS_PER_RANGE), ranges)
    for turn in range(ROUNDS + 1):
        placed = with_range(rows, bounds)
        stats = materialize(placed.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")), "shard_ranges")
        over = stats.filter(F.col("n") > most).select("range", "n").collect() if turn < ROUNDS and ranges > 1 else []
        if not over:  # fewer than n / most of them at any time
            break
        held = sum(r["n"] for r in over)
        parts = {r["range"]: math.ceil(2 * r["n"] / most) for r in over}
        inside = placed.join(F.broadcast(stats.filter(F.col("n") > most).select("range")), "range", "left_semi")
        drawn = sampled_keys(inside.withColumn("size", F.lit(1)), held, 2 * KEYS_PER_RANGE * sum(parts.values()))
        place = range_of([drawn[c].to_numpy() for c in KEY], np.array(bounds, KEY_TYPE))
        more = sorted({*bounds, *(k for r, m in parts.items() for k in quantile_keys(drawn[place == r], m))})
        if len(more) == len(bounds):
            break
        bounds = more
    return placed, stats


@dataclass
class Cuts:
    """Positions in the running sum of sizes at which shards 1, 2, … begin."""

    positions: list[int]


def place_cuts(ranked: DataFrame, total: int, shards: int, whole_group: float) -> Cuts:
    """Equal shares of the total; a cut inside a small group of equal texts moves to the group's nearer end."""
    ideal = [total * j // shards for j in range(1, shards)]
    if not ideal or not total:
        return Cuts(ideal)
    hit = F.array(*[F.lit(c) for c in ideal])
    inside = F.exists(hit, lambda c: (c >= F.col("before")) & (c < F.col("before") + F.col("size")))
    groups = [r["group"] for r in ranked.filter(inside).select("group").distinct().collect()]  # at most one per cut
    spans = (
        ranked.filter(F.col("group").isin(groups))
        .groupBy("group")
        .agg(F.min("before").alias("start"), F.max(F.col("before") + F.col("size")).alias("end"))
        .collect()
    )
    limit = whole_group * total / shards
    moved = []
    for c in ideal:
        for s in spans:
            if s["start"] < c < s["end"] and s["end"] - s["start"] <= limit:
                c = s["start"] if 2 * c <= s["start"] + s["end"] else s["end"]
                break
        moved.append(c)
    return Cuts(moved)


def ranked_rows(docs: DataFrame, id_col: str, text_col: str, rows_per_range: int) -> tuple[DataFrame, int]:
    """Rows in one global order with ``before`` (bytes) and ``rank`` (rows) before them, and the bytes of all."""
    rows = sized_rows(docs, id_col, text_col)
    whole = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    placed, stats = ranged_rows(rows, whole["n"], whole["bytes"], rows_per_range)
    # one row per range, at most a few times MAX_RANGES
    earlier = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = stats.select(
        "range",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"),
    )
    inside = Window.partitionBy("range").orderBy(*KEY)
    ranked = placed.withColumns(
        {
            "inside": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"),
            "place": F.row_number().over(inside) - 1,
        }
    ).join(starts, "range")
    ranked = ranked.select(
        "doc_id", "size", "text_crc32", "group", "member",
        (F.col("bytes_before") + F.col("inside")).alias("before"), (F.col("rows_before") + F.col("place")).alias("rank"),
    )
    return materialize(ranked, "shard_ranked"), whole["bytes"]


def shard_of(cuts: Cuts) -> Column:
    """The shard whose share holds the middle of the row."""
    middle = 2 * F.col("before") + F.col("size")
    return F.size(F.filter(F.array(*[F.lit(2 * c) for c in cuts.positions]), lambda c: c <= middle)) if cuts.positions else F.lit(0)


def assign_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    whole_group: float = WHOLE_GROUP,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    A document's size is the UTF-8 bytes of its text and 1; the law is ``bytes``: every shard holds an equal share of all
    bytes up to a document and ``whole_group`` of a share. Rows are range-partitioned by a digest of the text, then
    of the id, so equal texts are neighbours: a group of at most ``whole_group`` of a shard lies in one shard, a
    larger one is divided between neighbouring shards, whatever its share of the table. Inside the ranges the exact
    running sums of sizes decide; the sample decides only how evenly the work is spread, so reruns agree.

    A null text is empty, a null id has the digest of an empty one. Rows that repeat id and text have places of
    their own and may take each other's. ``slot`` counts the rows of a shard from 0 in that order. An
    empty table gives no rows; with fewer rows than shards some shards are empty. Other columns are ignored.
    Digests have 60 bits: two texts with one digest count as one group.
    """
    ranked, total = ranked_rows(docs, id_col, text_col, rows_per_range)
    placed = ranked.withColumn("shard", shard_of(place_cuts(ranked, total, shards, whole_group)))
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    whole_group: float = WHOLE_GROUP,
    rows_per_range: int = ROWS_PER_RANGE,
    files_per_shard: int = 1,
    folder: str = "shard",
) -> None:
    """Write all columns of ``docs`` as Parquet, one folder ``shard=j`` per shard, every file in key order.

    Shards are those of ``assign_shards``: their first keys (at most one per shard) divide the rows without another
    sort of the whole table, and each shard is written by ``files_per_shard`` tasks. Rows that repeat id and text of
    the first row of a shard all go to that shard. The name of the folders must be none of a column of ``docs``.
    """
    if folder in docs.columns:
        raise ValueError(f"the rows have a column {folder}; name the folders otherwise")
    ranked, total = ranked_rows(docs, id_col, text_col, rows_per_range)
    placed = ranked.withColumn("shard", shard_of(place_cuts(ranked, total, shards, whole_group)))
    firsts = placed.groupBy("shard").agg(F.min(F.struct("rank", "group", "member")).alias("k")).orderBy("shard").collect()
    own = F.struct(group_key(F.col(text_col)).alias("group"), member_key(F.col(id_col)).alias("member"))
    shard = F.lit(firsts[0]["shard"] if firsts else 0)
    for r in firsts[1:]:
        start = F.struct(F.lit(r["k"]["group"]).alias("group"), F.lit(r["k"]["member"]).alias("member"))
        shard = F.when(own >= start, F.lit(r["shard"])).otherwise(shard)
    keyed = docs.select(F.struct(*docs.columns).alias("row"), own.alias("own"), shard.alias(folder))
    spread = F.pmod(F.xxhash64("own"), F.lit(files_per_shard))
    spread = keyed.repartition(max(1, len(firsts)) * files_per_shard, folder, spread).sortWithinPartitions(folder, "own")
    spread.select("row.*", folder).write.partitionBy(folder).parquet(path)
