"""Exact order-dependent results (running sums, ranks, order statistics) without a one-task sort.

A running sum over one global order, or over a key that holds a third of the rows, would put all of
it into one window partition. Here the order is first cut into buckets; each bucket is one window
partition, and the sums of the earlier buckets are added afterwards. The cut is written before it is
used, so a recomputed task always agrees with the first run.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import materialize, remove

ROWS_PER_BUCKET = 500_000


def with_bucket(df: DataFrame, keys: list[str], order: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``bucket``, the row's range in the (keys, order) sort order, and ``split``.

    The number of ranges follows the number of rows; rows of one (keys, order) tuple share a range. The
    ranges are written once, so a recomputed task reads the same ones. ``split`` says that the key may lie in
    several ranges; rows of all other keys need nothing from another one.
    """
    df = materialize(df, "ordered")  # counting, sampling for ranges and ranging read the written rows
    buckets = math.ceil(df.count() / rows_per_bucket)
    if buckets <= 1:
        return df.withColumns({"bucket": F.lit(0), "split": F.lit(False)})
    written = df.inputFiles()[0].rpartition("/")[0]
    ranged = df.repartitionByRange(buckets, *keys, *order).withColumn("bucket", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    remove(df.sparkSession, written)  # the same rows
    if not keys:
        return ranged.withColumn("split", F.lit(True))
    key = F.struct(*keys)
    edges = ranged.groupBy("bucket").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    by_bucket = Window.partitionBy(F.lit(0)).orderBy("bucket")  # one row per bucket
    edges = edges.select(
        "bucket",
        F.when(F.lag("last").over(by_bucket) == F.col("first"), F.col("first")).alias("_low"),
        F.when(F.lead("first").over(by_bucket) == F.col("last"), F.col("last")).alias("_high"),
    )
    shared = F.coalesce(key == F.col("_low"), F.lit(False)) | F.coalesce(key == F.col("_high"), F.lit(False))
    return ranged.join(edges, "bucket").withColumn("split", shared).drop("_low", "_high")


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: list[str],
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Inclusive running sums ``cum_<c>`` and key totals ``total_<c>`` by ``order`` within ``keys``.

    ``df`` holds one row per (keys, order), with no null key: aggregate first, so that hot values
    have collapsed on the map side before anything is shuffled.
    """
    bucketed = with_bucket(df, keys, order, rows_per_bucket)
    # sums of the earlier buckets, only for keys that lie in several: at most two such keys a bucket
    part = bucketed.filter("split").groupBy(*keys, "bucket").agg(*[F.sum(c).alias(c) for c in sums])
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = part.select(
        *keys,
        "bucket",
        *[F.sum(c).over(before).alias(f"_before_{c}") for c in sums],
        *[F.sum(c).over(whole).alias(f"_total_{c}") for c in sums],
    )
    inside = Window.partitionBy(*keys, "bucket")
    upto = inside.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        bucketed.withColumns(
            {
                **{f"cum_{c}": F.sum(c).over(upto) for c in sums},
                **{f"total_{c}": F.sum(c).over(inside) for c in sums},
            }
        )
        .join(offsets, [*keys, "bucket"], "left")
        .withColumns(
            {
                **{f"cum_{c}": F.col(f"cum_{c}") + F.coalesce(f"_before_{c}", F.lit(0)) for c in sums},
                **{f"total_{c}": F.coalesce(f"_total_{c}", f"total_{c}") for c in sums},
            }
        )
        .drop("bucket", "split", *[f"_before_{c}" for c in sums], *[f"_total_{c}" for c in sums])
    )


def value_counts_long(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """``(keep…, column, value, n)``: occurrences of every non-null value of numeric columns."""
    return (
        df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot(list(keep), columns, "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy(*keep, "column", "value")
        .agg(F.count("*").alias("n"))
    )


def quantiles_by(counts: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Linear-interpolated quantiles per key from ``(keys, value, n)`` counts.

    One row per key: ``n`` and one column per entry of ``probs`` (name → probability).
    """
    run = running_totals(counts, keys, [value], ["n"])
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank <= last), F.col(value)))

    picks = {}
    for name, p in probs.items():
        spot = F.lit(p) * (F.col("total_n") - 1)
        picks[f"_lo_{name}"] = at(F.floor(spot))
        picks[f"_hi_{name}"] = at(F.ceil(spot))
    out = run.groupBy(*keys).agg(
        F.max("total_n").alias("n"), *[expr.alias(name) for name, expr in picks.items()]
    )
    columns = []
    for name, p in probs.items():
        spot = F.lit(p) * (F.col("n") - 1)
        share = spot - F.floor(spot)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        columns.append((lo + (hi - lo) * share).alias(name))
    return out.select(*keys, "n", *columns)


@dataclass
class ColumnCounts:
    """Rows of the frame and non-null values of one column."""

    rows: int
    present: int


# Values inside a bracket that are shuffled and ranked; a bracket with more is narrowed again.
BRACKET_ROWS = 2_000_000
ACCURACY = 5_000
MAX_NARROWINGS = 8
EVERYTHING = (float("-inf"), float("inf"))

Spans = dict[str, list[tuple[float, float]]]


def column_counts(df: DataFrame, columns: list[str]) -> dict[str, ColumnCounts]:
    """Row and non-null counts of every column in one aggregate."""
    if not columns:
        return {}
    row = df.agg(F.count("*").alias("rows"), *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    return {c: ColumnCounts(row["rows"], row[f"n{i}"]) for i, c in enumerate(columns)}


def _merge(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    merged: list[tuple[float, float]] = []
    for lo, hi in sorted(set(spans)):
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def _spans(df: DataFrame, counts: dict[str, ColumnCounts], wanted: dict[str, list[int]]) -> Spans:
    """Value ranges that enclose the wanted ranks, from one approximate pass over all columns."""
    slack = 2 / ACCURACY
    probs = {}
    for c, ranks in wanted.items():
        shares = [r / max(counts[c].present - 1, 1) for r in ranks]
        probs[c] = [min(max(s + d, 0.0), 1.0) for s in shares for d in (-slack, slack)]
    row = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), ps, ACCURACY).alias(f"q{i}") for i, (c, ps) in enumerate(probs.items())]
    ).first()
    spans = {}
    for i, (c, ps) in enumerate(probs.items()):
        ends = row[f"q{i}"]
        spans[c] = _merge(
            [
                (EVERYTHING[0] if ps[j] <= 0 else ends[j], EVERYTHING[1] if ps[j + 1] >= 1 else ends[j + 1])
                for j in range(0, len(ps), 2)
            ]
        )
    return spans


def values_at(
    df: DataFrame, counts: dict[str, ColumnCounts], ranks: dict[str, set[int]], most: int = BRACKET_ROWS
) -> dict[tuple[str, int], float]:
    """Exact values at 0-based ranks among the non-null values of each column.

    An approximate pass says between which two values each rank lies, one aggregate counts the rows below and inside
    these brackets, and only rows inside are shuffled and ranked. A bracket of more than ``most`` rows is narrowed
    by another approximate pass over its own rows, so at every size the same steps lead to brackets that
    one task can rank, except where a single value fills one, which collapses before the shuffle. A rank that falls
    outside its bracket (it should not) is looked up again over the whole column.
    """
    wanted = {c: sorted(r for r in rs if 0 <= r < counts[c].present) for c, rs in ranks.items()}
    wanted = {c: rs for c, rs in wanted.items() if rs}
    if not wanted:
        return {}
    found: dict[tuple[str, int], float] = {}
    spans = _spans(df, counts, wanted)
    for _ in range(MAX_NARROWINGS):
        below, inside = _count_spans(df, spans)
        if max(inside.values()) <= most:
            break
        narrower = _narrowed(df, spans, below, inside, wanted, most)
        if narrower == spans:
            break
        spans = narrower
    found.update(_search(df, spans, wanted, below, bucketed=max(inside.values()) > most))
    missed = {c: [r for r in rs if (c, r) not in found] for c, rs in wanted.items()}
    missed = {c: rs for c, rs in missed.items() if rs}
    if missed:
        whole = {c: [EVERYTHING] for c in missed}
        found.update(_search(df, whole, missed, {(c, 0): 0 for c in missed}, bucketed=True))
    return found


def _narrowed(
    df: DataFrame, spans: Spans, below: dict[tuple[str, int], int], inside: dict[tuple[str, int], int], wanted: dict[str, list[int]], most: int
) -> Spans:
    """Brackets of the same ranks, those of more than ``most`` rows drawn anew from their own rows."""
    full = {(c, i): f"s{j}" for j, (c, i) in enumerate(k for k, n in inside.items() if n > most)}
    columns, own_counts, own_ranks = [], {}, {}
    for (c, i), name in full.items():
        lo, hi = spans[c][i]
        value = F.col(c).cast("double")
        columns.append(F.when((value >= lo) & (value <= hi), value).alias(name))
        own_counts[name] = ColumnCounts(inside[c, i], inside[c, i])
        own_ranks[name] = [r - below[c, i] for r in wanted[c] if below[c, i] <= r < below[c, i] + inside[c, i]]
    own_ranks = {name: rs for name, rs in own_ranks.items() if rs}
    drawn = _spans(df.select(*columns), own_counts, own_ranks) if own_ranks else {}
    out = {}
    for c, brackets in spans.items():
        parts = []
        for i, (lo, hi) in enumerate(brackets):
            name = full.get((c, i))
            if name is None:
                parts.append((lo, hi))
            else:
                parts += [(max(a, lo), min(b, hi)) for a, b in drawn.get(name, [])]
        out[c] = _merge(parts) if parts else brackets
    return out


def _count_spans(df: DataFrame, spans: Spans) -> tuple[dict[tuple[str, int], int], dict[tuple[str, int], int]]:
    """Rows below and inside every span."""
    flat = [(c, i, lo, hi) for c, bs in spans.items() for i, (lo, hi) in enumerate(bs)]
    aggs = []
    for j, (c, _, lo, hi) in enumerate(flat):
        value = F.col(c).cast("double")
        aggs.append(F.count_if(value < lo).alias(f"below{j}"))
        aggs.append(F.count_if((value >= lo) & (value <= hi)).alias(f"inside{j}"))
    row = df.agg(*aggs).first()
    return (
        {(c, i): row[f"below{j}"] for j, (c, i, _, _) in enumerate(flat)},
        {(c, i): row[f"inside{j}"] for j, (c, i, _, _) in enumerate(flat)},
    )


def _search(
    df: DataFrame, spans: Spans, wanted: dict[str, list[int]], below: dict[tuple[str, int], int], bucketed: bool
) -> dict[tuple[str, int], float]:
    def inside(c: str, i: int, lo: float, hi: float) -> Column:
        value = F.col(c).cast("double")
        hit = F.struct(F.lit(c).alias("column"), F.lit(i).alias("span"), value.alias("value"))
        return F.when((value >= lo) & (value <= hi), hit)

    if all(bs == [EVERYTHING] for bs in spans.values()):
        table = value_counts_long(df, list(spans)).withColumn("span", F.lit(0))
    else:
        hits = [inside(c, i, lo, hi) for c, bs in spans.items() for i, (lo, hi) in enumerate(bs)]
        table = (
            df.select(F.explode(F.array_compact(F.array(*hits))).alias("hit"))
            .groupBy("hit.column", "hit.span", "hit.value")
            .agg(F.count("*").alias("n"))
        )
    if bucketed:
        run = running_totals(table, ["column", "span"], ["value"], ["n"])
    else:
        order = Window.partitionBy("column", "span").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        run = table.withColumn("cum_n", F.sum("n").over(order))
    local = {(c, i): [r - below[c, i] for r in wanted[c]] for c, bs in spans.items() for i in range(len(bs))}
    entries = [(c, i, r) for (c, i), rs in local.items() for r in rs if r >= 0]
    wants = df.sparkSession.createDataFrame(entries, "column string, span int, local long")
    rows = (
        run.join(F.broadcast(wants), ["column", "span"])  # a few ranks per column
        .filter((F.col("cum_n") - F.col("n") <= F.col("local")) & (F.col("local") < F.col("cum_n")))
        .select("column", "span", "local", "value")
        .collect()
    )
    return {(h["column"], h["local"] + below[h["column"], h["span"]]): h["value"] for h in rows}


def interpolation_ranks(n: int, p: float) -> tuple[int, int, float]:
    """The two ranks around probability ``p`` of ``n`` sorted values and the weight of the upper one."""
    spot = p * (n - 1)
    lo = int(spot)
    hi = min(lo + 1, n - 1) if spot > lo else lo
    return lo, hi, spot - lo


def exact_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], most: int = BRACKET_ROWS
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of every column; ``None`` for a column without values."""
    counts = column_counts(df, columns)
    ranks = {
        c: {r for p in probs for r in interpolation_ranks(n.present, p)[:2]} if n.present else set()
        for c, n in counts.items()
    }
    values = values_at(df, counts, ranks, most)
    out: dict[str, list[float | None]] = {}
    for c, n in counts.items():
        out[c] = [None] * len(probs)
        for j, p in enumerate(probs if n.present else []):
            lo, hi, share = interpolation_ranks(n.present, p)
            low, high = values[c, lo], values[c, hi]
            out[c][j] = low + (high - low) * share
    return out
