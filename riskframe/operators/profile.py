"""Dataset profiles and exploratory tables."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.hashing import row_digest
from riskframe.functions.ordered import exact_quantiles
from riskframe.operators.clean import missing_profile, numeric_columns, string_columns

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def dataset_profile(df: DataFrame) -> DataFrame:
    """``(column, dtype, rows, missing)`` from one aggregate."""
    one = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(t).alias("dtype"),
                F.col("_rows").alias("rows"),
                (F.col("_rows") - F.col(c)).alias("missing"),
            )
            for c, t in df.dtypes
        ]
    )
    return one.select(F.explode(entries).alias("e")).select("e.*")


def _moments(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        aggs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(v).alias("count"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
            ).alias(f"_{c}")
        )
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return wide.select(*by, F.explode(F.array(*[f"_{c}" for c in columns])).alias("e")).select(*by, "e.*")


DESCRIBED = ["column", "count", "mean", "std", "min", *QUARTILES, "max"]


def describe_numeric(
    df: DataFrame, columns: list[str] | None = None, by: str | None = None, max_groups: int = 100
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column (and group).

    Groups are classes of a target or the like; more than ``max_groups`` are an error.
    """
    columns = columns or [c for c in numeric_columns(df) if c != by]
    if by is not None:
        return _describe_groups(df.filter(F.col(by).isNotNull()), columns, by, max_groups)
    quartiles = exact_quantiles(df, columns, list(QUARTILES.values()))
    at = F.col("column")
    picks = {}
    for j, name in enumerate(QUARTILES):
        expr = F.lit(None).cast("double")
        for c in columns:
            expr = F.when(at == c, F.lit(quartiles[c][j])).otherwise(expr)
        picks[name] = expr
    return _moments(df, columns, []).withColumns(picks).select(*DESCRIBED)


def _describe_groups(df: DataFrame, columns: list[str], by: str, max_groups: int) -> DataFrame:
    """A column's values in one group are a column of their own: all quartiles of all groups are bracketed and counted by the
    same aggregates, and only values inside a bracket leave their task."""
    groups = [r[0] for r in df.select(by).distinct().limit(max_groups + 1).collect()]
    if len(groups) > max_groups:
        raise ValueError(f"{by!r} has more than {max_groups} groups")
    moments = _moments(df, columns, [by])
    if not groups:
        return moments.select(by, *[F.lit(None).cast("double").alias(c) if c in QUARTILES else F.col(c) for c in DESCRIBED])
    own = {(g, c): f"q{i}_{j}" for i, g in enumerate(groups) for j, c in enumerate(columns)}
    wide = df.select(*[F.when(F.col(by) == F.lit(g), F.col(c).cast("double")).alias(name) for (g, c), name in own.items()])
    quartiles = exact_quantiles(wide, list(own.values()), list(QUARTILES.values()))
    rows = [(g, c, *quartiles[name]) for (g, c), name in own.items()]
    kind = df.schema[by].dataType.simpleString()
    known = df.sparkSession.createDataFrame(rows, f"`{by}` {kind}, column string, " + ", ".join(f"{q} double" for q in QUARTILES))
    return moments.join(F.broadcast(known), [by, "column"]).select(by, *DESCRIBED)  # a row per group and column


def missing_summary(df: DataFrame, top: int = 10) -> DataFrame:
    """Columns with missing values, worst first."""
    return (
        missing_profile(df)
        .filter(F.col("missing") > 0)
        .select("column", "missing", "percent")
        .orderBy(F.desc("percent"), "column")
        .limit(top)
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, n, share)`` of the non-null values."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def top_values(df: DataFrame, columns: list[str] | None = None, top: int = 10) -> DataFrame:
    """``(column, distinct, rank, value, n)``: the most frequent values of every text column.

    The rank filter runs before the shuffle of the window, so a column with very many values does not
    gather in one task.
    """
    columns = columns or string_columns(df)
    counts = (
        df.unpivot([], columns, "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    distinct = counts.groupBy("column").agg(F.count("*").alias("distinct"))
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    best = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(distinct, "column").select("column", "distinct", "rank", "value", "n")


def crosstab_rate(df: DataFrame, category: str, target: str, top: int = 10) -> DataFrame:
    """Percent of each class (0, 1) per category, highest share of class 1 first."""
    known = df.filter(F.col(category).isNotNull() & F.col(target).isNotNull())
    return (
        known.groupBy(F.col(category).alias("category"))
        .agg(
            (F.avg((F.col(target) == 0).cast("double")) * 100).alias("pct_0"),
            (F.avg((F.col(target) == 1).cast("double")) * 100).alias("pct_1"),
        )
        .orderBy(F.desc(F.round("pct_1", 9)), "category")
        .limit(top)
    )


def default_rate_by(df: DataFrame, category: str, target: str, top: int = 10) -> DataFrame:
    """Mean target per category, highest first."""
    return (
        df.filter(F.col(category).isNotNull())
        .groupBy(category)
        .agg(F.count("*").alias("loans"), F.avg(target).alias("default_rate"))
        .orderBy(F.desc(F.round("default_rate", 9)), category)
        .limit(top)
    )


CORRELATION_BLOCK = 32


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(a, b, corr)`` of every pair of columns, over the rows where both are present.

    Every task adds up products of its rows as matrices, values and their masks alike, around the columns' means, so that
    large means do not cancel. It gives one row per column and block of ``CORRELATION_BLOCK`` others, however
    many rows it read; these sums are added without pairs of columns ever being spread over rows.
    """
    columns = columns or numeric_columns(df)
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    means = values.agg(*[F.avg(c).alias(c) for c in values.columns]).first()
    centre = [m if m is not None and math.isfinite(m) else 0.0 for m in means]
    width, k = CORRELATION_BLOCK, len(columns)
    sums = ["n", "x", "xx", "y", "yy", "xy"]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sums), k, k))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - centre
            there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            x = np.where(there > 0, x, 0.0)
            with np.errstate(invalid="ignore"):  # an infinite value makes its sums no number
                total += np.stack([there.T @ there, x.T @ there, (x * x).T @ there, there.T @ x, there.T @ (x * x), x.T @ x])
        rows = [(a, b, *total[:, a, b : b + width].tolist()) for a in range(k) for b in range(0, k, width) if b + width > a]
        types = [pa.int32(), pa.int32(), *[pa.list_(pa.float64())] * len(sums)]
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        yield pa.RecordBatch.from_arrays(arrays, ["a", "block", *sums])

    fields = ", ".join(f"{s} array<double>" for s in sums)
    parts = values.mapInArrow(products, f"a int, block int, {fields}")
    added = [F.array(*[F.sum(F.get(s, F.lit(i))) for i in range(min(width, k))]).alias(s) for s in sums]
    blocks = parts.groupBy("a", "block").agg(*added)
    names = F.array(*[F.lit(c) for c in columns])
    pairs = blocks.select("a", "block", F.posexplode(F.arrays_zip(*sums)).alias("at", "s"))
    pairs = pairs.select("a", (F.col("block") + F.col("at")).alias("b"), "s.*").filter((F.col("b") > F.col("a")) & (F.col("b") < k))
    n = F.col("n")
    spread = F.sqrt((F.col("xx") - F.col("x") * F.col("x") / n) * (F.col("yy") - F.col("y") * F.col("y") / n))
    corr = F.try_divide(F.col("xy") - F.col("x") * F.col("y") / n, spread)
    return pairs.filter(n > 0).select(F.get(names, F.col("a")).alias("a"), F.get(names, F.col("b")).alias("b"), corr.alias("corr"))


def histogram_by_class(
    df: DataFrame, column: str, label: str, bins: int = 50, common_range: bool = False, max_classes: int = 1000
) -> DataFrame:
    """``(label, bin, left, n, density)``: equal-width bins over each class's own (or one common) range.

    The ranges, one row per class, are broadcast; more than ``max_classes`` classes are an error.
    """
    rows = df.select(F.col(label).alias("label"), F.col(column).cast("double").alias("x")).filter(
        F.col("x").isNotNull() & F.col("label").isNotNull()
    )
    ranges = rows.groupBy("label").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("total"))
    if common_range:
        whole = rows.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("r")).scalar()
        ranges = ranges.withColumns({"lo": whole.getField("lo"), "hi": whole.getField("hi")})
    ranges = ranges.withColumn("width", (F.col("hi") - F.col("lo")) / bins).drop("hi")
    found = ranges.limit(max_classes + 1).collect()
    if len(found) > max_classes:
        raise ValueError(f"{label} has more than {max_classes} classes; it is no class label")
    ranges = df.sparkSession.createDataFrame(found, ranges.schema)
    at = F.least(F.floor(F.try_divide(F.col("x") - F.col("lo"), F.col("width"))), F.lit(bins - 1))
    return (
        rows.join(F.broadcast(ranges), "label")
        .groupBy("label", F.coalesce(at, F.lit(0)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"), F.max("lo").alias("lo"), F.max("width").alias("width"), F.max("total").alias("total"))
        .select(
            "label",
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("left"),
            "n",
            F.try_divide(F.col("n"), F.col("total") * F.col("width")).alias("density"),
        )
    )


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """One row: class counts, ``scale_pos_weight`` (1 if a class is empty) and the balanced weights."""
    n, pos = F.count(target), F.count_if(F.col(target) == 1)
    neg = F.count_if(F.col(target) == 0)
    return df.agg(
        neg.alias("negatives"),
        pos.alias("positives"),
        F.when((pos > 0) & (neg > 0), neg / pos).otherwise(1.0).alias("scale_pos_weight"),
        F.try_divide(n, 2 * neg).alias("weight_0"),
        F.try_divide(n, 2 * pos).alias("weight_1"),
    )


def content_hash(df: DataFrame) -> DataFrame:
    """One row ``(rows, digest)`` that does not depend on row or column order.

    Row digests are summed as numbers in two halves, so equal rows count as often as they occur.
    """
    digest = row_digest(df)

    def part(start: int):
        return F.sum(F.conv(F.substring("_d", start, 15), 16, 10).cast("decimal(38,0)"))

    sums = df.select(digest.alias("_d")).agg(F.count("*").alias("rows"), part(1).alias("a"), part(16).alias("b"))
    return sums.select(
        "rows",
        F.sha2(F.concat_ws("|", F.col("rows"), F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))), 256).alias("digest"),
    )
