"""Model versions, stages, aliases and runs as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.gates import require

FALLBACK_STAGES = ["Production", "Staging"]


def latest_run(metrics: DataFrame, by: str = "model") -> DataFrame:
    """The metrics of the newest run per model."""
    newest = metrics.groupBy(by).agg(F.max_by("run_id", F.struct("ts", "run_id")).alias("run_id"))
    return metrics.join(newest, [by, "run_id"], "left_semi")


def pick_version(registry: DataFrame, wanted: str | int) -> DataFrame:
    """One row per model name: an exact version, else the newest in the stage or under the alias,
    else the newest in Production or Staging.

    ``how`` says which of them applied. A name without a match is absent; use :func:`require_version`
    to treat that as an error.
    """
    row = F.struct("version", "stage", "alias", "creation_ts", "run_id")
    age = F.struct("creation_ts", "version")
    if isinstance(wanted, int):
        match: Column = F.col("version") == wanted
        fallback: Column = F.lit(False)
    else:
        text = wanted.lower()
        match = (F.lower("stage") == text) | (F.lower("alias") == text)
        fallback = F.col("stage").isin(FALLBACK_STAGES)
    match, fallback = F.coalesce(match, F.lit(False)), F.coalesce(fallback, F.lit(False))
    best = registry.groupBy("name").agg(
        F.max_by(F.when(match, row), F.when(match, age)).alias("exact"),
        F.max_by(F.when(fallback, row), F.when(fallback, age)).alias("other"),
    )
    return (
        best.withColumn("hit", F.coalesce("exact", "other"))
        .filter(F.col("hit").isNotNull())
        .select("name", "hit.*", F.when(F.col("exact").isNotNull(), "match").otherwise("fallback").alias("how"))
    )


def require_version(registry: DataFrame, name: str, wanted: str | int) -> dict:
    rows = pick_version(registry.filter(F.col("name") == name), wanted).collect()  # at most one row
    if not rows:
        raise ValueError(f"no version of {name!r} matches {wanted!r}")
    return rows[0].asDict()


def registry_state(log: DataFrame) -> DataFrame:
    """Current stage, description and aliases per version from an append-only promotion log.

    Log columns: ``name, version, stage, alias, description, ts, seq``; null means *not changed*.
    An alias belongs to the version that took it last.
    """
    at = F.struct("ts", "seq")

    def last(column: str) -> Column:
        known = F.col(column).isNotNull()
        return F.max_by(F.when(known, F.col(column)), F.when(known, at)).alias(column)

    versions = log.groupBy("name", "version").agg(
        last("stage"), last("description"), F.min("ts").alias("creation_ts"), F.max("ts").alias("updated_ts")
    )
    holders = (
        log.filter(F.col("alias").isNotNull())
        .groupBy("name", "alias")
        .agg(F.max_by("version", at).alias("version"))
        .groupBy("name", "version")
        .agg(F.array_join(F.sort_array(F.collect_list("alias")), ",").alias("aliases"))
    )
    return versions.join(holders, ["name", "version"], "left")


def promote(
    log_path: str,
    gates: list[DataFrame],
    name: str,
    version: int,
    alias: str = "champion",
    stage: str = "Staging",
    description: str = "",
) -> None:
    """Append a promotion to the log once all gates have passed; otherwise raise and append nothing."""
    for checks in gates:
        require(checks)
    spark = gates[0].sparkSession if gates else None
    if spark is None:
        raise ValueError("a promotion needs at least one gate")
    row = spark.range(1).select(
        F.lit(name).alias("name"),
        F.lit(version).cast("bigint").alias("version"),
        F.lit(stage.capitalize()).alias("stage"),
        F.lit(alias).alias("alias"),
        F.lit(description).alias("description"),
        F.current_timestamp().alias("ts"),
        F.lit(0).cast("bigint").alias("seq"),
    )
    row.write.mode("append").parquet(log_path)
