"""Promotion gates as rows ``(check, value, bound, passed, severity)`` per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.schemas import MAX_DISPARITY, MIN_AUC, PROMOTION_LIMITS, Limit

EXPECTED_METRICS = ["accuracy", "precision", "recall", "f1_score"]


class ValidationFailed(Exception):
    """A gate that must stop the run did not pass."""


def run_values(metrics: DataFrame, names: list[str], run: str = "run_id") -> DataFrame:
    """One row per run with the newest value of each named metric, null when it was never logged."""
    return metrics.groupBy(run).agg(
        *[F.max_by(F.when(F.col("name") == n, F.col("value")), F.when(F.col("name") == n, F.col("ts"))).alias(n) for n in names]
    )


def _holds(value: Column, op: str, bound: float) -> Column:
    return {">=": value >= bound, "<=": value <= bound, ">": value > bound, "<": value < bound}[op]


def _check(limit: Limit) -> Column:
    value = F.col(limit.metric)
    missing_passes = F.lit(not limit.required)
    passed = F.when(value.isNull(), missing_passes).otherwise(_holds(value, limit.op, limit.bound))
    severity = (
        F.when(value.isNull(), F.lit("error" if limit.required else "warning"))
        .when(passed, F.lit("info"))
        .otherwise(F.lit("error"))
    )
    return F.struct(
        F.lit(limit.metric).alias("check"),
        value.alias("value"),
        F.lit(limit.op).alias("op"),
        F.lit(limit.bound).alias("bound"),
        passed.alias("passed"),
        severity.alias("severity"),
    )


def check_limits(metrics: DataFrame, limits: list[Limit], run: str = "run_id") -> DataFrame:
    """Every limit against every run; no join, the limits travel in the plan."""
    wide = run_values(metrics, [limit.metric for limit in limits], run)
    return wide.select(run, F.explode(F.array(*[_check(limit) for limit in limits])).alias("e")).select(run, "e.*")


def gate_performance(metrics: DataFrame, min_auc: float = MIN_AUC, required: bool = False) -> DataFrame:
    """The area's floor; without one logged, a warning (or a failure when ``required``).

    Other expected metrics only warn when they are missing.
    """
    floor = check_limits(metrics, [Limit("auc", ">=", min_auc, required)])
    wide = run_values(metrics, EXPECTED_METRICS)
    presence = [
        F.struct(
            F.lit(n).alias("check"),
            F.col(n).alias("value"),
            F.lit("present").alias("op"),
            F.lit(None).cast("double").alias("bound"),
            F.lit(True).alias("passed"),
            F.when(F.col(n).isNull(), "warning").otherwise("info").alias("severity"),
        )
        for n in EXPECTED_METRICS
    ]
    return floor.unionByName(wide.select("run_id", F.explode(F.array(*presence)).alias("e")).select("run_id", "e.*"))


def gate_fairness(gaps: DataFrame, limit: float = MAX_DISPARITY, threshold: float = MAX_DISPARITY) -> DataFrame:
    """One row: fails when the report is empty, or a flagged disparity is above the limit."""
    over = F.col("value") > max(limit, threshold)
    return gaps.agg(F.count("*").alias("disparities"), F.count_if(over).alias("over_limit")).select(
        "disparities",
        "over_limit",
        ((F.col("disparities") > 0) & (F.col("over_limit") == 0)).alias("passed"),
        F.when(F.col("disparities") == 0, "no fairness report")
        .when(F.col("over_limit") > 0, "disparity above limit")
        .otherwise("ok")
        .alias("reason"),
    )


def gate_fairness_checks(gaps: DataFrame, limit: float = MAX_DISPARITY) -> DataFrame:
    """The fairness gate in the shape of the other gates."""
    verdict = gate_fairness(gaps, limit)
    return verdict.select(
        F.lit("fairness").alias("check"),
        F.col("over_limit").cast("double").alias("value"),
        F.lit("<=").alias("op"),
        F.lit(0.0).alias("bound"),
        "passed",
        F.when(F.col("passed"), "info").otherwise("error").alias("severity"),
    )


def promotion_checklist(metrics: DataFrame, limits: list[Limit] = PROMOTION_LIMITS) -> DataFrame:
    return check_limits(metrics, limits)


def all_passed(checks: DataFrame, keys: list[str] = ()) -> DataFrame:
    """``(keys…, checks, failed, passed)``: passes when every check does and there is one."""
    aggs = [
        F.count("*").alias("checks"),
        F.count_if(~F.col("passed")).alias("failed"),
        ((F.count("*") > 0) & F.coalesce(F.bool_and("passed"), F.lit(True))).alias("passed"),
    ]
    return checks.groupBy(*keys).agg(*aggs) if keys else checks.agg(*aggs)


def require(checks: DataFrame) -> None:
    """Raise unless every check passed; the message names the first 20 failing ones."""
    summary = all_passed(checks).first()
    if not summary["passed"]:
        shown = checks.filter(~F.col("passed")).limit(20).toJSON().collect()
        raise ValidationFailed(f"{summary['failed']} of {summary['checks']} checks failed: {shown}")
