"""Monitoring jobs: drift of logged predictions, data validation."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskframe.operators import drift, gates
from riskframe.session import materialize
from riskframe.sources.sinks import append_metrics, write_report


def monitor(
    reference: DataFrame,
    logs: DataFrame,
    metrics_path: str,
    report_path: str,
    run_id: str,
    labels: DataFrame | None = None,
    target: str | None = None,
    score: str | None = None,
) -> DataFrame:
    """Column, dataset and prediction drift, live performance when outcomes are known; returns the columns."""
    columns = materialize(drift.column_drift(reference, logs, target), "drift")
    write_report(columns, report_path)
    summary = drift.drift_summary(columns)
    names = ["drifted_columns", "drift_share"]
    doubles = summary.selectExpr(*[f"cast({n} as double) as {n}" for n in names])
    append_metrics(doubles.unpivot([], names, "name", "value"), metrics_path, run_id, "drift")
    if score is not None:
        shift = drift.prediction_drift(reference, logs, score).selectExpr(
            "'prediction_drift' as name", "statistic as value"
        )
        append_metrics(shift, metrics_path, run_id, "prediction")
    if labels is not None:
        append_metrics(drift.live_performance(logs, labels), metrics_path, run_id, "live")
    return columns


def validate(reference: DataFrame, current: DataFrame, report_path: str, **options) -> DataFrame:
    """Run the data quality tests, write their report and raise when one fails."""
    tests = materialize(drift.data_quality(reference, current, **options), "quality")
    write_report(tests, report_path)
    gates.require(tests)
    return tests
