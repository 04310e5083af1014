"""Writing processed sets, metrics, reports, predictions and feature snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.clean import numeric_columns


def write_processed(
    marked: DataFrame, destination: str, test_mark: str = "_test", target: str = "default", fmt: str = "parquet"
) -> dict[str, str]:
    """Train, test and full set plus the feature-name list under one folder; returns their paths."""
    paths = {name: f"{destination}/{name}" for name in ("train", "test", "full", "feature_names")}
    plain = marked.drop(test_mark)
    parts = {"train": marked.filter(~F.col(test_mark)), "test": marked.filter(test_mark), "full": marked}
    for name, part in parts.items():
        writer = part.drop(test_mark).write.mode("overwrite").format(fmt)
        (writer.option("header", "true") if fmt == "csv" else writer).save(paths[name])
    names = [(i, c) for i, c in enumerate(c for c in plain.columns if c != target)]
    spark = marked.sparkSession
    spark.createDataFrame(names, "position int, name string").coalesce(1).write.mode("overwrite").json(
        paths["feature_names"]
    )
    return paths


def metric_rows(wide: DataFrame, keys: list[str]) -> DataFrame:
    """Numeric columns of ``wide`` as ``(keys…, name, value)``; others are skipped, NaN is null."""
    names = [c for c in numeric_columns(wide) if c not in keys]
    doubles = wide.select(*keys, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in names])
    return doubles.unpivot(keys, names, "name", "value")


def append_metrics(rows: DataFrame, path: str, run_id: str, scope: str = "") -> None:
    """Append ``(run_id, scope, name, value, ts)`` rows to the metrics table."""
    rows.select(
        F.lit(run_id).alias("run_id"), F.lit(scope).alias("scope"), "name", "value", F.current_timestamp().alias("ts")
    ).write.mode("append").parquet(path)


def write_report(rows: DataFrame, path: str) -> None:
    """A drift or validation result as JSON lines."""
    rows.write.mode("overwrite").json(path)


def prediction_records(scored: DataFrame, inputs: list[str]) -> DataFrame:
    """Nested log record per prediction: details and input features as structures, plus its hour."""
    details = ["prediction", "probability_default", "probability_repayment", "risk_level", "model_name", "model_version"]
    return scored.select(
        "loan_id",
        "predicted_at",
        "model_type",
        "features_source",
        F.struct(*details).alias("prediction_details"),
        F.struct(*inputs).alias("input_features"),
        F.date_format("predicted_at", "yyyy-MM-dd-HH").alias("hour"),
    )


def write_prediction_log(records: DataFrame, path: str) -> None:
    """Append prediction records, partitioned by hour so that monitoring reads only its window."""
    records.write.mode("append").partitionBy("hour").parquet(path)


def feature_snapshot(df: DataFrame, key: str, ts: str, tie: str | None = None) -> DataFrame:
    """One JSON document per key: its newest row. Rows collapse on the map side; a hot key is no burden."""
    payload = F.struct(*[c for c in df.columns if c != key])
    newest = F.max_by(payload, F.struct(*([ts, tie] if tie else [ts])))
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(newest.alias("_row"), F.max(ts).alias("feature_ts"))
        .select(key, "feature_ts", F.to_json("_row").alias("features"))
    )
