"""Group fairness: metrics per group, disparities between groups, bias flags and summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.metrics import NO_VALUE, by_attribute, confusion, long_form, rates, ratio
from riskframe.schemas import MAX_DISPARITY

GROUP_METRICS = [
    "positive_rate", "true_positive_rate", "false_positive_rate", "accuracy", "precision", "recall", "f1_score", "auc",
]


def fairness_groups(df: DataFrame, attributes: list[str], y: str = "y", pred: str = "y_pred") -> DataFrame:
    """``(feature, group, count, …)`` with the area taken on the hard labels, −1 for a one-class group."""
    counts = confusion(by_attribute(df, attributes, [y, pred]), y, pred, ["feature", "group"])
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    tpr, fpr = ratio(tp, tp + fn), ratio(fp, fp + tn)
    two_classes = (tp + fn > 0) & (fp + tn > 0)
    return counts.select(
        "feature",
        "group",
        (tn + fp + fn + tp).alias("count"),
        ratio(tp + fp, tn + fp + fn + tp).alias("positive_rate"),
        tpr.alias("true_positive_rate"),
        fpr.alias("false_positive_rate"),
        *[expr.alias(name) for name, expr in rates().items()],
        F.when(two_classes, (tpr + 1 - fpr) / 2).otherwise(NO_VALUE).alias("auc"),
    )


def align_attributes(predictions: DataFrame, attributes: DataFrame, key: str = "loan_id") -> DataFrame:
    """Predictions with the sensitive attributes of the same loan."""
    return predictions.join(attributes, key)


def _spread(groups: DataFrame):
    """Per feature and metric: extremes, mean and population deviation over groups that have a value."""
    return (
        long_form(groups, ["feature", "group"], GROUP_METRICS)
        .filter(F.col("value") != NO_VALUE)
        .groupBy("feature", F.col("name").alias("metric"))
        .agg(
            F.count("*").alias("n"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
        )
    )


def disparities(groups: DataFrame) -> DataFrame:
    """``(feature, name, value)``: difference, deviation and coefficient of variation per metric.

    Needs at least two groups with a value.
    """
    metric = F.col("metric")
    entries = F.array(
        F.struct(F.concat(F.lit("max_"), metric, F.lit("_difference")).alias("name"), (F.col("max") - F.col("min")).alias("value")),
        F.struct(F.concat(metric, F.lit("_std")).alias("name"), F.col("std").alias("value")),
        F.struct(F.concat(metric, F.lit("_cv")).alias("name"), ratio(F.col("std"), F.col("mean")).alias("value")),
    )
    return (
        _spread(groups).filter(F.col("n") > 1).select("feature", F.explode(entries).alias("e")).select("feature", "e.*")
    )


def bias_flags(gaps: DataFrame, threshold: float = MAX_DISPARITY) -> DataFrame:
    """One row per feature that has disparities: those strictly above the threshold and the verdict."""
    high = F.col("value") > threshold
    flagged = F.sort_array(F.collect_list(F.when(high, F.col("name"))))  # at most three per metric
    return (
        gaps.groupBy("feature")
        .agg(
            flagged.alias("flagged"),
            F.count_if(high).alias("n_flagged"),
            F.coalesce(F.max(F.when(high, F.col("value"))), F.lit(0.0)).alias("max_disparity"),
        )
        .withColumn("has_bias", F.col("n_flagged") > 0)
        .withColumn(
            "concern",
            F.when(F.col("has_bias"), "Potential bias detected").otherwise("No significant bias detected"),
        )
    )


def fairness_summary(groups: DataFrame) -> DataFrame:
    """``(feature, metric, min, max, mean, std)`` over groups, for features with more than one group."""
    several = groups.groupBy("feature").agg(F.count("*").alias("groups")).filter(F.col("groups") > 1)
    return _spread(groups).drop("n").join(several.select("feature"), "feature", "left_semi")
