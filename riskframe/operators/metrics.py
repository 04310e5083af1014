"""Exact evaluation of scored rows: confusion counts, reports, curves, areas, metrics by group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.ordered import running_totals

NO_VALUE = -1.0  # stands for an area that is undefined because a class is missing


def ratio(a: Column, b: Column) -> Column:
    """``a / b``, 0 when ``b`` is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion(df: DataFrame, y: str = "y", pred: str = "y_pred", keys: list[str] = ()) -> DataFrame:
    """``(keys…, tn, fp, fn, tp)`` in one pass."""
    t, p = F.col(y) == 1, F.col(pred) == 1
    aggs = [
        F.count_if(~t & ~p).alias("tn"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(t & p).alias("tp"),
    ]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def rates() -> dict[str, Column]:
    """Metrics as expressions over the confusion counts; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return {
        "accuracy": ratio(tp + tn, tn + fp + fn + tp),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1_score": ratio(2 * tp, 2 * tp + fp + fn),
    }


def binary_metrics(df: DataFrame, y: str = "y", pred: str = "y_pred", keys: list[str] = ()) -> DataFrame:
    counts = confusion(df, y, pred, keys)
    return counts.select(*keys, *[expr.alias(name) for name, expr in rates().items()])


def class_report(df: DataFrame, y: str = "y", pred: str = "y_pred") -> DataFrame:
    """``(label, precision, recall, f1_score, support)`` per class, then macro and weighted averages."""
    cells = df.groupBy(F.col(y).cast("string").alias("t"), F.col(pred).cast("string").alias("p")).agg(
        F.count("*").alias("n")
    )
    hits = F.array(
        F.struct(F.col("t").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
    )
    per_class = (
        cells.select(F.explode(hits).alias("e"), F.when(F.col("t") == F.col("p"), F.col("n")).alias("tp"))
        .groupBy("e.label")
        # the diagonal cell is exploded twice
        .agg(F.sum("e.support").alias("support"), F.sum("e.predicted").alias("predicted"), F.sum("tp").alias("tp2"))
        .withColumn("tp", F.coalesce("tp2", F.lit(0)) / 2)
        .select(
            "label",
            ratio(F.col("tp"), F.col("predicted")).alias("precision"),
            ratio(F.col("tp"), F.col("support")).alias("recall"),
            ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1_score"),
            "support",
        )
    )
    names = ["precision", "recall", "f1_score"]
    averages = per_class.agg(
        F.struct(
            F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in names], F.sum("support").alias("support")
        ).alias("macro"),
        F.struct(
            F.lit("weighted avg").alias("label"),
            *[ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in names],
            F.sum("support").alias("support"),
        ).alias("weighted"),
    )
    return per_class.unionByName(averages.select(F.explode(F.array("macro", "weighted")).alias("e")).select("e.*"))


# --- score order ------------------------------------------------------------------------------


def score_table(df: DataFrame, score: str = "p", y: str = "y", keys: list[str] = ()) -> DataFrame:
    """``(keys…, score, pos, neg)`` with running sums from the lowest score and key totals."""
    keys = list(keys)
    counts = (
        df.filter(F.col(score).isNotNull())
        .groupBy(*keys, F.col(score).alias("score"))
        .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    )
    return running_totals(counts, keys, ["score"], ["pos", "neg"])


def _at_or_above(name: str) -> Column:
    return F.col(f"total_{name}") - F.col(f"cum_{name}") + F.col(name)


def area_expr() -> Column:
    """ROC area over a score table: positives ranked above negatives, ties half; −1 for one class."""
    wins = F.sum(F.col("pos") * ((F.col("cum_neg") - F.col("neg")) + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return F.coalesce(F.try_divide(wins, pairs), F.lit(NO_VALUE))


def average_precision_expr() -> Column:
    """Step-wise average precision over a score table; −1 without positives."""
    tp, fp = _at_or_above("pos"), _at_or_above("neg")
    return F.coalesce(F.try_divide(F.sum(F.col("pos") * tp / (tp + fp)), F.sum("pos")), F.lit(NO_VALUE))


def roc_auc(df: DataFrame, score: str = "p", y: str = "y", keys: list[str] = ()) -> DataFrame:
    table = score_table(df, score, y, keys)
    return table.groupBy(*keys).agg(area_expr().alias("auc")) if keys else table.agg(area_expr().alias("auc"))


def average_precision(df: DataFrame, score: str = "p", y: str = "y") -> DataFrame:
    return score_table(df, score, y).agg(average_precision_expr().alias("avg_precision"))


def roc_curve(df: DataFrame, score: str = "p", y: str = "y") -> DataFrame:
    """``(threshold, fpr, tpr)`` for every distinct score; collinear points are kept."""
    return score_table(df, score, y).select(
        F.col("score").alias("threshold"),
        ratio(_at_or_above("neg"), F.col("total_neg")).alias("fpr"),
        ratio(_at_or_above("pos"), F.col("total_pos")).alias("tpr"),
    )


def pr_curve(df: DataFrame, score: str = "p", y: str = "y") -> DataFrame:
    """``(threshold, precision, recall)`` for every distinct score."""
    tp, fp = _at_or_above("pos"), _at_or_above("neg")
    return score_table(df, score, y).select(
        F.col("score").alias("threshold"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, F.col("total_pos")).alias("recall"),
    )


def brier_score(df: DataFrame, score: str = "p", y: str = "y") -> DataFrame:
    return df.agg(F.avg((F.col(score) - F.col(y)) * (F.col(score) - F.col(y))).alias("brier"))


def auc_gap(df: DataFrame, part: str, score: str = "p", y: str = "y") -> DataFrame:
    """Area per value of a boolean ``part`` (true: validation) and the training minus validation gap."""
    areas = roc_auc(df, score, y, [part])
    return areas.agg(
        F.max(F.when(~F.col(part), F.col("auc"))).alias("train_auc"),
        F.max(F.when(F.col(part), F.col("auc"))).alias("validation_auc"),
    ).withColumn("auc_gap", F.col("train_auc") - F.col("validation_auc"))


def long_form(wide: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """``(keys…, name, value)``; NaN is written as null."""
    doubles = wide.select(*keys, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in names])
    return doubles.unpivot(keys, names, "name", "value")


def evaluate(df: DataFrame, score: str | None = "p", y: str = "y", pred: str = "y_pred") -> DataFrame:
    """All metrics of one scored table as ``(name, value)``, report entries named ``<metric>_<class>``."""
    counts = ["tn", "fp", "fn", "tp"]
    basic = confusion(df, y, pred).withColumns(rates())
    parts = [long_form(basic, [], [*counts, *rates()])]
    if score is None:
        areas = basic.select(F.lit(NO_VALUE).alias("auc"), F.lit(NO_VALUE).alias("avg_precision"))
    else:
        areas = score_table(df, score, y).agg(area_expr().alias("auc"), average_precision_expr().alias("avg_precision"))
    parts.append(long_form(areas, [], ["auc", "avg_precision"]))
    report = long_form(class_report(df, y, pred), ["label"], ["precision", "recall", "f1_score", "support"])
    parts.append(
        report.select(F.concat_ws("_", F.replace("name", F.lit("f1_score"), F.lit("f1-score")), "label").alias("name"), "value")
    )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def by_attribute(df: DataFrame, attributes: list[str], keep: list[str]) -> DataFrame:
    """``(feature, group, keep…)``: one row per sensitive attribute that is present."""
    return (
        df.select(*keep, *[F.col(a).cast("string").alias(a) for a in attributes])
        .unpivot(keep, attributes, "feature", "group")
        .filter(F.col("group").isNotNull())
    )


def metrics_by_group(
    df: DataFrame, attributes: list[str], score: str = "p", y: str = "y", pred: str = "y_pred"
) -> DataFrame:
    """Count, accuracy, precision, recall, F1 and area per group of every attribute."""
    keys = ["feature", "group"]
    groups = by_attribute(df, attributes, [y, pred, score])
    counts = confusion(groups, y, pred, keys).withColumns(
        {"count": F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp"), **rates()}
    )
    areas = roc_auc(groups, score, y, keys)
    return counts.drop("tn", "fp", "fn", "tp").join(areas, keys, "left").fillna(NO_VALUE, ["auc"])
