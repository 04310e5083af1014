"""Model jobs: train and evaluate, audit, gate and promote."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import fairness, gates
from riskframe.operators.learning import cv_scores, scored, train, vectors
from riskframe.operators.metrics import evaluate
from riskframe.operators.registry import promote
from riskframe.operators.split import split
from riskframe.session import materialize
from riskframe.sources.sinks import append_metrics


def train_job(
    df: DataFrame,
    kind: str,
    model_path: str,
    metrics_path: str,
    run_id: str,
    target: str = "default",
    key: str = "loan_id",
    test_size: float = 0.2,
    seed: int = 42,
    folds: int = 5,
    clean: bool = True,
    clean_exclude: tuple[str, ...] = (),
    early_stop: float = 0.0,
    **params,
) -> PipelineModel:
    """Split a feature table, train on one side, evaluate on the other, cross-validate, save model and metrics.

    The cleaner learns fill values and fences from the training rows and is the model's first stage. The label travels in the row, so deduplication cannot misalign it; folds come from the training rows.
    Boosting with ``early_stop`` holds back that share of the training rows, of each class, and stops where
    they gain nothing more; the rows the model is evaluated on take no part in it.
    """
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    training, validation = split(materialize(df, "train-input"), key, target, test_size, seed)
    fitted_on, stop = split(training, key, target, early_stop, seed + 1) if early_stop else (training, None)
    model = train(
        fitted_on,
        kind,
        target,
        ignore=(key,),
        clean=clean,
        clean_exclude=clean_exclude,
        validation=stop,
        **params,
    )
    model.write().overwrite().save(model_path)
    rows = materialize(scored(model, validation, target), "scored")
    append_metrics(evaluate(rows), metrics_path, run_id, "validation")
    if folds:
        ready = model.stages[0].transform(training) if clean else training
        areas = cv_scores(vectors(ready, target, key, folds), kind, target, folds, params)
        summary = areas.agg(F.avg("auc").alias("cv_auc_mean"), F.stddev_pop("auc").alias("cv_auc_std"))
        append_metrics(summary.unpivot([], ["cv_auc_mean", "cv_auc_std"], "name", "value"), metrics_path, run_id, "cv")
    return model


def audit(
    rows: DataFrame, attributes: list[str], threshold: float = 0.1, path: str | None = None
) -> dict[str, DataFrame]:
    """Fairness tables of scored rows: groups, disparities, flags and summary; written under ``path``."""
    groups = materialize(fairness.fairness_groups(rows, attributes), "fairness")
    gaps = fairness.disparities(groups)
    tables = {
        "groups": groups,
        "disparities": gaps,
        "flags": fairness.bias_flags(gaps, threshold),
        "summary": fairness.fairness_summary(groups),
    }
    if path is not None:
        for name, table in tables.items():
            table.write.mode("overwrite").json(f"{path}/{name}")
    return tables


def promote_job(
    metrics: DataFrame, gaps: DataFrame, log_path: str, name: str, version: int, stage: str = "Staging", min_auc: float = 0.7, run_id: str | None = None
) -> None:
    """Register a version after the performance and fairness gates.

    With ``run_id`` only that run's metrics count; a run without metrics does not pass.
    """
    if run_id is not None:
        metrics = metrics.filter(F.col("run_id") == run_id)
    promote(log_path, [gates.gate_performance(metrics, min_auc), gates.gate_fairness_checks(gaps)], name, version, stage=stage)
