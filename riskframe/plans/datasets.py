"""Dataset jobs: build training and test sets, build reference sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.operators import clean, features
from riskframe.operators.split import mark_test
from riskframe.operators.versioning import narrowed
from riskframe.session import materialize
from riskframe.sources.loans import scan_loans
from riskframe.sources.sinks import write_processed


def build_features(
    df: DataFrame, exclude: tuple[str, ...] = (), target: str = "default", keep_status: bool = False
) -> DataFrame:
    """Clean (target left uncapped), derive features and target; drop the status the target came from."""
    cleaned = clean.clean_loans(df, exclude=(*exclude, target, "Default"))
    out = features.apply_features(cleaned)
    return out if keep_status else out.drop("loan_status")


def build_dataset(
    spark: SparkSession,
    source: str,
    destination: str,
    fmt: str = "csv",
    schema=None,
    test_size: float = 0.2,
    seed: int = 42,
    key: str = "loan_id",
    target: str = "default",
) -> dict[str, str]:
    """Scan, clean, featurize, split and write train, test and full sets with the feature names."""
    frame = build_features(scan_loans(spark, source, fmt, schema), exclude=(key,), target=target)
    stratify = target if target in frame.columns else None
    marked = materialize(mark_test(frame, key, stratify, test_size, seed, "_test"), "features")
    return write_processed(marked, destination, "_test", target)


def reference_features(df: DataFrame, exclude: tuple[str, ...] = (), infer_types: bool = False) -> DataFrame:
    """Reference set of engineered features with the target; ``infer_types`` narrows text that holds numbers."""
    out = features.apply_features(clean.clean_loans(df, exclude))
    return narrowed(out) if infer_types else out


def reference_encoded(df: DataFrame, target: str = "default", key: str | None = None) -> DataFrame:
    """Reference set of label-encoded, scaled features without the target."""
    keys = (key,) if key else ()
    cleaned = clean.clean_loans(df.drop(target), exclude=keys)
    text = clean.string_columns(cleaned, keys)
    coded = materialize(clean.encode_labels(cleaned, clean.fit_labels(cleaned, text), text), "coded")
    return clean.scale(coded, clean.fit_scaler(coded, clean.numeric_columns(coded, keys)))
