"""Champion/challenger routing, risk levels and batch scoring."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.hashing import hash_share, row_digest
from riskframe.schemas import RISK_HIGH, RISK_MEDIUM

Scorer = Callable[[DataFrame], DataFrame]  # adds the column probability_default


@dataclass(frozen=True)
class ServedModel:
    """A scorer with the name and version that go into each prediction record."""

    name: str
    version: str
    score: Scorer
    threshold: float = 0.5


def route(
    df: DataFrame,
    challenger_pct: float,
    key: str = "loan_id",
    challenger_loaded: bool = True,
    seed: int = 0,
    request_id: str | None = None,
) -> DataFrame:
    """Add ``model_type``: the challenger serves the keys whose hash share is below its percentage.

    With a batch identifier as ``key`` a batch goes to one model as a whole. A request without a key is drawn by
    its ``request_id``, or by its content if that is not given.
    """
    if not challenger_loaded:
        return df.withColumn("model_type", F.lit("champion"))
    own = F.col(request_id).cast("string") if request_id else F.lit(None).cast("string")
    drawn = F.coalesce(F.col(key).cast("string"), own, row_digest(df))
    share = hash_share(drawn, seed)
    return df.withColumn("model_type", F.when(share < challenger_pct / 100, "challenger").otherwise("champion"))


def risk_level(probability: Column) -> Column:
    return F.when(probability > RISK_HIGH, "high").when(probability > RISK_MEDIUM, "medium").otherwise("low")


def linear_scorer(coefficients: dict[str, float], intercept: float = 0.0) -> Scorer:
    """Logistic probability of a weighted sum of columns; an absent value counts as 0."""

    def score(df: DataFrame) -> DataFrame:
        margin = F.lit(intercept)
        for c, w in coefficients.items():
            margin = margin + F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * w
        return df.withColumn("probability_default", 1 / (1 + F.exp(-margin)))

    return score


def pipeline_scorer(model) -> Scorer:
    """Scorer of a fitted ``pyspark.ml`` classification pipeline."""

    def score(df: DataFrame) -> DataFrame:
        columns = df.columns
        return model.transform(df).select(
            *columns, F.get(vector_to_array("probability"), 1).alias("probability_default")
        )

    return score


def score(
    requests: DataFrame,
    champion: ServedModel | None,
    challenger: ServedModel | None = None,
    challenger_pct: float = 0.0,
    key: str = "loan_id",
    seed: int = 0,
    request_id: str | None = None,
) -> DataFrame:
    """Requests with their prediction: each model scores the rows routed to it."""
    if champion is None:
        raise ValueError("no champion model is loaded")
    routed = route(requests, challenger_pct, key, challenger is not None, seed, request_id)
    served = {"champion": champion, **({"challenger": challenger} if challenger else {})}
    parts = []
    for model_type, model in served.items():
        rows = model.score(routed.filter(F.col("model_type") == model_type))
        p = F.col("probability_default")
        parts.append(
            rows.withColumns(
                {
                    "prediction": (p > model.threshold).cast("int"),
                    "probability_repayment": 1 - p,
                    "risk_level": risk_level(p),
                    "model_name": F.lit(model.name),
                    "model_version": F.lit(model.version),
                    "predicted_at": F.current_timestamp(),
                }
            )
        )
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def explode_batches(batches: DataFrame, column: str = "inputs") -> DataFrame:
    """One row per input of a batch request; ``position`` keeps the order of the response."""
    others = [c for c in batches.columns if c != column]
    return batches.select(*others, F.posexplode(column).alias("position", "_input")).select(*others, "position", "_input.*")


MAX_INPUTS = 1_000


def batch_responses(scored: DataFrame, batch: str, position: str = "position", max_inputs: int = MAX_INPUTS) -> DataFrame:
    """One record per batch request with its predictions in order.

    A request may hold ``max_inputs`` inputs at most. An input beyond is an error of its own row, raised before rows of
    one request are gathered.
    """
    too_many = F.raise_error(F.concat(F.lit(f"a batch request holds more than {max_inputs} inputs: position "), F.col(position)))
    place = F.when(F.col(position) < max_inputs, F.col(position)).otherwise(too_many.cast("int")).alias(position)
    details = F.struct(place, "prediction", "probability_default", "probability_repayment", "risk_level")
    return scored.groupBy(batch).agg(
        F.sort_array(F.collect_list(details)).alias("predictions"),
        F.count("*").alias("total_inputs"),
        F.first("model_name").alias("model_name"),
        F.first("model_version").alias("model_version"),
    )
