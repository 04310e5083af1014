"""Quality classifier: Bradley-Terry scores from preference pairs, cut at a score quantile."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.ordered import ColumnCounts, values_at
from riskframe.llm.labelled import held_out, labelled_sample, usable_labels
from riskframe.session import materialize

PER_CLASS = 5_000
PAIRS_PER_ROW = 16
CUT = 0.7
STEPS = 30
RANKED = 50_000  # beyond so many scores only those around the cut are ranked
RIDGE = 1e-3

LETTER, UPPER, DIGIT, SPACE, STOP, BAR, OTHER = range(7)
KIND = np.full(256, OTHER, np.uint8)
KIND[[*range(97, 123), *range(128, 256)]] = LETTER
KIND[65:91] = UPPER
KIND[48:58] = DIGIT
KIND[[9, 10, 11, 12, 13, 32]] = SPACE
KIND[[ord(c) for c in ".,;:'\"()!?-"]] = STOP
KIND[[ord(c) for c in "|<>{}[]\\/_="]] = BAR
WIDTH = 15


def features(text: str) -> list[float]:
    """Shares of character kinds, repeated words and lines, lengths; of the whole text."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = np.zeros(7)
    for at in range(0, len(data), 1 << 20):
        kinds += np.bincount(KIND[data[at : at + (1 << 20)]], minlength=7)
    words = text.split()
    n, chars = max(len(words), 1), max(len(data), 1)
    counts = Counter(words)
    lines = text.split("\n")
    repeats = sum(map(eq, words, islice(words, 1, None)))
    solid = max(chars - kinds[SPACE], 1)
    return [
        math.log1p(len(words)),
        math.log1p(1000 * kinds[OTHER] / solid),
        math.log1p(1000 * kinds[BAR] / solid),
        math.log1p(1000 * kinds[DIGIT] / solid),
        math.log1p(1000 * kinds[STOP] / solid),
        kinds[UPPER] / solid,
        kinds[LETTER] / solid,
        min(solid / n, 50.0),
        len(counts) / n**0.8,
        max(counts.values(), default=0) / n,
        math.log1p(1000 * repeats / n),
        1 - len(set(lines)) / len(lines),
        math.log1p(n / len(lines)),
        float(len(words) == 0),
        float(len(words) < 10),
    ]


@dataclass
class BradleyTerry:
    """Linear scores of standardised features; ``cut`` is the score that maps to the wanted threshold."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float = 0.0
    spread: float = 1.0
    threshold: float = CUT

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, and ``threshold`` exactly at the cut."""
        shift = math.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip((self.raw(x) - self.cut) / self.spread + shift, -30, 30)))


def preference_pairs(labels: np.ndarray, per_row: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(preferred, other) row numbers: every row meets ``per_row`` drawn rows of the other label."""
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    left = np.concatenate([np.repeat(good, per_row), rng.choice(good, len(bad) * per_row)])
    right = np.concatenate([rng.choice(bad, len(good) * per_row), np.repeat(bad, per_row)])
    return left, right


def fit_bradley_terry(
    x: np.ndarray, labels: np.ndarray, quantile: float | None = None, threshold: float = CUT
) -> BradleyTerry | None:
    """Maximises the likelihood sigmoid(s(preferred) - s(other)) by Newton steps; None without both labels.

    The cut is the ``quantile`` of the fitted scores, each label weighing as its share in the rows given; by
    default the share of label 0.
    """
    if len(np.unique(labels)) < 2:
        return None
    model = BradleyTerry(x.mean(axis=0), x.std(axis=0) + 1e-6, np.zeros(x.shape[1]), threshold=threshold)
    z = np.clip((x - model.mean) / model.scale, -6, 6)
    left, right = preference_pairs(labels, PAIRS_PER_ROW)
    d = z[left] - z[right]
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(d @ model.weights, -30, 30)))
        gradient = d.T @ (1 - p) / len(d) - RIDGE * model.weights
        curvature = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(x.shape[1])
        step = np.linalg.solve(curvature, gradient)
        model.weights = model.weights + step
        if np.abs(step).max() < 1e-8:
            break
    s = np.sort(model.raw(x))
    share = float((labels == 0).mean()) if quantile is None else quantile
    at = min(max(int(round(share * len(s))), 1), len(s) - 1)
    model.cut = float((s[at - 1] + s[at]) / 2)
    model.spread = max(float(np.median(s[at:]) - model.cut) / 4, 1e-3)
    return model


def feature_rows(docs: DataFrame, extra: str, extra_schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.list_(pa.float64()))], ["doc_id", extra, "x"])

    return docs.select("doc_id", "text", extra).mapInArrow(run, f"doc_id long, {extra_schema}, x array<double>")


def set_cut(model: BradleyTerry, docs: DataFrame, labels: DataFrame, label: str, ranked: int = RANKED) -> None:
    """Moves the cut to the quantile of the share of label 0 over the scores of all usable labelled rows, sampled or not.

    Texts are scored where they lie; only ids and scores meet the labels. The scores around the cut and the
    median above it, which sets the spread, are exact order statistics.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(1)]).reshape(-1, WIDTH)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.raw(x))], ["doc_id", "raw"])

    texts = docs.filter(F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    scores = texts.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, raw double")
    scores = materialize(scores.join(usable_labels(labels, label), "doc_id").select("label", "raw"), "quality_scores")
    row = scores.agg(F.count("*").alias("n"), F.count(F.when(F.col("label") == 0, 1)).alias("n0")).first()
    n, at = row["n"], min(max(row["n0"], 1), row["n"] - 1)
    low, high = at + (n - at - 1) // 2, at + (n - at) // 2
    values = values_at(scores, {"raw": ColumnCounts(n, n)}, {"raw": {at - 1, at, low, high}}, ranked)
    model.cut = (values["raw", at - 1] + values["raw", at]) / 2
    model.spread = max(((values["raw", low] + values["raw", high]) / 2 - model.cut) / 4, 1e-3)


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> BradleyTerry | None:
    """Weights fitted on at most ``per_class`` labelled documents of either label, the cut set over all of them; both
    outside the held-out fold."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    rows = feature_rows(labelled_sample(docs, labels, label, per_class), "label", "label int").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["label"], r["x"]))
    if not rows:
        return None
    model = fit_bradley_terry(np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows]))
    if model is not None:
        set_cut(model, docs, labels, label)
    return model


def quality_udf(model: BradleyTerry | None):
    """The score as a column function of the text, for filters that keep all columns."""

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in text]).reshape(-1, WIDTH)
        return pd.Series(np.ones(len(x)) if model is None else model.score(x))

    return score


def score_quality(docs: DataFrame, model: BradleyTerry | None, threshold: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row; 1 where ``score >= threshold``.

    Scores depend on the whole text alone. A null text counts as empty and is scored like one. Without a
    model (no labelled rows of both kinds) every score is 1: nothing is known against any document.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), held_out("doc_id").alias("held_out")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(1)]).reshape(-1, WIDTH)
            s = np.ones(len(x)) if model is None else model.score(x)
            columns = [batch.column(0), batch.column(2), pa.array(s), pa.array((s >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
