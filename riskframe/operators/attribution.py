"""Additive attributions of predictions to features: linear models and tree ensembles."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from riskframe.functions.hashing import hash48
from riskframe.session import new_path

MAX_NODES = 100_000  # nodes of an ensemble that is collected and broadcast


# --- linear models ----------------------------------------------------------------------------


def background_means(df: DataFrame, columns: list[str], rows: int | None = None, key: str | None = None) -> dict:
    """Mean of each column over the table, or over the ``rows`` rows with the smallest key hash."""
    if rows is not None:
        df = df.orderBy(hash48(F.col(key).cast("string")), key).limit(rows)
    row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def linear_attributions(
    df: DataFrame, coefficients: dict[str, float], means: dict[str, float], keep: tuple[str, ...] = ()
) -> DataFrame:
    """``coef · (x − mean)`` per feature."""
    return df.select(*keep, *[((F.col(c) - F.lit(means[c])) * w).alias(c) for c, w in coefficients.items()])


def attribution_ranking(attributions: DataFrame, features: list[str]) -> DataFrame:
    """``(feature, importance)``: mean absolute attribution, in one aggregate."""
    one = attributions.agg(*[F.avg(F.abs(c)).alias(c) for c in features])
    return one.unpivot([], features, "feature", "importance")


# --- tree ensembles ---------------------------------------------------------------------------


def _leaf_paths(nodes: pd.DataFrame, positive: bool) -> list[dict]:
    """Per leaf its value and, for every feature on its path, the interval it needs and its cover share."""
    rows = {r.id: r for r in nodes.itertuples()}
    leaves: list[dict] = []

    def cover(r) -> float:
        return float(r.cover)

    stack = [(0, {})]
    while stack:
        at, path = stack.pop()
        r = rows[at]
        if r.left < 0:
            leaves.append({"value": float(r.share if positive else r.prediction), "path": path})
            continue
        if r.categories >= 0:
            raise ValueError("categorical splits are not supported; encode categories as numbers")
        for child, below in ((r.left, True), (r.right, False)):
            lo, hi, share = path.get(r.feature, (-np.inf, np.inf, 1.0))
            lo, hi = (lo, min(hi, r.threshold)) if below else (max(lo, r.threshold), hi)
            stack.append((child, {**path, r.feature: (lo, hi, share * cover(rows[child]) / cover(r))}))
    return leaves


def tree_leaves(model, max_nodes: int = MAX_NODES) -> list[list[dict]]:
    """Weighted leaf paths of every tree of a boosted or random-forest classifier.

    The trees are read from the saved form of the model. A model is small next to the data, but its size
    is checked before it is collected.
    """
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    path = new_path(spark, "trees")
    model.save(path)
    table = spark.read.parquet(f"{path}/data")
    if table.count() > max_nodes:
        raise ValueError(f"the ensemble has more than {max_nodes} nodes")
    node = F.col("nodeData")
    stats = node["impurityStats"]
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    boosted = "GBT" in type(model).__name__
    nodes = table.select(
        F.col("treeID").alias("tree"),
        node["id"].alias("id"),
        node["prediction"].alias("prediction"),
        (F.get(stats, 0) if boosted else total).alias("cover"),
        F.try_divide(F.get(stats, 1), total).alias("share"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"),
        node["split"]["numCategories"].alias("categories"),
    ).toPandas()
    weights = list(model.treeWeights)
    scale = 1.0 if boosted else 1.0 / sum(weights)
    trees = []
    for tree, part in nodes.groupby("tree"):
        leaves = _leaf_paths(part, positive=not boosted)
        trees.append([{**leaf, "value": leaf["value"] * weights[int(tree)] * scale} for leaf in leaves])
    return trees


CELLS = (4096, 1024, 256, 64)  # cells of one table, the first that keeps all tables of an ensemble below MAX_TABLES
MAX_TABLES = 8_000_000  # numbers in the tables of an ensemble


def _edges(trees: list[list[dict]]) -> dict[int, np.ndarray]:
    """The thresholds of every feature, in order."""
    found: dict[int, set[float]] = {}
    for leaf in (leaf for tree in trees for leaf in tree):
        for f, (lo, hi, _) in leaf["path"].items():
            found.setdefault(f, set()).update(x for x in (lo, hi) if np.isfinite(x))
    return {f: np.array(sorted(values)) for f, values in found.items()}


def _classes(leaves: list[dict], edges: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per feature the class of every bin, and which leaves a class lies inside of; bins of a class lie in the same leaves."""
    out = {}
    for f in sorted({f for leaf in leaves for f in leaf["path"]}):
        below, above = np.concatenate([[-np.inf], edges[f], [np.nan]]), np.concatenate([edges[f], [np.inf, np.nan]])
        inside = np.ones((len(leaves), len(below)), dtype=bool)
        for i, leaf in enumerate(leaves):
            if f in leaf["path"]:
                lo, hi, _ = leaf["path"][f]
                inside[i] = (below >= lo) & (above <= hi)
        members, of_bin = np.unique(inside, axis=1, return_inverse=True)
        out[f] = (of_bin.reshape(-1), members)
    return out


def _groups(leaves: list[dict], edges: dict[int, np.ndarray], most: int) -> Iterator[tuple[list[dict], dict | None]]:
    """Neighbouring leaves whose classes make at most ``most`` cells; a single leaf with more comes without classes."""
    pending = [leaves]
    while pending:
        part = pending.pop()
        classes = _classes(part, edges) if len(part) > 1 or 2 ** len(part[0]["path"]) <= most else None
        if classes is not None and math.prod(m.shape[1] for _, m in classes.values()) <= most:
            yield part, classes
        elif len(part) == 1:
            yield part, None
        else:
            pending += [part[: len(part) // 2], part[len(part) // 2 :]]


def _table(leaves: list[dict], classes: dict[int, tuple[np.ndarray, np.ndarray]]) -> tuple[list[int], list[np.ndarray], np.ndarray]:
    """Features, per feature the share of a bin in the cell number, and per feature the attribution in every cell."""
    features = list(classes)
    sizes = [classes[f][1].shape[1] for f in features]
    cells = np.indices(sizes).reshape(len(sizes), -1)
    strides = [math.prod(sizes[i + 1 :]) for i in range(len(sizes))]
    share = np.array([[leaf["path"].get(f, (0, 0, 1.0))[2] for f in features] for leaf in leaves])
    value = np.array([leaf["value"] for leaf in leaves])
    inside = np.stack([classes[f][1][:, cells[j]] for j, f in enumerate(features)]).astype(float)  # features x leaves x cells
    points, weights = np.polynomial.legendre.leggauss((max(len(leaf["path"]) for leaf in leaves) + 1) // 2)
    gap = inside - share.T[:, :, None]
    total = np.zeros_like(inside)
    for t, w in zip((points + 1) / 2, weights / 2):
        factor = share.T[:, :, None] + gap * t
        total += w * factor.prod(axis=0) / factor
    table = np.einsum("jlc,l->jc", total * gap, value)
    return features, [(classes[f][0] * stride).astype(np.int32) for f, stride in zip(features, strides)], table


def _packed(trees: list[list[dict]], most: tuple[int, ...] = CELLS) -> tuple[float, dict, list[tuple], list[tuple]]:
    """Base value, thresholds, tables of groups of leaves, and arrays over the leaves that fit in no table.

    The arrays are (feature, low, high, share, value), one tuple per path length.
    """
    base = sum(leaf["value"] * float(np.prod([s for _, _, s in leaf["path"].values()])) for tree in trees for leaf in tree)
    edges = _edges(trees)
    split = [[leaf for leaf in tree if leaf["path"]] for tree in trees]
    for limit in most:
        groups = [g for tree in split if tree for g in _groups(tree, edges, limit)]
        size = sum(len(c) * math.prod(m.shape[1] for _, m in c.values()) for _, c in groups if c is not None)
        if size <= MAX_TABLES:
            break
    else:
        groups = [([leaf], None) for tree in split for leaf in tree]
    tables = [_table(leaves, classes) for leaves, classes in groups if classes is not None]
    single: dict[int, list[dict]] = {}
    for leaf in (leaf for leaves, classes in groups if classes is None for leaf in leaves):
        single.setdefault(len(leaf["path"]), []).append(leaf)
    packed = []
    for leaves in single.values():
        entries = [[(f, *span) for f, span in leaf["path"].items()] for leaf in leaves]
        grid = np.array(entries, dtype=float)  # leaves × features on the path × 4
        packed.append(
            (grid[:, :, 0].astype(int), grid[:, :, 1], grid[:, :, 2], grid[:, :, 3], np.array([x["value"] for x in leaves]))
        )
    return base, edges, tables, packed


ROWS_AT_ONCE = 8192


def tree_attributions(
    model, df: DataFrame, features: str = "_features", name: str = "attributions", max_nodes: int = MAX_NODES
) -> tuple[DataFrame, float]:
    """Add an array with one attribution per feature; they and the base value sum to the prediction.

    The explained value is the margin of a boosted model and the class-1 probability of a forest.
    Attributions are path-dependent Shapley values: a leaf contributes
    ``value · Π_j (in_j if j is known else share_j)``, and the Shapley value of such a product is the
    integral over t in [0, 1] of ``(in_i − share_i) · Π_{j≠i} (share_j + (in_j − share_j) t)``, a
    polynomial that Gauss–Legendre nodes integrate exactly. Runs batch-wise on the executors. An ensemble of
    more than ``max_nodes`` nodes (a hundred trees of depth 9, about) is an error.

    A leaf asks of a feature only whether it lies in its interval. So neighbouring leaves of a tree share a table over the cells
    that their intervals cut out, filled once: a row looks up its cell and adds what stands there. Leaves on paths of so many
    features that even one of them has too many cells are integrated row by row.
    """
    from pyspark.ml.functions import vector_to_array

    spark = df.sparkSession
    base, *packed = _packed(tree_leaves(model, max_nodes))
    size = model.numFeatures
    shared = spark.sparkContext.broadcast(packed)  # bounded by max_nodes and MAX_TABLES

    def explain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        edges, tables, single = shared.value

        def looked_up(x: np.ndarray, phi: np.ndarray) -> None:
            # the number of thresholds below a value; a value in no interval at all (not a number) has a bin of its own
            bins = {f: np.where(x[:, f] > -np.inf, np.searchsorted(e, x[:, f]), len(e) + 1) for f, e in edges.items()}
            for columns, shares, table in tables:
                cell = shares[0].take(bins[columns[0]])
                for f, part in zip(columns[1:], shares[1:]):
                    cell += part.take(bins[f])
                for f, attribution in zip(columns, table):
                    phi[f] += attribution.take(cell)

        def integrated(x: np.ndarray, phi: np.ndarray) -> None:
            for feature, low, high, share, value in single:
                length = feature.shape[1]
                points, weights = np.polynomial.legendre.leggauss((length + 1) // 2)
                step = max(1, 4_000_000 // max(1, len(x) * length))
                for at in range(0, len(value), step):
                    part = slice(at, at + step)
                    f, s = feature[part], share[part]
                    seen = x[:, f]
                    inside = ((seen > low[part]) & (seen <= high[part])).astype(float)
                    total = np.zeros_like(inside)
                    for t, w in zip((points + 1) / 2, weights / 2):
                        factor = s + (inside - s) * t
                        total += w * factor.prod(axis=2, keepdims=True) / factor
                    gain = total * (inside - s) * value[part][None, :, None]
                    flat, owner = gain.reshape(len(x), -1), f.reshape(-1)
                    for i in np.unique(owner):
                        phi[i] += flat[:, owner == i].sum(axis=1)

        for batch in batches:
            rows = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            out = np.zeros((len(rows), size))
            for at in range(0, len(rows), rows_at_once):
                x = rows[at : at + rows_at_once]
                phi = np.zeros((size, len(x)))
                looked_up(x, phi)
                integrated(x, phi)
                out[at : at + rows_at_once] = phi.T
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * size)
            yield pa.ListArray.from_arrays(ends, pa.array(out.reshape(-1)))

    rows_at_once = ROWS_AT_ONCE
    # a nested function travels by value, so workers need no copy of this package
    explain.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(explain, ArrayType(DoubleType()))
    return df.withColumn(name, udf(vector_to_array(features))), base


def spread_attributions(df: DataFrame, names: list[str], column: str = "attributions") -> DataFrame:
    """The attribution array as one column per feature."""
    return df.select(*[F.get(F.col(column), i).alias(n) for i, n in enumerate(names)])
