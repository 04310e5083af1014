"""SimHash near-duplicates: fingerprints, vantage-point shards, exact pairs, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import components
from riskframe.session import materialize

SHINGLE = 3
RADIUS = 2
SEED = 42
SAMPLE = 50_000
SHARD_ROWS = 10_000
LEAF = 1_024
CANDIDATES = 8
COUNT_CHUNK = 65_536


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """64-bit hashes of the word shingles in their order; one of all words if there are fewer, none without words.

    ``bytes.lower`` and ``bytes.split`` touch ASCII letters and ASCII white space only.
    """
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.dtype("<u8"))
    joined = b" ".join(words)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[:-1]]]
    width = min(shingle, len(words))
    return np.fromiter(
        (xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :])), np.dtype("<u8"), len(words) - width + 1
    )


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits; a bit is set if more than half of the shingles' hashes have it. No words: zero."""
    hashes = shingle_hashes(text, shingle)
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNT_CHUNK):
        part = hashes[at : at + COUNT_CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` with the fingerprint as a signed long; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).mapInArrow(run, "doc_id long, fp long")


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def choose_vantage(points: np.ndarray, radius: int) -> tuple[np.uint64, int] | None:
    """The vantage point and ball that send the fewest points to both sides; None if nothing is split.

    A pair on two sides of a ball of size m has its inner point in the last ``radius`` shells inside, because
    of the triangle bound |d(a, v) - d(b, v)| <= d(a, b). Only those points go to the other side too.
    """
    best = None
    for v in points[np.linspace(0, len(points) - 1, CANDIDATES).astype(int)]:
        shells = np.bincount(distance(points, v), minlength=65)
        inside = np.cumsum(shells)
        band = inside - np.concatenate([np.zeros(radius, int), inside[:-radius]])
        larger = np.maximum(inside, len(points) - inside + band)
        m = int(np.argmin(larger))
        if best is None or larger[m] < best[0]:
            best = (int(larger[m]), v, m)
    if best is None or best[0] > 0.95 * len(points):
        return None
    return best[1], best[2]


class Tree:
    """Vantage-point tree over a sample: inner nodes are (vantage, ball, left, right), leaves are shard numbers."""

    def __init__(self, sample: np.ndarray, total: int, shard_rows: int, radius: int):
        self.radius = radius
        self.nodes: list[tuple | int] = []
        self.shards = 0
        self.build(sample, total / max(len(sample), 1) if len(sample) else 1.0, shard_rows)

    def build(self, points: np.ndarray, rows_per_point: float, shard_rows: int) -> int:
        at = len(self.nodes)
        self.nodes.append(0)
        split = choose_vantage(points, self.radius) if len(points) * rows_per_point > shard_rows and len(points) >= 32 else None
        if split is None:
            self.nodes[at] = self.shards
            self.shards += 1
            return at
        v, m = split
        near = distance(points, v) <= m
        left = self.build(points[near], rows_per_point, shard_rows)
        self.nodes[at] = (v, m, left, self.build(points[~near], rows_per_point, shard_rows))
        return at

    def route(self, fps: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, row numbers): every row's own shard and the shards whose boundary it overlaps."""
        todo = [(0, np.arange(len(fps)))]
        while todo:
            at, rows = todo.pop()
            if not len(rows):
                continue
            node = self.nodes[at]
            if isinstance(node, int):
                yield node, rows
                continue
            v, m, left, right = node
            d = distance(fps[rows], v).astype(np.int16)
            todo.append((left, rows[d <= m]))
            todo.append((right, rows[d > m - self.radius]))


def local_links(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (row, row) that connect whatever is connected by pairs within ``radius`` among ``fps``.

    The same tree goes on inside the shard down to small leaves. A leaf is searched from point to point: a
    point links to all unreached points in its reach, so a dense cluster of n points costs n links, not n^2.
    """
    links: list[tuple[int, int]] = []
    todo = [np.arange(len(fps))]
    while todo:
        rows = todo.pop()
        split = choose_vantage(fps[rows], radius) if len(rows) > LEAF else None
        if split is not None:
            d = distance(fps[rows], split[0]).astype(np.int16)
            todo += [rows[d <= split[1]], rows[d > split[1] - radius]]
            continue
        values, unreached = fps[rows], np.arange(len(rows))
        while len(unreached) > 1:
            frontier, unreached = [unreached[0]], unreached[1:]
            while frontier and len(unreached):
                p = frontier.pop()
                near = distance(values[unreached], values[p]) <= radius
                if near.any():
                    hits = unreached[near]
                    unreached = unreached[~near]
                    links += [(int(rows[p]), int(rows[h])) for h in hits]
                    frontier += hits.tolist()
    return links


def near_links(distinct: DataFrame, radius: int = RADIUS, sample: int = SAMPLE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``a, b`` links between ids of ``distinct`` (``fp, id``, one row per fingerprint) that span all exact pairs.

    The upper tree is fitted on at most ``sample`` fingerprints chosen by hash; every fingerprint is routed
    through it. The sample sets the size of the shards, not the result.
    """
    total = distinct.count()
    picked = distinct.select("fp").orderBy(F.xxhash64("fp", F.lit(11)), "fp").limit(sample).collect()
    tree = Tree(np.array([r["fp"] for r in picked], np.int64).view(np.uint64), total, shard_rows, radius)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, ids = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for shard, rows in tree.route(fps.view(np.uint64)):
                columns = [pa.array(np.full(len(rows), shard, np.int64)), pa.array(fps[rows]), pa.array(ids[rows])]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "fp", "id"])

    def link(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        ids = group["id"].to_numpy()
        links = local_links(group["fp"].to_numpy().view(np.uint64), radius)
        return pd.DataFrame({"a": ids[[x for x, _ in links]], "b": ids[[y for _, y in links]]})

    routed = distinct.select("fp", "id").mapInArrow(route, "shard long, fp long, id long")
    return routed.groupBy("shard").applyInPandas(link, "a long, b long")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row: groups linked by fingerprints at most ``radius`` bits apart.

    Equal fingerprints collapse to their smallest id first, so copies cost no pairs. Components are found on
    tables of links. Null texts are empty (fingerprint 0). A row with a null id makes no links and takes the
    component of its fingerprint, null if no other row has it. Repeated ids give a row each.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash_fps")
    distinct = materialize(
        fps.filter(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash_distinct"
    )
    linked = components(near_links(distinct, radius=radius))
    groups = distinct.join(linked, distinct["id"] == linked["node"], "left").select(
        F.col("fp").alias("own"), F.coalesce("component", "id").alias("component_id")
    )
    return fps.join(groups, fps["fp"] == groups["own"], "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
