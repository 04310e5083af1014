"""Near copies: SimHash links first, then every pair that shares a rare shingle; the similarity is counted on the texts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.graph import components
from riskframe.llm.simhash import near_links, shingle_hashes
from riskframe.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
SIMHASH_RADIUS = 2
LEADER_ROUNDS = 3
LEADERS = 64
COUNTER_BITS = 22  # counters of the frequency sketch, as a power of two: 16 MB in all, whatever the table's size
PARITY_WORDS = 4  # 64-bit words of parities a set
PARITY = [f"parity{i}" for i in range(PARITY_WORDS)]
BLOCK = 1 << 16
HELD = 1 << 20


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; one shingle of all words in a shorter text."""
    return np.unique(shingle_hashes(text, shingle))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; two empty sets are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def set_fingerprint(hashes: np.ndarray) -> np.int64:
    """A bit is set if more than half of the distinct shingles have it."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * bits > len(hashes), bitorder="little").view("<i8")[0]


def parities(hashes: np.ndarray) -> np.ndarray:
    """``PARITY_WORDS`` words; a bit is the parity of the number of shingles that fall on it.

    A shingle in one of two sets turns one bit, so their words differ in at most as many bits as the sets in shingles.
    """
    bits = np.bincount((hashes % np.uint64(64 * PARITY_WORDS)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8")


def counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def shingle_levels(texts: DataFrame, shingle: int) -> np.ndarray:
    """Powers of two of how often shingles occur, by counters of fixed number that shingles share by hash.

    Every task counts all its texts; the counters are added up block by block. A counter is at least as high as
    the frequency of any shingle in it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        counts, held, n = np.zeros(1 << COUNTER_BITS, np.uint32), [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(shingle_set(text.as_py(), shingle))
                n += len(held[-1])
                if n >= HELD:
                    counts += np.bincount(counter(np.concatenate(held)), minlength=len(counts)).astype(np.uint32)
                    held, n = [], 0
        if held:
            counts += np.bincount(counter(np.concatenate(held)), minlength=len(counts)).astype(np.uint32)
        blocks = [(i, counts[i * BLOCK : (i + 1) * BLOCK]) for i in range(len(counts) // BLOCK)]
        blocks = [(i, zlib.compress(b.tobytes(), 1)) for i, b in blocks if b.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in blocks], pa.int32()), pa.array([b for _, b in blocks], pa.binary())], ["block", "counts"]
        )

    def add(blocks: pa.Table) -> pa.Table:
        import zlib

        total = np.zeros(BLOCK, np.uint64)
        for b in blocks.column("counts"):
            total += np.frombuffer(zlib.decompress(b.as_py()), np.uint32)
        level = np.log2(np.maximum(total, 1)).astype(np.uint8)
        return pa.table({"block": blocks.column("block").slice(0, 1), "level": pa.array([level.tobytes()], pa.binary())})

    parts = texts.mapInArrow(count, "block int, counts binary")
    levels = np.zeros(1 << COUNTER_BITS, np.uint8)
    for r in parts.groupBy("block").applyInArrow(add, "block int, level binary").collect():  # one byte a counter
        levels[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["level"], np.uint8)
    return levels


def prefix(hashes: np.ndarray, levels: np.ndarray, least: float) -> np.ndarray:
    """The ``n - ceil(least * n) + 1`` rarest shingles, rarest first, equally rare ones by hash.

    Two sets at a similarity of ``least`` share so many shingles that, in any common order, these prefixes meet.
    """
    width = len(hashes) - math.ceil(least * len(hashes) - 1e-9) + 1
    return hashes[np.lexsort((hashes, levels[counter(hashes)]))[:width]]


def signed_rows(docs: DataFrame, id_col: str, text_col: str, shingle: int, least: float) -> DataFrame:
    """``at, row, rank, size, set, fp, parity, keys, text``: rows numbered once, with what is known of their sets."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    levels = shingle_levels(docs.select(text.alias("text")), shingle)

    @F.pandas_udf("size int, set binary, fp long, parity array<long>, keys array<long>")
    def signature(text: pd.Series) -> pd.DataFrame:
        from xxhash import xxh128_digest

        sets = [shingle_set(t, shingle) for t in text]
        return pd.DataFrame(
            {
                "size": [len(s) for s in sets],
                "set": [xxh128_digest(s.tobytes()) for s in sets],
                "fp": [set_fingerprint(s) for s in sets],
                "parity": [parities(s) for s in sets],
                "keys": [prefix(s, levels, least).view(np.int64) if len(s) else [] for s in sets],
            }
        )

    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
        signature(text).alias("own"),
        F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.md5(text).alias("md5")).alias("rank"),
    )
    rows = rows.select(F.monotonically_increasing_id().alias("at"), "row", "rank", "own.*")
    return materialize(rows, "near_rows").withColumn("text", F.coalesce(F.col("row")[text_col], F.lit("")).cast("binary"))


def similar_pairs(pairs: DataFrame, rows: DataFrame, shingle: int, least: float) -> DataFrame:
    """Those of the pairs ``a, b`` of row numbers whose texts reach the similarity.

    Only rows of some pair send their texts; below Spark's size threshold their numbers, not the texts, go to all tasks.
    """
    pairs = materialize(pairs, "near_pairs")
    met = materialize(pairs.select(F.explode(F.array("a", "b")).alias("at")).distinct(), "near_met")
    rows = rows.join(met, "at", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_last = None, np.zeros(0, np.uint64)
        for batch in batches:
            hits = []
            for i, a in enumerate(batch.column(0).to_pylist()):
                if a != last:
                    last, of_last = a, shingle_set(batch.column(2)[i].as_py(), shingle)
                if similarity(of_last, shingle_set(batch.column(3)[i].as_py(), shingle)) >= least:
                    hits.append(i)
            yield batch.select([0, 1]).take(pa.array(hits, pa.int64()))

    texts = [rows.select(F.col("at").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab"]
    met = pairs.join(texts[1], "b").join(texts[0], "a").select("a", "b", "text_a", "text_b")
    return met.mapInArrow(run, "a long, b long")


def candidates(left: DataFrame, right: DataFrame, apart: Column, least: float) -> DataFrame:
    """Distinct pairs of one bucket in different components that can reach the similarity.

    With ``place`` the shared shingle's places in the two orders, the sets have at most the shingles from there on in common
    if no earlier one is shared. Rows with the words of :func:`parities` differ in no more bits than similar sets in shingles.
    """
    sizes = F.col("l.size") + F.col("r.size")
    ahead = F.least(F.col("l.size") - F.col("l.place"), F.col("r.size") - F.col("r.place"))
    fits = (F.least("l.size", "r.size") >= (least - 1e-9) * F.greatest("l.size", "r.size")) & (
        ahead >= (least / (1 + least) - 1e-9) * sizes
    )
    if "parity0" in left.columns:
        apart_bits = sum(F.bit_count(F.col(f"l.{p}").bitwiseXOR(F.col(f"r.{p}"))) for p in PARITY)
        fits = fits & (apart_bits <= ((1 - least) / (1 + least) + 1e-9) * sizes)
    pairs = left.alias("l").join(right.alias("r"), "bucket").filter(apart & fits)
    return pairs.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).distinct()


def with_components(nodes: DataFrame, groups: DataFrame | None) -> DataFrame:
    nodes = nodes.drop("component")
    if groups is None:
        return nodes.withColumn("component", F.col("node"))
    return nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))


def grown(groups: DataFrame | None, links: DataFrame) -> DataFrame:
    """``node, component`` of the groups and of new links; only links between components are followed, once a pair."""
    if groups is None:
        return components(links)
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = groups.join(ends, "node", "full").select("node", F.coalesce("component", "node").alias("component"))
    known = materialize(known, "near_known")
    of = [known.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab"]
    between = links.join(of[0], "a").join(of[1], "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    roots = components(between).select(F.col("node").alias("component"), F.col("component").alias("root"))
    return known.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("component"))


def leaders(members: DataFrame, most: int, turn: int) -> DataFrame:
    """One member each of ``most`` components of every bucket: of the smallest component, or of ones chosen by hash."""
    by = members.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.min(F.struct(*[c for c in members.columns if c not in ("bucket", "component")])).alias("m"))
    if most == 1:
        first = by.groupBy("bucket").agg(F.min(F.struct("n", "component", "m")).alias("x"))
        return first.select("bucket", F.col("x.component").alias("component"), "x.m.*")
    order = Window.partitionBy("bucket").orderBy(F.xxhash64("component", F.lit(turn)), "component")
    few = by.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most)
    return few.select("bucket", "component", "m.*")


def mixed(members: DataFrame) -> DataFrame:
    """The members of buckets that hold several components."""
    several = members.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    return members.join(several.select("bucket"), "bucket")


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: float = SIMILARITY
) -> DataFrame:
    """The rows of ``docs`` without near copies: one row per group of texts linked by a Jaccard similarity of ``least``.

    Similarity is that of the sets of ``shingle``-word shingles (ASCII letters lowered, ASCII white space
    splits, compared by 64-bit hashes), counted in full for every candidate pair. Texts with equal sets
    collapse first. Candidates are the pairs whose SimHash fingerprints meet in the vantage-point tree, then all pairs
    that share a shingle of their prefixes, so no pair at the similarity is missed. A prefix holds a set's rarest
    shingles, by a sketch of all texts' shingles, so what many texts share is a key of hardly any.

    A bucket is compared from leaders: all members meet one member of the bucket's smallest component, in later rounds one
    each of ``LEADERS`` components, so a dense group of n costs some n pairs a round and its rows stay in tables. After
    ``LEADER_ROUNDS`` rounds what is still in different components of a bucket is compared pair by pair.

    Of a group the row with the smallest id stays, of rows that repeat that id the one with the least MD5 of
    its text, of equal rows any one. A null id comes last. Texts without words are one group; an empty table stays empty.
    """
    rows = signed_rows(docs, id_col, text_col, shingle, least)
    sets = materialize(
        rows.groupBy("set").agg(F.min(F.struct("at", "size", "fp")).alias("own"), F.min(F.struct("rank", "at")).alias("best"))
        .select(F.col("own.at").alias("node"), "own.size", "own.fp", "best"),
        "near_sets",
    )
    heads = sets.groupBy("fp").agg(F.min("node").alias("id"))
    same = sets.join(heads, "fp").filter("id < node").select(F.col("id").alias("a"), F.col("node").alias("b"))
    close = near_links(materialize(heads.select("fp", "id"), "near_fps"), radius=SIMHASH_RADIUS)
    close = close.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    own = rows.join(sets.select(F.col("node").alias("at")), "at", "left_semi")
    members = own.select(F.col("at").alias("node"), "size", F.posexplode("keys").alias("place", "bucket"))
    shared = members.withColumn("n", F.count("*").over(Window.partitionBy("bucket"))).filter("n > 1").drop("n")
    open_ = materialize(shared.withColumn("component", F.col("node")), "near_open")
    groups = None
    for turn in range(LEADER_ROUNDS + 1):
        if turn and open_.isEmpty():
            break
        if turn < LEADER_ROUNDS:
            lead = leaders(open_, 1 if turn == 0 else LEADERS, turn)
            pairs = candidates(open_, lead, F.col("l.component") != F.col("r.component"), least)
        else:
            pairs = candidates(open_, open_, F.col("l.component") < F.col("r.component"), least)
        if turn == 0:
            pairs = pairs.union(same).union(close).distinct()
        found = materialize(similar_pairs(pairs, rows, shingle, least), "near_links")
        if not found.isEmpty():
            groups = materialize(grown(groups, found), "near_groups")
        if turn == LEADER_ROUNDS:
            break
        # the leaders have met every other member; a bucket in one component is done
        rest = open_.join(lead.select("bucket", "node"), ["bucket", "node"], "left_anti")
        open_ = mixed(with_components(rest, groups))
        if turn == 0:
            words = [F.col("parity")[i].alias(p) for i, p in enumerate(PARITY)]
            open_ = open_.join(rows.select(F.col("at").alias("node"), *words), "node")
        open_ = materialize(open_, "near_open")
    component = F.col("node")
    if groups is not None:
        sets = sets.join(groups, "node", "left")
        component = F.coalesce("component", "node")
    kept = sets.groupBy(component.alias("group")).agg(F.min("best").alias("best")).select(F.col("best.at").alias("at"))
    return rows.join(kept, "at", "left_semi").select("row.*")
