"""Removal of repeated byte strings by a distributed, common-prefix-aware merge sort of suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier in the corpus. Not every suffix is
sorted: each window of ``LENGTH`` bytes elects the position of its least ``PREFIX``-byte hash, so equal windows
elect the same place and only elected suffixes (about one in 35) have to meet. Elected suffixes whose prefix is
nowhere repeated are left out before any text is moved. Hashes only choose; every repeat is decided by bytes.

1. Elect suffixes, find the repeated prefixes (hashes in buckets, one entry per run and hash).
2. Per task: sort the remaining suffixes with their left contexts into runs, collapse equal ones, front-code the
   runs and cut them at range splitters.
3. Per range: merge the runs with a loser tree that starts every comparison behind the known common prefix.
   The common prefixes that fall out of the merge are the classes of equal windows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 100
PREFIX = 32
LEFT = LENGTH - PREFIX
FULL = LENGTH + LEFT
PAD = 0xFF  # never a byte of UTF-8
CHUNK = 1 << 18
RUN_ANCHORS = 500_000
RUN_SUFFIXES = 50_000
BUCKET_BYTES = 1 << 25
RANGE_BYTES = 1 << 24
MAX_SPLITTERS = 1 << 16
SAMPLE_PER_RANGE = 32
ANCHORS_PER_RANGE = RANGE_BYTES // 35

MIX = np.uint64(0x9E3779B97F4A7C15)
FACTORS = [np.uint64(f) for f in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


# --- election of suffixes -------------------------------------------------------------------------------------


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``PREFIX`` bytes from every position, by doubling the hashed length; odd, so never 0."""
    h = data.astype(np.uint64) * MIX
    width = 1
    for f in FACTORS:
        h = h[:-width] * f + h[width:]
        h ^= h >> np.uint64(29)
        width *= 2
    h *= MIX
    return h ^ (h >> np.uint64(32)) | np.uint64(1)


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over ``values[i : i + width]``."""
    have = 1
    while have * 2 <= width:
        values = pick(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return pick(values[:-rest], values[rest:]) if rest else values


def elected(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes that some window elects; ``starts`` marks where a window may begin."""
    window = LENGTH - PREFIX + 1
    hashes = prefix_hashes(data)
    least = np.where(starts[: len(hashes) - window + 1], sliding(hashes, window, np.minimum), np.uint64(0))
    padding = np.zeros(window - 1, np.uint64)
    reach = sliding(np.concatenate([padding, least, padding]), window, np.maximum)
    at = np.flatnonzero((reach == hashes) & (hashes != 0))
    return at, hashes[at]


def chunks(texts: list[bytes]) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Texts joined into chunks of about ``CHUNK`` bytes; parts are (text number, offset in the text, length).

    A long text is cut into parts that overlap by one byte less than a window, so that each window lies in one.
    """
    parts, size, pieces = [], 0, []
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - LENGTH + 1, 0), CHUNK):
            piece = text[at : at + CHUNK + LENGTH - 1]
            parts.append((i, at, len(piece)))
            pieces.append(piece)
            size += len(piece)
            if size >= CHUNK:
                yield parts, b"".join(pieces)
                parts, size, pieces = [], 0, []
    if parts:
        yield parts, b"".join(pieces)


def anchors(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, position, hash) of the elected suffixes."""
    for parts, joined in chunks(texts):
        data = np.frombuffer(joined, np.uint8)
        numbers, offsets, lengths = (np.array(x, np.int64) for x in zip(*parts))
        ends = np.cumsum(lengths)
        starts = np.ones(len(data), bool)
        for end, length in zip(ends.tolist(), lengths.tolist()):
            starts[max(end - LENGTH + 1, end - length) : end] = False
        at, hashes = elected(data, starts)
        part = np.searchsorted(ends, at, "right")
        yield numbers[part], at - (ends - lengths)[part] + offsets[part], hashes


def blob(*arrays: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpack(data: bytes, n: int, types: list[str]) -> tuple[list[np.ndarray], bytes]:
    out, at = [], 0
    for t in types:
        out.append(np.frombuffer(data, t, n, at))
        at += n * np.dtype(t).itemsize
    return out, data[at:]


BLOBS = "cell long, kind int, n int, data binary"
PROBE, FOUND, RUN, REMOVED = range(4)


def blob_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["cell", "kind", "n", "data"])


def probe_rows(docs: np.ndarray, at: np.ndarray, hashes: np.ndarray, buckets: int) -> list[tuple]:
    """What a run of anchors sends: every hash once; hashes repeated inside the run are known as repeated here."""
    hashes = (hashes ^ (hashes >> np.uint64(29))) * FACTORS[0]  # elected hashes are small ones: spread them again
    order = np.argsort(hashes, kind="stable")
    docs, at, hashes = docs[order], at[order], hashes[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    count = np.diff(np.append(first, len(hashes)))
    repeated = np.repeat(count > 1, count)
    rows = []
    if repeated.any():
        own = int(hashes[0] % np.uint64(buckets))
        rows.append((own, FOUND, int(repeated.sum()), blob(docs[repeated], at[repeated].astype(np.int32))))
    known = np.where(count > 1, -1, at[first]).astype(np.int32)
    bucket = ((hashes[first] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)  # ascending, as the hashes are
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        s = slice(edges[b], edges[b + 1])
        rows.append((b, PROBE, int(edges[b + 1] - edges[b]), blob(hashes[first][s], docs[first][s], known[s])))
    return rows


def probe_anchors(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for numbers, at, hashes in anchors(batch.column(1).to_pylist()):
                held.append((ids[numbers], at, hashes))
                size += len(at)
                if size >= RUN_ANCHORS:
                    yield blob_batch(probe_rows(*map(np.concatenate, zip(*held)), buckets))
                    held, size = [], 0
        if size:
            yield blob_batch(probe_rows(*map(np.concatenate, zip(*held)), buckets))

    return docs.mapInArrow(run, BLOBS)


def repeated_anchors(group: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, at) of anchors whose hash occurs more than once; an entry with position -1 stands for several."""
    docs, at = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
    probes = []
    for kind, n, data in zip(group["kind"], group["n"], group["data"]):
        if kind == FOUND:
            (d, a), _ = unpack(data, n, ["<i8", "<i4"])
            docs.append(d), at.append(a)
        else:
            probes.append(unpack(data, n, ["<u8", "<i8", "<i4"])[0])
    if probes:
        h, d, a = (np.concatenate(x) for x in zip(*probes))
        order = np.argsort(h, kind="stable")
        h, d, a = h[order], d[order], a[order]
        same = h[1:] == h[:-1]
        hit = (np.append(same, False) | np.append(False, same)) & (a >= 0)
        docs.append(d[hit]), at.append(a[hit])
    return pd.DataFrame({"doc_id": np.concatenate(docs), "at": np.concatenate(at)})


# --- sorted, front-coded runs ---------------------------------------------------------------------------------


def contexts(text: bytes, at: np.ndarray) -> np.ndarray:
    """Rows of ``LENGTH`` bytes from every position and the ``LEFT`` bytes before it in reverse, padded."""
    data = np.full(len(text) + LEFT + LENGTH, PAD, np.uint8)
    data[LEFT : LEFT + len(text)] = np.frombuffer(text, np.uint8)
    shift = np.concatenate([np.arange(LENGTH), -1 - np.arange(LEFT)])
    return data[at[:, None] + (shift + LEFT)]


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def reach(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the text to the left and to the right that a row holds."""
    return (rows[:, LENGTH:] != PAD).sum(axis=1), (rows[:, :LENGTH] != PAD).sum(axis=1)


def whole_span(rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the windows around equal contexts cover; empty where no window fits."""
    left, right = reach(rows)
    fits = left + right >= LENGTH
    return np.where(fits, at - left, 0), np.where(fits, at + right, 0)


def merged(docs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of a document become one."""
    keep = ends > starts
    docs, starts, ends = docs[keep], starts[keep], ends[keep]
    if not len(docs):
        return docs, starts, ends
    order = np.lexsort((starts, docs))
    docs, starts, ends = docs[order], starts[order], ends[order]
    new_doc = np.concatenate([[True], docs[1:] != docs[:-1]])
    lift = np.cumsum(new_doc) * (int(ends.max()) + 1)  # each document on a stretch of its own
    furthest = np.maximum.accumulate(ends + lift)
    new = np.concatenate([[True], (starts + lift)[1:] > furthest[:-1]]) | new_doc
    first = np.flatnonzero(new)
    return docs[first], starts[first], (furthest - lift)[np.append(first[1:], len(docs)) - 1]


def removed_blob(docs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[int, bytes]:
    docs, starts, ends = merged(docs, starts, ends)
    return len(docs), blob(docs.astype("<i8"), starts.astype("<i4"), ends.astype("<i4"))


def cells_of(rows: np.ndarray, splitters: np.ndarray, sub: int) -> np.ndarray:
    """The range of every row's prefix, in ``sub`` parts by a hash where splitters are fewer than ranges."""
    prefix = np.ascontiguousarray(rows[:, :PREFIX])
    cell = np.searchsorted(splitters, prefix.view(f"S{PREFIX}").ravel(), "right") if len(splitters) else np.zeros(len(rows), np.int64)
    if sub == 1:
        return cell
    h = (prefix.view("<u8") * np.array(FACTORS[: PREFIX // 8])).sum(axis=1, dtype=np.uint64) * MIX
    return cell * sub + ((h >> np.uint64(33)) % np.uint64(sub)).astype(np.int64)


def run_rows(rows: np.ndarray, docs: np.ndarray, at: np.ndarray, splitters: np.ndarray, sub: int) -> list[tuple]:
    """A sorted run cut by range, equal contexts collapsed to their earliest, front-coded."""
    cell = cells_of(rows, splitters, sub)
    order = np.lexsort((at, docs))
    order = order[np.argsort(rows[order].view(f"S{FULL}").ravel(), kind="stable")]
    order = order[np.argsort(cell[order], kind="stable")]
    rows, docs, at, cell = rows[order], docs[order], at[order], cell[order]
    lcp = np.concatenate([[0], common_prefix(rows[1:], rows[:-1])])
    lcp[np.concatenate([[True], cell[1:] != cell[:-1]])] = 0
    first = lcp < FULL
    out = []
    leader = np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))
    later = ~first & ((docs != docs[leader]) | (at != at[leader]))
    if later.any():
        n, data = removed_blob(docs[later], *whole_span(rows[later], at[later]))
        out.append((int(cell[0]), REMOVED, n, data))
    rows, docs, at, cell, lcp = rows[first], docs[first], at[first], cell[first], lcp[first]
    edges = np.append(np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])), len(cell))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        tails = rows[a:b][np.arange(FULL) >= lcp[a:b, None]]
        data = blob(docs[a:b].astype("<i8"), at[a:b].astype("<i4"), lcp[a:b].astype(np.uint8), tails)
        out.append((int(cell[a]), RUN, b - a, data))
    return out


def sorted_runs(texts: DataFrame, splitters: np.ndarray, sub: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc_id, text, at in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                text = text.as_py()
                positions = np.unique(at.values.to_numpy(zero_copy_only=False)).astype(np.int64)
                positions = positions[positions < len(text)]
                for i in range(0, len(positions), RUN_SUFFIXES):
                    own = positions[i : i + RUN_SUFFIXES]
                    held.append((contexts(text, own), np.full(len(own), doc_id, np.int64), own))
                    size += len(own)
                    if size >= RUN_SUFFIXES:
                        yield blob_batch(run_rows(*map(np.concatenate, zip(*held)), splitters, sub))
                        held, size = [], 0
        if size:
            yield blob_batch(run_rows(*map(np.concatenate, zip(*held)), splitters, sub))

    return texts.mapInArrow(run, BLOBS)


# --- merge ----------------------------------------------------------------------------------------------------


def decode(lcps: np.ndarray, tails: bytes) -> list[bytes]:
    out, at, last = [], 0, b""
    for l in lcps.tolist():
        end = at + FULL - l
        last = last[:l] + tails[at:end]
        out.append(last)
        at = end
    return out


def mismatch(a: bytes, b: bytes, at: int) -> int:
    """The first position from ``at`` on where the strings differ, or their length."""
    if a == b:
        return FULL
    while a[at : at + 16] == b[at : at + 16]:
        at += 16
    while a[at] == b[at]:
        at += 1
    return at


def merge_runs(runs: list[list[bytes]], lcps: list[list[int]]) -> Iterator[tuple[int, int, int]]:
    """(run, index, common prefix with the string before) in sorted order, by a loser tree.

    Every waiting string knows its common prefix with the last winner. Of two strings the one that shares more
    with the last winner is smaller, without a look at it; only at equal shares bytes are compared, from
    there on, and the loser keeps its common prefix with the string that beat it.
    """
    k = len(runs)
    heads: list[bytes | None] = [r[0] for r in runs]
    known, at, losers = [0] * k, [0] * k, [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        same = mismatch(x, y, known[a])
        if same == FULL or x[same] < y[same]:
            known[b] = same
            return a, b
        known[a] = same
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if k > 1 else 0
    while heads[winner] is not None:
        i = at[winner]
        yield winner, i, known[winner]
        at[winner] = i = i + 1
        if i < len(runs[winner]):
            heads[winner], known[winner] = runs[winner][i], lcps[winner][i]
        else:
            heads[winner] = None
        node = (winner + k) >> 1
        while node:
            winner, losers[node] = play(winner, losers[node])
            node >>= 1


def repeats(rows: np.ndarray, lcp: np.ndarray, docs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the windows that also start earlier, from contexts in sorted order and their common prefixes.

    Equal contexts first: all but the earliest are covered. Then, among different contexts with one prefix,
    for each distance t of a window's start to the left of the anchor: windows are equal if the suffixes agree
    on LENGTH - t bytes and the left contexts on t. Both are classes of neighbours in a sorted order, read off
    the common prefixes.
    """
    rank_order = np.lexsort((at, docs))
    new = np.concatenate([[True], (docs[rank_order][1:] != docs[rank_order][:-1]) | (at[rank_order][1:] != at[rank_order][:-1])])
    rank = np.empty(len(docs), np.int64)
    rank[rank_order] = np.cumsum(new)
    group = np.cumsum(lcp < FULL) - 1
    first_rank = np.full(group[-1] + 1, len(docs) + 1)
    np.minimum.at(first_rank, group, rank)
    later = rank > first_rank[group]
    out = [(docs[later], *whole_span(rows[later], at[later]))]
    # one row per context, its earliest occurrence
    order = np.lexsort((rank, group))
    one = order[np.concatenate([[True], group[order][1:] != group[order][:-1]])]
    right_lcp = np.minimum(lcp[lcp < FULL], LENGTH)
    prefix = np.cumsum(right_lcp < PREFIX)
    shared = np.bincount(prefix)[prefix] > 1
    one, right_lcp, prefix = one[shared], right_lcp[shared], prefix[shared]
    if len(one):
        rows, docs, at, rank = rows[one], docs[one], at[one], rank[one]
        left, right = reach(rows)
        lefts = np.ascontiguousarray(rows[:, LENGTH:])
        by_left = np.argsort(lefts.view(f"S{LEFT}").ravel(), kind="stable")
        by_left = by_left[np.argsort(prefix[by_left], kind="stable")]
        left_lcp = np.concatenate([[-1], common_prefix(lefts[by_left][1:], lefts[by_left][:-1])])
        left_lcp[np.concatenate([[True], prefix[by_left][1:] != prefix[by_left][:-1]])] = -1
        least, most = np.full(len(one), LENGTH), np.full(len(one), -1)
        left_class = np.empty(len(one), np.int64)
        early = np.argsort(rank, kind="stable")
        for t in range(LEFT + 1):
            left_class[by_left] = np.cumsum(left_lcp < t)
            key = np.cumsum(right_lcp < LENGTH - t) * (len(one) + 1) + left_class
            valid = early[(left[early] >= t) & (right[early] >= LENGTH - t)]
            if not len(valid):
                continue
            _, first, inverse = np.unique(key[valid], return_index=True, return_inverse=True)
            hit = valid[rank[valid] > rank[valid[first[inverse]]]]
            least[hit] = np.minimum(least[hit], t)
            most[hit] = t
        hit = most >= 0
        out.append((docs[hit], at[hit] - most[hit], at[hit] - least[hit] + LENGTH))
    return tuple(np.concatenate(x) for x in zip(*out))


def merge_range(group: pd.DataFrame) -> pd.DataFrame:
    found, runs, lcps, docs, at = [], [], [], [], []
    for kind, n, data in zip(group["kind"], group["n"], group["data"]):
        if kind == REMOVED:
            found.append(unpack(data, n, ["<i8", "<i4", "<i4"])[0])
        else:
            (d, a, l), tails = unpack(data, n, ["<i8", "<i4", "u1"])
            runs.append(decode(l, tails)), lcps.append(l.tolist()), docs.append(d), at.append(a)
    if runs:
        picked = np.fromiter(((r, i, l) for r, i, l in merge_runs(runs, lcps)), np.dtype("i8,i8,i8"), sum(map(len, runs)))
        base = np.cumsum([0, *map(len, runs)])[:-1]
        order = base[picked["f0"]] + picked["f1"]
        rows = np.frombuffer(b"".join(b"".join(r) for r in runs), np.uint8).reshape(-1, FULL)[order]
        docs, at = np.concatenate(docs)[order], np.concatenate(at).astype(np.int64)[order]
        found.append(repeats(rows, picked["f2"], docs, at))
    spans = merged(*(np.concatenate([np.asarray(f[i], np.int64) for f in found]) for i in range(3)))
    return pd.DataFrame(dict(zip(["doc_id", "start", "end"], spans)))


# --- operator -------------------------------------------------------------------------------------------------


def range_splitters(docs: DataFrame, ranges: int, anchors_per_range: int) -> np.ndarray:
    """Prefixes that cut the elected suffixes of a sample of documents, chosen by hash, into equal ranges."""
    every = max(1, anchors_per_range // SAMPLE_PER_RANGE)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [
                texts[i][p : p + PREFIX] for numbers, at, hashes in anchors(texts)
                for i, p in zip(numbers[(hashes >> np.uint64(20)) % every == 0].tolist(), at[(hashes >> np.uint64(20)) % every == 0].tolist())
            ]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["p"])

    sample = sorted(bytes(r["p"]) for r in docs.mapInArrow(prefixes, "p binary").distinct().collect())
    cuts = [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []
    return np.array(sorted(set(cuts)), f"S{PREFIX}")


def repeated_spans(docs: DataFrame, range_bytes: int = RANGE_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, start, end`` byte spans, not yet merged across ranges, of ``docs`` (``doc_id``, binary ``text``)."""
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(1, math.ceil(total / range_bytes))
    cut = min(ranges, MAX_SPLITTERS)
    splitters = range_splitters(docs, cut, max(range_bytes // 35, 1)) if cut > 1 else np.array([], f"S{PREFIX}")
    buckets = max(1, math.ceil(total / bucket_bytes))
    marked = (
        probe_anchors(docs, buckets)
        .groupBy("cell")
        .applyInPandas(repeated_anchors, "doc_id long, at int")
        .groupBy("doc_id")
        .agg(F.collect_list("at").alias("at"))
    )
    texts = docs.join(marked.hint("shuffle_hash"), "doc_id")
    runs = sorted_runs(texts.select("doc_id", "text", "at"), splitters, math.ceil(ranges / cut))
    return runs.groupBy("cell").applyInPandas(merge_range, "doc_id long, start long, end long")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row; with ``with_text`` also the kept ``text`` (binary).

    Texts are UTF-8 bytes; a null text is empty, a text shorter than ``LENGTH`` loses nothing. The earlier of two
    equal strings is the one with the smaller id, or the smaller start. All null ids count as the one smallest
    id. Rows that share an id share its spans: strings at the same place of the same id are not earlier than
    each other, and if the texts differ, spans found in one are cut from each. Extra columns are ignored.
    """
    smallest = F.lit(-(2**63))
    base = docs.select(
        F.coalesce(F.col(id_col).cast("long"), smallest).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    spans = (
        repeated_spans(base)
        .groupBy("doc_id")
        .agg(F.collect_list("start").alias("starts"), F.collect_list(F.col("end")).alias("ends"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, starts, ends in zip(*(batch.column(i) for i in range(4))):
                text, kept, at, removed, runs = text.as_py(), [], 0, 0, 0
                if starts.is_valid:
                    s, e = (np.asarray(x.values.to_numpy(zero_copy_only=False), np.int64) for x in (starts, ends))
                    e = np.minimum(e, len(text))
                    for a, b in zip(*(x.tolist() for x in merged(np.zeros(len(s), np.int64), s, e)[1:])):
                        kept.append(text[at:a])
                        at, removed, runs = b, removed + b - a, runs + 1
                left = b"".join([*kept, text[at:]])
                rows.append((doc_id.as_py(), len(text), removed, runs, hashlib.sha256(left).hexdigest(), left if with_text else None))
            columns = list(zip(*rows)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    out = base.join(spans.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "starts", "ends").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text binary"
    )
    out = out.withColumn("doc_id", F.when(F.col("doc_id") != smallest, F.col("doc_id")))
    return out if with_text else out.drop("text")
