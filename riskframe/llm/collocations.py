"""Phrase collocations from sorted count streams: suffix order counts, prefix order meets it in lockstep."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import materialize

LEAST_COUNT = 10
KEEP_SHARE = 50  # per cent of a phrase's places inside one longer phrase that make it a part of that phrase
TOP = 2_000
SCALE = 1_000_000
UNKNOWN = "und"

# Every word of a key ends with this byte, which no word holds: keys sort as tuples of words, and all
# phrases that start with the same words are neighbours.
END = b"\t"
AFTER_END = b"\n"
RUN_WORDS = 1_000_000
BYTES_PER_RANGE = 8 << 20
MAX_RANGES = 1 << 16
KEYS_PER_RANGE = 16
SPLITTER_BYTES = 64
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
TO_BREAK = bytes(10 if b in PIECE_ENDS else b for b in range(256))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of every piece that has any: ASCII letters lowered, split at signs and line ends, then at spaces and tabs."""
    for piece in text.lower().translate(TO_BREAK).split(b"\n"):
        words = [w for w in piece.replace(b"\t", b" ").split(b" ") if w]
        if words:
            yield words


class Run:
    """A sorted run: the trigrams that end at the words gathered so far, counted, in suffix order.

    Every word of a piece ends one trigram, with empty words before the piece, so one stream holds the counts of
    all phrases: sums over its last word and its last two words are those of the shorter phrases.
    """

    def __init__(self):
        self.ids: dict[bytes, int] = {b"": 0}
        self.stream: list[int] = []

    def add(self, words: list[bytes], start: int, end: int) -> None:
        """Count the trigrams that end at ``words[start:end]``; earlier words (negative in the stream) are context."""
        ids = self.ids
        for at in (start - 2, start - 1):
            self.stream.append(-ids.setdefault(words[at], len(ids)) if at >= 0 else 0)
        self.stream += [ids.setdefault(w, len(ids)) for w in words[start:end]]

    def counted(self) -> tuple[pa.Array, np.ndarray]:
        """Keys ``last, middle, first`` word in byte order, and their counts."""
        words = [w + END for w in self.ids]
        order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ids = np.array(self.stream, np.int64)
        last = np.flatnonzero(ids[2:] > 0) + 2
        width = int(len(order)).bit_length()
        ids = rank[np.abs(ids)]
        packed, n = np.unique((ids[last] << 2 * width) | (ids[last - 1] << width) | ids[last - 2], return_counts=True)
        mask = (1 << width) - 1
        by_rank = pa.array([words[i] for i in order], pa.binary())
        parts = [by_rank.take(pa.array(packed >> s & mask)) for s in (2 * width, width, 0)]
        return pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.binary())), n


def pack(keys: pa.Array, n: np.ndarray) -> bytes:
    """A block: keys and counts as a compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([keys, pa.array(n, pa.int64())], ["key", "n"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(block).read_all()


def first_at(keys: pa.Array, bound: bytes, lo: int) -> int:
    """The first place from ``lo`` on of a key not below ``bound``."""
    hi = len(keys)
    while lo < hi:
        mid = (lo + hi) // 2
        if keys[mid].as_py() < bound:
            lo = mid + 1
        else:
            hi = mid
    return lo


def stretches(keys: pa.Array, splitters: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """``range, start, end`` of the sorted keys between the splitters."""
    start = 0
    while start < len(keys):
        place = bisect_right(splitters, keys[start].as_py())
        end = len(keys) if place == len(splitters) else first_at(keys, splitters[place], start)
        yield place, start, end
        start = end


def suffix_splitters(texts: DataFrame, n_bytes: int, ranges: int) -> list[bytes]:
    """Quantiles of the keys around byte positions that lie a fixed step apart, from a random one in every text.

    The keys that reach the driver number ``ranges * KEYS_PER_RANGE``, each cut to ``SPLITTER_BYTES``.
    """
    if ranges < 2:
        return []
    step = max(1, n_bytes // (ranges * KEYS_PER_RANGE))
    first = F.floor(F.rand(7) * F.lit(step)).cast("long")
    size = F.length("text").cast("long")
    spots = texts.select("text", first.alias("first")).filter(F.col("first") < size)
    spots = spots.select("text", F.explode(F.sequence("first", size - 1, F.lit(step).cast("long"))).alias("spot"))
    around = spots.select(F.substring(F.col("text"), (F.col("spot") - 99).cast("int"), F.lit(300)).cast("binary").alias("around"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for around in batch.column(0).to_pylist():
                words = max(pieces(around), key=len, default=[])
                at = len(words) // 2
                if words:
                    keys.append(b"".join(w + END for w in reversed([b"", b"", *words[: at + 1]][-3:]))[:SPLITTER_BYTES])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], ["key"])

    keys = sorted(r["key"] for r in around.mapInArrow(run, "key binary").collect())
    return sorted({keys[len(keys) * j // ranges] for j in range(1, ranges)}) if keys else []


def sorted_runs(texts: DataFrame, splitters: list[bytes]) -> DataFrame:
    """``range, lang, block``: every task's runs, cut at the splitters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, Run] = {}
        held = 0

        def flush():
            for lang, own in runs.items():
                keys, n = own.counted()
                rows = [(place, lang, pack(keys[a:b], n[a:b])) for place, a, b in stretches(keys, splitters)]
                for at in range(0, len(rows), 1_000):
                    columns = zip(*rows[at : at + 1_000])
                    arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.binary()))]
                    yield pa.RecordBatch.from_arrays(arrays, ["range", "lang", "block"])
            runs.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for words in pieces(text.as_py()):
                    for start in range(0, len(words), RUN_WORDS):
                        end = min(start + RUN_WORDS, len(words))
                        runs.setdefault(lang, Run()).add(words, start, end)
                        held += end - start
                        if held >= RUN_WORDS:
                            yield from flush()
                            held = 0
        yield from flush()

    return texts.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(run, "range int, lang string, block binary")


def group_sums(starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums between the starts, and which groups may go on in another range (the first and the last)."""
    edge = np.zeros(len(starts), bool)
    edge[[0, -1]] = True
    return np.add.reduceat(n, starts), edge


def phrase_counts(runs: DataFrame, least: int) -> DataFrame:
    """``lang, key, f``: phrases of one to three words found ``least`` times, in suffix order; all words under an empty key.

    The runs of one range are merged and passed once; a phrase is a stretch of its stream. Only the stretches at the
    ends of a range, a handful a range, go on in another one and are added up afterwards.
    """

    def merge(blocks: pa.Table) -> pa.Table:
        lang = blocks.column("lang")[0].as_py()
        table = pa.concat_tables([unpack(b.as_py()) for b in blocks.column("block")]).combine_chunks()
        order = pc.sort_indices(table.column("key"))
        keys = table.column("key").take(order).combine_chunks()
        n = table.column("n").take(order).to_numpy()
        new = np.ones(len(keys), bool)
        new[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        keys, n = keys.take(pa.array(starts)), np.add.reduceat(n, starts)
        words = pc.split_pattern(keys, END.decode()).flatten()
        last, middle, first = (words.take(pa.array(np.arange(i, len(words), 4))) for i in range(3))
        new1, new2 = np.ones(len(keys), bool), np.ones(len(keys), bool)
        new1[1:] = pc.not_equal(last[1:], last[:-1]).to_numpy(zero_copy_only=False)
        new2[1:] = new1[1:] | pc.not_equal(middle[1:], middle[:-1]).to_numpy(zero_copy_only=False)
        found = [(pa.array([b""], pa.binary()), np.array([n.sum()]), np.array([True]))]
        end, none = pa.scalar(END, pa.binary()), pa.scalar(b"", pa.binary())
        for starts, parts in ((np.flatnonzero(new1), (last,)), (np.flatnonzero(new2), (last, middle))):
            f, edge = group_sums(starts, n)
            there = np.array(pc.greater(pc.binary_length(parts[-1].take(pa.array(starts))), 0))
            kept = np.flatnonzero(there & (edge | (f >= least)))
            own = [p.take(pa.array(starts[kept])) for p in parts]
            joined = pc.binary_join_element_wise(*[x for p in own for x in (p, end)], none)
            found.append((joined, f[kept], edge[kept]))
        whole = np.flatnonzero(np.array(pc.greater(pc.binary_length(first), 0)) & (n >= least))
        found.append((keys.take(pa.array(whole)), n[whole], np.zeros(len(whole), bool)))
        f = np.concatenate([x[1] for x in found])
        return pa.table(
            {
                "lang": pa.array([lang] * len(f), pa.string()),
                "key": pa.concat_arrays([x[0].combine_chunks() if isinstance(x[0], pa.ChunkedArray) else x[0] for x in found]),
                "f": pa.array(f, pa.int64()),
                "edge": pa.array(np.concatenate([x[2] for x in found])),
            }
        )

    counted = materialize(runs.groupBy("range", "lang").applyInArrow(merge, "lang string, key binary, f long, edge boolean"), "phrases")
    edges = counted.filter("edge").groupBy("lang", "key").agg(F.sum("f").alias("f"))
    return counted.filter("not edge").drop("edge").union(edges.filter((F.col("f") >= least) | (F.octet_length("key") == 0)))


def routed(rows: DataFrame, splitters: list[bytes]) -> DataFrame:
    """``rows`` (``lang, key, …``) with ``range`` and ``copy``, in the order of ranges, languages and keys.

    A phrase goes to its own range and, marked as a copy, to every further range that holds longer phrases which start
    with it: at most one phrase of one and one of two words for each border.
    """
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields]
    at = rows.columns.index("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, place, copy = [], [], []
            for i, key in enumerate(batch.column(at).to_pylist()):
                low = bisect_right(splitters, key)
                high = bisect_left(splitters, key[:-1] + AFTER_END)
                for p in range(low, max(low, high) + 1):
                    take.append(i)
                    place.append(p)
                    copy.append(p > low)
            arrays = [c.take(pa.array(take, pa.int64())) for c in batch.columns]
            arrays += [pa.array(place, pa.int32()), pa.array(copy, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "range", "copy"])

    out = rows.mapInArrow(run, ", ".join([*fields, "range int", "copy boolean"]))
    return out.repartition("range").sortWithinPartitions("range", "lang", "key", "copy")


def with_right_counts(phrases: DataFrame, splitters: list[bytes]) -> DataFrame:
    """``lang, key, f, rights, longer``: phrases by their words in reading order, with the counts behind every cut.

    In suffix order a phrase's endings stand right before it. ``longer`` is the highest count of a phrase that adds
    one word in front; a row whose ``f`` is null only brings such a count from another range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, one, two = None, 0, None  # the group, its last word's count, its open phrase of two words
        for batch in batches:
            out = []
            names = batch.schema.names
            for row in zip(*[batch.column(names.index(c)).to_pylist() for c in ("range", "lang", "key", "f", "copy")]):
                place, lang, key, f, copy = row
                words = key.split(END)[:-1]
                if two and ((place, lang) != at or len(words) < 3):
                    out.append(two)
                    two = None
                at = (place, lang)
                forward = END.join(reversed(words)) + END
                if len(words) == 1:
                    one = f
                    if not copy:
                        out.append((lang, forward, f, [], 0))
                elif len(words) == 2:
                    two = (lang, forward, None if copy else f, [one], 0)
                    of_two = f
                else:
                    two = (*two[:4], max(two[4], f))
                    out.append((lang, forward, f, [of_two, one], 0))
            yield phrase_batch(out)
        if two:
            yield phrase_batch([two])

    return routed(phrases, splitters).mapInArrow(run, "lang string, key binary, f long, rights array<long>, longer long")


PHRASE_TYPES = [pa.string(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.int64()]


def phrase_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(PHRASE_TYPES)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, PHRASE_TYPES)], ["lang", "key", "f", "rights", "longer"]
    )


def least_cut(a: int, lefts: list[int], rights: list[int]) -> tuple[int, int, int]:
    """``l, r, score`` of the cut with the lowest score, the first of equal ones; whole numbers throughout."""
    best = None
    for left, right in zip(lefts, rights):
        score = SCALE * a * a // (left * right)
        if best is None or score < best[2]:
            best = left, right, score
    return best


def scored(phrases: DataFrame, splitters: list[bytes]) -> DataFrame:
    """``lang, phrase, a, l, r, score, longer`` of all phrases of two and three words.

    In prefix order a phrase's beginnings stand right before it, so the left counts of all cuts are at hand, and the
    phrases that add a word behind follow it.
    """
    names = ["lang", "phrase", "a", "l", "r", "score", "longer"]
    types = [pa.string(), pa.string(), *[pa.int64()] * 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, open_key, one, two, of_two = None, None, 0, None, 0

        def batch_of(rows):
            columns = list(zip(*rows)) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            out = []
            order = [batch.schema.names.index(c) for c in ("range", "lang", "key", "f", "rights", "longer", "copy")]
            for place, lang, key, f, rights, longer, copy in zip(*[batch.column(i).to_pylist() for i in order]):
                words = key.split(END)[:-1]
                if two and ((place, lang) != at or len(words) < 3 and key != open_key):
                    out.append(tuple(two))
                    two = None
                at = (place, lang)
                phrase = b" ".join(words).decode()
                if len(words) == 1:
                    one = f
                elif len(words) == 2:
                    if two is None:
                        two, open_key = [lang, phrase, None, None, None, None, 0], key
                    two[6] = max(two[6], longer)
                    if f is not None:
                        of_two = f
                        if not copy:
                            two[2:6] = f, *least_cut(f, [one], rights)
                else:
                    two[6] = max(two[6], f)
                    out.append((lang, phrase, f, *least_cut(f, [one, of_two], rights), 0))
            yield batch_of(out)
        if two:
            yield batch_of([tuple(two)])

    fields = "lang string, phrase string, a long, l long, r long, score long, longer long"
    parts = routed(phrases, splitters).mapInArrow(run, fields)
    # a phrase of two words whose longer phrases lie in two ranges has two rows
    return parts.groupBy("lang", "phrase").agg(*[F.max(c).alias(c) for c in names[2:]])


def prefix_splitters(phrases: DataFrame, ranges: int) -> list[bytes]:
    """Quantiles of a sample of about ``ranges * KEYS_PER_RANGE`` keys."""
    if ranges < 2:
        return []
    share = min(1.0, ranges * KEYS_PER_RANGE / max(1, phrases.count()))
    keys = phrases.sample(share, 7).select(F.substring("key", 1, SPLITTER_BYTES).alias("key")).collect()
    keys = sorted(bytes(r["key"]) for r in keys)
    return sorted({keys[len(keys) * j // ranges] for j in range(1, ranges)}) if keys else []


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST_COUNT,
    keep_share: int = KEEP_SHARE,
    top: int | None = TOP,
    bytes_per_range: int = BYTES_PER_RANGE,
) -> DataFrame:
    """The collocations of every language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase of two or three words found ``a >= least`` times inside pieces is cut after every word; with ``l`` and ``r`` the
    counts of the two parts a cut scores ``floor(10^6 a a / (l r))``, and the lowest cut counts. A phrase goes if
    one longer phrase around it is found ``keep_share`` per cent as often. ``n`` is the number of words of the language;
    ``top`` rows a language are given by score, count and phrase (None: all).

    Tasks count trigrams into sorted runs, ranges between sampled splitters merge them in suffix order, and the phrases kept
    are passed twice more, in suffix and in prefix order, where the parts of a phrase stand right before it. A word of a
    third of all places lies in several ranges, since ranges are cut by whole trigrams; a trigram of a third of
    all places is one entry a run. A range holds the distinct trigrams of about ``bytes_per_range`` of text at a
    time; beyond ``MAX_RANGES`` ranges (0.5 TB at the default) raise that size with the executors' memory.

    A null text is empty, a null language is ``und``. Texts without words and empty tables give no rows; repeated rows
    count again; other columns are ignored.
    """
    lang = F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang")
    texts = docs.select(lang, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n_bytes = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    ranges = min(MAX_RANGES, math.ceil(n_bytes / bytes_per_range))
    splitters = suffix_splitters(texts, n_bytes, ranges)
    counts = materialize(phrase_counts(sorted_runs(texts, splitters), least), "phrase_counts")
    phrases = counts.filter(F.octet_length("key") > 0)
    forward = materialize(with_right_counts(phrases, splitters), "phrases_forward")
    found = scored(forward, prefix_splitters(forward, ranges))
    kept = found.filter(100 * F.col("longer") < keep_share * F.col("a"))
    by_lang = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(by_lang))
    if top is not None:
        best = best.filter(F.col("rank") <= top)
    words = counts.filter(F.octet_length("key") == 0).select("lang", F.col("f").alias("n"))
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
