"""Best-fit packing of token pieces into sequences, certified by dual-feasible-function bounds."""

from __future__ import annotations

import json
import math
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialize

CAPACITY = 4096
END = 1
TOKENIZER = "word_bpe_49k.json"
CACHED_WORDS = 150_000
CHUNK_CHARS = 2_000_000
PIECES_PER_PART = 250_000
MAX_ROUNDS = 3


# settings under which a word's parts are encoded one by one, and the same parts of words of ASCII and Latin-1 letters
WORD_CUTS = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
LETTERS = "a-zß-öø-ÿ"
PLAIN_WORD = re.compile(f"[!-~À-ÖØ-Þ{LETTERS}]*")  # no marks to compose, one lower-case letter each
PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")


class Codes(dict):
    """Codes by word, made when first looked up. When ``CACHED_WORDS`` are held they become the old half, which goes at the next
    such time; words in use come back from it."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make = make
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        code = self.old.get(word)
        if code is None:
            code = self.make(word)
        if len(self) >= CACHED_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = code
        return code


class WordTokenizer:
    """Token ids of whole texts for a tokenizer that drops white space and never merges across it.

    Such a tokenizer gives the ids of a text as those of its words in turn, so a word is encoded when it is first met. If it is
    known to cut words (``WORD_CUTS``) and to encode each part by itself, words of ASCII and Latin-1 letters are put together from
    their parts, of which there are far fewer, and a part goes to the tokenizer's model alone.
    """

    open_tokenizers: dict[str, WordTokenizer] = {}  # of this worker process, over all its tasks

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker on every core already
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        self.in_parts = all(settings[k] == v for k, v in WORD_CUTS.items())
        self.added = re.compile("|".join(re.escape(t["content"].lower()) for t in settings["added_tokens"]) or "(?!)")
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}  # the others stand for themselves
        self.model = self.tokenizer.model
        self.parts = Codes(self.encode_part)
        self.known = Codes(self.encode_word)

    def parts_of(self, word: str) -> list[str] | None:
        if self.in_parts and PLAIN_WORD.fullmatch(word):
            lower = word.lower()
            if lower == word:
                lower = word  # a part that is the word is kept once
            if not self.added.search(lower):
                return [lower] if lower.isalpha() else PARTS.findall(lower)
        return None

    def encode_part(self, part: str) -> bytes:
        tokens = self.model.tokenize(part if part.isascii() else part.translate(self.letters))
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def encode_word(self, word: str) -> bytes:
        parts = self.parts_of(word)
        if parts is not None:
            return b"".join(map(self.parts.__getitem__, parts))
        (code,) = self.tokenizer.encode_batch_fast([word], add_special_tokens=False)
        return struct.pack(f"<{len(code)}I", *code.ids)

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        if path not in cls.open_tokenizers:
            cls.open_tokenizers[path] = cls(path)
        return cls.open_tokenizers[path]

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        for text in texts:
            words = text.replace("\n", " ").replace("\t", " ").split(" ")  # other white space stays inside words
            yield b"".join(map(self.known.__getitem__, words))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def text_chunks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of a batch, in chunks of about ``CHUNK_CHARS``."""
    ids, texts, size = [], [], 0
    for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
        ids.append(doc_id), texts.append(value.as_py())
        size += len(texts[-1])
        if size >= CHUNK_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: every text's ids and the end id, cut only if too long."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer.of(path)
        last = struct.pack("<I", end)
        for batch in batches:
            for doc_ids, texts in text_chunks(batch):
                rows = []
                for doc_id, ids in zip(doc_ids, words.ids(texts)):
                    ids += last
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: the bin and the offset of every piece, and the number of bins."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by the room they have left
    open_rooms, count = 0, 0  # bit r: some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = rooms[room].pop()
            if not rooms[room]:
                open_rooms &= ~(1 << room)
        else:
            room, own, count = capacity, count, count + 1
        bins[i], offsets[i] = own, capacity - room
        if room > size:
            rooms[room - size].append(own)
            open_rooms |= 1 << (room - size)
    return bins, offsets, count


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best of two families of dual feasible functions: no packing has fewer bins.

    U(e): sizes above C - e count as C, sizes below e as 0. u(k): x counts as floor((k + 1) x / C) / k, or
    as x / C where (k + 1) x / C is whole.
    """
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1, dtype=np.int64)
    n, words = np.cumsum(counts), np.cumsum(counts * sizes)
    e = np.arange(0, capacity // 2 + 1)
    large = n[-1] - n[capacity - e]
    middle = words[capacity - e] - np.where(e > 0, words[np.maximum(e - 1, 0)], 0)
    best = int(np.max(large + -(-middle // capacity)))
    for k in range(1, 20):
        whole = (k + 1) * sizes % capacity == 0
        value = np.where(whole, k * sizes, (k + 1) * sizes // capacity * capacity)  # in units of 1 / (k C)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def pack_parts(pieces: DataFrame, capacity: int, stage: int) -> DataFrame:
    """Packs every ``part`` by itself; ``gap`` is its number of bins above the bound."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "part"]

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        lengths = group["length"].to_numpy(np.int64)
        bins, offsets, count = best_fit(lengths, capacity)
        fill = np.bincount(bins, weights=lengths, minlength=count)
        own = (stage << 56) + (int(group["part"].iloc[0]) << 28)
        return group[columns].assign(
            sequence_id=own + bins, offset=offsets, fill=fill[bins].astype(np.int64), gap=count - lower_bound(lengths, capacity)
        )

    schema = f"{PIECE_SCHEMA}, part long, sequence_id long, offset long, fill long, gap long"
    return pieces.groupBy("part").applyInPandas(pack, schema)


PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
RESULT = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def pack_sequences(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    pieces_per_part: int = PIECES_PER_PART,
    max_rounds: int = MAX_ROUNDS,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every text.

    Pieces are dealt at random into parts of about ``pieces_per_part`` and each part is packed best-fit
    decreasing. A part is certified when it has no more bins than a dual feasible function proves
    necessary. After a round only bins that are not full of the parts with a gap, and the one emptiest bin of
    every certified part, are opened; their documents meet in new, fewer parts and are packed again. The
    work shrinks with every round; ``max_rounds`` bounds the repacking, every piece stays packed.

    Null texts are empty and give one piece, the end id. Rows that repeat an id are packed each. Extra
    columns are ignored.
    """
    path = path or tokenizer_path()
    open_pieces = materialize(token_pieces(docs.select("doc_id", "text"), path, capacity, end), "pack_pieces")
    done: list[DataFrame] = []
    last_parts = None
    for stage in range(max_rounds + 1):
        parts = max(1, math.ceil(open_pieces.count() / pieces_per_part))
        key = F.xxhash64(F.lit(stage), "doc_id", "piece", "ids_crc32")
        dealt = open_pieces.withColumn("part", F.pmod(key, F.lit(parts)))
        packed = materialize(pack_parts(dealt.repartition(parts, "part"), capacity, stage), f"pack_round{stage}")
        if stage == max_rounds or parts == 1 or parts == last_parts:
            done.append(packed)
            break
        last_parts = parts
        emptiest = packed.groupBy("part").agg(F.min(F.struct("fill", "sequence_id")).alias("least"))
        reopen = F.when(F.col("gap") > 0, F.col("fill") < capacity).otherwise(F.col("sequence_id") == F.col("least.sequence_id"))
        marked = packed.join(emptiest, "part").withColumn("reopen", reopen & (F.col("fill") < capacity))
        done.append(marked.filter(~F.col("reopen")))
        open_pieces = marked.filter("reopen").select("doc_id", "piece", "start", "length", "ids_crc32")
    out = done[0].select(*RESULT)
    for part in done[1:]:
        out = out.unionByName(part.select(*RESULT))
    return out
