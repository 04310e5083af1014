"""Language identification by compression: the language whose dictionary makes the text smallest."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.labelled import fold, held_out

UNKNOWN = "und"
FOLDS = 5
HELD_OUT = 0
SAMPLE_TEXTS = 100
SAMPLE_CHARS = 2_000
DICTIONARY_BYTES = 131_072
MAX_LANGUAGES = 500
BLOCK = 4_096
LEVEL = 6
MARGIN = 0.02


NO_LETTERS = bytes(i for i in range(128) if not chr(i).isalpha() and not chr(i).isspace())


def plain(text: str) -> bytes:
    """Lower-case words without ASCII digits and signs: case, tables and noise say nothing about the language."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(None, NO_LETTERS).split())


def fit_dictionaries(
    docs: DataFrame, sample_texts: int = SAMPLE_TEXTS, sample_chars: int = SAMPLE_CHARS, size: int = DICTIONARY_BYTES
) -> dict[str, bytes]:
    """The languages, those with more labelled rows first, and raw content per language: ``sample_texts`` labelled texts chosen by a hash of the id, outside the held-out fold.

    The sample is bounded by its parameters: of a sampled text one block of at most ``sample_chars`` characters, at a
    place that a hash of the id chooses anywhere in the text, and ``size`` bytes a language. More than
    ``MAX_LANGUAGES`` languages are an error.
    """
    labelled = docs.filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold("doc_id", FOLDS) != HELD_OUT)
    )
    places = F.greatest(F.length("text") - sample_chars + 1, F.lit(1))
    start = F.pmod(F.xxhash64("doc_id", F.lit(5)), places).cast("int") + 1
    block = F.substring(F.col("text"), start, F.lit(sample_chars))
    rows = labelled.select("lang", "doc_id", block.alias("text"), F.xxhash64("doc_id", F.lit(3)).alias("h"))
    order = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    picked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample_texts)
    languages = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    content: dict[str, list[bytes]] = {r["lang"]: [] for r in languages}
    for r in sorted(picked.collect(), key=lambda r: -r["rank"]):
        content[r["lang"]].append(plain(r["text"]))
    return {lang: b" ".join(texts)[-size:] for lang, texts in content.items()}


class Coder:
    """Sizes of a text under every language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        import zstandard as zstd

        self.languages = list(dictionaries)
        self.coders = []
        for lang in self.languages:
            own = zstd.ZstdCompressionDict(dictionaries[lang], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=level)
            self.coders.append(zstd.ZstdCompressor(dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        """Blocks are coded apart, so that the dictionary counts as much at the end of a long text as at its start."""
        text = plain(text)
        blocks = [text[at : at + BLOCK] for at in range(0, max(len(text), 1), BLOCK)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.coders]


def predict_language(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted`` per row.

    ``lang_pred`` is the language of the smallest encoding, ties to the one with
    more labelled rows; ``und`` if the text is
    null, has no letter, or no language was learned. ``score`` is the probability of that language when sizes
    are read as code lengths (bytes). ``accepted`` is false when the second size is within ``margin`` of the
    first, or the prediction is ``und``. Only the text is looked at, all of it.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"),
        held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(dictionaries)
        for batch in batches:
            names, scores, accepted = [], [], []
            for value in batch.column(1):
                text = value.as_py()
                if text is None or not coder.languages:
                    names.append(UNKNOWN), scores.append(0.0), accepted.append(False)
                    continue
                sizes = coder.sizes(text)
                best = min(sizes)
                second = min(sizes[: (i := sizes.index(best))] + sizes[i + 1 :], default=2 * best)
                names.append(coder.languages[i])
                scores.append(1 / sum(2.0 ** max(best - s, -1000) for s in sizes))
                accepted.append(second - best >= margin * best)
            columns = [batch.column(0), batch.column(2), pa.array(names), pa.array(scores, pa.float64()), pa.array(accepted)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score", "accepted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")


def identify_language(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Learn the dictionaries from the documents' own ``lang`` and predict every row."""
    return predict_language(docs, fit_dictionaries(docs), margin)
