"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Patterns find the protected entities. Corpus co-occurrence then says how much a word next to an entity gives
away of it: the pointwise mutual information of word and entity over the entity's own information. Words
beyond one threshold are generalised, beyond a higher one removed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialize

# The patterns as specified, written without backtracking or rescans so that long runs of digits or name
# characters take linear time: possessive repeats where nothing shorter could match, and a start inside a
# run only right after the previous match.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDED = {"email": "@", "ip": ".", "phone": "+"}  # a text without the character has no match
WORD = r"[\p{L}\p{N}]{3,}"
SPAN = "array<struct<start:int,end:int,value:string>>"
TAGGED = "array<struct<kind:string,start:int,end:int,value:string>>"


@dataclass(frozen=True)
class Disclosure:
    """Thresholds: the share of an entity's information that a word may give away.

    ``context`` characters on either side of an entity are searched for words; ``support`` is the least number
    of different texts in which a word stands next to the entity.
    """

    context: int = 48
    support: int = 2
    generalise: float = 0.75
    remove: float = 0.95


def matches(text: Column, pattern: str, wanted: Callable[[Column], Column] | None = None) -> Column:
    """``array<struct<start, end, value>>`` of the matches (those whose span is ``wanted``), in code points, from the
    pieces between them.

    The fold carries only what it keeps, so the many matches that are not wanted cost linear time.
    """
    pieces = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["piece"])
        end = start + F.length(pair["value"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        out = F.array_append(state["out"], span)
        if wanted is not None:
            out = F.when(F.coalesce(wanted(span), F.lit(False)), out).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    pairs = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(values)), values, lambda p, v: F.struct(p.alias("piece"), v.alias("value"))
    )
    return F.when(F.size(values) > 0, F.aggregate(pairs, zero, step, lambda s: s["out"])).otherwise(F.array().cast(SPAN))


def luhn(digits: Column) -> Column:
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        # the cast is safe: three digits at most
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(F.substring(p, 1, 3).try_cast("int"), F.lit(0)) <= 255))
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(F.substring(digits, 1, 19))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Spans of all kinds, ``array<struct<kind, start, end, value>>``, by kind as listed and by start."""

    def valid_span(kind: str) -> Callable[[Column], Column]:
        return lambda s: valid(kind, s["value"])

    def tag(kind: str) -> Callable[[Column], Column]:
        return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"], s["end"], s["value"])

    kinds = []
    for kind, pattern in PATTERNS.items():
        tagged = F.transform(matches(text, pattern, valid_span(kind)), tag(kind))
        if kind in NEEDED:
            tagged = F.when(F.contains(text, F.lit(NEEDED[kind])), tagged).otherwise(F.array().cast(TAGGED))
        kinds.append(tagged)
    return F.concat(*kinds)


def _text_key() -> Column:
    """A hash of id and text."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit(""))))


def _entities() -> Column:
    return F.array_distinct(F.transform("spans", lambda s: F.xxhash64(s["kind"], s["value"]))).alias("entities")


def find_entities(docs: DataFrame, rules: Disclosure) -> DataFrame:
    """``doc_id, key, spans`` per row; a span carries the text on its left and right. Written once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = _text_key()
    width = rules.context

    def with_context(s: Column) -> Column:
        from_ = F.greatest(s["start"] - width, F.lit(0))
        return F.struct(
            s["kind"], s["start"], s["end"], s["value"], from_.alias("from"),
            F.substring(F.col("text"), from_ + 1, s["start"] - from_).alias("left"),
            F.substring(F.col("text"), s["end"] + 1, F.lit(width)).alias("right"),
        )

    rows = docs.select("doc_id", key.alias("key"), text.alias("text")).withColumn("found", base_spans(F.col("text")))
    spans = F.transform("found", with_context).alias("spans")
    return materialize(rows.select("doc_id", "key", F.md5("text").alias("content"), spans), "pii_entities")


def neighbours(found: DataFrame, rules: Disclosure) -> DataFrame:
    """``key, content, entity, term, start, end``: the words around every entity, outside all entities."""
    width = rules.context
    near = found.filter(F.size("spans") > 0).select("key", "content", "spans", F.explode("spans").alias("s"))
    entity = F.xxhash64("s.kind", "s.value")

    def words(context: Column, at: Column, inner: Column) -> Column:
        return F.transform(
            F.filter(matches(context, WORD), inner),
            lambda w: F.struct((w["start"] + at).alias("start"), (w["end"] + at).alias("end"), F.lower(w["value"]).alias("term")),
        )

    # a word that the edge of the context may have cut does not count
    left = words(F.col("s.left"), F.col("s.from"), lambda w: (w["start"] > 0) | (F.col("s.from") == 0))
    right = words(F.col("s.right"), F.col("s.end"), lambda w: (w["end"] < width))
    word = F.explode(F.concat(left, right))
    rows = near.select("key", "content", "spans", entity.alias("entity"), word.alias("w"))
    free = ~F.exists("spans", lambda s: (s["start"] < F.col("w.end")) & (F.col("w.start") < s["end"]))
    return rows.filter(free).select("key", "content", "entity", "w.term", "w.start", "w.end").distinct()


def term_frequency(docs: DataFrame) -> DataFrame:
    """``term, n_term``: rows whose text has the word, over all rows."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(WORD), F.lit(0)))
    return docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))


def disclosing_terms(docs: DataFrame, found: DataFrame, near: DataFrame, rules: Disclosure) -> DataFrame:
    """``entity, term, share``: pairs whose word gives away at least ``rules.generalise`` of the entity.

    share = PMI(word; entity) / IC(entity) with PMI = log2(n_both N / (n_entity n_word)), IC = log2(N / n_entity).
    """
    total = found.count()
    n_entity = found.select(F.explode(_entities()).alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    pairs = (
        near.select("key", "content", "entity", "term").distinct().groupBy("entity", "term")
        .agg(F.count("*").alias("n_both"), F.count_distinct("content").alias("texts"))
        .filter(F.col("texts") >= rules.support)
    )
    information = F.log2(F.lit(float(total)) / F.col("n_entity"))
    pmi = F.log2(F.col("n_both") * F.lit(float(total)) / (F.col("n_entity") * F.col("n_term")))
    return (
        pairs.join(n_entity, "entity")
        .join(term_frequency(docs), "term")
        .withColumn("share", F.when(information > 0, pmi / information))
        .filter(F.col("share") >= rules.generalise)
        .select("entity", "term", "share")
    )


def sanitisation_spans(docs: DataFrame, rules: Disclosure | None = None) -> DataFrame:
    """``doc_id, key, spans, terms`` per row: entities, and words to generalise or remove.

    What a word gives away of an entity is learned where it stands next to the entity; then it is replaced wherever it stands,
    outside entities, in every text that holds the entity. ``key`` is a hash of id and text. A null text is empty and has no spans; rows that repeat an id and a text get
    the same spans. A text without an entity is never touched. Extra columns are ignored.
    """
    rules = rules or Disclosure()
    docs = docs.select("doc_id", "text")
    found = find_entities(docs, rules)
    near = materialize(neighbours(found, rules), "pii_neighbours")
    pairs = disclosing_terms(docs, found, near, rules)
    places = F.transform("spans", lambda s: F.struct(s["start"], s["end"])).alias("spans")
    held = found.filter(F.size("spans") > 0).select("key", places, _entities())
    held = held.groupBy("key").agg(F.first("spans").alias("spans"), F.first("entities").alias("entities"))  # rows of one key are equal
    # one word may give away several entities: its strongest share counts
    words = held.select("key", F.explode("entities").alias("entity")).join(pairs, "entity").groupBy("key", "term").agg(F.max("share").alias("share"))
    action = F.when(F.col("share") >= rules.remove, F.lit("removed")).otherwise(F.lit("generalised"))
    words = words.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("term", action.alias("kind")))).alias("words"))
    texts = docs.select(_text_key().alias("key"), F.coalesce("text", F.lit("")).alias("text")).join(words, "key").join(held.select("key", "spans"), "key")

    def gives_away(w: Column) -> Column:
        free = ~F.exists("spans", lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"]))
        return F.map_contains_key("words", F.lower(w["value"])) & free

    def term(w: Column) -> Column:
        return F.struct(F.element_at("words", F.lower(w["value"])).alias("kind"), w["start"], w["end"])

    spots = F.sort_array(F.transform(matches(F.col("text"), WORD, gives_away), term))
    terms = texts.select("key", spots.alias("terms")).groupBy("key").agg(F.first("terms").alias("terms"))
    no_terms = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    plain = F.transform("spans", lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return found.join(terms, "key", "left").select(
        "doc_id", "key", plain.alias("spans"), F.coalesce("terms", no_terms).alias("terms")
    )


def sanitise(docs: DataFrame, rules: Disclosure | None = None) -> DataFrame:
    """``doc_id, text``: entities become ``[KIND]``, generalised words ``[NUMBER]``, ``[NAME]`` or ``[WORD]``, removed ones go."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spans = sanitisation_spans(docs, rules).select("key", F.concat("spans", "terms").alias("all")).dropDuplicates(["key"])
    key = _text_key()
    by_start = F.sort_array(F.transform("all", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def instead(s: Column) -> Column:
        word = F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])
        wide = F.when(word.rlike(r"^\p{N}+$"), "[NUMBER]").when(word.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
        return F.when(s["kind"] == "removed", "").when(s["kind"] == "generalised", wide).otherwise(
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        )

    def step(state: Column, s: Column) -> Column:
        before = F.substring(F.col("text"), state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        skip = s["start"] < state["at"]  # overlaps what is already replaced
        out = F.when(skip, state["out"]).otherwise(F.concat(state["out"], before, instead(s)))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    rebuilt = F.aggregate(
        "sorted", zero, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text")))
    )
    return docs.withColumn("key", key).join(spans, "key").withColumn("sorted", by_start).select("doc_id", rebuilt.alias("text"))


def span_digest(spans: DataFrame) -> DataFrame:
    """Counts per kind and the spans as text, ``kind:start:end`` joined by commas."""

    def joined(column: str) -> Column:
        return F.array_join(
            F.transform(column, lambda s: F.concat(s["kind"], F.lit(":"), s["start"], F.lit(":"), s["end"])), ","
        )

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    return spans.select(
        "doc_id",
        *[count(k) for k in PATTERNS],
        F.sha2(joined("spans"), 256).alias("base_sha256"),
        F.concat_ws(",", *[F.when(F.size(c) > 0, joined(c)) for c in ("spans", "terms")]).alias("spans"),
        F.size("terms").cast("long").alias("n_terms"),
    )
