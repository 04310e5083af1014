"""Registered queries of the package over the test tables, and the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import checks, collocations, conversations, exact_dedup, language, mixing, packing, pii, quality, sharding
from riskframe.llm import simhash, suffix, topk, toxicity
from riskframe.llm.batches import prepare

NEIGHBOURS = 5
QUERY_STEP = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_language(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="max")


def op5_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(pii.sanitisation_spans(table(spark, sf_dir, "documents")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_sequences(table(spark, sf_dir, "documents"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.exact_topk(vectors, vectors.filter(F.col("vec_id") % QUERY_STEP == 0), NEIGHBOURS)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit_conversations(table(spark, sf_dir, "conversations"), damage=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_language, op3_simhash, op4_exact_dedup, op5_sanitise, op6_toxicity, op7_mixing,
        op8_packing, op9_topk, op10_quality, op11_sharding, op12_collocations, op13_conversations,
    )
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op7_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   md5(coalesce(doc_id::VARCHAR, '')) AS key
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
            FROM sized GROUP BY source
        ), caps AS (
            SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT] AS weight, 2 * source_size AS cap,
                   2 * source_size / [5, 2, 1][((rank - 1) % 3 + 1)::INT] AS fills_at
            FROM sources
        ), levels AS (
            SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT
                       - coalesce(sum(cap) OVER (ORDER BY fills_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
                      / (sum(weight) OVER (ORDER BY fills_at, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
            FROM caps
        ), targets AS (
            SELECT source, rank, source_size,
                   coalesce(least(cap::DOUBLE, weight * (
                       SELECT level FROM levels WHERE fills_at > level ORDER BY fills_at, rank LIMIT 1)), cap::DOUBLE) AS target
            FROM levels
        ), ordered AS (
            SELECT doc_id, size, source_size, target,
                   CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs,
                   coalesce(sum(size) OVER (PARTITION BY rank ORDER BY key, doc_id, size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
            FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
        )
        SELECT doc_id, size, source_size, target,
               (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
        FROM ordered
    """,
    "op9_topk": """
        WITH parts AS (
            SELECT vec_id, generate_subscripts(embedding, 1) AS i, floor(256 * unnest(embedding)::DOUBLE)::BIGINT AS q
            FROM embeddings
            WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
        ), scores AS (
            SELECT a.vec_id AS query_id, b.vec_id, sum(a.q * b.q)::BIGINT AS score
            FROM parts a JOIN parts b ON a.i = b.i AND a.vec_id <> b.vec_id
            WHERE a.vec_id % 50 = 0 GROUP BY ALL
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scores
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_sharding": checks.SHARDING,
    "op12_collocations": checks.COLLOCATIONS,
    "op13_conversations": checks.CONVERSATIONS,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
