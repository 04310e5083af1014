"""Corpus pipeline: quality filter, exact and near deduplication, mixing, packing.

Every stage reads what its predecessor kept, written as Parquet in the shared folder; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.batches import prepare
from riskframe.llm.exact_dedup import exact_dedup
from riskframe.llm.mixing import mix
from riskframe.llm.near import drop_near_copies
from riskframe.llm.packing import pack_sequences
from riskframe.llm.quality import CUT, fit_quality, quality_udf
from riskframe.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold go. Learns from the labels outside the held-out fold."""
    model = fit_quality(docs, prepare(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(quality_udf(model)(F.coalesce("text", F.lit(""))) >= CUT)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays, one of the rows if that id and text are repeated."""
    kept = exact_dedup(docs, keep="max").filter("kept")
    kept = kept.select(_id_and_text(F.col("doc_id"), F.col("text_sha256")).alias("own")).distinct()
    sha = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    rows = docs.select(F.struct(*docs.columns).alias("row"), _id_and_text(docs["doc_id"], sha).alias("own")).join(kept, "own")
    nth = F.row_number().over(Window.partitionBy("own").orderBy("own"))
    return rows.withColumn("nth", nth).filter("nth = 1").select("row.*")


def _id_and_text(doc_id: Column, text_sha256: Column) -> Column:
    return F.concat(F.coalesce(F.concat(F.lit("id "), doc_id.cast("string")), F.lit("no id")), F.lit(" "), text_sha256)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies (5-word shingles, Jaccard similarity 0.8 or more) the row with the smallest id stays."""
    prepare(spark)
    return drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, its words rounded to whole copies (a half counts up)."""
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    taken = (
        mix(docs).select(F.col("doc_id").alias("own"), copies.alias("copies")).groupBy("own").agg(F.max("copies").alias("copies"))
    ).filter("copies > 0")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"))
    again = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return rows.join(taken, F.col("id").eqNullSafe(F.col("own"))).select("row", again.alias("again")).select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; a document mixed twice is packed twice."""
    prepare(spark)
    return pack_sequences(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# near-duplicate groups, the learned filter and the tokens cannot be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
