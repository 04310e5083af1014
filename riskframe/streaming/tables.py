"""Tables that streams write: one folder per micro-batch, so that a repeated batch replaces itself."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_batch(batch: DataFrame, path: str, batch_id: int, partition_by: list[str] = ()) -> None:
    writer = batch.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, *paths: str, base: str | None = None) -> DataFrame | None:
    """All batches written so far with their ``batch_id``, or those in the given folders of ``base``; None before the first one."""
    try:
        return spark.read.option("basePath", base or paths[0]).parquet(*paths)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing) or "UNABLE_TO_INFER_SCHEMA" in str(missing):
            return None
        raise


def upsert_stream(result: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the changed rows of every micro-batch (update mode)."""
    writer = (
        result.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def newest_rows(table: DataFrame, keys: list[str], order: list[str | Column] = ("batch_id",)) -> DataFrame:
    """Current state of an upserted table: the newest row per key, collapsed before the shuffle."""
    row = F.struct(*[c for c in table.columns if c not in keys])
    newest = table.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row"))
    return newest.select(*keys, "_row.*").drop("batch_id")
