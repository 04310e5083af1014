"""Session settings of the text operators."""

from __future__ import annotations

from pyspark.sql import SparkSession

from riskframe.session import configure

# Rows and bytes that go to a Python worker at once: whole texts are long, so the default row count is too much.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    return configure(spark)
