"""Dataset versions: stored Parquet data, a manifest by content hash and the statistics of each version."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.clean import numeric_columns
from riskframe.operators.profile import content_hash, dataset_profile, describe_numeric
from riskframe.session import materialize

MANIFEST = "_manifest"


def save_version(df: DataFrame, root: str, name: str, description: str = "") -> str:
    """Store, hash, profile and describe a frame; returns the version id (eight hash digits).

    The frame is computed once: hash and statistics are read from the stored copy. Equal content gets
    the same id.
    """
    spark = df.sparkSession
    path = f"{root}/{name}/data-{uuid.uuid4().hex[:12]}"
    df.write.mode("error").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    hashed = content_hash(stored).first()
    version = hashed["digest"][:8]
    dataset_profile(stored).write.mode("overwrite").json(f"{root}/{name}_stats/version={version}/profile")
    if numeric_columns(stored):
        describe_numeric(stored).write.mode("overwrite").json(f"{root}/{name}_stats/version={version}/numeric")
    spark.range(1).select(
        F.lit(name).alias("name"),
        F.lit(version).alias("version"),
        F.lit(hashed["digest"]).alias("digest"),
        F.lit(hashed["rows"]).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.lit(description).alias("description"),
        F.lit(path).alias("path"),
        F.current_timestamp().alias("created_at"),
    ).write.mode("append").parquet(f"{root}/{MANIFEST}")
    return version


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Newest entry per dataset and version."""
    table = spark.read.parquet(f"{root}/{MANIFEST}")
    entry = F.struct(*[c for c in table.columns if c not in ("name", "version")])
    return table.groupBy("name", "version").agg(F.max_by(entry, "created_at").alias("e")).select("name", "version", "e.*")


def load_version(spark: SparkSession, root: str, name: str, version: str) -> DataFrame:
    try:
        rows = manifest(spark, root).filter((F.col("name") == name) & (F.col("version") == version)).collect()
    except AnalysisException:
        rows = []
    if not rows:
        raise FileNotFoundError(f"no version {version!r} of dataset {name!r}")
    return spark.read.parquet(rows[0]["path"])


def register_reference(df: DataFrame, root: str, name: str, description: str = "reference dataset") -> str:
    return save_version(df, root, f"reference_{name}", description)


def narrowed(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Text columns whose values are all whole numbers, or all numbers, as that type; one pass decides."""
    from riskframe.functions.text import NUMBER
    from riskframe.operators.clean import string_columns

    columns = columns or string_columns(df)
    if not columns:
        return df
    base = materialize(df, "narrow")
    row = base.agg(
        *[F.bool_and(F.col(c).rlike(r"^[-+]?\d{1,18}$")).alias(f"i{k}") for k, c in enumerate(columns)],
        *[F.bool_and(F.col(c).rlike(NUMBER)).alias(f"d{k}") for k, c in enumerate(columns)],
    ).first()
    kinds = {c: "bigint" if row[f"i{k}"] else "double" if row[f"d{k}"] else None for k, c in enumerate(columns)}
    return base.withColumns({c: F.col(c).cast(t) for c, t in kinds.items() if t})
