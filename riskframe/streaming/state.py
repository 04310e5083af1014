"""A table of newest features that a stream writes in batches and keeps small: base files, later batches, a manifest."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.streaming.tables import read_batches, write_batch

ROWS_PER_FILE = 2_000_000


def month_of(ts: Column) -> Column:
    """Partition of the feature table; coarse, so that a replay of years does not shatter into files."""
    return F.date_format(ts, "yyyy-MM")


class FeatureTable:
    """Features per key under ``path``: ``batch_id=N`` folders, ``base=K`` folders and numbered manifests.

    A manifest names the base that holds all batches up to one number, and the newest manifest counts. It comes into
    being by one rename, so a reader sees the table before or after a compaction, never between. What a compaction replaces
    is removed by the next one, when readers of the manifest before have gone on.

    A base holds, per key, all rows newer than ``horizon`` and the newest one before it, both within the time limit. So
    lookups of requests later than the horizon find in it what they would find in the batches.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "loan_id", ts: str = "feature_ts"):
        self.spark, self.path, self.key, self.ts = spark, path.rstrip("/"), key, ts
        self._jvm = spark._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _numbers(self, prefix: str, folder: str = "") -> list[int]:
        where = self._at(folder) if folder else self._root
        if not self._fs.exists(where):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(where)]
        return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix) :].lstrip("-").isdigit())

    def manifest(self, back: int = 0) -> dict:
        """The newest manifest, or the one ``back`` before it."""
        versions = self._numbers("v", "_manifest")
        if len(versions) <= back:
            return {"version": 0, "base": None, "upto": -1, "rows": 0}
        stream = self._fs.open(self._at(f"_manifest/v{versions[-1 - back]}"))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """The features of one batch; a batch that is run again replaces its own."""
        write_batch(rows.withColumn("month", month_of(F.col(self.ts))), self.path, batch_id, ["month"])

    def folders(self, before: int | None = None) -> list[str]:
        """The folders a read opens: one base and the batches after it, below ``before`` if it is given."""
        now = self.manifest()
        later = [b for b in self._numbers("batch_id=") if b > now["upto"] and (before is None or b < before)]
        base = [f"base={now['base']}"] if now["base"] is not None else []
        return [f"{self.path}/{n}" for n in base + [f"batch_id={b}" for b in later]]

    def read(self, before: int | None = None) -> DataFrame | None:
        """Rows with ``month`` and ``batch_id``; None if there is none. Rows of a base carry the batch they came with."""
        folders = self.folders(before)
        base = [f for f in folders if "/base=" in f]
        batches = [f for f in folders if "/base=" not in f]
        parts = [
            read_batches(self.spark, *base).withColumn("batch_id", F.col("source_batch")).drop("source_batch") if base else None,
            read_batches(self.spark, *batches, base=self.path) if batches else None,
        ]
        parts = [p for p in parts if p is not None]
        return parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0] if parts else None

    def compact(self, before: int, ttl: float, lateness: float = 0.0) -> bool:
        """Merge all batches below ``before`` into a new base; False if there is nothing to merge.

        ``lateness`` is how many seconds behind the newest feature a request may still come; rows older than that and
        ``ttl`` are gone. Files are counted by rows, ``ROWS_PER_FILE`` each.
        """
        now = self.manifest()
        table = self.read(before)
        merged = [b for b in self._numbers("batch_id=") if now["upto"] < b < before]
        if table is None or not merged:
            return False
        at = F.col(self.ts).cast("double")
        newest = table.agg(F.max(at).alias("at")).first()["at"]
        horizon = (newest or 0.0) - lateness
        alive = table.filter(at > F.lit(horizon - ttl))
        columns = [c for c in table.columns if c != self.key]
        old = alive.filter(at <= F.lit(horizon)).groupBy(self.key)
        old = old.agg(F.max_by(F.struct(*columns), F.struct(self.ts, "batch_id")).alias("_row")).select(self.key, "_row.*")
        rows = old.unionByName(alive.filter(at > F.lit(horizon))).withColumnRenamed("batch_id", "source_batch")
        version = now["version"] + 1
        base = f"{self.path}/base={version}"
        files = max(1, math.ceil(now["rows"] / ROWS_PER_FILE))
        spread = rows.repartition("month", F.pmod(F.xxhash64(self.key), F.lit(files)))
        spread.write.mode("overwrite").partitionBy("month").parquet(base)
        count = self.spark.read.schema(rows.schema).parquet(base).count()
        self._publish({"version": version, "base": version, "upto": max(merged), "rows": count})
        self._remove_before(self.manifest(back=1))
        return True

    def _publish(self, manifest: dict) -> None:
        self._fs.mkdirs(self._at("_manifest"))
        draft, final = self._at(f"_manifest/_draft{manifest['version']}"), self._at(f"_manifest/v{manifest['version']}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not self._fs.rename(draft, final):
            raise RuntimeError(f"another writer has published {final}")

    def _remove_before(self, kept: dict) -> None:
        """Folders that neither the newest manifest nor ``kept``, the one before it, refers to."""
        if kept["base"] is None:
            return
        for b in self._numbers("batch_id="):
            if b <= kept["upto"]:
                self._fs.delete(self._at(f"batch_id={b}"), True)
        for b in self._numbers("base="):
            if b < kept["base"]:
                self._fs.delete(self._at(f"base={b}"), True)
