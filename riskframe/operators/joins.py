"""Joins: as-of feature lookup with a time limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.ordered import ROWS_PER_BUCKET, with_bucket
from riskframe.schemas import FEATURE_TTL_SECONDS

CACHED, PAYLOAD = "redis_cache", "request_payload"


def feature_lookup(
    requests: DataFrame,
    snapshots: DataFrame,
    key: str = "loan_id",
    request_ts: str = "req_ts",
    feature_ts: str = "feature_ts",
    request_id: str = "event_id",
    version: str | None = None,
    ttl: float = FEATURE_TTL_SECONDS,
    sources: tuple[str, str] = (CACHED, PAYLOAD),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    renew: bool = False,
) -> DataFrame:
    """Each request with the newest snapshot of its key that is at most ``ttl`` seconds old.

    On a hit every shared feature column comes from the snapshot, otherwise from the request itself;
    ``features_source`` and ``feature_ts`` tell which. A request without a key keeps its payload.

    With ``renew`` every request also writes the features it was served with back under its own time. Requests
    less than ``ttl`` apart so keep what the first of them, or a snapshot in between, supplied; ``feature_ts`` is
    then the time of the event before. Requests of equal time follow each other by ``request_id``.

    Requests and snapshots are merged into one time line per key and each request takes the last
    snapshot before it, so no request–snapshot pairs are formed. The time line of a hot key is cut into
    several buckets; the last snapshot of the earlier buckets is carried over.
    """
    features = [c for c in requests.columns if c in snapshots.columns and c not in (key, request_ts, feature_ts)]
    if version in features:
        features.remove(version)
    keep = [c for c in requests.columns]
    tie = F.col(version).cast("string") if version else F.lit("")
    snap = F.struct(F.col(feature_ts).alias("at"), *features)
    timeline = (
        requests.filter(F.col(key).isNotNull())
        .select(
            F.col(key).alias("_key"),
            F.col(request_ts).alias("_ts"),
            F.lit(1).alias("_kind"),
            F.col(request_id).cast("string").alias("_tie"),
            F.struct(*keep).alias("_request"),
        )
        .unionByName(
            snapshots.filter(F.col(key).isNotNull()).select(
                F.col(key).alias("_key"),
                F.col(feature_ts).alias("_ts"),
                F.lit(0).alias("_kind"),
                F.lpad(tie, 20, "0").alias("_tie") if version else tie.alias("_tie"),
                snap.alias("_snap"),
            ),
            allowMissingColumns=True,
        )
    )
    order = ["_ts", "_kind", "_tie"]
    cut = with_bucket(timeline, ["_key"], order, rows_per_bucket)

    if renew:
        before = Window.partitionBy("_key", "bucket").orderBy(*order)
        earlier = F.coalesce(F.lag("_ts").over(before), F.col("_carried"))
        cut = cut.join(_carried(cut, "_ts", order), ["_key", "bucket"], "left").withColumn("_before", earlier).drop("_carried")
        served = F.coalesce(_seconds("_ts") - _seconds("_before") < ttl, F.lit(False))
        types = dict(snapshots.dtypes)
        own = F.struct(F.col("_ts").alias("at"), *[F.col(f"_request.{c}").cast(types[c]).alias(c) for c in features])
        cut = cut.withColumn("_snap", F.when((F.col("_kind") == 1) & ~served, own).otherwise(F.col("_snap")))
    inside = Window.partitionBy("_key", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = (
        cut.withColumn("_inside", F.last("_snap", ignorenulls=True).over(inside))
        .filter(F.col("_kind") == 1)
        .join(_carried(cut, "_snap", order), ["_key", "bucket"], "left")
        .withColumn("_found", F.coalesce("_inside", "_carried"))
    )
    matched = found.select("_request.*", "_found", F.col("_before" if renew else "_found.at").alias("_at"))
    hit = F.coalesce(_seconds(request_ts) - _seconds("_at") < ttl, F.lit(False))
    no_key = requests.filter(F.col(key).isNull())
    joined = matched.unionByName(no_key, allowMissingColumns=True) if _nullable(requests, key) else matched

    def chosen(c: str) -> Column:
        return F.when(hit, F.col(f"_found.{c}")).otherwise(F.col(c)).alias(c) if c in features else F.col(c)

    return joined.select(
        *[chosen(c) for c in keep],
        F.when(hit, sources[0]).otherwise(sources[1]).alias("features_source"),
        F.when(hit, F.col("_at")).alias(feature_ts),
    )


def _carried(cut: DataFrame, value: str, order: list[str]) -> DataFrame:
    """``_key, bucket, _carried``: the last value of a key in the buckets before; only keys that lie in several."""
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order)))
    newest = cut.filter("split").groupBy("_key", "bucket").agg(last.alias("_last"))
    earlier = Window.partitionBy("_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = newest.select("_key", "bucket", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    return carried.filter(F.col("_carried").isNotNull())


def _seconds(ts: str) -> Column:
    return F.col(ts).cast("double")


def _nullable(df: DataFrame, column: str) -> bool:
    return df.schema[column].nullable
