"""Streaming jobs: scoring, feature state, hourly logs, drift."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskframe.operators.drift import column_drift, count_reference, drift_by_period, drift_summary, period_counts
from riskframe.operators.joins import feature_lookup
from riskframe.operators.scoring import ServedModel, score
from riskframe.operators.service import alert_episodes, alerts, metric_series, request_panes, windows_of_panes
from riskframe.schemas import ALERT_LIMITS, FEATURE_TTL_SECONDS, REQUEST_RULES
from riskframe.session import materialize, passing
from riskframe.sources.sinks import prediction_records
from riskframe.streaming.messages import dead_letters, drop_repeats, parse_messages, valid_requests
from riskframe.streaming.state import FeatureTable, month_of
from riskframe.streaming.tables import newest_rows, read_batches, upsert_stream, write_batch

FEATURES = [r.field for r in REQUEST_RULES if r.field != "loan_id"]


@dataclass(frozen=True)
class ScoringTables:
    """Folders a scoring stream writes to."""

    predictions: str
    dead_letters: str
    features: str
    checkpoint: str

    def staged(self, df: DataFrame, step: str) -> DataFrame:
        """``df`` written once for the running batch, in place of the batch before; later steps read the files."""
        path = f"{self.checkpoint}_{step}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    @staticmethod
    def under(root: str) -> ScoringTables:
        return ScoringTables(f"{root}/predictions", f"{root}/dead_letters", f"{root}/features", f"{root}/checkpoint")


def feature_state(
    spark: SparkSession, path: str, now: str | None = None, ttl: float = FEATURE_TTL_SECONDS
) -> DataFrame | None:
    """Newest features per loan; with ``now`` only those written less than ``ttl`` seconds before."""
    table = FeatureTable(spark, path).read()
    if table is None:
        return None
    state = newest_rows(table.drop("month"), ["loan_id"], ["feature_ts", "batch_id"])
    if now is None:
        return state
    age = F.lit(now).cast("timestamp").cast("double") - F.col("feature_ts").cast("double")
    return state.filter(age < ttl)


def _recent(requests: DataFrame, ttl: float) -> Column:
    """Features that can still serve these requests: prunes months, then row groups by time."""
    first = requests.agg(F.min("ts").alias("ts")).select(
        (F.unix_timestamp("ts") - int(ttl)).alias("since"), month_of(F.timestamp_seconds(F.unix_timestamp("ts") - int(ttl)))
    ).first()
    if first[0] is None:
        return F.lit(True)
    return (F.col("month") >= first[1]) & (F.col("feature_ts") >= F.timestamp_seconds(F.lit(first[0])))


def score_batch(
    messages: DataFrame,
    batch_id: int,
    tables: ScoringTables,
    champion: ServedModel,
    challenger: ServedModel | None = None,
    challenger_pct: float = 0.0,
    ttl: float = FEATURE_TTL_SECONDS,
    message_id: str = "message_id",
    compact_every: int | None = 50,
    lateness: float = FEATURE_TTL_SECONDS,
) -> None:
    """Parse, reject, look up, route, score and log one micro-batch, then write its features back.

    A request also sees the earlier requests of its own batch, so messages that arrive in the order of their time
    give the same rows in one batch or in many. Of a batch only the newest features per loan are kept.
    Every output is a folder named by the batch, so a batch that is run again replaces its own output. Every
    ``compact_every`` batches the features of the batches before are merged, for requests at most ``lateness``
    seconds behind the newest; so a lookup opens one base and fewer than twice that many batches.
    """
    spark = messages.sparkSession
    table = FeatureTable(spark, tables.features)
    if compact_every and batch_id and batch_id % compact_every == 0:
        table.compact(batch_id, ttl, lateness)
    parsed = tables.staged(parse_messages(messages), "parsed")
    write_batch(dead_letters(parsed), tables.dead_letters, batch_id)
    requests = valid_requests(parsed)
    # a repeated batch must not see the features it wrote itself
    written = table.read(before=batch_id)
    if written is None:
        columns = ["loan_id", F.col("ts").alias("feature_ts"), *FEATURES, F.lit(-1).cast("int").alias("batch_id")]
        known = spark.createDataFrame([], requests.select(*columns).schema)
    else:
        known = written.filter(_recent(requests, ttl)).drop("month")  # older months are not read
    with passing(spark):
        looked_up = feature_lookup(
            requests, known, request_ts="ts", request_id=message_id, version="batch_id", ttl=ttl, renew=True
        )
        looked_up = tables.staged(looked_up, "looked_up")
    scored = score(looked_up, champion, challenger, challenger_pct, request_id=message_id)
    inputs = [c for c in FEATURES if c in scored.columns]
    write_batch(prediction_records(scored, inputs), tables.predictions, batch_id, ["hour"])
    state = looked_up.filter(F.col("loan_id").isNotNull()).select(
        "loan_id", F.col("ts").alias("feature_ts"), *FEATURES, F.col(message_id).cast("string").alias("_message")
    )
    newest = newest_rows(state, ["loan_id"], ["feature_ts", "_message"]).drop("_message")
    table.write(newest, batch_id)


def score_stream(
    messages: DataFrame,
    tables: ScoringTables,
    available_now: bool = False,
    repeats_within: str | None = None,
    **options,
) -> StreamingQuery:
    """Score a stream of ``(message_id, value, ts)``; options are those of :func:`score_batch`.

    With ``repeats_within`` a message id is scored once among messages that arrive that close together.
    """
    if repeats_within is not None:
        messages = drop_repeats(messages, options.get("message_id", "message_id"), "ts", repeats_within)
    writer = messages.writeStream.foreachBatch(
        lambda batch, batch_id: score_batch(batch, batch_id, tables, **options)
    ).option("checkpointLocation", tables.checkpoint)
    wanted = SCORING_SETTINGS | (STATE_ON_DISK if repeats_within is not None else {})
    with _settings(messages.sparkSession, wanted):  # a stream keeps the settings it starts with
        return (writer.trigger(availableNow=True) if available_now else writer).start()


# Shuffle files of a batch go when its tables are written.
SCORING_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# The message ids seen within the delay may be many more than the executors' heap holds.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def drift_stream(
    logs: DataFrame,
    reference: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Compare every micro-batch of logs with the reference and write ``(name, value)`` metrics.

    The reference is counted once, when the stream starts.
    """
    counted = count_reference(reference)

    def monitor(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        columns = column_drift(counted, prepare(batch)).persist()
        summary = drift_summary(columns).select(
            F.explode(
                F.create_map(
                    F.lit("drifted_columns"), F.col("drifted_columns").cast("double"), F.lit("drift_share"), F.col("drift_share")
                )
            ).alias("name", "value")
        )
        per_column = columns.select(F.concat(F.col("column"), F.lit("_p_value")).alias("name"), F.col("p_value").alias("value"))
        write_batch(summary.unionByName(per_column), path, batch_id)
        columns.unpersist()

    writer = logs.writeStream.foreachBatch(monitor).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def period_drift_stream(
    logs: DataFrame,
    reference: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "ts",
    every: str = "1 hour",
    delay: str = "10 minutes",
    available_now: bool = False,
) -> StreamingQuery:
    """Compare every hour of logs with the reference once, when its watermark closes it, whatever the micro-batches.

    Writes ``(at, column, test, statistic, p_value, drifted)`` per closed period. The reference is counted once, the
    state holds value counts of the open periods, and rows that come after their period has closed are left out.
    """
    counted = count_reference(reference)

    def compare(closed: DataFrame, batch_id: int) -> None:
        counts = materialize(closed, "closed-periods")
        if not counts.isEmpty():
            write_batch(drift_by_period(counted, counts), path, batch_id)

    counts = period_counts(logs, counted, ts, every, delay)
    writer = counts.writeStream.outputMode("append").foreachBatch(compare).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def drift_series(tests: DataFrame, scores: list[str], every_seconds: int = 3600) -> DataFrame:
    """Alert metrics ``(metric, at, value)`` of period drift: the share of drifted columns and the largest gap of the scores.

    Columns named in ``scores`` are predictions, all others features; a period's value is known at its end.
    """
    at = F.unix_timestamp("at") + every_seconds
    is_score = F.col("column").isin(scores)
    features = tests.filter(~is_score).groupBy(at.alias("at")).agg((F.count_if("drifted") / F.count("*")).alias("value"))
    predictions = tests.filter(is_score).groupBy(at.alias("at")).agg(F.max("statistic").alias("value"))
    parts = [(features, "drift_share"), (predictions, "prediction_drift")]
    return parts[0][0].select(F.lit(parts[0][1]).alias("metric"), "at", "value").unionByName(
        parts[1][0].select(F.lit(parts[1][1]).alias("metric"), "at", "value")
    )


def service_windows_stream(
    log: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Keep the table of request panes up to date: one state row per pane, of which a batch writes those it changed."""
    return upsert_stream(request_panes(log), path, checkpoint, available_now)


def service_windows(spark: SparkSession, path: str) -> DataFrame | None:
    """Sliding request windows over the current panes."""
    table = read_batches(spark, path)
    return None if table is None else windows_of_panes(newest_rows(table, ["pane"]))


def service_alerts(spark: SparkSession, path: str, limits: dict[str, float] = ALERT_LIMITS) -> DataFrame | None:
    """Alerts over the current state of the pane table, for a schedule or for each batch."""
    windows = service_windows(spark, path)
    if windows is None:
        return None
    return alerts(metric_series(windows, {"error_ratio": "error_ratio", "p95_latency": "p95"}), limits)


def run_alerts(
    spark: SparkSession, path: str, run_id: int, series: DataFrame, limits: dict[str, float] = ALERT_LIMITS, **options
) -> DataFrame:
    """One run of the alert rules over metric tables that arrive at their own times; its state is kept under ``path``.

    Takes the points of ``(metric, at, value)`` that are newer than those the runs before have seen, metric by metric, goes on
    with the breaches they left open, and writes this run's episodes. A run that is repeated replaces its own. Points
    older than the newest seen of their metric came too late and count for nothing. Options are those of
    :func:`alert_episodes`. Returns the episodes of all runs, open ones in their newest state.
    """
    before = [(r, read_batches(spark, f"{path}/run={r}/seen")) for r in _runs(spark, path) if r < run_id]
    points = series.filter(F.col("value").isNotNull()).select("metric", F.col("at").cast("long").alias("at"), F.col("value").cast("double").alias("value"))
    points, left_open, seen = materialize(points, "alert-points"), None, points.select("metric", "at").limit(0)
    if before:
        newest = before[-1][0]
        seen = before[-1][1]
        last = seen.select("metric", F.col("at").alias("seen"))
        points = points.join(last, "metric", "left").filter("seen IS NULL OR at > seen").drop("seen")
        left_open = spark.read.parquet(f"{path}/run={newest}/episodes").filter("ended IS NULL")
    episodes = alert_episodes(points, limits, open_episodes=left_open, **options)
    episodes.write.mode("overwrite").parquet(f"{path}/run={run_id}/episodes")
    latest = points.select("metric", "at").unionByName(seen.select("metric", "at")).groupBy("metric").agg(F.max("at").alias("at"))
    latest.write.mode("overwrite").parquet(f"{path}/run={run_id}/seen")
    return alert_history(spark, path)


def _runs(spark: SparkSession, path: str) -> list[int]:
    """Runs that have ended, in their order: what they have seen is written last."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    runs = [s.getPath().getName() for s in files.listStatus(root)]
    done = [r for r in runs if r.startswith("run=") and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{r}/seen/_SUCCESS"))]
    return sorted(int(r[4:]) for r in done)


def alert_history(spark: SparkSession, path: str) -> DataFrame:
    """The episodes of all runs: closed ones, and the newest run's open ones."""
    runs = _runs(spark, path)
    parts = [spark.read.parquet(f"{path}/run={r}/episodes") for r in runs]
    parts = [p if r == runs[-1] else p.filter("ended IS NOT NULL") for r, p in zip(runs, parts)]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table
