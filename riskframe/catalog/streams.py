"""Service windows, alerts and streams run to the end of their input."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe import fixtures as fx
from riskframe.catalog.monitoring import ALL_TESTS
from riskframe.catalog.registry import query, r6, rounded
from riskframe.catalog.serving import SCORE_SQL, served
from riskframe.catalog.views import DRIFT, DRIFT_LOG, LOANS, REQUEST_LOG, REQUEST_ROWS, SCORED, with_
from riskframe.operators import drift, service
from riskframe.session import materialize, new_path
from riskframe.streaming.jobs import (
    ScoringTables,
    drift_series,
    drift_stream,
    feature_state,
    period_drift_stream,
    run_alerts,
    score_stream,
    service_alerts,
    service_windows,
    service_windows_stream,
)
from riskframe.streaming.messages import dead_letters, drop_repeats, file_messages, parse_messages
from riskframe.streaming.state import FeatureTable
from riskframe.streaming.tables import newest_rows, read_batches, upsert_stream

WINDOWS = """
panes AS (SELECT CAST(floor(epoch(ts) / 60) AS BIGINT) * 60 AS pane, * FROM request_log),
windowed AS (SELECT CAST(pane - 240 + 60 * i AS BIGINT) AS window_start, status, latency_s FROM panes, (SELECT unnest(range(0, 5)) AS i)),
rates AS (SELECT window_start, count(*) AS requests, count(*) FILTER (status >= 500) AS errors,
  count(*) / 300.0 AS request_rate, count(*) FILTER (status >= 500) / CAST(count(*) AS DOUBLE) AS error_ratio
  FROM windowed GROUP BY window_start)"""


@query("request_rate", with_(REQUEST_LOG, WINDOWS) + "SELECT window_start, requests, CAST(round(request_rate, 6) AS DOUBLE) AS request_rate FROM rates")
def request_rate(spark, sf_dir):
    return rounded(service.request_windows(fx.request_log(spark, sf_dir)).select("window_start", "requests", "request_rate"))


@query("error_ratio", with_(REQUEST_LOG, WINDOWS) + "SELECT window_start, errors, round(error_ratio, 6) AS error_ratio FROM rates")
def error_ratio(spark, sf_dir):
    return rounded(service.request_windows(fx.request_log(spark, sf_dir)).select("window_start", "errors", "error_ratio"))


P95 = "p95 AS (SELECT window_start, count(*) AS requests, quantile_cont(latency_s, 0.95) AS latency FROM windowed GROUP BY window_start)"


@query("p95_latency", with_(REQUEST_LOG, WINDOWS, P95) + "SELECT window_start, requests, round(latency, 8) AS latency FROM p95")
def p95_latency(spark, sf_dir):
    return rounded(service.latency_quantile(fx.request_log(spark, sf_dir)), digits=8)


def _bucket_sql() -> str:
    bounds = service.LATENCY_BOUNDS
    counts = ", ".join(f"count(*) FILTER (latency_s <= {b}) AS le{i}" for i, b in enumerate(bounds))
    steps = []
    for i, b in enumerate(bounds):
        low, below = (bounds[i - 1], f"le{i - 1}") if i else (0, "0")
        steps.append(
            f"WHEN le{i} >= 0.95 * n THEN CAST({low} AS DOUBLE) + (CAST({b} AS DOUBLE) - CAST({low} AS DOUBLE)) * "
            f"CASE WHEN le{i} = {below} THEN 1 ELSE (CAST(0.95 AS DOUBLE) * n - {below}) / (le{i} - {below}) END"
        )
    return f"""SELECT window_start, n AS requests, round(CASE {' '.join(steps)} ELSE CAST({bounds[-1]} AS DOUBLE) END, 6) AS latency
FROM (SELECT window_start, count(*) AS n, {counts} FROM windowed GROUP BY window_start)"""


@query("p95_latency_buckets", with_(REQUEST_LOG, WINDOWS) + _bucket_sql())
def p95_latency_buckets(spark, sf_dir):
    return rounded(service.bucket_quantile(fx.request_log(spark, sf_dir)))


@query(
    "alerts",
    with_(REQUEST_LOG, WINDOWS, P95)
    + """, series AS (
  SELECT 'error_ratio' AS metric, window_start + 300 AS at, error_ratio AS value FROM rates WHERE error_ratio > 0.05
  UNION ALL SELECT 'p95_latency', window_start + 300, latency FROM p95 WHERE latency > 0.2
)
SELECT s.metric, s.at, round(s.value, 8) AS value,
  CASE WHEN EXISTS (SELECT 1 FROM series x WHERE x.metric = s.metric AND x.at = s.at - 60) THEN 'firing' ELSE 'pending' END AS state
FROM series s""",
)
def alerts(spark, sf_dir):
    """Both service rules, latency at 0.2 s: the log's 95th percentile does not reach the 0.5 s of ``ALERT_LIMITS``."""
    log = fx.request_log(spark, sf_dir)
    rates = service.metric_series(service.request_windows(log), {"error_ratio": "error_ratio"})
    p95 = service.metric_series(service.latency_quantile(log), {"p95_latency": "latency"})
    return rounded(service.alerts(rates.unionByName(p95), {"error_ratio": 0.05, "p95_latency": 0.2}), digits=8)


HOURLY = """hourly AS (
  SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, count(*) AS predictions, round(avg(y_pred), 6) AS mean_prediction,
    round(avg(p), 6) AS mean_probability,
    round(count(*) FILTER (p <= 0.3) / CAST(count(*) AS DOUBLE), 6) AS share_low,
    round(count(*) FILTER (p > 0.3 AND p <= 0.7) / CAST(count(*) AS DOUBLE), 6) AS share_medium,
    round(count(*) FILTER (p > 0.7) / CAST(count(*) AS DOUBLE), 6) AS share_high
  FROM scored GROUP BY 1
)"""


def _prediction_log(spark, sf_dir):
    from riskframe.operators.scoring import risk_level

    return fx.scored_only(spark, sf_dir).select(
        F.col("ts").alias("predicted_at"),
        F.col("y_pred").alias("prediction"),
        F.col("p").alias("probability_default"),
        risk_level(F.col("p")).alias("risk_level"),
    )


@query("hourly_logs", with_(SCORED, HOURLY) + "SELECT * FROM hourly")
def hourly_logs(spark, sf_dir):
    return rounded(service.hourly_logs(_prediction_log(spark, sf_dir)))


@query("stream_hourly_logs", with_(SCORED, HOURLY) + "SELECT * FROM hourly")
def stream_hourly_logs(spark, sf_dir):
    """Order dates are no arrival order, so the log is written by date first, as a log would be."""
    log = _prediction_log(spark, sf_dir)
    source, root = new_path(spark, "log"), new_path(spark, "hourly")
    log.write.parquet(source)
    schema = ", ".join(f"{c} {t}" for c, t in log.dtypes)
    stream = service.hourly_logs(file_messages(spark, source, schema))
    upsert_stream(stream, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return rounded(newest_rows(read_batches(spark, f"{root}/table"), ["hour"]))


@query(
    "stream_windows",
    with_(REQUEST_LOG, WINDOWS)
    + """SELECT window_start, requests, errors, CAST(round(request_rate, 6) AS DOUBLE) AS request_rate,
  round(error_ratio, 6) AS error_ratio, round(p95, 6) AS p95
FROM rates JOIN (SELECT window_start, quantile_disc(latency_s, 0.95) AS p95 FROM windowed GROUP BY window_start) USING (window_start)""",
)
def stream_windows(spark, sf_dir):
    root = new_path(spark, "windows")
    log = fx.request_log(spark, sf_dir, streaming=True)
    service_windows_stream(log, f"{root}/panes", f"{root}/checkpoint", available_now=True).awaitTermination()
    return rounded(service_windows(spark, f"{root}/panes"))


DISC = "p95 AS (SELECT window_start, quantile_disc(latency_s, 0.95) AS latency FROM windowed GROUP BY window_start)"


@query(
    "stream_alerts",
    with_(REQUEST_LOG, WINDOWS, DISC)
    + """, series AS (
  SELECT 'error_ratio' AS metric, window_start + 300 AS at, error_ratio AS value FROM rates WHERE error_ratio > 0.05
  UNION ALL SELECT 'p95_latency', window_start + 300, latency FROM p95 WHERE latency > 0.5
)
SELECT s.metric, s.at, round(s.value, 6) AS value,
  CASE WHEN EXISTS (SELECT 1 FROM series x WHERE x.metric = s.metric AND x.at = s.at - 60) THEN 'firing' ELSE 'pending' END AS state FROM series s""",
)
def stream_alerts(spark, sf_dir):
    """Alerts on error ratio and latency from the pane table a stream maintains."""
    root = new_path(spark, "alerts")
    log = fx.request_log(spark, sf_dir, streaming=True)
    service_windows_stream(log, f"{root}/table", f"{root}/checkpoint", available_now=True).awaitTermination()
    return rounded(service_alerts(spark, f"{root}/table"))


def _hourly_tests(closed: str) -> str:
    """Tests of every hour against the log before it, from the definitions; ``closed`` says which hours count."""
    numbers = " UNION ALL ".join(f"SELECT ts, '{c}' AS \"column\", {c} AS value FROM drift_log" for c in ("amount", "score"))
    words = " UNION ALL ".join(f"SELECT ts, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM drift_log" for c in ("kind", "flagged"))
    sides = """SELECT h, "column", value, sum(r) AS r, sum(c) AS c FROM (
    SELECT h, "column", value, count(*) AS r, 0 AS c FROM {0} JOIN hours ON true WHERE ts < TIMESTAMP '2024-01-08 00:00:00' GROUP BY ALL
    UNION ALL SELECT date_trunc('hour', ts), "column", value, 0, count(*) FROM {0} WHERE date_trunc('hour', ts) IN (FROM hours) GROUP BY ALL
  ) GROUP BY ALL"""
    return f"""hours AS (
  SELECT DISTINCT date_trunc('hour', ts) AS h FROM drift_log WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND {closed}
), number_log AS ({numbers}), word_log AS ({words}), gaps AS (
  SELECT h, "column", sum(r) OVER upto AS cr, sum(r) OVER side AS tr, sum(c) OVER upto AS cc, sum(c) OVER side AS tc
  FROM ({sides.format("number_log")}) WINDOW side AS (PARTITION BY h, "column"), upto AS (PARTITION BY h, "column" ORDER BY value)
), ks AS (
  SELECT h, "column", max(abs(CAST(cr AS DOUBLE) / tr - CAST(cc AS DOUBLE) / tc)) AS statistic, any_value(CAST(tr AS DOUBLE)) AS n, any_value(CAST(tc AS DOUBLE)) AS m
  FROM gaps GROUP BY ALL
), chi AS (
  SELECT h, "column", sum((r - e_r) * (r - e_r) / e_r + (c - e_c) * (c - e_c) / e_c) AS statistic, count(*) - 1 AS dof FROM (
    SELECT *, CAST(r + c AS DOUBLE) * tr / (tr + tc) AS e_r, CAST(r + c AS DOUBLE) * tc / (tr + tc) AS e_c FROM (
      SELECT *, sum(r) OVER side AS tr, sum(c) OVER side AS tc FROM ({sides.format("word_log")}) WINDOW side AS (PARTITION BY h, "column")))
  GROUP BY ALL
), lam AS (SELECT *, statistic * sqrt(n * m / (n + m)) AS l FROM ks), hourly_tests AS (
  SELECT h, "column", 'ks' AS test, statistic, CASE WHEN l < 0.2 THEN 1.0 ELSE least(greatest(2 * list_sum(list_transform(range(1, 101),
    lambda k: CASE WHEN k % 2 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END * exp(-2.0::DOUBLE * k * k * l * l))), 0), 1) END AS p_value FROM lam
  UNION ALL SELECT h, "column", 'chi2', statistic, CASE WHEN dof % 2 = 0
    THEN exp(-statistic / 2) * list_sum(list_transform(range(0, greatest(dof // 2, 1)), lambda k: pow(statistic / 2, k) / gamma(k + 1)))
    ELSE {_odd_tail()} END FROM chi
)"""


def _odd_tail() -> str:
    """Upper χ² tail for an odd number of degrees of freedom by Simpson's rule over the density of z² with z from sqrt(statistic)."""
    return """list_sum(list_transform(range(0, 2001), lambda i: CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
      * pow(sqrt(statistic) + i * CAST(0.006 AS DOUBLE), dof - 1) * exp(-pow(sqrt(statistic) + i * CAST(0.006 AS DOUBLE), 2) / 2)))
      * CAST(0.006 AS DOUBLE) / 3 / (pow(2, CAST(dof AS DOUBLE) / 2 - 1) * gamma(CAST(dof AS DOUBLE) / 2))"""


HOURLY_TESTS = """SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS at, "column", test, round(statistic, 6) AS statistic,
  round(p_value, 4) AS p_value, p_value < 0.05 AS drifted FROM hourly_tests"""


def _hourly_frames(spark, sf_dir, streaming: bool = False):
    start = F.lit(fx.DRIFT_LOG_START).cast("timestamp")
    reference = fx.drift_log(spark, sf_dir).filter(F.col("ts") < start).drop("ts")
    return reference, fx.drift_log(spark, sf_dir, streaming).filter(F.col("ts") >= start)


def _rounded_tests(tests):
    return rounded(tests.withColumn("p_value", F.round("p_value", 4)))


@query("hourly_drift", with_(DRIFT_LOG, _hourly_tests("true")) + HOURLY_TESTS)
def hourly_drift(spark, sf_dir):
    """Every hour of the log against the log of the first week."""
    reference, logs = _hourly_frames(spark, sf_dir)
    counted = drift.count_reference(reference)
    return _rounded_tests(drift.drift_by_period(counted, materialize(drift.period_counts(logs, counted, "ts"), "hours")))


CLOSED = "date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM drift_log) - INTERVAL 10 MINUTE"


@query("stream_hourly_drift", with_(DRIFT_LOG, _hourly_tests(CLOSED)) + HOURLY_TESTS)
def stream_hourly_drift(spark, sf_dir):
    """The same from a stream: the hours that its watermark has closed."""
    reference, logs = _hourly_frames(spark, sf_dir, streaming=True)
    root = new_path(spark, "hourly-drift")
    period_drift_stream(logs, reference, f"{root}/tests", f"{root}/checkpoint", available_now=True).awaitTermination()
    return _rounded_tests(read_batches(spark, f"{root}/tests").drop("batch_id"))


@query(
    "alert_rules",
    with_(REQUEST_LOG.replace("value / 1000", "value / 400"), WINDOWS, P95, DRIFT_LOG, _hourly_tests("true"))
    + """, points AS (
  SELECT 'error_ratio' AS metric, window_start + 300 AS t, error_ratio AS value, 0.05 AS bound, 60 AS lifetime FROM rates
  UNION ALL SELECT 'p95_latency', window_start + 300, latency, 0.5, 60 FROM p95
  UNION ALL SELECT 'drift_share', CAST(epoch(h) AS BIGINT) + 3600, count(*) FILTER (p_value < 0.05) / CAST(count(*) AS DOUBLE), 0.3, 3600
    FROM hourly_tests WHERE "column" <> 'score' GROUP BY h
  UNION ALL SELECT 'prediction_drift', CAST(epoch(h) AS BIGINT) + 3600, statistic, 0.15, 3600 FROM hourly_tests WHERE "column" = 'score'
), breaches AS (
  SELECT *, lead(t) OVER line AS next_at, coalesce(lag(value > bound) OVER line AND t - lag(t) OVER line <= lifetime, false) AS goes_on
  FROM points WINDOW line AS (PARTITION BY metric ORDER BY t)
), islands AS (
  SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY metric ORDER BY t) AS island FROM breaches WHERE value > bound
), episodes AS (
  SELECT metric, min(t) AS started, max(t) AS last_at, count(*) AS points, max(value) AS peak, arg_max(coalesce(next_at, -1), t) AS next_at, any_value(lifetime) AS lifetime
  FROM islands GROUP BY metric, island
)
SELECT metric, started, last_at, points, round(peak, 8) AS peak, CASE WHEN next_at > 0 THEN least(next_at, last_at + lifetime) END AS ended,
  CASE WHEN CASE WHEN next_at > 0 THEN least(next_at, last_at + lifetime) ELSE last_at + lifetime END > started + 60 THEN started + 60 END AS fires_at
FROM episodes""",
)
def alert_rules(spark, sf_dir):
    """All four rules at their own limits, over tables that come each minute and each hour, in three runs of the job."""
    log = fx.request_log(spark, sf_dir).withColumn("latency_s", F.col("latency_s") * 2.5)
    reference, logs = _hourly_frames(spark, sf_dir)
    counted = drift.count_reference(reference)
    tests = materialize(drift.drift_by_period(counted, materialize(drift.period_counts(logs, counted, "ts"), "hours")), "tests")
    rates = service.metric_series(service.request_windows(log), {"error_ratio": "error_ratio"})
    p95 = service.metric_series(service.latency_quantile(log), {"p95_latency": "latency"})
    series = materialize(rates.unionByName(p95).unionByName(drift_series(tests, ["score"])), "series")
    root = new_path(spark, "alert-runs")
    ends = series.agg(F.min("at").alias("a"), F.max("at").alias("b")).first()
    for run in range(3):
        known = F.col("at") <= ends["a"] + (ends["b"] - ends["a"]) * (run + 1) // 3
        episodes = run_alerts(spark, root, run, series.filter(known))
    return rounded(episodes, digits=8)


@query(
    "stream_dedup",
    with_(LOANS, REQUEST_ROWS)
    + "SELECT o_orderkey, o_orderkey % 37 = 0 AS cut_short FROM request_rows",
)
def stream_dedup(spark, sf_dir):
    source, root = _message_files(spark, sf_dir), new_path(spark, "dedup")
    stream = file_messages(spark, source, "o_orderkey bigint, ts timestamp, value string")
    once = drop_repeats(stream, "o_orderkey")
    query = once.writeStream.format("parquet").option("path", f"{root}/table").option(
        "checkpointLocation", f"{root}/checkpoint"
    )
    query.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema("o_orderkey bigint, ts timestamp, value string").parquet(f"{root}/table")
    return rows.select("o_orderkey", (F.length("value") <= 40).alias("cut_short"))


def _message_files(spark, sf_dir) -> str:
    """The raw messages as files of a topic."""
    path = new_path(spark, "messages")
    fx.raw_messages(spark, sf_dir).write.parquet(path)
    return path


REPEATED = """messages AS (
  SELECT *, 'request_payload' AS features_source FROM request_errors
  UNION ALL SELECT *, 'redis_cache' FROM request_errors WHERE o_orderkey % 50 = 0
)"""


@query(
    "dead_letter",
    with_(LOANS, REQUEST_ROWS, REPEATED)
    + """SELECT o_orderkey, CASE WHEN o_orderkey % 37 = 0 THEN 'malformed JSON' ELSE array_to_string(errors, '; ') END AS reason
FROM messages WHERE o_orderkey % 37 = 0 OR len(errors) > 0""",
)
def dead_letter(spark, sf_dir):
    parsed = parse_messages(fx.raw_messages(spark, sf_dir))
    return dead_letters(parsed).select("o_orderkey", "reason")


@query(
    "parsed_messages",
    with_(LOANS, REQUEST_ROWS, REPEATED)
    + f"SELECT o_orderkey, loan_id, term, grade, {r6('loan_amnt', 'int_rate', 'dti')} FROM messages WHERE o_orderkey % 37 <> 0 AND len(errors) = 0",
)
def parsed_messages(spark, sf_dir):
    parsed = parse_messages(fx.raw_messages(spark, sf_dir)).filter(F.size("errors") == 0)
    return rounded(parsed.select("o_orderkey", "loan_id", "term", "grade", "loan_amnt", "int_rate", "dti"))


STREAM_SCORED = SCORE_SQL.replace(
    "FROM request_errors WHERE len(errors) = 0", "FROM messages WHERE o_orderkey % 37 <> 0 AND len(errors) = 0"
)


STREAM_RECORD = """SELECT loan_id, model_type, model_version, CASE WHEN pd > 0.5 THEN 1 ELSE 0 END AS prediction,
  round(pd, 6) AS probability_default, CASE WHEN pd > 0.7 THEN 'high' WHEN pd > 0.3 THEN 'medium' ELSE 'low' END AS risk_level"""


ROW_GROUP = 16 * 2**20


def _run_scoring(spark, sf_dir, batches: int = 4, **options) -> ScoringTables:
    """Score all messages; the second copies arrive in files of their own, after the first."""
    source = new_path(spark, "messages")
    rows = fx.message_rows(spark, sf_dir)
    # dealt to their files as typed rows, which become texts where they are written; row groups that several tasks can read
    each = {} if "repeats_within" in options else {"maxFilesPerTrigger": "1"}
    first = (rows.repartition(batches - 1, "o_orderkey") if each else rows).dropDuplicates(["o_orderkey"])
    fx.message_texts(first).write.option("parquet.block.size", ROW_GROUP).parquet(source)
    again = rows.filter(F.col("o_orderkey") % 50 == 0).dropDuplicates(["o_orderkey"])
    fx.message_texts(again).coalesce(1).write.option("parquet.block.size", ROW_GROUP).mode("append").parquet(source)
    tables = ScoringTables.under(new_path(spark, "scoring"))
    messages = file_messages(spark, source, "o_orderkey bigint, ts timestamp, value string", **each).withColumnRenamed(
        "o_orderkey", "message_id"
    )
    score_stream(
        messages,
        tables,
        available_now=True,
        champion=served("champion"),
        challenger=served("challenger"),
        challenger_pct=30,
        **options,
    ).awaitTermination()
    return tables


def _stream_records(spark, tables: ScoringTables):
    details = F.col("prediction_details")
    return rounded(
        read_batches(spark, tables.predictions).select(
            "loan_id",
            "model_type",
            details.model_version.alias("model_version"),
            details.prediction.alias("prediction"),
            details.probability_default.alias("probability_default"),
            details.risk_level.alias("risk_level"),
            "features_source",
        )
    )


@query("stream_score", with_(LOANS, REQUEST_ROWS, REPEATED, STREAM_SCORED) + STREAM_RECORD + ", features_source FROM predicted")
def stream_score(spark, sf_dir):
    """Four micro-batches; repeated messages come in the last one and are served from the first copy's features."""
    return _stream_records(spark, _run_scoring(spark, sf_dir))


@query(
    "stream_score_once",
    with_(LOANS, REQUEST_ROWS, REPEATED, STREAM_SCORED)
    + STREAM_RECORD
    + ", features_source FROM predicted WHERE features_source = 'request_payload'",
)
def stream_score_once(spark, sf_dir):
    """The same messages with repeats removed before scoring."""
    return _stream_records(spark, _run_scoring(spark, sf_dir, repeats_within="10 minutes"))


@query(
    "feature_state",
    with_(LOANS, REQUEST_ROWS)
    + """SELECT r.loan_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS feature_ts, grade, round(dti, 6) AS dti, total_acc
FROM request_errors r JOIN orders o ON o.o_orderkey = r.o_orderkey
WHERE r.o_orderkey % 37 <> 0 AND len(errors) = 0 AND o_orderdate > TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 365 DAY""",
)
def stream_feature_state(spark, sf_dir):
    """Features a scoring stream leaves behind that are less than a year old at the start of 1998."""
    tables = _run_scoring(spark, sf_dir)
    state = feature_state(spark, tables.features, now=fx.EPOCH_1998, ttl=365 * 86400)
    return rounded(state.select("loan_id", "feature_ts", "grade", "dti", "total_acc"))


FEATURE_BATCHES = 12


@query(
    "feature_compaction",
    """WITH views AS (SELECT user_id AS loan_id, ts, event_id, value FROM events WHERE event_type = 'view')
SELECT loan_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS feature_ts, event_id, round(value, 6) AS value, true AS few_folders
FROM views WHERE epoch(ts) > (SELECT max(epoch(ts)) FROM views) - 604800 QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def feature_compaction(spark, sf_dir):
    """Features of a week from a table written in twelve batches and merged every third one."""
    views = fx.table(spark, sf_dir, "events").filter("event_type = 'view'")
    views = views.select(F.col("user_id").alias("loan_id"), F.col("ts").cast("timestamp").alias("feature_ts"), "event_id", "value")
    views = materialize(views, "views")
    ends = views.agg(F.min(F.unix_timestamp("feature_ts")).alias("a"), F.max(F.unix_timestamp("feature_ts")).alias("b"), F.max("feature_ts").alias("last")).first()
    table = FeatureTable(spark, new_path(spark, "features"))
    batch = F.floor((F.unix_timestamp("feature_ts") - ends["a"]) * FEATURE_BATCHES / (ends["b"] - ends["a"] + 1))
    for i in range(FEATURE_BATCHES):
        if i and i % 3 == 0:
            table.compact(i, ttl=7 * 86400, lateness=3600)
        table.write(views.filter(batch == i), i)
    few = len(table.folders()) <= 4
    age = F.lit(ends["last"]).cast("double") - F.col("feature_ts").cast("double")
    state = newest_rows(table.read().drop("month").filter(age < 7 * 86400), ["loan_id"], ["feature_ts", "event_id"])
    return rounded(state).withColumn("few_folders", F.lit(few))


@query(
    "stream_drift",
    with_(DRIFT, ALL_TESTS)
    + """SELECT "column" || '_p_value' AS name, round(p_value, 6) AS value FROM tests
UNION ALL SELECT 'drifted_columns', CAST(count(*) FILTER (drifted) AS DOUBLE) FROM tests
UNION ALL SELECT 'drift_share', round(count(*) FILTER (drifted) / CAST(count(*) AS DOUBLE), 6) FROM tests""",
)
def stream_drift(spark, sf_dir):
    """Drift metrics of the later line items as they arrive, against the earlier ones."""
    reference, current = fx.drift_frames(spark, sf_dir)
    source, root = new_path(spark, "lines"), new_path(spark, "drift")
    current.write.parquet(source)
    schema = ", ".join(f"{c} {t}" for c, t in current.dtypes)
    drift_stream(
        file_messages(spark, source, schema), reference, f"{root}/metrics", f"{root}/checkpoint", available_now=True
    ).awaitTermination()
    return rounded(read_batches(spark, f"{root}/metrics").select("name", "value"))
