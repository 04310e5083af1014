"""Feature lookup, snapshots, routing and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe import fixtures as fx
from riskframe.catalog.registry import query, rounded
from riskframe.catalog.views import LOANS, LOOKUP, REQUEST_ROWS, with_
from riskframe.operators import joins, scoring
from riskframe.operators.clean import validate_requests
from riskframe.operators.features import online_encode
from riskframe.session import new_path
from riskframe.sources.sinks import feature_snapshot, prediction_records, write_prediction_log


def lookup_sql(ttl: int) -> str:
    return (
        with_(LOOKUP)
        + f""", hits AS (
  SELECT r.event_id, arg_max(struct_pack(v := s.value, t := s.feature_ts), (s.feature_ts, s.version)) AS s
  FROM requests r JOIN snapshots s ON r.loan_id = s.loan_id AND s.feature_ts <= r.req_ts
    AND s.feature_ts > r.req_ts - INTERVAL {ttl} SECOND GROUP BY r.event_id
)
SELECT r.event_id, r.loan_id, strftime(req_ts, '%Y-%m-%d %H:%M:%S') AS req_ts,
  round(CASE WHEN h.event_id IS NOT NULL THEN h.s.v ELSE value END, 6) AS value,
  CASE WHEN h.event_id IS NOT NULL THEN 'redis_cache' ELSE 'request_payload' END AS features_source,
  strftime(h.s.t, '%Y-%m-%d %H:%M:%S') AS feature_ts
FROM requests r LEFT JOIN hits h ON r.event_id = h.event_id"""
    )


@query("feature_lookup", lookup_sql(3600))
def feature_lookup(spark, sf_dir):
    requests, snapshots = fx.lookup_frames(spark, sf_dir)
    return rounded(joins.feature_lookup(requests, snapshots, version="version"))


@query("feature_lookup_day", lookup_sql(86400))
def feature_lookup_day(spark, sf_dir):
    requests, snapshots = fx.lookup_frames(spark, sf_dir)
    return rounded(joins.feature_lookup(requests, snapshots, version="version", ttl=86400))


@query(
    "feature_snapshot",
    """SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS feature_ts,
  arg_max('{"event_type":"' || event_type || '","event_id":' || event_id || '}', (ts, event_id)) AS features
FROM events GROUP BY user_id""",
)
def snapshot(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    newest = feature_snapshot(events.select("user_id", "event_type", "event_id", "ts"), "user_id", "ts", "event_id")
    # the document also holds its time stamp; only the plain fields are compared
    parsed = F.from_json("features", "event_type string, event_id bigint")
    return rounded(newest.withColumn("features", F.to_json(parsed)))


SHARE = "(CAST('0x' || substr(sha256(loan_id || '#0'), 1, 12) AS BIGINT) % 10000) / 10000.0"


@query(
    "routing",
    f"""SELECT model_type, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM (
  SELECT o_orderkey, CASE WHEN {SHARE} < 0.3 THEN 'challenger' ELSE 'champion' END AS model_type
  FROM (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS loan_id FROM orders)) GROUP BY 1""",
)
def routing(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("loan_id"))
    routed = scoring.route(orders, 30)
    return routed.groupBy("model_type").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


BATCH = "CAST(o_custkey AS VARCHAR)"


@query(
    "routing_batches",
    f"""SELECT o_orderkey, CASE WHEN {SHARE.replace('loan_id', BATCH)} < 0.5 THEN 'challenger' ELSE 'champion' END AS model_type FROM orders""",
)
def routing_batches(spark, sf_dir):
    """A customer's requests form one batch and go to one model."""
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return scoring.route(orders, 50, key="o_custkey").select("o_orderkey", "model_type")


@query(
    "risk_level",
    """SELECT event_id, CASE WHEN value / 100 > 0.7 THEN 'high' WHEN value / 100 > 0.3 THEN 'medium' ELSE 'low' END AS risk_level
FROM events""",
)
def risk_level(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    return events.select("event_id", scoring.risk_level(F.col("value") / 100).alias("risk_level"))


# Fixed scorers: champion and challenger weigh the same few inputs differently.
CHAMPION_WEIGHTS = {"dti": 0.03, "int_rate": 0.05, "grade_A": -1.0, "grade_G": 1.0, "annual_inc": -0.00001}
CHALLENGER_WEIGHTS = {"dti": 0.02, "int_rate": 0.08, "grade_A": -0.5, "grade_G": 0.5, "annual_inc": -0.00002}


def served(kind: str) -> scoring.ServedModel:
    weights, intercept = (CHAMPION_WEIGHTS, -2.0) if kind == "champion" else (CHALLENGER_WEIGHTS, -1.5)
    linear = scoring.linear_scorer(weights, intercept)

    def score(df):
        names = list(weights)
        keep = tuple(c for c in df.columns if c not in names)
        return linear(online_encode(df, names, keep=keep))

    return scoring.ServedModel("credit_scoring_model", "1" if kind == "champion" else "2", score)


def margin_sql(weights: dict[str, float], intercept: float) -> str:
    columns = {
        "grade_A": "CASE WHEN grade = 'A' THEN 1e0 ELSE 0e0 END",
        "grade_G": "CASE WHEN grade = 'G' THEN 1e0 ELSE 0e0 END",
    }
    terms = " + ".join(f"coalesce({columns.get(c, c)}, 0) * CAST({w:.6f} AS DOUBLE)" for c, w in weights.items())
    return f"1 / (1 + exp(-(CAST({intercept} AS DOUBLE) + {terms})))"


SCORE_SQL = f"""routed AS (
  SELECT *, CASE WHEN {SHARE} < 0.3 THEN 'challenger' ELSE 'champion' END AS model_type FROM request_errors WHERE len(errors) = 0
), predicted AS (
  SELECT *, CASE WHEN model_type = 'champion' THEN {margin_sql(CHAMPION_WEIGHTS, -2.0)}
    ELSE {margin_sql(CHALLENGER_WEIGHTS, -1.5)} END AS pd, CASE WHEN model_type = 'champion' THEN '1' ELSE '2' END AS model_version
  FROM routed
)"""
RECORD_SQL = """SELECT loan_id, model_type, CASE WHEN pd > 0.5 THEN 1 ELSE 0 END AS prediction, round(pd, 6) AS probability_default,
  round(1 - pd, 6) AS probability_repayment, CASE WHEN pd > 0.7 THEN 'high' WHEN pd > 0.3 THEN 'medium' ELSE 'low' END AS risk_level,
  'credit_scoring_model' AS model_name, model_version FROM predicted"""
RECORD = [
    "loan_id", "model_type", "prediction", "probability_default", "probability_repayment", "risk_level", "model_name",
    "model_version",
]


@query("batch_score", with_(LOANS, REQUEST_ROWS, SCORE_SQL) + RECORD_SQL)
def batch_score(spark, sf_dir):
    valid, _ = validate_requests(fx.request_rows(spark, sf_dir))
    scored = scoring.score(valid, served("champion"), served("challenger"), 30)
    return rounded(scored.select(*RECORD))


@query(
    "prediction_log",
    with_(LOANS, REQUEST_ROWS, SCORE_SQL)
    + """SELECT model_type, CASE WHEN pd > 0.7 THEN 'high' WHEN pd > 0.3 THEN 'medium' ELSE 'low' END AS risk_level,
  grade, count(*) AS n, round(avg(pd), 6) AS mean_probability FROM predicted GROUP BY ALL""",
)
def prediction_log(spark, sf_dir):
    """Nested log records as written, aggregated through their structures."""
    valid, _ = validate_requests(fx.request_rows(spark, sf_dir))
    scored = scoring.score(valid, served("champion"), served("challenger"), 30)
    records = prediction_records(scored.withColumn("features_source", F.lit(joins.PAYLOAD)), ["grade", "term"])
    path = new_path(spark, "prediction-log")
    write_prediction_log(records, path)
    records = spark.read.parquet(path)
    return rounded(
        records.groupBy(
            "model_type", F.col("prediction_details.risk_level"), F.col("input_features.grade")
        ).agg(F.count("*").alias("n"), F.avg("prediction_details.probability_default").alias("mean_probability"))
    )
