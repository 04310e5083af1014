"""Drift, live performance and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe import fixtures as fx
from riskframe.catalog.evaluation import CONFUSION, auc_sql, rates_sql
from riskframe.catalog.registry import query, rounded
from riskframe.catalog.views import DRIFT, SCORED, with_
from riskframe.operators import drift, gates
from riskframe.plans.monitoring import monitor
from riskframe.session import new_path

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]
CATEGORIES = ["l_returnflag", "l_linestatus"]


def ks_sql(column: str, reference: str, current: str, source: str | None = None) -> str:
    """One row with statistic, sizes and p-value."""
    c = source or column
    return f"""SELECT '{column}' AS "column", d AS statistic, n_reference, n_current,
  CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest(2 * list_sum(list_transform(range(1, 101),
    lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * lam * lam))), 0.0), 1.0) END AS p_value
FROM (SELECT *, d * sqrt(CAST(n_reference AS DOUBLE) * n_current / (n_reference + n_current)) AS lam FROM (
  SELECT max(abs(cr / CAST(nr AS DOUBLE) - cc / CAST(nc AS DOUBLE))) AS d, CAST(any_value(nr) AS BIGINT) AS n_reference, CAST(any_value(nc) AS BIGINT) AS n_current
  FROM (SELECT sum(r) OVER (ORDER BY v) AS cr, sum(c) OVER (ORDER BY v) AS cc, sum(r) OVER () AS nr, sum(c) OVER () AS nc
    FROM (SELECT v, sum(r) AS r, sum(c) AS c FROM (
      SELECT {c} AS v, 1 AS r, 0 AS c FROM {reference} UNION ALL SELECT {c}, 0, 1 FROM {current}) GROUP BY v))))"""


KS = " UNION ALL ".join(ks_sql(c, "drift_ref", "drift_cur") for c in NUMBERS)


@query(
    "ks_drift",
    with_(DRIFT)
    + f"""SELECT "column", round(statistic, 6) AS statistic, n_reference, n_current, round(p_value, 6) AS p_value, p_value < 0.05 AS drifted
FROM ({KS})""",
)
def ks_drift(spark, sf_dir):
    return rounded(drift.ks_drift(*fx.drift_frames(spark, sf_dir), NUMBERS))


def chi2_sql(column: str, reference: str, current: str) -> str:
    return f"""SELECT '{column}' AS "column", sum((r - er) * (r - er) / er + (c - ec) * (c - ec) / ec) AS statistic,
  count(*) - 1 AS dof, CAST(any_value(nr) AS BIGINT) AS n_reference, CAST(any_value(nc) AS BIGINT) AS n_current
FROM (SELECT *, (r + c) * CAST(nr AS DOUBLE) / (nr + nc) AS er, (r + c) * CAST(nc AS DOUBLE) / (nr + nc) AS ec FROM (
  SELECT *, sum(r) OVER () AS nr, sum(c) OVER () AS nc FROM (SELECT v, sum(r) AS r, sum(c) AS c FROM (
    SELECT {column} AS v, 1 AS r, 0 AS c FROM {reference} UNION ALL SELECT {column}, 0, 1 FROM {current}) GROUP BY v)))"""


# upper tail as 1 minus the Poisson-weighted series of the lower incomplete gamma function
CHI2 = f"""SELECT *, greatest(1 - list_sum(list_transform(range(0, 3000),
  lambda n: exp((dof / 2.0 + n) * ln(statistic / 2) - statistic / 2 - lgamma(dof / 2.0 + n + 1)))), 0.0) AS p_value
FROM ({" UNION ALL ".join(chi2_sql(c, 'drift_ref', 'drift_cur') for c in CATEGORIES)})"""


@query(
    "chi2_drift",
    with_(DRIFT)
    + f"""SELECT "column", round(statistic, 4) AS statistic, dof, n_reference, n_current,
  CASE WHEN statistic > 2000 THEN 0.0 ELSE round(p_value, 6) END AS p_value,
  CASE WHEN statistic > 2000 THEN true ELSE p_value < 0.05 END AS drifted FROM ({CHI2})""",
)
def chi2_drift(spark, sf_dir):
    frame = drift.chi2_drift(*fx.drift_frames(spark, sf_dir), CATEGORIES)
    return rounded(frame.withColumn("statistic", F.round("statistic", 4)))


ALL_TESTS = f"""tests AS (
  SELECT "column", 'ks' AS test, statistic, p_value, p_value < 0.05 AS drifted FROM ({KS})
  UNION ALL SELECT "column", 'chi2', statistic, CASE WHEN statistic > 2000 THEN 0.0 ELSE p_value END,
    CASE WHEN statistic > 2000 THEN true ELSE p_value < 0.05 END FROM ({CHI2})
)"""


@query(
    "column_drift",
    with_(DRIFT, ALL_TESTS)
    + 'SELECT "column", test, round(statistic, 4) AS statistic, round(p_value, 6) AS p_value, drifted FROM tests',
)
def column_drift(spark, sf_dir):
    frame = drift.column_drift(*fx.drift_frames(spark, sf_dir))
    return rounded(frame.withColumn("statistic", F.round("statistic", 4)))


@query(
    "dataset_drift",
    with_(DRIFT, ALL_TESTS)
    + """SELECT count(*) AS columns, count(*) FILTER (drifted) AS drifted_columns,
  round(count(*) FILTER (drifted) / CAST(count(*) AS DOUBLE), 6) AS drift_share,
  count(*) FILTER (drifted) / CAST(count(*) AS DOUBLE) > 0.3 AS dataset_drift FROM tests""",
)
def dataset_drift(spark, sf_dir):
    return rounded(drift.dataset_drift(*fx.drift_frames(spark, sf_dir)))


@query(
    "drift_report",
    with_(DRIFT, ALL_TESTS)
    + """SELECT 'report' AS part, "column" AS name, round(p_value, 6) AS value FROM tests
UNION ALL SELECT 'metrics', 'drifted_columns', CAST(count(*) FILTER (drifted) AS DOUBLE) FROM tests
UNION ALL SELECT 'metrics', 'drift_share', round(count(*) FILTER (drifted) / CAST(count(*) AS DOUBLE), 6) FROM tests""",
)
def drift_report(spark, sf_dir):
    """What the monitoring job leaves behind: its report as JSON lines and the rows of the metrics table."""
    report, metrics = new_path(spark, "report"), new_path(spark, "metrics")
    monitor(*fx.drift_frames(spark, sf_dir), metrics, report, "run-1")
    rows = spark.read.json(report).select(F.lit("report").alias("part"), F.col("column").alias("name"), F.col("p_value").alias("value"))
    logged = spark.read.parquet(metrics).filter("run_id = 'run-1' AND scope = 'drift'")
    return rounded(rows.unionByName(logged.select(F.lit("metrics").alias("part"), "name", "value")))


HALVES = """
early AS (SELECT * FROM scored WHERE ts < TIMESTAMP '1998-01-01 00:00:00'),
late AS (SELECT *, p * p AS q FROM scored WHERE ts >= TIMESTAMP '1998-01-01 00:00:00')"""


@query(
    "prediction_drift",
    with_(SCORED, HALVES, "late_p AS (SELECT q AS p FROM late)")
    + f"""SELECT "column", round(statistic, 6) AS statistic, n_reference, n_current, round(p_value, 6) AS p_value, p_value < 0.05 AS drifted
FROM ({ks_sql('p', 'early', 'late_p')})""",
)
def prediction_drift(spark, sf_dir):
    rows = fx.scored_only(spark, sf_dir)
    cut = F.lit(fx.EPOCH_1998).cast("timestamp")
    early = rows.filter(F.col("ts") < cut).select("p")
    late = rows.filter(F.col("ts") >= cut).select((F.col("p") * F.col("p")).alias("p"))
    return rounded(drift.prediction_drift(early, late, "p"))


KNOWN = "known AS (SELECT s.* FROM scored s WHERE CAST(loan_id AS BIGINT) % 3 <> 0)"


@query(
    "live_performance",
    with_(SCORED, KNOWN)
    + f""", basic AS (SELECT {rates_sql(False)} FROM (SELECT {CONFUSION} FROM known)), area AS ({auc_sql('known')})
"""
    + " UNION ALL ".join(
        f"SELECT '{n}' AS name, round({n}, 6) AS value FROM {t}"
        for n, t in [("accuracy", "basic"), ("f1_score", "basic"), ("precision", "basic"), ("recall", "basic"), ("auc", "area")]
    ),
)
def live_performance(spark, sf_dir):
    rows = fx.scored_only(spark, sf_dir)
    outcome = F.when(F.col("loan_id").cast("bigint") % 3 != 0, F.col("y")).alias("y")  # a third is still open
    return rounded(drift.live_performance(rows.drop("y"), rows.select("loan_id", outcome)))


QUALITY_BOUNDS = {"l_discount": (0.0, 0.05), "l_quantity": (0.0, 1000.0)}


def _quality_sql() -> str:
    rows = []
    for c in NUMBERS + CATEGORIES:
        rows.append(
            f"""SELECT '{c}' AS "column", 'missing_share' AS test, (count(*) - count({c})) / CAST(count(*) AS DOUBLE) AS value,
  (SELECT (count(*) - count({c})) / CAST(count(*) AS DOUBLE) + 0.1 FROM drift_ref) AS "limit" FROM drift_cur"""
        )
        rows.append(
            f"SELECT '{c}', 'constant', CASE WHEN min({c}) = max({c}) THEN 1e0 ELSE 0e0 END, 0e0 FROM drift_cur"
        )
    for c in NUMBERS:
        rows.append(f"SELECT '{c}', 'min', min({c}), (SELECT min({c}) FROM drift_ref) FROM drift_cur")
        rows.append(f"SELECT '{c}', 'max', max({c}), (SELECT max({c}) FROM drift_ref) FROM drift_cur")
    for c in CATEGORIES:
        rows.append(
            f"SELECT '{c}', 'new_categories', CAST(count(DISTINCT {c}) AS DOUBLE), 0e0 FROM drift_cur "
            f"WHERE {c} NOT IN (SELECT {c} FROM drift_ref)"
        )
    rows.append(
        "SELECT '*', 'duplicate_share', 1 - (SELECT count(*) FROM (SELECT DISTINCT * FROM drift_cur)) / CAST(count(*) AS DOUBLE), 0e0 FROM drift_cur"
    )
    for c, (lo, hi) in QUALITY_BOUNDS.items():
        rows.append(f"SELECT '{c}', 'lower_bound', min({c}), CAST({lo} AS DOUBLE) FROM drift_cur")
        rows.append(f"SELECT '{c}', 'upper_bound', max({c}), CAST({hi} AS DOUBLE) FROM drift_cur")
    return (
        with_(DRIFT)
        + ", tests AS ("
        + " UNION ALL ".join(rows)
        + """), judged AS (SELECT "column", test, value, "limit",
  CASE WHEN test IN ('min', 'lower_bound') THEN value >= "limit" ELSE value <= "limit" END AS passed FROM tests)"""
    )


def _quality(spark, sf_dir):
    return drift.data_quality(*fx.drift_frames(spark, sf_dir), bounds=QUALITY_BOUNDS)


@query("data_quality", _quality_sql() + 'SELECT "column", test, round(value, 6) AS value, round("limit", 6) AS "limit", passed FROM judged')
def data_quality(spark, sf_dir):
    return rounded(_quality(spark, sf_dir))


@query(
    "validation_gate",
    _quality_sql()
    + "SELECT count(*) AS checks, count(*) FILTER (NOT passed) AS failed, bool_and(passed) AS passed FROM judged",
)
def validation_gate(spark, sf_dir):
    return gates.all_passed(_quality(spark, sf_dir))
