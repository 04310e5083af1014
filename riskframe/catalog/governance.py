"""Gates, runs, versions and promotions."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe import fixtures as fx
from riskframe.catalog.evaluation import ATTRIBUTES, CONFUSION, FAIR, auc_sql, div, rates_sql
from riskframe.catalog.registry import query, rounded
from riskframe.catalog.views import REGISTRY, SCORED, with_
from riskframe.operators import fairness, gates, registry
from riskframe.schemas import PROMOTION_LIMITS
from riskframe.sources.sinks import metric_rows

METRICS = (
    with_(SCORED, "monthly AS (SELECT *, strftime(ts, '%Y-%m') AS month FROM scored)")
    + f""",
cells AS (SELECT month, {CONFUSION} FROM monthly GROUP BY month),
group_cells AS (SELECT month, home_ownership, {CONFUSION} FROM monthly GROUP BY ALL),
spreads AS (SELECT month, max(rate) - min(rate) AS max_positive_rate_difference FROM (
  SELECT month, {div('tp + fp', 'tp + fp + tn + fn')} AS rate FROM group_cells) GROUP BY month),
areas AS ({auc_sql('monthly', 'month')}),
wide AS (SELECT cells.*, {rates_sql(False)}, auc, abs(auc - 0.8) AS auc_gap, max_positive_rate_difference
  FROM cells JOIN areas ON areas.month = cells.month JOIN spreads ON spreads.month = cells.month),
metrics AS (SELECT 'run-' || month AS run_id, 'model-' || substr(month, 1, 4) AS model, name, CAST(value AS DOUBLE) AS value,
    strptime(month || '-01', '%Y-%m-%d') AS ts FROM ("""
    + " UNION ALL ".join(f"SELECT month, '{n}' AS name, {n} AS value FROM wide" for n in fx.RUN_METRICS)
    + """) WHERE NOT (name = 'auc' AND CAST(substr(month, 6, 2) AS INT) % 5 = 0)
    AND NOT (name = 'precision' AND CAST(substr(month, 6, 2) AS INT) % 7 = 0))"""
)
RUNS = METRICS + ", runs AS (SELECT DISTINCT run_id FROM metrics)"


def _value(name: str) -> str:
    return f"(SELECT max(value) FROM metrics m WHERE m.run_id = runs.run_id AND name = '{name}')"


def _limit_sql(metric: str, op: str, bound: float, required: bool) -> str:
    missing = "false" if required else "true"
    return f"""SELECT run_id, '{metric}' AS "check", round(v, 6) AS value, '{op}' AS op, round(CAST({bound} AS DOUBLE), 6) AS bound,
  CASE WHEN v IS NULL THEN {missing} ELSE v {op} {bound} END AS passed,
  CASE WHEN v IS NULL THEN '{'error' if required else 'warning'}' WHEN v {op} {bound} THEN 'info' ELSE 'error' END AS severity
FROM (SELECT run_id, {_value(metric)} AS v FROM runs)"""


def _gate_sql(floor: float, required: bool) -> str:
    present = " UNION ALL ".join(
        f"""SELECT run_id, '{n}' AS "check", round(v, 6) AS value, 'present' AS op, CAST(NULL AS DOUBLE) AS bound, true AS passed,
  CASE WHEN v IS NULL THEN 'warning' ELSE 'info' END AS severity FROM (SELECT run_id, {_value(n)} AS v FROM runs)"""
        for n in gates.EXPECTED_METRICS
    )
    return RUNS + _limit_sql("auc", ">=", floor, required) + " UNION ALL " + present


@query("gate_performance", _gate_sql(0.7, False))
def gate_performance(spark, sf_dir):
    return rounded(gates.gate_performance(fx.run_metrics(spark, sf_dir)))


@query("gate_strict", _gate_sql(0.75, True))
def gate_strict(spark, sf_dir):
    return rounded(gates.gate_performance(fx.run_metrics(spark, sf_dir), 0.75, required=True))


@query(
    "gate_fairness",
    FAIR
    + """SELECT count(*) AS disparities, count(*) FILTER (value > 0.1) AS over_limit,
  count(*) > 0 AND count(*) FILTER (value > 0.1) = 0 AS passed,
  CASE WHEN count(*) = 0 THEN 'no fairness report' WHEN count(*) FILTER (value > 0.1) > 0 THEN 'disparity above limit' ELSE 'ok' END AS reason
FROM gaps""",
)
def gate_fairness(spark, sf_dir):
    groups = fairness.fairness_groups(fx.scored(spark, sf_dir), ATTRIBUTES)
    return gates.gate_fairness(fairness.disparities(groups))


CHECKLIST = RUNS + " UNION ALL ".join(_limit_sql(x.metric, x.op, x.bound, x.required) for x in PROMOTION_LIMITS)


@query("promotion_checklist", CHECKLIST)
def promotion_checklist(spark, sf_dir):
    return rounded(gates.promotion_checklist(fx.run_metrics(spark, sf_dir)))


@query(
    "checklist_verdict",
    RUNS
    + ", checks AS ("
    + " UNION ALL ".join(_limit_sql(x.metric, x.op, x.bound, x.required) for x in PROMOTION_LIMITS)
    + ") SELECT run_id, count(*) AS checks, count(*) FILTER (NOT passed) AS failed, bool_and(passed) AS passed FROM checks GROUP BY run_id",
)
def checklist_verdict(spark, sf_dir):
    return gates.all_passed(gates.promotion_checklist(fx.run_metrics(spark, sf_dir)), ["run_id"])


@query(
    "metrics_long",
    METRICS
    + " SELECT month, name, round(CAST(value AS DOUBLE), 6) AS value FROM ("
    + " UNION ALL ".join(f"SELECT month, '{n}' AS name, {n} AS value FROM wide" for n in ["tn", "fp", "fn", "tp", "accuracy", "f1_score"])
    + ")",
)
def metrics_long(spark, sf_dir):
    from riskframe.operators.metrics import confusion, rates

    rows = fx.scored_only(spark, sf_dir).withColumn("month", F.date_format("ts", "yyyy-MM"))
    wide = confusion(rows, keys=["month"])
    picked = wide.withColumns({n: e for n, e in rates().items() if n in ("accuracy", "f1_score")})
    return rounded(metric_rows(picked, ["month"]))


@query(
    "latest_run",
    METRICS
    + """ SELECT model, run_id, name, round(value, 6) AS value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM metrics m
WHERE run_id = (SELECT max(run_id) FROM metrics x WHERE x.model = m.model)""",
)
def latest_run(spark, sf_dir):
    return rounded(registry.latest_run(fx.run_metrics(spark, sf_dir)).select("model", "run_id", "name", "value", "ts"))


def _pick_sql(match: str, fallback: str) -> str:
    return (
        with_(REGISTRY)
        + f"""SELECT name, version, stage, alias, strftime(creation_ts, '%Y-%m-%d %H:%M:%S') AS creation_ts, run_id,
  CASE WHEN hit = 1 THEN 'match' ELSE 'fallback' END AS how
FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY hit DESC, creation_ts DESC, version DESC) AS rn
  FROM (SELECT *, CASE WHEN coalesce({match}, false) THEN 1 ELSE 0 END AS hit FROM registry)
  WHERE hit = 1 OR {fallback}) WHERE rn = 1"""
    )


@query("pick_version", _pick_sql("alias = 'champion' OR lower(stage) = 'champion'", "stage IN ('Production', 'Staging')"))
def pick_version(spark, sf_dir):
    return rounded(registry.pick_version(fx.registry(spark, sf_dir), "champion"))


@query("pick_by_stage", _pick_sql("lower(stage) = 'archived' OR alias = 'archived'", "stage IN ('Production', 'Staging')"))
def pick_by_stage(spark, sf_dir):
    return rounded(registry.pick_version(fx.registry(spark, sf_dir), "Archived"))


@query("pick_exact", _pick_sql("version = 7", "false"))
def pick_exact(spark, sf_dir):
    return rounded(registry.pick_version(fx.registry(spark, sf_dir), 7))


@query(
    "registry_state",
    with_(REGISTRY)
    + """, states AS (
  SELECT name, version, arg_max(stage, (ts, seq)) FILTER (stage IS NOT NULL) AS stage,
    arg_max(description, (ts, seq)) FILTER (description IS NOT NULL) AS description, min(ts) AS creation_ts, max(ts) AS updated_ts
  FROM promotions GROUP BY name, version
), holders AS (
  SELECT name, version, string_agg(alias, ',' ORDER BY alias) AS aliases FROM (
    SELECT name, alias, arg_max(version, (ts, seq)) AS version FROM promotions WHERE alias IS NOT NULL GROUP BY name, alias
  ) GROUP BY name, version
)
SELECT s.name, s.version, stage, description, strftime(creation_ts, '%Y-%m-%d %H:%M:%S') AS creation_ts,
  strftime(updated_ts, '%Y-%m-%d %H:%M:%S') AS updated_ts, aliases
FROM states s LEFT JOIN holders h ON h.name = s.name AND h.version = s.version""",
)
def registry_state(spark, sf_dir):
    return rounded(registry.registry_state(fx.promotion_log(spark, sf_dir)))
