"""Evaluation of scored rows, fairness audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe import fixtures as fx
from riskframe.catalog.registry import query, r6, rounded
from riskframe.catalog.views import LABEL_SCORED, SCORED, with_
from riskframe.operators import fairness, metrics
from riskframe.operators.fairness import GROUP_METRICS

CONFUSION = """count(*) FILTER (y = 0 AND y_pred = 0) AS tn, count(*) FILTER (y = 0 AND y_pred = 1) AS fp,
  count(*) FILTER (y = 1 AND y_pred = 0) AS fn, count(*) FILTER (y = 1 AND y_pred = 1) AS tp"""


def div(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


RATES = {
    "accuracy": div("tp + tn", "tn + fp + fn + tp"),
    "precision": div("tp", "tp + fp"),
    "recall": div("tp", "tp + fn"),
    "f1_score": div("2 * tp", "2 * tp + fp + fn"),
}


def rates_sql(digits: bool = True) -> str:
    return ", ".join(f"{'round(' if digits else ''}{e}{', 6)' if digits else ''} AS {n}" for n, e in RATES.items())


@query("confusion", with_(SCORED) + f"SELECT {CONFUSION} FROM scored")
def confusion(spark, sf_dir):
    return metrics.confusion(fx.scored_only(spark, sf_dir))


@query("binary_metrics", with_(SCORED) + f"SELECT {rates_sql()} FROM (SELECT {CONFUSION} FROM scored)")
def binary_metrics(spark, sf_dir):
    return rounded(metrics.binary_metrics(fx.scored_only(spark, sf_dir)))


def report_sql(source: str) -> str:
    return f"""per_class AS (
  SELECT label, {div('tp', 'predicted')} AS precision, {div('tp', 'support')} AS recall,
    {div('2 * tp', 'predicted + support')} AS f1_score, support
  FROM (SELECT CAST(c.label AS VARCHAR) AS label, count(*) FILTER (y = c.label AND y_pred = c.label) AS tp,
    count(*) FILTER (y_pred = c.label) AS predicted, count(*) FILTER (y = c.label) AS support
    FROM {source}, (SELECT DISTINCT y AS label FROM {source} UNION SELECT DISTINCT y_pred FROM {source}) c GROUP BY c.label)
), report AS (
  SELECT * FROM per_class
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM per_class
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1_score * support) / sum(support), sum(support) FROM per_class
)"""


@query(
    "class_report",
    with_(LABEL_SCORED, report_sql("label_scored"))
    + f"SELECT label, {r6('precision', 'recall', 'f1_score')}, CAST(support AS BIGINT) AS support FROM report",
)
def class_report(spark, sf_dir):
    return rounded(metrics.class_report(fx.label_scored(spark, sf_dir)))


def auc_sql(source: str, keys: str = "") -> str:
    """Rank-sum area per key, ties at half weight."""
    part = f"PARTITION BY {keys} " if keys else ""
    group = f" GROUP BY {keys}" if keys else ""
    pick = f"{keys}, " if keys else ""
    return f"""SELECT {pick}CASE WHEN sum(y) = 0 OR sum(y) = count(*) THEN -1.0 ELSE
  (sum(CASE WHEN y = 1 THEN r END) - CAST(sum(y) AS DOUBLE) * (sum(y) + 1) / 2) / (CAST(sum(y) AS DOUBLE) * (count(*) - sum(y))) END AS auc
FROM (SELECT *, rank() OVER ({part}ORDER BY p) + (count(*) OVER ({part.strip() + ', p' if keys else 'PARTITION BY p'}) - 1) / 2.0 AS r FROM {source}){group}"""


@query("roc_auc", with_(SCORED) + f"SELECT round(auc, 6) AS auc FROM ({auc_sql('scored')})")
def roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(fx.scored_only(spark, sf_dir)))


CURVE = """, by_score AS (SELECT p, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored GROUP BY p),
curve AS (SELECT p, pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn
  FROM by_score WINDOW w AS (ORDER BY p DESC))"""


@query(
    "roc_curve",
    with_(SCORED) + CURVE + "SELECT round(p, 6) AS threshold, round(fp / CAST(nn AS DOUBLE), 6) AS fpr, round(tp / CAST(np AS DOUBLE), 6) AS tpr FROM curve",
)
def roc_curve(spark, sf_dir):
    return rounded(metrics.roc_curve(fx.scored_only(spark, sf_dir)))


@query(
    "pr_curve",
    with_(SCORED) + CURVE + "SELECT round(p, 6) AS threshold, round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision, round(tp / CAST(np AS DOUBLE), 6) AS recall FROM curve",
)
def pr_curve(spark, sf_dir):
    return rounded(metrics.pr_curve(fx.scored_only(spark, sf_dir)))


@query(
    "avg_precision",
    with_(SCORED) + CURVE + "SELECT round(sum(CAST(pos AS DOUBLE) / np * tp / (tp + fp)), 6) AS avg_precision FROM curve",
)
def avg_precision(spark, sf_dir):
    return rounded(metrics.average_precision(fx.scored_only(spark, sf_dir)))


@query("brier", with_(SCORED) + "SELECT round(avg((p - y) * (p - y)), 6) AS brier FROM scored")
def brier(spark, sf_dir):
    return rounded(metrics.brier_score(fx.scored_only(spark, sf_dir)))


@query(
    "auc_gap",
    with_(SCORED, "timed AS (SELECT *, ts >= TIMESTAMP '1998-01-01 00:00:00' AS later FROM scored)")
    + f""", areas AS ({auc_sql('timed', 'later')})
SELECT round(max(auc) FILTER (NOT later), 6) AS train_auc, round(max(auc) FILTER (later), 6) AS validation_auc,
  round(max(auc) FILTER (NOT later) - max(auc) FILTER (later), 6) AS auc_gap FROM areas""",
)
def auc_gap(spark, sf_dir):
    rows = fx.scored_only(spark, sf_dir).withColumn("later", F.col("ts") >= F.lit(fx.EPOCH_1998).cast("timestamp"))
    return rounded(metrics.auc_gap(rows, "later"))


EVALUATE = f"""{with_(SCORED, report_sql('scored'))}, {CURVE[2:]},
basic AS (SELECT *, {rates_sql(False)} FROM (SELECT {CONFUSION} FROM scored)),
areas AS (SELECT (SELECT auc FROM ({auc_sql('scored')})) AS auc,
  (SELECT sum(CAST(pos AS DOUBLE) / np * tp / (tp + fp)) FROM curve) AS avg_precision),
""" + "long_rows AS (" + " UNION ALL ".join(
    [f"SELECT '{n}' AS name, CAST({n} AS DOUBLE) AS value FROM basic" for n in ["tn", "fp", "fn", "tp", *RATES]]
    + [f"SELECT '{n}', {n} FROM areas" for n in ("auc", "avg_precision")]
    + [f"SELECT '{n}_' || label, {c} FROM report" for n, c in
       [("precision", "precision"), ("recall", "recall"), ("f1-score", "f1_score"), ("support", "CAST(support AS DOUBLE)")]]
) + ")"


@query("evaluate", EVALUATE + "SELECT name, round(value, 6) AS value FROM long_rows")
def evaluate(spark, sf_dir):
    return rounded(metrics.evaluate(fx.scored_only(spark, sf_dir)))


ATTRIBUTES = ["home_ownership", "purpose", "family"]


def melt_sql(attributes: list[str], source: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature, {a} AS \"group\", {columns} FROM {source} WHERE {a} IS NOT NULL" for a in attributes
    )


@query(
    "metrics_by_group",
    with_(SCORED, f"melted AS ({melt_sql(ATTRIBUTES, 'scored', 'y, y_pred, p')})")
    + f""", areas AS ({auc_sql('melted', 'feature, "group"')}),
cells AS (SELECT feature, "group", count(*) AS count, {CONFUSION} FROM melted GROUP BY ALL)
SELECT c.feature, c."group", c.count, {rates_sql()}, round(auc, 6) AS auc
FROM cells c JOIN areas a ON a.feature = c.feature AND a."group" = c."group" """,
)
def metrics_by_group(spark, sf_dir):
    return rounded(metrics.metrics_by_group(fx.scored(spark, sf_dir), ATTRIBUTES))


def groups_sql(attributes: list[str], source: str) -> str:
    tpr, fpr = div("tp", "tp + fn"), div("fp", "fp + tn")
    return f"""melted AS ({melt_sql(attributes, source, 'y, y_pred')}),
cells AS (SELECT feature, "group", {CONFUSION} FROM melted GROUP BY ALL),
fair AS (SELECT feature, "group", tn + fp + fn + tp AS count, {div('tp + fp', 'tn + fp + fn + tp')} AS positive_rate,
  {tpr} AS true_positive_rate, {fpr} AS false_positive_rate, {rates_sql(False)},
  CASE WHEN tp + fn > 0 AND fp + tn > 0 THEN (({tpr}) + 1 - ({fpr})) / 2 ELSE -1.0 END AS auc FROM cells),
spread AS (SELECT feature, metric, count(*) AS n, min(v) AS min, max(v) AS max, avg(v) AS mean, stddev_pop(v) AS std FROM (
  {" UNION ALL ".join(f"SELECT feature, '{m}' AS metric, {m} AS v FROM fair" for m in GROUP_METRICS)}) WHERE v <> -1 GROUP BY ALL),
gaps AS (
  SELECT feature, 'max_' || metric || '_difference' AS name, max - min AS value FROM spread WHERE n > 1
  UNION ALL SELECT feature, metric || '_std', std FROM spread WHERE n > 1
  UNION ALL SELECT feature, metric || '_cv', CASE WHEN mean = 0 THEN 0 ELSE std / mean END FROM spread WHERE n > 1)"""


FAIR = with_(SCORED, groups_sql(ATTRIBUTES, "scored"))
FAIR_LABELS = with_(LABEL_SCORED, groups_sql(["lang", "source"], "label_scored"))


def _groups(spark, sf_dir):
    return fairness.fairness_groups(fx.scored(spark, sf_dir), ATTRIBUTES)


@query("fairness_groups", FAIR + f'SELECT feature, "group", count, {r6(*GROUP_METRICS)} FROM fair')
def fairness_groups(spark, sf_dir):
    return rounded(_groups(spark, sf_dir))


@query("fairness_groups_labels", FAIR_LABELS + f'SELECT feature, "group", count, {r6(*GROUP_METRICS)} FROM fair')
def fairness_groups_labels(spark, sf_dir):
    return rounded(fairness.fairness_groups(fx.label_scored(spark, sf_dir), ["lang", "source"]))


@query("disparities", FAIR + "SELECT feature, name, round(value, 6) AS value FROM gaps")
def disparities(spark, sf_dir):
    return rounded(fairness.disparities(_groups(spark, sf_dir)))


FLAGS = """SELECT feature, coalesce(string_agg(name, ',' ORDER BY name) FILTER (value > 0.1), '') AS flagged,
  count(*) FILTER (value > 0.1) AS n_flagged, round(coalesce(max(value) FILTER (value > 0.1), 0.0), 6) AS max_disparity,
  count(*) FILTER (value > 0.1) > 0 AS has_bias,
  CASE WHEN count(*) FILTER (value > 0.1) > 0 THEN 'Potential bias detected' ELSE 'No significant bias detected' END AS concern
FROM gaps GROUP BY feature"""


@query("bias_flags", FAIR + FLAGS)
def bias_flags(spark, sf_dir):
    flags = fairness.bias_flags(fairness.disparities(_groups(spark, sf_dir)))
    return rounded(flags.withColumn("flagged", F.array_join("flagged", ",")))


@query("bias_flags_labels", FAIR_LABELS + FLAGS)
def bias_flags_labels(spark, sf_dir):
    groups = fairness.fairness_groups(fx.label_scored(spark, sf_dir), ["lang", "source"])
    flags = fairness.bias_flags(fairness.disparities(groups))
    return rounded(flags.withColumn("flagged", F.array_join("flagged", ",")))


@query(
    "fairness_summary",
    FAIR
    + f"""SELECT feature, metric, {r6('min', 'max', 'mean', 'std')} FROM spread
WHERE feature IN (SELECT feature FROM fair GROUP BY feature HAVING count(*) > 1)""",
)
def fairness_summary(spark, sf_dir):
    return rounded(fairness.fairness_summary(_groups(spark, sf_dir)))


@query(
    "aligned_attributes",
    with_(SCORED)
    + """SELECT home_ownership, verification_status, count(*) AS n, CAST(sum(y_pred) AS BIGINT) AS predicted
FROM scored s JOIN (SELECT CAST(o_orderkey AS VARCHAR) AS loan_id,
  CASE o_orderkey % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Source Verified' ELSE 'Not Verified' END AS verification_status FROM orders) a
ON s.loan_id = a.loan_id GROUP BY ALL""",
)
def aligned_attributes(spark, sf_dir):
    attributes = fx.loans(spark, sf_dir, ["loan_id", "verification_status", "home_ownership"], repeats=False)
    joined = fairness.align_attributes(fx.scored_only(spark, sf_dir), attributes)
    return joined.groupBy("home_ownership", "verification_status").agg(
        F.count("*").alias("n"), F.sum("y_pred").alias("predicted")
    )
