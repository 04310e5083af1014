"""Profiles and exploratory tables."""

from __future__ import annotations

from itertools import combinations

from riskframe import fixtures as fx
from riskframe.catalog.cleaning import NUMERIC, TYPED
from riskframe.catalog.features import TARGET_SQL
from riskframe.catalog.registry import query, rounded
from riskframe.catalog.views import LOANS, SCORED, with_
from riskframe.operators import clean, features, profile

STAT = ["loan_amnt", "installment", "annual_inc", "dti", "revol_util", "revol_bal", "open_acc", "mths_since_last_delinq"]
SPARK_TYPES = {
    "bigint": ["o_orderkey", "revol_bal", "tot_hi_cred_lim", "open_acc"],
    "double": ["loan_amnt", "installment", "annual_inc", "dti", "revol_util", "total_debt", "mths_since_last_delinq"],
    "int": ["delinq_2yrs"],
    "timestamp_ntz": ["earliest_cr_line"],
}


def _type_of(c: str) -> str:
    return next((t for t, cs in SPARK_TYPES.items() if c in cs), "string")


@query(
    "dataset_profile",
    with_(LOANS)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{_type_of(c)}' AS dtype, count(*) AS rows, count(*) - count({c}) AS missing FROM loans"
        for c in fx.LOAN_COLUMNS
    ),
)
def dataset_profile(spark, sf_dir):
    return profile.dataset_profile(fx.loans(spark, sf_dir))


def _describe_sql(c: str, by: str = "") -> str:
    return (
        f"SELECT {by + ', ' if by else ''}'{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min, "
        + ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS {n}" for n, p in profile.QUARTILES.items())
        + f", round(CAST(max({c}) AS DOUBLE), 6) AS max FROM loans_t" + (f" GROUP BY {by}" if by else "")
    )


WITH_TARGET = f'loans_t AS (SELECT *, {TARGET_SQL} AS "default" FROM loans)'


@query("describe", with_(LOANS, WITH_TARGET) + " UNION ALL ".join(_describe_sql(c) for c in STAT))
def describe(spark, sf_dir):
    return rounded(profile.describe_numeric(fx.loans(spark, sf_dir, STAT)))


@query("describe_by_target", with_(LOANS, WITH_TARGET) + " UNION ALL ".join(_describe_sql(c, '"default"') for c in STAT))
def describe_by_target(spark, sf_dir):
    frame = features.with_target(fx.loans(spark, sf_dir, [*STAT, "loan_status"]))
    return rounded(profile.describe_numeric(frame, STAT, by="default"))


@query(
    "missing_top10",
    with_(LOANS)
    + "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, round((count(*) - count({c})) * 100.0 / count(*), 6) AS percent FROM loans"
        for c in fx.LOAN_COLUMNS
    )
    + ') WHERE missing > 0 ORDER BY percent DESC, "column" LIMIT 10',
)
def missing_top10(spark, sf_dir):
    return rounded(profile.missing_summary(fx.loans(spark, sf_dir)))


@query(
    "value_counts",
    with_(LOANS)
    + """SELECT emp_length AS value, count(*) AS n, round(count(*) / (SELECT CAST(count(emp_length) AS DOUBLE) FROM loans), 6) AS share
FROM loans WHERE emp_length IS NOT NULL GROUP BY emp_length""",
)
def value_counts(spark, sf_dir):
    return rounded(profile.value_counts(fx.loans(spark, sf_dir, ["emp_length"]), "emp_length"))


TOP = ["loan_id", "emp_length", "purpose", "grade", "sub_grade", "issue_d", "loan_status"]


@query(
    "top_values",
    with_(LOANS)
    + " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS "column", count(*) OVER () AS "distinct",
  row_number() OVER (ORDER BY n DESC, value) AS rank, value, n
  FROM (SELECT {c} AS value, count(*) AS n FROM loans WHERE {c} IS NOT NULL GROUP BY {c})) WHERE rank <= 10"""
        for c in TOP
    ),
)
def top_values(spark, sf_dir):
    return profile.top_values(fx.loans(spark, sf_dir, TOP), TOP)


@query(
    "crosstab",
    with_(LOANS, WITH_TARGET)
    + """SELECT sub_grade AS category, round(avg(CASE WHEN "default" = 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_0,
  round(avg(CASE WHEN "default" = 1 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_1
FROM loans_t GROUP BY sub_grade ORDER BY round(avg(CASE WHEN "default" = 1 THEN 1.0 ELSE 0.0 END) * 100, 9) DESC, sub_grade LIMIT 10""",
)
def crosstab(spark, sf_dir):
    frame = features.with_target(fx.loans(spark, sf_dir, ["sub_grade", "loan_status"]))
    return rounded(profile.crosstab_rate(frame, "sub_grade", "default"))


@query(
    "default_rate_by_month",
    with_(LOANS, WITH_TARGET)
    + """SELECT issue_d, count(*) AS loans, round(avg("default"), 6) AS default_rate
FROM loans_t GROUP BY issue_d ORDER BY round(avg("default"), 9) DESC, issue_d LIMIT 10""",
)
def default_rate_by_month(spark, sf_dir):
    frame = features.with_target(fx.loans(spark, sf_dir, ["issue_d", "loan_status"]))
    return rounded(profile.default_rate_by(frame, "issue_d", "default"))


@query(
    "correlation",
    with_(LOANS, TYPED)
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM typed" for a, b in combinations(NUMERIC, 2)
    ),
)
def correlation(spark, sf_dir):
    frame = clean.typed(fx.loans(spark, sf_dir, ["o_orderkey", *NUMERIC]))
    return rounded(profile.correlation_matrix(frame, NUMERIC))


@query(
    "histogram",
    with_(SCORED)
    + """, ranges AS (SELECT y, min(p) AS lo, max(p) AS hi, (max(p) - min(p)) / 50 AS w, count(*) AS total FROM scored GROUP BY y),
binned AS (SELECT s.y, least(CAST(floor((p - lo) / w) AS INT), 49) AS bin, lo, w, total FROM scored s JOIN ranges r ON s.y = r.y)
SELECT y AS label, bin, round(any_value(lo) + bin * any_value(w), 6) AS "left", count(*) AS n,
  round(count(*) / (any_value(total) * any_value(w)), 6) AS density FROM binned GROUP BY y, bin""",
)
def histogram(spark, sf_dir):
    return rounded(profile.histogram_by_class(fx.scored_only(spark, sf_dir), "p", "y"))


@query(
    "class_weights",
    with_(SCORED)
    + """SELECT count(*) FILTER (y = 0) AS negatives, count(*) FILTER (y = 1) AS positives,
  round(count(*) FILTER (y = 0) / CAST(count(*) FILTER (y = 1) AS DOUBLE), 6) AS scale_pos_weight,
  round(count(*) / (2.0 * count(*) FILTER (y = 0)), 6) AS weight_0,
  round(count(*) / (2.0 * count(*) FILTER (y = 1)), 6) AS weight_1 FROM scored""",
)
def class_weights(spark, sf_dir):
    return rounded(profile.class_weights(fx.scored_only(spark, sf_dir), "y"))


@query(
    "content_hash",
    """WITH digests AS (
  SELECT sha256('{"l_linenumber":' || l_linenumber || ',"l_linestatus":"' || l_linestatus || '","l_orderkey":' || l_orderkey
    || ',"l_partkey":' || l_partkey || ',"l_returnflag":"' || l_returnflag || '"}') AS d FROM lineitem
), sums AS (
  SELECT count(*) AS rows, sum(CAST('0x' || substr(d, 1, 15) AS BIGINT)) AS a, sum(CAST('0x' || substr(d, 16, 15) AS BIGINT)) AS b
  FROM digests
) SELECT rows, sha256(rows || '|' || a || '|' || b) AS digest FROM sums""",
)
def content_hash(spark, sf_dir):
    columns = ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    return profile.content_hash(fx.table(spark, sf_dir, "lineitem").select(*columns))
