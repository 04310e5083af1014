"""Feature engineering, targets, splits and reference sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe import fixtures as fx
from riskframe.catalog.cleaning import CLEAN_CHAIN, KEY, TYPED, clean_frame
from riskframe.catalog.registry import query, r2, r6, rounded
from riskframe.catalog.views import LOANS, REQUEST_ROWS, Y, with_
from riskframe.operators import clean, features
from riskframe.operators.split import mark_test, with_fold
from riskframe.plans.datasets import build_features, reference_encoded, reference_features
from riskframe.schemas import BRACKETS, DEFAULT_STATUSES, RISK_LIMITS
from riskframe.session import new_path
from riskframe.sources.sinks import write_processed

EPS = "1e-8"
BIG_RATIOS = ("loan_income_ratio", "installment_income_ratio", "debt_income_ratio")
RATIO_SQL = {
    "debt_amnt": "annual_inc * dti / 100",
    "loan_income_ratio": f"loan_amnt / (annual_inc + {EPS})",
    "installment_income_ratio": f"installment * 12 / (annual_inc + {EPS})",
    "revol_util_ratio": f"revol_bal / (tot_hi_cred_lim + {EPS})",
    "debt_income_ratio": f"total_debt / (annual_inc + {EPS})",
}
GRADE_SQL = "CASE WHEN regexp_full_match(grade, '[A-G]') THEN CAST(ascii(grade) - 64 AS DOUBLE) ELSE 0.0 END"
SUB_GRADE_SQL = (
    "CASE WHEN regexp_full_match(sub_grade, '[A-G][1-5]') "
    "THEN CAST((ascii(sub_grade) - 65) * 5 + CAST(substr(sub_grade, 2, 1) AS INT) AS DOUBLE) ELSE 0.0 END"
)
ONEHOT_VALUES = {
    "home_ownership": ["ANY", "MORTGAGE", "OTHER", "OWN", "RENT"],
    "verification_status": ["Not Verified", "Source Verified", "Verified"],
    "initial_list_status": ["f", "w"],
}
ONEHOT_SQL = {
    f"{c}_{v}": f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END" for c, vs in ONEHOT_VALUES.items() for v in vs
}
TIME_SQL = {
    "issue_month": "month(issue_d)",
    "issue_year": "year(issue_d)",
    "issue_day_of_week": "isodow(issue_d) - 1",
    "term_numeric": "TRY_CAST(regexp_extract(term, '(\\d+)', 1) AS INT)",
    "credit_history_length_years": "greatest(floor((epoch(issue_d) - epoch(earliest_cr_line)) / 86400) / 365.25, 0.0)",
}
INTERACTION_SQL = {
    "loan_rate_interaction": "loan_amnt * int_rate / 100",
    "income_dti_interaction": "annual_inc * dti / 100",
    "grade_loan_interaction": f"({GRADE_SQL}) * loan_amnt",
}


def _bracket_sql(c: str) -> str:
    _, edges, labels = BRACKETS[c]
    steps = " ".join(f"WHEN {c} <= {e} THEN '{label}'" for e, label in zip(edges, labels))
    return f"CASE WHEN {c} IS NULL OR {c} < 0 THEN 'nan' {steps} ELSE '{labels[-1]}' END"


BIN_SQL = {BRACKETS[c][0]: _bracket_sql(c) for c in BRACKETS}
RISK_SQL = {name: f"CASE WHEN {c} > {limit} THEN 1 ELSE 0 END" for c, (name, limit) in RISK_LIMITS.items()}
RISK_SQL["combined_risk_score"] = " + ".join(f"({e})" for e in list(RISK_SQL.values()))
TARGET_SQL = f"CASE WHEN loan_status IN ({', '.join(repr(s) for s in DEFAULT_STATUSES)}) THEN 1 ELSE 0 END"
LONG_EMPLOYED_SQL = "CASE WHEN emp_length >= 5 THEN 1 ELSE 0 END"
CONSOLIDATION_SQL = "CASE WHEN purpose IN ('debt_consolidation', 'credit_card') THEN 1 ELSE 0 END"

KEPT = [
    "loan_id", "loan_amnt", "int_rate", "installment", "emp_length", "annual_inc", "dti", "revol_util", "revol_bal",
    "tot_hi_cred_lim", "total_debt", "open_acc", "delinq_2yrs", "loan_status", "mths_since_last_delinq",
]
KEPT_DOUBLES = [c for c in KEPT if c not in ("loan_id", "loan_status")]


def quoted(definitions: dict[str, str]) -> str:
    return ", ".join(f'{expr} AS "{name}"' for name, expr in definitions.items())


def rounded_sql(definitions: dict[str, str]) -> str:
    return quoted({n: f"round({e}, {2 if n in BIG_RATIOS else 6})" for n, e in definitions.items()})


FEATURES_SQL = f"""
featured AS (
  SELECT {KEY}, {', '.join(KEPT)}, {quoted(RATIO_SQL)},
    {GRADE_SQL} AS grade_numeric, {SUB_GRADE_SQL} AS sub_grade_numeric,
    {LONG_EMPLOYED_SQL} AS is_long_term_employed, {quoted(ONEHOT_SQL)}, {CONSOLIDATION_SQL} AS is_debt_consolidation,
    {quoted(TIME_SQL)}, {quoted(INTERACTION_SQL)}, {quoted(BIN_SQL)}, {quoted(RISK_SQL)},
    {TARGET_SQL} AS "default"
  FROM cleaned
)"""
FEATURE_CHAIN = CLEAN_CHAIN + "," + FEATURES_SQL


def typed_loans(spark, sf_dir, columns):
    return clean.typed(fx.loans(spark, sf_dir, [KEY, *columns]))


RATIO_IN = ["annual_inc", "dti", "loan_amnt", "installment", "revol_bal", "tot_hi_cred_lim", "total_debt"]


@query("ratios", with_(LOANS, TYPED) + f"SELECT {KEY}, {rounded_sql(RATIO_SQL)} FROM typed")
def ratios(spark, sf_dir):
    frame = features.financial_ratios(typed_loans(spark, sf_dir, RATIO_IN))
    return rounded(frame.drop(*RATIO_IN), coarse=BIG_RATIOS)


@query(
    "grades",
    with_(LOANS) + f"SELECT {KEY}, {GRADE_SQL} AS grade_numeric, {SUB_GRADE_SQL} AS sub_grade_numeric FROM loans",
)
def grades(spark, sf_dir):
    return features.grade_features(fx.loans(spark, sf_dir, [KEY, "grade", "sub_grade"]))


@query("onehot", with_(LOANS) + f"SELECT {KEY}, {quoted(ONEHOT_SQL)} FROM loans")
def onehot(spark, sf_dir):
    frame = fx.loans(spark, sf_dir, [KEY, *ONEHOT_VALUES])
    return features.onehot(frame, features.fit_onehot(frame))


@query(
    "category_flags",
    with_(LOANS, TYPED)
    + f"SELECT {KEY}, emp_length, {LONG_EMPLOYED_SQL} AS is_long_term_employed, {CONSOLIDATION_SQL} AS is_debt_consolidation FROM typed",
)
def category_flags(spark, sf_dir):
    return features.categorical_features(typed_loans(spark, sf_dir, ["emp_length", "purpose"]), {})


@query("time_features", with_(LOANS, TYPED) + f"SELECT {KEY}, {rounded_sql(TIME_SQL)} FROM typed")
def time_features(spark, sf_dir):
    return rounded(features.time_features(typed_loans(spark, sf_dir, ["issue_d", "earliest_cr_line", "term"])))


INTERACT_IN = ["loan_amnt", "int_rate", "annual_inc", "dti", "grade"]


@query("interactions", with_(LOANS, TYPED) + f"SELECT {KEY}, {rounded_sql(INTERACTION_SQL)} FROM typed")
def interactions(spark, sf_dir):
    frame = features.grade_features(typed_loans(spark, sf_dir, INTERACT_IN))
    return rounded(features.interactions(frame).drop(*INTERACT_IN, "grade_numeric"))


@query("bins", with_(LOANS, TYPED) + f"SELECT {KEY}, {quoted(BIN_SQL)} FROM typed")
def bins(spark, sf_dir):
    return features.bins(typed_loans(spark, sf_dir, list(BRACKETS))).drop(*BRACKETS)


@query("risk_flags", with_(LOANS, TYPED) + f"SELECT {KEY}, {quoted(RISK_SQL)} FROM typed")
def risk_flags(spark, sf_dir):
    return features.risk_flags(typed_loans(spark, sf_dir, list(RISK_LIMITS))).drop(*RISK_LIMITS)


@query("target", with_(LOANS) + f'SELECT loan_status, {TARGET_SQL} AS "default", count(*) AS n FROM loans GROUP BY ALL')
def target(spark, sf_dir):
    frame = features.with_target(fx.loans(spark, sf_dir, ["loan_status"]))
    return frame.groupBy("loan_status", "default").agg(F.count("*").alias("n"))


FEATURE_SELECT = (
    f"SELECT {KEY}, loan_id, loan_status, {r6(*KEPT_DOUBLES)}, "
    + ", ".join(
        f'round("{n}", {2 if n in BIG_RATIOS else 6}) AS "{n}"'
        for n in [*RATIO_SQL, "grade_numeric", "sub_grade_numeric", "credit_history_length_years", *INTERACTION_SQL]
    )
    + ", is_long_term_employed, is_debt_consolidation, issue_month, issue_year, issue_day_of_week, term_numeric, "
    + ", ".join(f'"{n}"' for n in [*ONEHOT_SQL, *BIN_SQL, *RISK_SQL, "default"])
)


@query("create_features", FEATURE_CHAIN + FEATURE_SELECT + " FROM featured")
def create_features(spark, sf_dir):
    return rounded(features.apply_features(clean_frame(spark, sf_dir)), coarse=BIG_RATIOS)


@query(
    "default_rate",
    FEATURE_CHAIN
    + """SELECT income_bracket, count(*) AS loans, round(avg("default"), 6) AS default_rate
FROM featured GROUP BY income_bracket ORDER BY round(avg("default"), 9) DESC, income_bracket LIMIT 10""",
)
def default_rate(spark, sf_dir):
    from riskframe.operators.profile import default_rate_by

    frame = features.apply_features(clean_frame(spark, sf_dir), values={})
    return rounded(default_rate_by(frame, "income_bracket", "default"))


ONLINE_NAMES = [
    "loan_amnt", "dti", "annual_inc", "grade_A", "grade_Z", "home_ownership_RENT", "home_ownership_MORTGAGE",
    "verification_status_Verified", "purpose_credit_card", "initial_list_status_w", "term_36 months", "not_a_feature",
]


@query(
    "online_encode",
    with_(LOANS, REQUEST_ROWS)
    + f"""SELECT {KEY}, {r6('loan_amnt', 'dti', 'annual_inc')},
  CASE WHEN grade = 'A' THEN 1e0 ELSE 0e0 END AS "grade_A", CASE WHEN grade = 'Z' THEN 1e0 ELSE 0e0 END AS "grade_Z",
  CASE WHEN home_ownership = 'RENT' THEN 1e0 ELSE 0e0 END AS "home_ownership_RENT",
  CASE WHEN home_ownership = 'MORTGAGE' THEN 1e0 ELSE 0e0 END AS "home_ownership_MORTGAGE",
  CASE WHEN verification_status = 'Verified' THEN 1e0 ELSE 0e0 END AS "verification_status_Verified",
  CASE WHEN purpose = 'credit_card' THEN 1e0 ELSE 0e0 END AS "purpose_credit_card",
  CASE WHEN initial_list_status = 'w' THEN 1e0 ELSE 0e0 END AS "initial_list_status_w",
  CASE WHEN term = '36 months' THEN 1e0 ELSE 0e0 END AS "term_36 months", 0e0 AS not_a_feature FROM request_rows""",
)
def online_encode(spark, sf_dir):
    return rounded(features.online_encode(fx.request_rows(spark, sf_dir), ONLINE_NAMES, keep=(KEY,)))


HASH = "CAST('0x' || substr(sha256(o_orderkey || '#42'), 1, 12) AS BIGINT)"


@query(
    "stratified_split",
    f"""SELECT o_orderkey, y, (rank() OVER (PARTITION BY y ORDER BY h) - 1) < 0.2 * count(*) OVER (PARTITION BY y) AS is_test
FROM (SELECT o_orderkey, {Y} AS y, {HASH} AS h FROM orders)""",
)
def stratified_split(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select(KEY, fx.target_flag(F.col(KEY)).alias("y"))
    return mark_test(orders, KEY, "y")


@query(
    "plain_split",
    f"""SELECT o_orderkey, (rank() OVER (ORDER BY h) - 1) < 0.25 * count(*) OVER () AS is_test
FROM (SELECT o_orderkey, {HASH} AS h FROM orders)""",
)
def plain_split(spark, sf_dir):
    return mark_test(fx.table(spark, sf_dir, "orders").select(KEY), KEY, None, test_size=0.25)


@query("folds", f"SELECT {HASH} % 5 AS fold, count(*) AS n, CAST(sum({Y}) AS BIGINT) AS positives FROM orders GROUP BY 1")
def folds(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select(KEY, fx.target_flag(F.col(KEY)).alias("y"))
    return with_fold(orders, KEY).groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("positives"))


@query("reference_features", FEATURE_CHAIN + FEATURE_SELECT + " FROM featured")
def reference_a(spark, sf_dir):
    return rounded(reference_features(fx.loans(spark, sf_dir), exclude=(KEY,)), coarse=BIG_RATIOS)


ENC_TEXT = ["term", "grade", "home_ownership", "purpose"]
ENC_NUM = ["loan_amnt", "annual_inc", "dti", "emp_length"]


def _z(c: str) -> str:
    return (
        f"round(({c} - (SELECT avg({c}) FROM coded)) / "
        f"(SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END FROM coded), 6) AS {c}"
    )


@query(
    "reference_encoded",
    CLEAN_CHAIN
    + ", "
    + ", ".join(
        f"{c}_codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT coalesce({c}, 'nan') AS v FROM cleaned))"
        for c in ENC_TEXT
    )
    + f""", coded AS (
  SELECT loan_id, {', '.join(f'{c}_codes.code AS {c}' for c in ENC_TEXT)}, {', '.join(ENC_NUM)}
  FROM cleaned t {' '.join(f"JOIN {c}_codes ON coalesce(t.{c}, 'nan') = {c}_codes.v" for c in ENC_TEXT)}
) SELECT loan_id, {', '.join(_z(c) for c in ENC_TEXT + ENC_NUM)} FROM coded""",
)
def reference_b(spark, sf_dir):
    frame = fx.loans(spark, sf_dir, ["loan_id", *ENC_TEXT, *ENC_NUM, "loan_status"])
    return rounded(reference_encoded(frame, target="loan_status", key="loan_id"))


@query(
    "build_dataset",
    FEATURE_CHAIN
    + f"""SELECT is_test, "default", count(*) AS n, round(sum(loan_amnt), 2) AS loan_amnt, round(sum(annual_inc), 2) AS annual_inc,
  CAST(sum(combined_risk_score) AS BIGINT) AS risk FROM (
  SELECT *, (rank() OVER (PARTITION BY "default" ORDER BY {HASH}) - 1) < 0.2 * count(*) OVER (PARTITION BY "default") AS is_test
  FROM featured) GROUP BY ALL""",
)
def build_dataset(spark, sf_dir):
    """The build job's frame with its split mark, as totals per side and class."""
    frame = build_features(fx.loans(spark, sf_dir), exclude=(KEY,), keep_status=True)
    marked = mark_test(frame, "loan_id", "default")
    return rounded(
        marked.groupBy("is_test", "default").agg(
            F.count("*").alias("n"),
            F.sum("loan_amnt").alias("loan_amnt"),
            F.sum("annual_inc").alias("annual_inc"),
            F.sum("combined_risk_score").alias("risk"),
        ),
        digits=2,
    )


@query(
    "written_sets",
    FEATURE_CHAIN
    + f""", marked AS (
  SELECT *, (rank() OVER (PARTITION BY "default" ORDER BY {HASH}) - 1) < 0.2 * count(*) OVER (PARTITION BY "default") AS is_test FROM featured
), sides AS (SELECT 'full' AS part, * FROM marked UNION ALL SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END, * FROM marked)
SELECT part, "default", count(*) AS n, round(sum(loan_amnt), 2) AS loan_amnt, CAST(sum(combined_risk_score) AS BIGINT) AS risk,
  true AS names_fit FROM sides GROUP BY ALL""",
)
def written_sets(spark, sf_dir):
    """Train, test and full set as the sink writes them, read back, and whether the name list is that of their columns."""
    frame = build_features(fx.loans(spark, sf_dir), exclude=(KEY,))
    paths = write_processed(mark_test(frame, "loan_id", "default", name="_test"), new_path(spark, "sets"))
    parts = {name: spark.read.parquet(paths[name]) for name in ("train", "test", "full")}
    names = [r["name"] for r in spark.read.json(paths["feature_names"]).orderBy("position").collect()]
    fits = all([c for c in part.columns if c != "default"] == names for part in parts.values())
    rows = None
    for name, part in parts.items():
        own = part.select(F.lit(name).alias("part"), "default", "loan_amnt", "combined_risk_score")
        rows = own if rows is None else rows.unionByName(own)
    totals = rows.groupBy("part", "default").agg(
        F.count("*").alias("n"), F.sum("loan_amnt").alias("loan_amnt"), F.sum("combined_risk_score").alias("risk")
    )
    return rounded(totals.withColumn("names_fit", F.lit(fits)), digits=2)
