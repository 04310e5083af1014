"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe import fixtures as fx
from riskframe.catalog.registry import query, r6, rounded
from riskframe.catalog.views import LOANS, REQUEST_ROWS, with_
from riskframe.functions.text import employment_years, issue_month
from riskframe.operators import clean
from riskframe.schemas import NA_TOKENS, NUMERIC_TEXT_COLUMNS, VALID_RANGES
from riskframe.session import new_path
from riskframe.sources.loans import scan_loans

KEY = "o_orderkey"
NUMERIC = [
    "loan_amnt", "int_rate", "installment", "emp_length", "annual_inc", "dti", "revol_util", "revol_bal",
    "tot_hi_cred_lim", "total_debt", "open_acc", "delinq_2yrs", "mths_since_last_delinq",
]
TEXT = [
    "loan_id", "term", "grade", "sub_grade", "home_ownership", "verification_status", "purpose",
    "initial_list_status", "loan_status",
]
IMPUTED = ["loan_amnt", "int_rate", "emp_length", "revol_util"]


def parse(c: str) -> str:
    x = f"replace({c}, '%', '')"
    return (
        f"CASE WHEN contains(lower({x}), '< 1 year') OR contains(lower({x}), 'n/a') THEN 0.0 "
        f"WHEN contains(lower({x}), 'year') THEN TRY_CAST(regexp_extract({x}, '(\\d+)', 1) AS DOUBLE) "
        f"WHEN regexp_full_match({x}, '\\s*[-+]?(\\d+\\.?\\d*|\\.\\d+)([eE][-+]?\\d+)?\\s*') "
        f"THEN TRY_CAST(trim({x}) AS DOUBLE) END"
    )


TYPED = f"""
typed AS (
  SELECT DISTINCT * REPLACE ({parse('int_rate')} AS int_rate, {parse('emp_length')} AS emp_length,
    try_strptime(issue_d, '%b-%Y') AS issue_d)
  FROM loans
)"""


def mode_of(c: str, source: str) -> str:
    return (
        f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    )


FILLED = f"""
filled AS (
  SELECT * REPLACE ({", ".join(f"coalesce({c}, (SELECT median({c}) FROM typed)) AS {c}" for c in IMPUTED)},
    coalesce(purpose, {mode_of('purpose', 'typed')}) AS purpose)
  FROM typed
)"""


def fences(source: str, columns: list[str], name: str = "fences") -> str:
    quartiles = ", ".join(
        f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS {c}_1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS {c}_3"
        for c in columns
    )
    bounds = ", ".join(
        f"{c}_1 - 1.5 * ({c}_3 - {c}_1) AS {c}_lo, {c}_3 + 1.5 * ({c}_3 - {c}_1) AS {c}_hi" for c in columns
    )
    return f"{name}_q AS (SELECT {quartiles} FROM {source}), {name} AS (SELECT {bounds} FROM {name}_q)"


def clipped(c: str) -> str:
    return f"CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE CAST({c} AS DOUBLE) END"


def clamped(c: str, value: str | None = None) -> str:
    lo, hi = VALID_RANGES[c]
    v = value or c
    return f"CASE WHEN {v} < {lo} THEN {lo} WHEN {v} > {hi} THEN {hi} ELSE {v} END"


CAPPED = (
    fences("filled", NUMERIC)
    + f""",
capped AS (
  SELECT filled.* REPLACE ({", ".join(f"{clipped(c)} AS {c}" for c in NUMERIC)}) FROM filled, fences
)"""
)
CLEAN = f"""
cleaned AS (
  SELECT * REPLACE ({", ".join(f"{clamped(c)} AS {c}" for c in VALID_RANGES)}) FROM capped
)"""
CLEAN_CHAIN = with_(LOANS, TYPED, FILLED, CAPPED, CLEAN)

DATES = "strftime(issue_d, '%Y-%m-%d %H:%M:%S') AS issue_d, strftime(earliest_cr_line, '%Y-%m-%d %H:%M:%S') AS earliest_cr_line"


def clean_frame(spark, sf_dir):
    """The cleaned loans every later stage starts from."""
    return clean.clean_loans(fx.loans(spark, sf_dir), exclude=(KEY,))


@query(
    "scan_loans",
    with_(LOANS)
    + """
SELECT loan_id, round(loan_amnt, 6) AS loan_amnt, int_rate,
  CASE WHEN emp_length <> 'n/a' THEN emp_length END AS emp_length, purpose, round(dti, 6) AS dti, o_orderkey
FROM loans""",
)
def scan_loans_query(spark, sf_dir):
    columns = ["loan_id", "loan_amnt", "int_rate", "emp_length", "purpose", "dti", KEY]
    frame = fx.loans(spark, sf_dir, columns)
    path = new_path(spark, "loans-csv")
    frame.write.option("header", "true").csv(path)
    return rounded(scan_loans(spark, path, "csv", schema=frame.schema, na_tokens=NA_TOKENS))


@query("dedup", with_(LOANS) + f"SELECT DISTINCT {KEY}, loan_id, {r6('loan_amnt', 'annual_inc')}, issue_d FROM loans")
def dedup(spark, sf_dir):
    frame = fx.loans(spark, sf_dir, [KEY, "loan_id", "loan_amnt", "annual_inc", "issue_d"])
    return rounded(clean.drop_exact_duplicates(frame))


@query(
    "dedup_report",
    with_(LOANS)
    + """SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM loans)) AS distinct_rows,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM loans)) AS removed FROM loans""",
)
def dedup_report(spark, sf_dir):
    return clean.duplicate_report(fx.loans(spark, sf_dir))


@query(
    "coerce_numeric",
    with_(LOANS, TYPED)
    + f"SELECT {KEY}, {r6(*NUMERIC_TEXT_COLUMNS)} FROM typed UNION ALL "
    + f"SELECT {KEY}, {r6(*NUMERIC_TEXT_COLUMNS)} FROM typed WHERE {KEY} % 50 = 0",
)
def coerce_numeric(spark, sf_dir):
    return rounded(clean.coerce_numeric(fx.loans(spark, sf_dir, [KEY, *NUMERIC_TEXT_COLUMNS])))


@query(
    "emp_length",
    with_(LOANS) + f"SELECT emp_length, {parse('emp_length')} AS years, count(*) AS n FROM loans GROUP BY ALL",
)
def emp_length(spark, sf_dir):
    frame = fx.loans(spark, sf_dir, ["emp_length"])
    return frame.groupBy("emp_length", employment_years(F.col("emp_length")).alias("years")).agg(
        F.count("*").alias("n")
    )


@query(
    "issue_date",
    with_(LOANS)
    + """SELECT o_orderkey, issue_d, strftime(try_strptime(issue_d, '%b-%Y'), '%Y-%m-%d %H:%M:%S') AS issued,
  try_strptime(term, '%b-%Y') IS NULL AS bad_is_null FROM loans""",
)
def issue_date(spark, sf_dir):
    frame = fx.loans(spark, sf_dir, [KEY, "issue_d", "term"])
    return rounded(
        frame.select(
            KEY,
            "issue_d",
            issue_month(F.col("issue_d")).alias("issued"),
            issue_month(F.col("term")).isNull().alias("bad_is_null"),
        )
    )


def _missing_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, "
        f"round((count(*) - count({c})) * 100.0 / count(*), 6) AS percent, "
        f"(count(*) > count({c}) AND (count(*) - count({c})) * 100.0 <= 50.0 * count(*)) AS impute FROM loans"
        for c in columns
    )


@query("missing_profile", with_(LOANS) + _missing_sql(fx.LOAN_COLUMNS))
def missing_profile(spark, sf_dir):
    return rounded(clean.missing_profile(fx.loans(spark, sf_dir)))


IMPUTE_OUT = [*IMPUTED, "mths_since_last_delinq"]


@query("impute", with_(LOANS, TYPED, FILLED) + f"SELECT {KEY}, purpose, {r6(*IMPUTE_OUT)} FROM filled")
def impute(spark, sf_dir):
    columns = [*IMPUTE_OUT, "purpose"]
    frame = clean.typed(fx.loans(spark, sf_dir, [KEY, *columns]))
    return rounded(clean.impute(frame, clean.fit_imputer(frame, columns)))


HALVES = """
early AS (SELECT * FROM typed WHERE issue_d < TIMESTAMP '1998-01-01 00:00:00'),
late AS (SELECT * FROM typed WHERE issue_d >= TIMESTAMP '1998-01-01 00:00:00')"""


@query(
    "impute_transform",
    with_(LOANS, TYPED, HALVES)
    + f"""SELECT {KEY}, {", ".join(f"round(coalesce({c}, (SELECT median({c}) FROM early)), 6) AS {c}" for c in IMPUTED)},
  coalesce(purpose, {mode_of('purpose', 'early')}) AS purpose, round(mths_since_last_delinq, 6) AS mths_since_last_delinq
FROM late""",
)
def impute_transform(spark, sf_dir):
    columns = [*IMPUTE_OUT, "purpose"]
    frame = clean.typed(fx.loans(spark, sf_dir, [KEY, *columns, "issue_d"]))
    early = frame.filter(F.col("issue_d") < F.lit("1998-01-01").cast("timestamp"))
    late = frame.filter(F.col("issue_d") >= F.lit("1998-01-01").cast("timestamp"))
    return rounded(clean.impute(late, clean.fit_imputer(early, columns)).drop("issue_d"))


WINSOR = ["installment", "annual_inc", "dti", "revol_util", "total_debt", "open_acc", "delinq_2yrs"]


@query(
    "winsorize",
    with_(LOANS, fences("loans", WINSOR))
    + f"SELECT {KEY}, {', '.join(f'round({clipped(c)}, 6) AS {c}' for c in WINSOR)} FROM loans, fences",
)
def winsorize(spark, sf_dir):
    return rounded(clean.winsorize_iqr(fx.loans(spark, sf_dir, [KEY, *WINSOR]), exclude=(KEY,)))


@query(
    "outlier_report",
    with_(LOANS, fences("loans", WINSOR))
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(any_value({c}_lo), 6) AS lower, round(any_value({c}_hi), 6) AS upper, "
        f"count(*) FILTER ({c} < {c}_lo OR {c} > {c}_hi) AS outliers, "
        f"round(count(*) FILTER ({c} < {c}_lo OR {c} > {c}_hi) * 100.0 / count(*), 6) AS percent FROM loans, fences"
        for c in WINSOR
    ),
)
def outlier_report(spark, sf_dir):
    return rounded(clean.iqr_outlier_report(fx.loans(spark, sf_dir, WINSOR)))


@query(
    "outlier_rows",
    with_("q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)")
    + """SELECT event_id, round(value, 6) AS value FROM events, q
WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)""",
)
def outlier_rows(spark, sf_dir):
    return rounded(clean.iqr_outliers(fx.table(spark, sf_dir, "events").select("event_id", "value"), "value"))


CLAMP = ["int_rate", "annual_inc", "dti", "loan_amnt"]


@query(
    "clamp",
    with_(LOANS, TYPED)
    + f"SELECT {KEY}, {', '.join(f'round({clamped(c)}, 6) AS {c}' for c in CLAMP)} FROM typed",
)
def clamp(spark, sf_dir):
    frame = clean.typed(fx.loans(spark, sf_dir, [KEY, *CLAMP]))
    return rounded(clean.clamp_ranges(frame))


@query(
    "range_report",
    with_(LOANS, TYPED)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} < {VALID_RANGES[c][0]} OR {c} > {VALID_RANGES[c][1]}) "
        f"AS out_of_range FROM typed"
        for c in CLAMP
    ),
)
def range_report(spark, sf_dir):
    return clean.range_report(clean.typed(fx.loans(spark, sf_dir, [KEY, *CLAMP])))


@query(
    "clean_loans",
    CLEAN_CHAIN + f"SELECT {KEY}, {', '.join(TEXT)}, {r6(*NUMERIC)}, {DATES} FROM cleaned",
)
def clean_loans(spark, sf_dir):
    return rounded(clean_frame(spark, sf_dir))


@query(
    "residual_fill",
    with_(LOANS)
    + f"""SELECT {KEY}, {", ".join(f"round(coalesce({c}, (SELECT median({c}) FROM loans)), 6) AS {c}"
    for c in ["loan_amnt", "revol_util", "mths_since_last_delinq"])} FROM loans""",
)
def residual_fill(spark, sf_dir):
    frame = fx.loans(spark, sf_dir, [KEY, "loan_amnt", "revol_util", "mths_since_last_delinq"])
    return rounded(clean.residual_median_fill(frame))


ENCODED = ["loan_id", "grade", "purpose", "home_ownership", "emp_length"]


def _codes(c: str, source: str) -> str:
    return (
        f"{c}_codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code "
        f"FROM (SELECT DISTINCT coalesce({c}, 'nan') AS v FROM {source}))"
    )


def _encoded(columns: list[str], source: str) -> str:
    picks = ", ".join(f"coalesce({c}_codes.code, -1) AS {c}" for c in columns)
    joins = " ".join(f"LEFT JOIN {c}_codes ON coalesce(t.{c}, 'nan') = {c}_codes.v" for c in columns)
    return f"SELECT t.{KEY}, {picks} FROM {source} t {joins}"


@query("label_encode", with_(LOANS, *[_codes(c, "loans") for c in ENCODED]) + _encoded(ENCODED, "loans"))
def label_encode(spark, sf_dir):
    frame = fx.loans(spark, sf_dir, [KEY, *ENCODED])
    return clean.encode_labels(frame, clean.fit_labels(frame))


UNSEEN = ["sub_grade", "loan_status", "purpose"]


@query(
    "label_encode_unseen",
    with_(
        LOANS,
        "paid AS (SELECT * FROM loans WHERE loan_status = 'Fully Paid')",
        "unpaid AS (SELECT * FROM loans WHERE loan_status <> 'Fully Paid')",
        *[_codes(c, "paid") for c in UNSEEN],
    )
    + _encoded(UNSEEN, "unpaid"),
)
def label_encode_unseen(spark, sf_dir):
    frame = fx.loans(spark, sf_dir, [KEY, *UNSEEN])
    fitted = clean.fit_labels(clean.where_group(frame, "loan_status", "Fully Paid"), UNSEEN)
    return clean.encode_labels(frame.filter(F.col("loan_status") != "Fully Paid"), fitted)


SCALED = ["loan_amnt", "annual_inc", "dti", "installment", "open_acc"]


@query(
    "standard_scale",
    with_(LOANS)
    + f"""SELECT {KEY}, {", ".join(f"round((l.{c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}"
    for c in SCALED)} FROM loans l, (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED)}
  FROM loans)""",
)
def standard_scale(spark, sf_dir):
    frame = fx.loans(spark, sf_dir, [KEY, *SCALED])
    return rounded(clean.scale(frame, clean.fit_scaler(frame, SCALED)))


@query(
    "validate_requests",
    with_(LOANS, REQUEST_ROWS)
    + f"SELECT {KEY}, loan_id, grade, {r6('loan_amnt', 'int_rate', 'annual_inc', 'dti')} FROM request_errors WHERE len(errors) = 0",
)
def validate_requests(spark, sf_dir):
    valid, _ = clean.validate_requests(fx.request_rows(spark, sf_dir))
    return rounded(valid.select(KEY, "loan_id", "grade", "loan_amnt", "int_rate", "annual_inc", "dti"))


@query(
    "rejected_requests",
    with_(LOANS, REQUEST_ROWS)
    + f"SELECT {KEY}, array_to_string(errors, '; ') AS errors, len(errors) AS n_errors FROM request_errors WHERE len(errors) > 0",
)
def rejected_requests(spark, sf_dir):
    _, rejected = clean.validate_requests(fx.request_rows(spark, sf_dir))
    return rejected.select(KEY, F.array_join("errors", "; ").alias("errors"), F.size("errors").alias("n_errors"))


@query(
    "align_columns",
    with_(LOANS) + f"SELECT {KEY}, {r6('dti', 'annual_inc')}, 0e0 AS absent_feature, open_acc FROM loans",
)
def align_columns(spark, sf_dir):
    frame = fx.loans(spark, sf_dir, [KEY, "annual_inc", "dti", "open_acc", "grade"])
    return rounded(clean.align_columns(frame, [KEY, "dti", "annual_inc", "absent_feature", "open_acc"]))
