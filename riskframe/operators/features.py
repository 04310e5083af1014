"""Feature engineering as native column expressions; a step is skipped when its columns are absent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.text import first_digits
from riskframe.schemas import (
    BRACKETS,
    CONSOLIDATION_PURPOSES,
    DEFAULT_STATUSES,
    EPSILON,
    GRADES,
    LONG_EMPLOYMENT_YEARS,
    RISK_LIMITS,
)

ONEHOT_COLUMNS = ["home_ownership", "verification_status", "initial_list_status"]
MAX_CATEGORIES = 1000


def _have(df: DataFrame, *names: str) -> bool:
    return all(n in df.columns for n in names)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


# --- ratios and interactions ------------------------------------------------------------------

# new column → (inputs, expression); fixed definitions of the derived amounts
RATIOS = {
    "debt_amnt": (("annual_inc", "dti"), lambda inc, dti: inc * dti / 100),
    "loan_income_ratio": (("loan_amnt", "annual_inc"), lambda amount, inc: F.try_divide(amount, inc + EPSILON)),
    "installment_income_ratio": (
        ("installment", "annual_inc"),
        lambda monthly, inc: F.try_divide(monthly * 12, inc + EPSILON),
    ),
    "revol_util_ratio": (("revol_bal", "tot_hi_cred_lim"), lambda bal, limit: F.try_divide(bal, limit + EPSILON)),
    "debt_income_ratio": (("total_debt", "annual_inc"), lambda debt, inc: F.try_divide(debt, inc + EPSILON)),
}
INTERACTIONS = {
    "loan_rate_interaction": (("loan_amnt", "int_rate"), lambda amount, rate: amount * rate / 100),
    "income_dti_interaction": (("annual_inc", "dti"), lambda inc, dti: inc * dti / 100),
    "grade_loan_interaction": (("grade_numeric", "loan_amnt"), lambda grade, amount: grade * amount),
}


def _derive(df: DataFrame, definitions: dict) -> DataFrame:
    return df.withColumns(
        {name: f(*[F.col(c) for c in inputs]) for name, (inputs, f) in definitions.items() if _have(df, *inputs)}
    )


def financial_ratios(df: DataFrame) -> DataFrame:
    return _derive(df, RATIOS)


def interactions(df: DataFrame) -> DataFrame:
    return _derive(df, INTERACTIONS)


# --- categories -------------------------------------------------------------------------------


def grade_number(grade: Column) -> Column:
    """A..G → 1..7 as a double, anything else 0."""
    return F.when(grade.rlike(f"^[{GRADES}]$"), (F.instr(F.lit(GRADES), grade)).cast("double")).otherwise(0.0)


def sub_grade_number(sub_grade: Column) -> Column:
    """A1..G5 → 1..35 as a double, anything else 0."""
    letter = F.ascii(sub_grade) - F.lit(ord(GRADES[0]))
    number = letter * 5 + F.substring(sub_grade, 2, 1).try_cast("int")
    return F.when(sub_grade.rlike(f"^[{GRADES}][1-5]$"), number.cast("double")).otherwise(0.0)


def grade_features(df: DataFrame) -> DataFrame:
    for column, parse in (("grade", grade_number), ("sub_grade", sub_grade_number)):
        if column in df.columns:
            df = df.withColumn(f"{column}_numeric", parse(F.col(column))).drop(column)
    return df


def onehot_sources(df: DataFrame) -> dict[str, str]:
    """Source column → prefix of its indicator columns."""
    sources = {c: c for c in ONEHOT_COLUMNS if c in df.columns}
    if "home_ownership" not in df.columns and "home_ownership_n" in df.columns:
        sources["home_ownership_n"] = "home_ownership"
    return sources


def fit_onehot(df: DataFrame, columns: list[str] | None = None, max_categories: int = MAX_CATEGORIES) -> dict:
    """Observed values per column. They become columns, so a column with too many values is an error."""
    columns = list(onehot_sources(df)) if columns is None else columns
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    distinct = (
        df.select(F.explode(pairs).alias("e")).select("e.column", "e.value").filter(F.col("value").isNotNull()).distinct()
    )
    rows = distinct.limit(len(columns) * max_categories + 1).collect()
    values = {c: sorted(r["value"] for r in rows if r["column"] == c) for c in columns}
    for c, vs in values.items():
        if len(vs) > max_categories:
            raise ValueError(f"{c} has more than {max_categories} categories; encode it by label instead")
    return values


def onehot(df: DataFrame, values: dict[str, list[str]]) -> DataFrame:
    """0/1 columns ``<prefix>_<value>``; a missing value has none set. The sources are dropped."""
    sources = onehot_sources(df)
    new = {
        f"{sources.get(c, c)}_{v}": _flag(F.col(c) == v)
        for c, vs in values.items()
        if c in df.columns
        for v in vs
    }
    return df.withColumns(new).drop(*[c for c in values if c in df.columns])


def categorical_features(df: DataFrame, values: dict[str, list[str]]) -> DataFrame:
    df = grade_features(df)
    if "emp_length" in df.columns:
        df = df.withColumn("is_long_term_employed", _flag(F.col("emp_length") >= LONG_EMPLOYMENT_YEARS))
    df = onehot(df, values)
    if "purpose" in df.columns:
        df = df.withColumn("is_debt_consolidation", _flag(F.col("purpose").isin(CONSOLIDATION_PURPOSES)))
        df = df.drop("purpose")
    return df


# --- time -------------------------------------------------------------------------------------


def _as_timestamp(df: DataFrame, column: str) -> Column:
    """Text is read as month and year (``Dec-2015``) first, then as an ISO date."""
    if dict(df.dtypes)[column] != "string":
        return F.col(column).cast("timestamp")
    return F.coalesce(F.try_to_timestamp(column, F.lit("MMM-yyyy")), F.try_to_timestamp(column))


def years_between(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps in years, not below zero."""
    days = F.floor((F.unix_timestamp(later) - F.unix_timestamp(earlier)) / 86400)
    return F.when(days < 0, 0.0).otherwise(days / 365.25)


def time_features(df: DataFrame) -> DataFrame:
    """Parts of the issue date, the term in months and the credit history; the dates are dropped."""
    df = df.withColumns({c: _as_timestamp(df, c) for c in ("issue_d", "earliest_cr_line") if c in df.columns})
    new = {}
    if "issue_d" in df.columns:
        new["issue_month"] = F.month("issue_d")
        new["issue_year"] = F.year("issue_d")
        new["issue_day_of_week"] = F.weekday("issue_d")
    if dict(df.dtypes).get("term") == "string":
        new["term_numeric"] = first_digits(F.col("term")).try_cast("int")
    if _have(df, "issue_d", "earliest_cr_line"):
        new["credit_history_length_years"] = years_between(F.col("issue_d"), F.col("earliest_cr_line"))
    df = df.withColumns(new)
    return df.drop("issue_d", "earliest_cr_line", *(["term"] if "term_numeric" in new else []))


# --- brackets, risk flags, target -------------------------------------------------------------


def bracket(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Right-closed brackets from 0 (included) up; outside or missing is the text ``nan``."""
    steps = F.when(value.isNull() | (value < 0), "nan")
    for edge, label in zip(edges, labels):
        steps = steps.when(value <= edge, label)
    return steps.otherwise(labels[-1])


def bins(df: DataFrame, specs: dict = BRACKETS) -> DataFrame:
    return df.withColumns(
        {name: bracket(F.col(c), edges, labels) for c, (name, edges, labels) in specs.items() if c in df.columns}
    )


def risk_flags(df: DataFrame, limits: dict = RISK_LIMITS) -> DataFrame:
    """A 0/1 flag per exceeded limit and their sum."""
    flags = {name: _flag(F.col(c) > limit) for c, (name, limit) in limits.items() if c in df.columns}
    if not flags:
        return df
    return df.withColumns(flags).withColumn(
        "combined_risk_score", reduce(lambda a, b: a + b, [F.col(name) for name in flags])
    )


def with_target(df: DataFrame, target: str = "default") -> DataFrame:
    """Binary target from ``loan_status``, or from a ready ``Default`` column."""
    if "loan_status" in df.columns:
        return df.withColumn(target, _flag(F.col("loan_status").isin(DEFAULT_STATUSES)))
    # Spark resolves names without case, so only an exact match counts as the ready column
    if "Default" in df.columns:
        return df.withColumn("_target", F.col("Default").cast("int")).drop("Default").withColumnRenamed("_target", target)
    return df


# --- composites -------------------------------------------------------------------------------


def create_features(df: DataFrame, values: dict[str, list[str]] | None = None) -> DataFrame:
    """Ratios, categories, time, interactions, brackets and risk flags: projections over one scan.

    ``values`` are the one-hot categories of the training frame; without them they are read from ``df``.
    """
    values = fit_onehot(df) if values is None else values
    return (
        df.transform(financial_ratios)
        .transform(categorical_features, values)
        .transform(time_features)
        .transform(interactions)
        .transform(bins)
        .transform(risk_flags)
    )


def apply_features(df: DataFrame, values: dict[str, list[str]] | None = None) -> DataFrame:
    """Features and target; free-text columns are dropped."""
    return df.transform(create_features, values).transform(with_target).drop("title", "desc")


def online_encode(df: DataFrame, names: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """The model's feature vector straight from request fields.

    A name is a numeric field, or ``<text field>_<value>``; anything else is 0. Values without a name
    vanish. No fit and no shuffle.
    """
    types = dict(df.dtypes)
    text = sorted((c for c, t in types.items() if t == "string"), key=len, reverse=True)

    def feature(name: str) -> Column:
        if name in types and types[name] != "string":
            return F.col(name).cast("double")
        hits = [_flag(F.col(c) == name[len(c) + 1 :]) for c in text if name.startswith(f"{c}_")]
        return (F.greatest(*hits) if len(hits) > 1 else hits[0]).cast("double") if hits else F.lit(0.0)

    return df.select(*keep, *[feature(n).alias(n) for n in names])
