"""Drift between a reference and a current table, data quality checks, live performance."""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from riskframe.functions.ordered import running_totals
from riskframe.operators.clean import as_categories, common_columns, numeric_columns, string_columns
from riskframe.operators.metrics import evaluate
from riskframe.session import materialize

ALPHA = 0.05
DRIFT_SHARE = 0.3


def _value_counts(df: DataFrame, columns: list[str], cast: str) -> DataFrame:
    """``(column, value, n)``: occurrences of every value, a missing one included."""
    long = df.select(*[F.col(x).cast(cast).alias(x) for x in columns]).unpivot([], columns, "column", "value")
    return long.groupBy("column", "value").agg(F.count("*").alias("n"))


def _meet(reference: DataFrame, current: DataFrame) -> DataFrame:
    """``(column, value, r, c)`` from the counts of the two sides."""
    zero = F.lit(0).cast("long")
    sides = reference.select("column", "value", F.col("n").alias("r"), zero.alias("c")).unionByName(
        current.select("column", "value", zero.alias("r"), F.col("n").alias("c"))
    )
    return sides.groupBy("column", "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))


def _both_sides(reference: DataFrame, current: DataFrame, columns: list[str], cast: str) -> DataFrame:
    """``(column, value, r, c)``: occurrences on each side, counted before the two sides meet."""
    return _meet(_value_counts(reference, columns, cast), _value_counts(current, columns, cast))


@dataclass(frozen=True)
class CountedReference:
    """Roles of a reference's columns and the occurrences of their values, for comparisons with many tables."""

    numeric: list[str]
    text: list[str]
    numbers: DataFrame | None
    words: DataFrame | None
    rows: int


def count_reference(reference: DataFrame, target: str | None = None) -> CountedReference:
    """Count a reference once; the counts are written to the shared folder."""
    reference = as_categories(reference)
    numeric = [c for c in numeric_columns(reference) if c != target]
    text = [c for c in string_columns(reference) if c != target]
    numbers = materialize(_value_counts(reference, numeric, "double"), "reference-numbers") if numeric else None
    words = materialize(_value_counts(reference, text, "string"), "reference-words") if text else None
    return CountedReference(numeric, text, numbers, words, reference.count())


def kolmogorov_p(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value of a two-sample statistic, from 100 terms of the series."""
    lam = d * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    # below 0.2 the sum is 1 to twelve digits, but 100 terms do not show it
    return F.when(lam < 0.2, 1.0).otherwise(F.least(F.greatest(2 * series, F.lit(0.0)), F.lit(1.0)))


def ks_drift(reference: DataFrame, current: DataFrame, columns: list[str], alpha: float = ALPHA) -> DataFrame:
    """Two-sample Kolmogorov–Smirnov test per numeric column over all values of both sides."""
    return _ks(_both_sides(reference, current, columns, "double"), alpha)


def _ks(counts: DataFrame, alpha: float) -> DataFrame:
    run = running_totals(counts.filter(F.col("value").isNotNull()), ["column"], ["value"], ["r", "c"])
    gap = F.abs(
        F.try_divide(F.col("cum_r"), F.col("total_r")) - F.try_divide(F.col("cum_c"), F.col("total_c"))
    )
    return (
        run.groupBy("column")
        .agg(
            F.max(gap).alias("statistic"),
            F.max("total_r").alias("n_reference"),
            F.max("total_c").alias("n_current"),
        )
        .withColumn(
            "p_value",
            kolmogorov_p(F.col("statistic"), F.col("n_reference").cast("double"), F.col("n_current").cast("double")),
        )
        .withColumn("drifted", F.col("p_value") < alpha)
    )


def chi2_p(statistic: Column, dof: Column) -> Column:
    """Upper tail of the χ² distribution; evaluated on one row per column of the result."""

    def upper_gamma(a: float, x: float) -> float:
        # regularized upper incomplete gamma function: series below a + 1, continued fraction above
        if x <= 0:
            return 1.0
        front = math.exp(a * math.log(x) - x - math.lgamma(a))
        if x < a + 1:
            term = total = 1.0 / a
            k = a
            while abs(term) > 1e-16 * abs(total):
                k += 1
                term *= x / k
                total += term
            return max(0.0, 1.0 - front * total)
        tiny = 1e-300
        b = x + 1 - a
        c, d = 1 / tiny, 1 / b
        h = d
        for i in range(1, 100_000):
            an = -i * (i - a)
            b += 2
            d = an * d + b
            d = 1 / (d if abs(d) > tiny else tiny)
            c = b + an / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
            if abs(d * c - 1) < 1e-15:
                break
        return min(1.0, front * h)

    def tail(s: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([1.0 if n <= 0 else upper_gamma(n / 2, x / 2) for x, n in zip(s, k)])

    # nested functions travel by value, so workers need no copy of this package
    return pandas_udf(tail, DoubleType())(statistic, dof)


def chi2_drift(reference: DataFrame, current: DataFrame, columns: list[str], alpha: float = ALPHA) -> DataFrame:
    """χ² test of equal category shares per text column; a missing value is a category of its own."""
    return _chi2(_both_sides(reference, current, columns, "string"), reference.count(), current.count(), alpha)


def _chi2(counts: DataFrame, rows: int, current_rows: int, alpha: float) -> DataFrame:
    """With R and C rows on the sides, the sum of (seen - expected)²/expected over both sides is
    Σ (r C - c R)²/(r + c) / (R C). As missing values count, R and C are the sides' rows, the same for all columns: plan
    constants, so one aggregate does and nothing of the size of R or C is subtracted after summing."""
    gap = F.col("r") * F.lit(float(current_rows)) - F.col("c") * F.lit(float(rows))
    terms = gap * gap / (F.col("r") + F.col("c"))
    sums = counts.groupBy("column").agg(
        F.sum(terms).alias("_terms"),
        (F.count("*") - 1).alias("dof"),
        F.sum("r").alias("n_reference"),
        F.sum("c").alias("n_current"),
    )
    statistic = F.try_divide(F.col("_terms"), F.lit(float(rows) * float(current_rows)))
    return (
        sums.withColumn("statistic", F.coalesce(statistic, F.lit(0.0)))
        .select("column", "statistic", "dof", "n_reference", "n_current")
        .withColumn("p_value", chi2_p(F.col("statistic"), F.col("dof").cast("double")))
        .withColumn("drifted", F.col("p_value") < alpha)
    )


def column_drift(
    reference: DataFrame | CountedReference, current: DataFrame, target: str | None = None, alpha: float = ALPHA
) -> DataFrame:
    """``(column, test, statistic, p_value, drifted)`` over the common columns.

    Roles come from the reference's types; its target is no feature. Booleans and days are categories.
    """
    current = as_categories(current)
    counted = reference if isinstance(reference, CountedReference) else None
    if counted is None:
        reference = as_categories(reference)
    roles = (counted.numeric, counted.text) if counted else (numeric_columns(reference), string_columns(reference))
    numeric, text = ([c for c in names if c in current.columns and c != target] for names in roles)

    def met(columns: list[str], cast: str, known: DataFrame | None) -> DataFrame:
        seen = known.filter(F.col("column").isin(columns)) if counted else _value_counts(reference, columns, cast)
        return _meet(seen, _value_counts(current, columns, cast))

    out = ["column", "test", "statistic", "p_value", "drifted"]
    parts = []
    if numeric:
        tests = _ks(met(numeric, "double", counted and counted.numbers), alpha)
        parts.append(tests.withColumn("test", F.lit("ks")).select(*out))
    if text:
        known_rows = counted.rows if counted else reference.count()
        tests = _chi2(met(text, "string", counted and counted.words), known_rows, current.count(), alpha)
        parts.append(tests.withColumn("test", F.lit("chi2")).select(*out))
    if not parts:
        raise ValueError("the frames have no common column to compare")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def drift_summary(columns: DataFrame, share: float = DRIFT_SHARE) -> DataFrame:
    """One row: number and share of drifted columns and the dataset flag."""
    return columns.agg(
        F.count("*").alias("columns"),
        F.count_if("drifted").alias("drifted_columns"),
        (F.count_if("drifted") / F.count("*")).alias("drift_share"),
    ).withColumn("dataset_drift", F.col("drift_share") > share)


def dataset_drift(
    reference: DataFrame, current: DataFrame, target: str | None = None, alpha: float = ALPHA, share: float = DRIFT_SHARE
) -> DataFrame:
    return drift_summary(column_drift(reference, current, target, alpha), share)


def prediction_drift(reference: DataFrame, current: DataFrame, column: str, alpha: float = ALPHA) -> DataFrame:
    """Drift of the prediction or probability; both sides must be scored."""
    for name, df in (("reference", reference), ("current", current)):
        if column not in df.columns:
            raise ValueError(f"the {name} side has no column {column!r}: score it first")
    return ks_drift(reference, current, [column], alpha)


def with_truth(predictions: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Predictions whose outcome is known."""
    known = labels.filter(F.col(label).isNotNull()).select(key, label)
    return predictions.join(known, key)


def live_performance(
    predictions: DataFrame, labels: DataFrame, key: str = "loan_id", score: str = "p", y: str = "y", pred: str = "y_pred"
) -> DataFrame:
    """Accuracy, F1, precision, recall and area of logged predictions with known outcome."""
    wanted = ["accuracy", "f1_score", "precision", "recall", "auc"]
    return evaluate(with_truth(predictions, labels, key, y), score, y, pred).filter(F.col("name").isin(wanted))


# --- drift by period --------------------------------------------------------------------------


def period_counts(current: DataFrame, reference: CountedReference, ts: str, every: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """``(at, column, number, word, n)``: occurrences of every value per period of event time.

    For a batch, or a stream, which gives a period's counts once its watermark, ``delay`` behind the newest time, has passed
    the period's end. Its state is one counter per (period, column, value). A missing value has neither number nor word.
    """
    if current.isStreaming:
        current = current.withWatermark(ts, delay)
    features = [c for c in current.columns if c != ts]
    kinds = dict(current.dtypes)
    entries = []
    for c in reference.numeric:
        if c in features:
            entries.append((c, F.col(c).cast("double"), F.lit(None).cast("string")))
    for c in reference.text:
        if c in features:
            word = F.date_format(c, "yyyy-MM-dd") if kinds[c].startswith(("date", "timestamp")) else F.col(c).cast("string")
            entries.append((c, F.lit(None).cast("double"), word))
    if not entries:
        raise ValueError("the frames have no common column to compare")
    values = F.array(*[F.struct(F.lit(c).alias("column"), n.alias("number"), w.alias("word")) for c, n, w in entries])
    long = current.select(F.col(ts), F.explode(values).alias("v"))
    counts = long.groupBy(F.window(ts, every).alias("w"), "v.column", "v.number", "v.word").agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("at"), "column", "number", "word", "n")


def _ks_by_period(reference: CountedReference, counts: DataFrame, alpha: float) -> DataFrame:
    """Largest gap of the two distribution functions per (period, column).

    Between two values of a period its own function is flat, so the largest gap lies at one of its values or right before one:
    the reference's running sums are needed at these values only, and are formed once for all periods.
    """
    own = counts.filter(F.col("number").isNotNull()).select("at", "column", F.col("number").alias("value"), F.col("n").alias("c"))
    zero = F.lit(0).cast("long")
    spots = reference.numbers.filter(F.col("value").isNotNull()).select("column", "value", F.col("n").alias("r"))
    spots = spots.unionByName(own.select("column", "value", zero.alias("r")).distinct())
    known = running_totals(spots.groupBy("column", "value").agg(F.sum("r").alias("r")), ["column"], ["value"], ["r"])
    run = running_totals(own, ["at", "column"], ["value"], ["c"]).join(known, ["column", "value"])
    after = F.abs(F.col("cum_r") / F.col("total_r") - F.col("cum_c") / F.col("total_c"))
    before = F.abs((F.col("cum_r") - F.col("r")) / F.col("total_r") - (F.col("cum_c") - F.col("c")) / F.col("total_c"))
    tests = run.filter("total_r > 0").groupBy("at", "column").agg(
        F.max(F.greatest(after, before)).alias("statistic"), F.max("total_r").alias("n"), F.max("total_c").alias("m")
    )
    p = kolmogorov_p(F.col("statistic"), F.col("n").cast("double"), F.col("m").cast("double"))
    return tests.select("at", "column", F.lit("ks").alias("test"), "statistic", p.alias("p_value")).withColumn(
        "drifted", F.col("p_value") < alpha
    )


def _chi2_by_period(reference: CountedReference, counts: DataFrame, alpha: float) -> DataFrame:
    """χ² per (period, column): only the period's own categories meet the reference's.

    A category of the reference alone adds r C² to the sum of (r C - c R)²/(r + c), so all of them together add C² times the
    reference rows that the period's categories do not cover.
    """
    rows, known = reference.rows, reference.words
    kinds = {r["column"]: r["n"] for r in known.groupBy("column").agg(F.count("*").alias("n")).collect()}  # a row a column
    own = counts.filter(F.col("column").isin(reference.text)).select("at", "column", F.col("word").alias("value"), F.col("n").alias("c"))
    totals = own.groupBy("at", "column").agg(F.sum("c").alias("total"))
    met = own.join(totals, ["at", "column"]).alias("o").join(
        known.alias("k"), (F.col("o.column") == F.col("k.column")) & F.col("o.value").eqNullSafe(F.col("k.value")), "left"
    ).select("o.*", F.coalesce("k.n", F.lit(0)).alias("r"))
    gap = F.col("r") * F.col("total").cast("double") - F.col("c") * F.lit(float(rows))
    sums = met.groupBy("at", "column", "total").agg(
        F.sum(gap * gap / (F.col("r") + F.col("c"))).alias("terms"), F.sum("r").alias("covered"), F.count_if(F.col("r") == 0).alias("new")
    )
    c = F.col("total").cast("double")
    of_column = F.when(F.lit(False), F.lit(0))
    for column, n in kinds.items():
        of_column = of_column.when(F.col("column") == column, F.lit(n))
    statistic = F.try_divide(F.col("terms") + c * c * (F.lit(rows) - F.col("covered")), F.lit(float(rows)) * c)
    tests = sums.select(
        "at", "column", F.lit("chi2").alias("test"), F.coalesce(statistic, F.lit(0.0)).alias("statistic"), (of_column + F.col("new") - 1).alias("dof")
    )
    tests = tests.withColumn("p_value", chi2_p(F.col("statistic"), F.col("dof").cast("double"))).drop("dof")
    return tests.withColumn("drifted", F.col("p_value") < alpha)


def drift_by_period(reference: CountedReference, counts: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """``(at, column, test, statistic, p_value, drifted)``: every period's counts against the reference.

    The same tests as ``column_drift`` of the period's rows alone. A numeric column without a value in a period has no test there.
    """
    parts = []
    if reference.numbers is not None:
        parts.append(_ks_by_period(reference, counts.filter(F.col("column").isin(reference.numeric)), alpha))
    if reference.words is not None:
        parts.append(_chi2_by_period(reference, counts, alpha))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


# --- data quality -----------------------------------------------------------------------------


def _side_stats(df: DataFrame, numeric: list[str], text: list[str]) -> DataFrame:
    """``(column, missing_share, low, high, constant)`` from one aggregate."""
    entries = []
    for c in [*numeric, *text]:
        value = F.col(c)
        number = value.cast("double") if c in numeric else F.lit(None).cast("double")
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.coalesce(F.try_divide(F.count_if(value.isNull()), F.count("*")), F.lit(0.0)).alias("missing_share"),
                F.min(number).alias("low"),
                F.max(number).alias("high"),
                F.coalesce(F.min(value) == F.max(value), F.lit(True)).alias("constant"),
            )
        )
    return df.agg(F.array(*entries).alias("es")).select(F.explode("es").alias("e")).select("e.*")


def _test(name: str, value: Column, limit: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(name).alias("test"),
        value.cast("double").alias("value"),
        limit.cast("double").alias("limit"),
        F.coalesce(passed, F.lit(True)).alias("passed"),
    )


def data_quality(
    reference: DataFrame,
    current: DataFrame,
    tolerance: float = 0.1,
    bounds: dict[str, tuple[float, float]] | None = None,
    max_duplicate_share: float = 0.0,
) -> DataFrame:
    """``(column, test, value, limit, passed)`` for the common columns.

    Missing share against the reference plus tolerance, numbers inside the reference's range, no new
    category, no constant column, duplicate rows over all common columns, and declared bounds.
    """
    columns = common_columns(reference, current)
    whole = current.select(*columns)
    reference, current = as_categories(reference), as_categories(current)
    numeric = [c for c in numeric_columns(reference) if c in columns]
    text = [c for c in string_columns(reference) if c in columns]
    ref, cur = reference.select(*numeric, *text), current.select(*numeric, *text)
    ref_stats = _side_stats(ref, numeric, text)
    cur_stats = _side_stats(cur, numeric, text)
    pairs = cur_stats.join(
        ref_stats.select("column", *[F.col(c).alias(f"ref_{c}") for c in ("missing_share", "low", "high", "constant")]),
        "column",
    )
    is_number = F.col("column").isin(numeric)
    tests = F.array(
        _test(
            "missing_share",
            F.col("missing_share"),
            F.col("ref_missing_share") + tolerance,
            F.col("missing_share") <= F.col("ref_missing_share") + tolerance,
        ),
        _test("constant", F.col("constant").cast("int"), F.lit(0), ~F.col("constant")),
        F.when(is_number, _test("min", F.col("low"), F.col("ref_low"), F.col("low") >= F.col("ref_low"))),
        F.when(is_number, _test("max", F.col("high"), F.col("ref_high"), F.col("high") <= F.col("ref_high"))),
    )
    shape = ["column", "test", "value", "limit", "passed"]
    out = pairs.select("column", F.explode(F.array_compact(tests)).alias("e")).select("column", "e.*")
    if text:
        fresh = _both_sides(ref, cur, text, "string").filter(F.col("value").isNotNull())
        out = out.unionByName(
            fresh.groupBy("column")
            .agg(F.count_if((F.col("r") == 0) & (F.col("c") > 0)).alias("new"))
            .select("column", _test("new_categories", F.col("new"), F.lit(0), F.col("new") == 0).alias("e"))
            .select("column", "e.*")
        )
    repeats = (
        whole.groupBy(*whole.columns)
        .agg(F.count("*").alias("_n"))
        .agg((1 - F.try_divide(F.count("*"), F.sum("_n"))).alias("share"))
        .select(
            F.lit("*").alias("column"),
            _test(
                "duplicate_share", F.col("share"), F.lit(max_duplicate_share), F.col("share") <= max_duplicate_share
            ).alias("e"),
        )
        .select("column", "e.*")
    )
    out = out.unionByName(repeats)
    declared = {c: b for c, b in (bounds or {}).items() if c in numeric}
    if declared:
        checks = []
        for c, (lo, hi) in declared.items():
            low = _test("lower_bound", F.min(F.col(c)), F.lit(lo), F.min(F.col(c)) >= lo)
            high = _test("upper_bound", F.max(F.col(c)), F.lit(hi), F.max(F.col(c)) <= hi)
            checks += [F.struct(F.lit(c).alias("column"), low.alias("e")), F.struct(F.lit(c).alias("column"), high.alias("e"))]
        rows = cur.agg(F.array(*checks).alias("cs")).select(F.explode("cs").alias("c")).select("c.column", "c.e.*")
        out = out.unionByName(rows)
    return out.select(*shape)
