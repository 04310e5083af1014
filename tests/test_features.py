import pytest
from pyspark.sql import functions as F

from riskframe.operators import features


def values(df, column):
    return [r[column] for r in df.collect()]


def test_grades(spark):
    df = spark.createDataFrame([("A", "A1"), ("G", "G5"), ("B", "B2"), ("Z", "Z1"), (None, None), ("AB", "A6")], "grade string, sub_grade string")
    out = features.grade_features(df)
    assert values(out, "grade_numeric") == [1.0, 7.0, 2.0, 0.0, 0.0, 0.0]
    assert values(out, "sub_grade_numeric") == [1.0, 35.0, 7.0, 0.0, 0.0, 0.0]
    assert out.columns == ["grade_numeric", "sub_grade_numeric"]


def test_brackets_are_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in (None, -1.0, 0.0, 30000.0, 30000.5, 100000.0, 1e7)], "annual_inc double")
    assert values(features.bins(df), "income_bracket") == ["nan", "nan", "Low", "Low", "Lower_Middle", "Upper_Middle", "High"]


def test_onehot_uses_the_fitted_values(spark):
    fit = spark.createDataFrame([("OWN", "f"), ("RENT", "w"), (None, None)], "home_ownership string, initial_list_status string")
    known = features.fit_onehot(fit)
    out = features.onehot(spark.createDataFrame([("OWN", "x"), ("NEW", "f")], fit.schema), known).collect()
    assert [r.asDict() for r in out] == [
        {"home_ownership_OWN": 1, "home_ownership_RENT": 0, "initial_list_status_f": 0, "initial_list_status_w": 0},
        {"home_ownership_OWN": 0, "home_ownership_RENT": 0, "initial_list_status_f": 1, "initial_list_status_w": 0},
    ]
    with pytest.raises(ValueError):
        features.fit_onehot(fit, max_categories=1)


def test_alternative_ownership_column_keeps_the_prefix(spark):
    df = spark.createDataFrame([("OWN",)], "home_ownership_n string")
    assert features.onehot(df, features.fit_onehot(df)).columns == ["home_ownership_OWN"]


def test_time(spark):
    df = spark.createDataFrame(
        [("2015-12-01", "2005-12-01", "36 months"), ("2015-12-01", "2016-01-01", "none"), (None, "2005-12-01", None)],
        "issue_d string, earliest_cr_line string, term string",
    )
    rows = features.time_features(df).collect()
    assert rows[0]["issue_month"] == 12 and rows[0]["issue_year"] == 2015 and rows[0]["issue_day_of_week"] == 1
    assert rows[0]["credit_history_length_years"] == pytest.approx(3652 / 365.25)
    assert rows[1]["credit_history_length_years"] == 0 and rows[1]["term_numeric"] is None
    assert rows[2]["issue_year"] is None and rows[2]["credit_history_length_years"] is None


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert features.create_features(df).columns == ["x"]


def test_risk_flags_sum_only_present(spark):
    df = spark.createDataFrame([(30.0, None), (25.0, 16.0)], "dti double, int_rate double")
    rows = features.risk_flags(df).collect()
    assert [r["combined_risk_score"] for r in rows] == [1, 1]
    assert rows[0]["high_interest_risk"] == 0


def test_target(spark):
    df = spark.createDataFrame([("Charged Off",), ("Current",), ("odd",), (None,)], "loan_status string")
    assert values(features.with_target(df), "default") == [1, 0, 0, 0]
    ready = features.with_target(spark.createDataFrame([(1.0,), (0.0,)], "Default double"))
    assert ready.columns == ["default"] and values(ready, "default") == [1, 0]


def test_ratio_with_zero_income(spark):
    df = spark.createDataFrame([(0.0, 10.0), (-1e-8, 10.0)], "annual_inc double, loan_amnt double")
    got = values(features.financial_ratios(df), "loan_income_ratio")
    assert got[0] == pytest.approx(1e9) and got[1] is None


def test_online_names(spark):
    df = spark.createDataFrame([("36 months", "A", 5)], "term string, grade string, total_acc int")
    row = features.online_encode(df, ["total_acc", "term_36 months", "grade_B", "grade_A", "other"]).first()
    assert tuple(row) == (5.0, 1.0, 0.0, 1.0, 0.0)


def test_features_are_one_projection(spark):
    df = spark.range(1).select(F.lit(1.0).alias("annual_inc"), F.lit(2.0).alias("dti"), F.lit(3.0).alias("loan_amnt"))
    plan = features.create_features(df, {})._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_text_dates(spark):
    from riskframe.operators.features import time_features

    df = spark.createDataFrame([("Dec-2015", "Aug-2003"), ("2015-12-01", "2003-08-01"), ("x", None)], "issue_d string, earliest_cr_line string")
    rows = [tuple(r) for r in time_features(df).select("issue_month", "issue_year", "credit_history_length_years").collect()]
    assert rows[0] == rows[1] and rows[0][:2] == (12, 2015) and 12.3 < rows[0][2] < 12.4 and rows[2] == (None, None, None)
