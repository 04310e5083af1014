import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import drift, gates
from riskframe.plans import monitoring


def test_same_table_has_no_drift(spark):
    df = spark.createDataFrame([(float(i % 13), "ab"[i % 2]) for i in range(200)], "x double, t string")
    rows = {r["column"]: r for r in drift.column_drift(df, df).collect()}
    assert rows["x"]["statistic"] == 0 and rows["x"]["p_value"] == 1
    assert rows["t"]["statistic"] == 0 and rows["t"]["p_value"] == 1
    assert drift.dataset_drift(df, df).first()["dataset_drift"] is False


def test_ks_against_brute_force(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=150), rng.normal(0.4, 1.2, size=90)
    ref = spark.createDataFrame([(float(v),) for v in a] + [(None,)], "x double")
    cur = spark.createDataFrame([(float(v),) for v in b], "x double")
    row = drift.ks_drift(ref, cur, ["x"]).first()
    grid = np.concatenate([a, b])
    d = max(abs((a <= v).mean() - (b <= v).mean()) for v in grid)
    lam = d * math.sqrt(150 * 90 / 240)
    p = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert row["statistic"] == pytest.approx(d) and row["p_value"] == pytest.approx(p)
    assert (row["n_reference"], row["n_current"]) == (150, 90)


def test_chi2_tail_values(spark):
    # textbook 5 % and 1 % points
    points = [(3.841459, 1.0, 0.05), (5.991465, 2.0, 0.05), (18.307038, 10.0, 0.05), (23.209251, 10.0, 0.01), (124.342113, 100.0, 0.05), (0.0, 3.0, 1.0), (5.0, 0.0, 1.0)]
    df = spark.createDataFrame(points, "s double, k double, p double")
    for r in df.withColumn("got", drift.chi2_p(F.col("s"), F.col("k"))).collect():
        assert r["got"] == pytest.approx(r["p"], abs=1e-6)


def test_missing_is_a_category(spark):
    ref = spark.createDataFrame([("a",)] * 50 + [(None,)] * 50, "t string")
    cur = spark.createDataFrame([("a",)] * 100, "t string")
    row = drift.chi2_drift(ref, cur, ["t"]).first()
    assert row["dof"] == 1 and row["drifted"]
    assert row["statistic"] == pytest.approx(2 * 25**2 / 75 + 2 * 25**2 / 25)


def test_counted_reference_and_plan_without_joins(spark):
    ref = spark.createDataFrame([(float(i % 7), "ab"[i % 2], i % 3 == 0) for i in range(90)], "x double, g string, b boolean")
    cur = spark.createDataFrame([(float(i % 5), "abc"[i % 3], None) for i in range(60)], "x double, g string, b boolean")
    counted = drift.count_reference(ref)
    for current in (cur, cur.drop("x"), cur.drop("b")):
        direct = sorted(drift.column_drift(ref, current).collect())
        assert sorted(drift.column_drift(counted, current).collect()) == direct and len(direct) == len(current.columns)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = drift.chi2_drift(ref, cur, ["g"])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" not in plan


def test_prediction_drift_needs_both_sides(spark):
    df = spark.createDataFrame([(0.1,)], "p double")
    with pytest.raises(ValueError):
        drift.prediction_drift(df.select(F.lit(1).alias("x")), df, "p")


def test_quality_and_gate(spark, tmp_path):
    ref = spark.createDataFrame([(float(i), "ab"[i % 2]) for i in range(20)], "x double, t string")
    bad = spark.createDataFrame([(50.0, "c"), (50.0, "c"), (None, "a")], "x double, t string")
    tests = {(r["column"], r["test"]): r["passed"] for r in drift.data_quality(ref, bad, bounds={"x": (0, 60)}).collect()}
    assert tests == {
        ("x", "missing_share"): False, ("x", "constant"): False, ("x", "min"): True, ("x", "max"): False,
        ("t", "missing_share"): True, ("t", "constant"): True, ("t", "new_categories"): False,
        ("*", "duplicate_share"): False, ("x", "lower_bound"): True, ("x", "upper_bound"): True,
    }
    with pytest.raises(gates.ValidationFailed):
        monitoring.validate(ref, bad, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 8
    monitoring.validate(ref, ref, str(tmp_path / "good"))


def test_monitor_job(spark, tmp_path):
    rows = [(str(i), float(i), i / 100, int(i > 50), int(i % 2)) for i in range(100)]
    logs = spark.createDataFrame(rows, "loan_id string, x double, p double, y_pred int, y int")
    reference = logs.select("x", "p")
    columns = monitoring.monitor(
        reference, logs.drop("y"), str(tmp_path / "metrics"), str(tmp_path / "report"), "run-1",
        labels=logs.select("loan_id", F.when(F.col("x") < 90, F.col("y")).alias("y")), score="p",
    )
    assert columns.count() == 2
    names = {r["name"] for r in spark.read.parquet(str(tmp_path / "metrics")).collect()}
    assert {"drift_share", "drifted_columns", "prediction_drift", "accuracy", "auc"} <= names


def test_booleans_and_times_are_columns_too(spark):
    from riskframe.operators import drift

    df = spark.range(60).selectExpr("id % 2 = 0 flag", "timestamp_seconds(id * 86400) at", "cast(id % 7 as double) x")
    columns = {r["column"]: r["test"] for r in drift.column_drift(df, df).collect()}
    assert columns == {"flag": "chi2", "at": "chi2", "x": "ks"}
    assert drift.column_drift(df.drop("x"), df).count() == 2
    share = drift.data_quality(df, df).filter("test = 'duplicate_share'").first()
    assert share["value"] == 0 and share["passed"]


def test_gates_need_evidence(spark):
    from riskframe.operators import gates

    none = spark.createDataFrame([], "run_id string, name string, value double, ts timestamp")
    for checks in (gates.gate_performance(none), gates.gate_performance(none, required=True)):
        assert not gates.all_passed(checks).first()["passed"]
