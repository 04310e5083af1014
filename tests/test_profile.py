import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import profile


def test_correlation_of_many_columns_with_gaps(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 70)) @ rng.normal(size=(70, 70)) + 1e6
    x[rng.random(x.shape) < 0.2] = np.nan
    names = [f"v{i}" for i in range(70)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r["a"], r["b"]): r["corr"] for r in profile.correlation_matrix(df).collect()}
    assert len(got) == 70 * 69 // 2
    for i in range(70):
        for j in range(i + 1, 70):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert got[f"v{i}", f"v{j}"] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    plan = profile.correlation_matrix(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1  # blocks are opened after the sums, rows never


def test_correlation_of_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (1.0, 3.0, None)], "a double, b double, c double")
    assert {(r["a"], r["b"]): r["corr"] for r in profile.correlation_matrix(df).collect()} == {("a", "b"): None}


def test_grouped_quartiles_shuffle_no_distinct_values(spark):
    rng = np.random.default_rng(5)
    rows = [(int(g), float(v), float(v * 2) if g else None) for g, v in zip(rng.integers(0, 2, 5000), rng.normal(size=5000))]
    df = spark.createDataFrame([*rows, (None, 9.0, 9.0)], "g int, x double, y double")
    got = {(r["g"], r["column"]): r for r in profile.describe_numeric(df, ["x", "y"], by="g").collect()}
    for g in (0, 1):
        values = np.array([r[1] for r in rows if r[0] == g])
        assert [got[g, "x"][q] for q in profile.QUARTILES] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))
    assert got[0, "y"]["p50"] is None and got[0, "y"]["count"] == 0 and len(got) == 4
    plan = profile.describe_numeric(df, ["x", "y"], by="g")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Expand" not in plan  # quartiles are constants of the plan
    with pytest.raises(ValueError):
        profile.describe_numeric(df.withColumn("g", F.col("x")), ["y"], by="g")
    assert profile.describe_numeric(df.filter("g > 5"), ["x"], by="g").count() == 0
