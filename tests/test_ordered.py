import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions import ordered
from riskframe.functions.ordered import exact_quantiles, quantiles_by, running_totals, value_counts_long


@pytest.mark.parametrize("rows_per_bucket", [3, 50, 10**9])
def test_running_totals_with_a_hot_key(spark, rows_per_bucket):
    # key "hot" holds most rows; every bucket size must give the same sums
    rows = [("hot", float(i % 97) + i / 1000, 1 + i % 3) for i in range(400)] + [("rare", 1.0, 5), ("rare", 0.5, 7)]
    df = spark.createDataFrame(rows, "k string, v double, n long")
    got = {(r["k"], r["v"]): (r["cum_n"], r["total_n"]) for r in running_totals(df, ["k"], ["v"], ["n"], rows_per_bucket).collect()}
    want = {}
    for key in ("hot", "rare"):
        part = sorted((v, n) for k, v, n in rows if k == key)
        total, run = sum(n for _, n in part), 0
        for v, n in part:
            run += n
            want[key, v] = (run, total)
    assert got == want


def test_running_totals_over_text_without_keys(spark):
    words = sorted({f"w{i * 7919 % 1000:03d}" for i in range(300)})
    df = spark.createDataFrame([(w, 1) for w in words], "w string, n long")
    got = {r["w"]: r["cum_n"] for r in running_totals(df, [], ["w"], ["n"], 5).collect()}
    assert got == {w: i + 1 for i, w in enumerate(words)}


def _frame(spark):
    rng = np.random.default_rng(1)
    a, b, c = rng.normal(size=5000), rng.integers(0, 4, 5000).astype(float), np.exp(rng.normal(size=5000) * 5)
    rows = [(float(x), float(y), float(z) if i % 9 else None, None) for i, (x, y, z) in enumerate(zip(a, b, c))]
    return spark.createDataFrame(rows, "a double, b double, c double, empty double"), {
        "a": a, "b": b, "c": np.array([z for i, z in enumerate(c) if i % 9])}


@pytest.mark.parametrize("most", [0, 10**6])
def test_exact_quantiles_by_both_routes(spark, most):
    df, arrays = _frame(spark)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["a", "b", "c", "empty"], probs, most=most)
    for name, values in arrays.items():
        np.testing.assert_allclose(got[name], np.quantile(values, probs), rtol=1e-12)
    assert got["empty"] == [None] * len(probs)


def test_a_wrong_range_is_searched_again(spark, monkeypatch):
    df, arrays = _frame(spark)
    monkeypatch.setattr(ordered, "_spans", lambda df, counts, wanted: {c: [(5.0, 6.0)] for c in wanted})
    got = exact_quantiles(df, ["a", "c"], [0.5], most=0)
    assert got["a"][0] == pytest.approx(np.median(arrays["a"]), rel=1e-12)
    assert got["c"][0] == pytest.approx(np.median(arrays["c"]), rel=1e-12)


def test_grouped_quantiles(spark):
    df, _ = _frame(spark)
    df = df.withColumn("g", (F.col("b") > 1).cast("int"))
    got = {(r["g"], r["column"]): r["q"] for r in quantiles_by(value_counts_long(df, ["a"], ["g"]), ["g", "column"], "value", {"q": 0.3}).collect()}
    pdf = df.select("a", "g").toPandas()
    for g, part in pdf.groupby("g"):
        assert got[g, "a"] == pytest.approx(np.quantile(part["a"], 0.3), rel=1e-12)


def test_buckets_actually_split(spark):
    df = spark.range(2400).select(F.col("id").cast("double").alias("v"), F.lit(1).alias("n"))
    buckets = ordered.with_bucket(df, [], ["v"], 2).select("bucket").distinct().count()
    assert buckets > 1023  # nothing bounds their number
    assert running_totals(df, [], ["v"], ["n"], 100).filter("cum_n <> v + 1 or total_n <> 2400").count() == 0
