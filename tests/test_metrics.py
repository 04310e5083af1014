import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import fairness, gates, metrics, profile
from riskframe.operators.split import mark_test, with_fold

RNG = np.random.default_rng(3)
ROWS = [(int(y), float(np.round(p, 1)), "a" if i % 3 else "b") for i, (y, p) in enumerate(zip(RNG.integers(0, 2, 300), RNG.random(300)))]


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(ROWS, "y int, p double, g string").withColumn("y_pred", (F.col("p") > 0.5).cast("int"))


def brute_auc(rows):
    pos, neg = [p for y, p, *_ in rows if y], [p for y, p, *_ in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_and_its_symmetries(scored):
    auc = metrics.roc_auc(scored).first()[0]
    assert auc == pytest.approx(brute_auc(ROWS))
    assert metrics.roc_auc(scored.withColumn("p", -F.col("p"))).first()[0] == pytest.approx(1 - auc)
    assert metrics.roc_auc(scored.withColumn("p", F.exp("p") * 3)).first()[0] == pytest.approx(auc)


def test_one_class_has_no_area(scored):
    assert metrics.roc_auc(scored.filter("y = 1")).first()[0] == -1
    areas = {r["group"]: r["auc"] for r in metrics.metrics_by_group(scored.filter("y = 1 or g = 'a'"), ["g"]).collect()}
    assert areas["b"] == -1 and areas["a"] == pytest.approx(brute_auc([r for r in ROWS if r[2] == "a"]))


def test_average_precision(scored):
    by_score = sorted({p for _, p, _ in ROWS}, reverse=True)
    positives, before, want = sum(y for y, *_ in ROWS), 0.0, 0.0
    for s in by_score:
        chosen = [y for y, p, _ in ROWS if p >= s]
        recall = sum(chosen) / positives
        want += (recall - before) * sum(chosen) / len(chosen)
        before = recall
    assert metrics.average_precision(scored).first()[0] == pytest.approx(want)


def test_confusion_sums_to_rows(scored):
    assert sum(metrics.confusion(scored).first()) == len(ROWS)


def test_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, y_pred int")
    assert metrics.binary_metrics(df).first().asDict() == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1_score": 0.0}


def test_report_names(scored):
    names = {r["name"] for r in metrics.evaluate(scored).collect()}
    assert {"accuracy", "auc", "avg_precision", "tn", "precision_1", "f1-score_macro avg", "support_weighted avg"} <= names
    no_scores = {r["name"]: r["value"] for r in metrics.evaluate(scored, score=None).collect()}
    assert no_scores["auc"] == -1


def test_fairness(spark):
    rows = [("a", 1, 1), ("a", 1, 0), ("a", 0, 0), ("b", 1, 1), ("b", 1, 1), (None, 0, 1)]
    df = spark.createDataFrame(rows, "g string, y int, y_pred int").withColumn("single", F.lit("x"))
    groups = fairness.fairness_groups(df, ["g", "single"])
    by = {(r["feature"], r["group"]): r for r in groups.collect()}
    assert ("g", None) not in by
    assert by["g", "b"]["auc"] == -1 and by["g", "a"]["auc"] == pytest.approx(0.75)
    gaps = {(r["feature"], r["name"]): r["value"] for r in fairness.disparities(groups).collect()}
    assert gaps["g", "max_positive_rate_difference"] == pytest.approx(2 / 3)
    assert ("g", "auc_std") not in gaps  # only one group has an area
    assert not [k for k in gaps if k[0] == "single"]
    flags = fairness.bias_flags(fairness.disparities(groups)).collect()
    assert [f["feature"] for f in flags] == ["g"] and flags[0]["concern"] == "Potential bias detected"
    assert {r["feature"] for r in fairness.fairness_summary(groups).collect()} == {"g"}


def test_gates(spark):
    ts = "2024-01-01"
    rows = [("r1", "auc", 0.7, ts), ("r1", "accuracy", 0.9, ts), ("r2", "accuracy", 0.9, ts), ("r3", "auc", 0.72, "2024-01-02"), ("r3", "auc", 0.1, ts)]
    log = spark.createDataFrame(rows, "run_id string, name string, value double, ts string").withColumn("ts", F.to_timestamp("ts"))
    loose = {r["run_id"]: r["passed"] for r in gates.gate_performance(log).filter("check = 'auc'").collect()}
    strict = {r["run_id"]: r["passed"] for r in gates.gate_performance(log, 0.75, required=True).filter("check = 'auc'").collect()}
    assert loose == {"r1": True, "r2": True, "r3": True}
    assert strict == {"r1": False, "r2": False, "r3": False}
    with pytest.raises(gates.ValidationFailed):
        gates.require(gates.gate_performance(log, 0.75, required=True))
    empty = spark.createDataFrame([], "feature string, name string, value double")
    assert gates.gate_fairness(empty).first()["reason"] == "no fairness report"
    fair = spark.createDataFrame([("g", "x", 0.1)], "feature string, name string, value double")
    assert gates.gate_fairness(fair).first()["passed"]


def test_split_keeps_class_shares(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("loan_id"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    marked = mark_test(df, "loan_id", "y")
    got = {(r["y"], r["is_test"]): r["count"] for r in marked.groupBy("y", "is_test").count().collect()}
    assert got == {(1, True): 120, (1, False): 480, (0, True): 480, (0, False): 1920}
    again = mark_test(df.repartition(7), "loan_id", "y")
    assert marked.exceptAll(again).count() == 0
    assert with_fold(df, "loan_id", 5).select("fold").distinct().count() == 5


def test_content_hash_ignores_order_but_not_counts(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "i int, t string")
    digest = lambda d: profile.content_hash(d).first()["digest"]
    assert digest(df) == digest(df.orderBy(F.desc("i")).select("t", "i"))
    assert digest(df) != digest(df.distinct())


def test_histogram_density_sums_to_one(scored):
    rows = profile.histogram_by_class(scored, "p", "y", bins=7, common_range=True).collect()
    width = 1.0 / 7
    for label in (0, 1):
        assert sum(r["density"] for r in rows if r["label"] == label) * width == pytest.approx(1.0, rel=0.11)
