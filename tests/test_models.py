import json
import shutil
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Row
from pyspark.sql import functions as F

from riskframe.operators import attribution, learning, logistic, registry
from riskframe.operators.versioning import load_version, narrowed, register_reference, save_version
from riskframe.plans.models import audit, promote_job, train_job
from riskframe.plans.datasets import build_dataset
from riskframe.session import FEW_ROWS, ROWS_PER_TASK, spread


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(600):
        a, b, c = rng.normal(), rng.normal(), "uvw"[rng.integers(0, 3)]
        y = int(a + 0.5 * b * (c == "u") + rng.normal() * 0.3 > 0)
        rows.append((str(i), float(a), float(b) if i % 7 else None, c, y))
    return spark.createDataFrame(rows, "loan_id string, a double, b double, c string, default int").cache()


@pytest.mark.parametrize(
    "kind, params",
    [("logistic_regression", {}), ("boosted_trees", {"n_estimators": 5, "max_depth": 3}), ("random_forest", {"n_estimators": 5, "max_depth": 4})],
)
def test_models_learn(spark, frame, kind, params, tmp_path):
    model = learning.train(frame, kind, ignore=("loan_id",), dictionary=str(tmp_path / "dict"), **params)
    scored = learning.scored(model, frame, keep=("loan_id",))
    from riskframe.operators.metrics import roc_auc

    assert roc_auc(scored).first()[0] > 0.9
    model.write().overwrite().save(str(tmp_path / "model"))
    again = learning.scored(PipelineModel.load(str(tmp_path / "model")), frame, keep=("loan_id",))
    assert scored.exceptAll(again).count() == 0


def test_a_moved_model_scores_alike(spark, frame, tmp_path):
    """The dictionary travels inside the saved pipeline: the folder is moved and the one it was fitted with is gone."""
    model = learning.train(frame, "logistic_regression", ignore=("loan_id",), dictionary=str(tmp_path / "dict"))
    want = sorted(learning.scored(model, frame, keep=("loan_id",)).collect())
    model.write().save(str(tmp_path / "model"))
    shutil.move(str(tmp_path / "model"), str(tmp_path / "elsewhere"))
    shutil.rmtree(tmp_path / "dict")
    moved = PipelineModel.load(str(tmp_path / "elsewhere"))
    assert sorted(learning.scored(moved, frame, keep=("loan_id",)).collect()) == want
    moved.write().save(str(tmp_path / "again"))
    shutil.rmtree(tmp_path / "elsewhere")
    assert sorted(learning.scored(PipelineModel.load(str(tmp_path / "again")), frame, keep=("loan_id",)).collect()) == want


def test_boosting_stops_where_validation_gains_nothing(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(str(i), *map(float, rng.normal(size=3)), int(rng.random() < 0.5)) for i in range(400)]  # nothing to learn
    noise = spark.createDataFrame(rows, "loan_id string, a double, b double, c double, default int").cache()
    fit, held = noise.filter("loan_id % 4 <> 0"), noise.filter("loan_id % 4 = 0")
    params = {"n_estimators": 30, "max_depth": 5}
    assert learning.train(fit, "boosted_trees", ignore=("loan_id",), **params).stages[-1].getNumTrees == 30
    stopped = learning.train(fit, "boosted_trees", ignore=("loan_id",), validation=held, **params)
    assert stopped.stages[-1].getNumTrees < 30
    job = train_job(noise, "boosted_trees", str(tmp_path / "m"), str(tmp_path / "metrics"), "r", folds=0, early_stop=0.25, **params)
    assert job.stages[-1].getNumTrees < 30


@pytest.mark.parametrize("kind", ["logistic_regression", "random_forest", "boosted_trees"])
def test_an_interrupted_search_goes_on(frame, tmp_path, kind):
    small = {
        "logistic_regression": "adaptive",
        "random_forest": {"n_estimators": ("int", 2, 4), "max_depth": ("int", 2, 3)},
        "boosted_trees": {"n_estimators": ("int", 2, 3), "max_depth": ("int", 2, 3)},
    }[kind]
    log = str(tmp_path / "log")
    first, _, _ = learning.random_search(frame, kind, trials=5, folds=2, space=small, log=log, timeout=0.0)
    assert first.count() == 1  # no time is left for a second one
    rows, best, score = learning.random_search(frame, kind, trials=2, folds=2, space=small, log=log)
    got = {r["trial"]: r for r in rows.collect()}
    assert set(got) == {0, 1} and got[0] == first.first()
    assert score == max(r["cv_auc_mean"] for r in got.values()) and json.dumps(best, sort_keys=True) in {r["params"] for r in got.values()}
    with pytest.raises(ValueError, match="another search"):
        learning.random_search(frame, kind, trials=1, folds=2, space=small, log=log, seed=7)


def test_cleaning_keeps_the_training_fences(spark, frame):
    model = learning.train(frame, "logistic_regression", ignore=("loan_id",), clean=True)
    far = frame.limit(1).withColumn("a", F.lit(1000.0)).withColumn("b", F.lit(None).cast("double"))
    cleaned = model.stages[0].transform(far).first()
    assert 1.0 < cleaned["a"] < 10.0 and cleaned["loan_id"] == frame.first()["loan_id"]
    at_fence = far.withColumn("a", F.lit(cleaned["a"]))
    scored = learning.scored(model, far).first()  # the missing b is filled behind the cleaner
    assert scored == learning.scored(model, at_fence).first() and 0 <= scored["p"] <= 1


def test_unknown_kind(frame):
    with pytest.raises(ValueError):
        learning.train(frame, "nearest_neighbour")


def test_cross_validation_and_search(frame):
    row = learning.cv_auc(frame, "logistic_regression", folds=3).first()
    assert row["folds"] == 3 and row["cv_auc_mean"] > 0.9 and row["cv_auc_std"] < 0.1
    trials, best, score = learning.random_search(frame, "logistic_regression", trials=2, folds=2, seed=1)
    assert trials.count() == 2 and set(best) == {"C", "penalty", "l1_ratio"} and score > 0.9


def brute_shapley(leaves, x, size):
    """Path-dependent Shapley values of one tree by enumerating all coalitions."""

    def value(known):
        total = 0.0
        for leaf in leaves:
            w = leaf["value"]
            for f, (lo, hi, share) in leaf["path"].items():
                w *= float(lo < x[f] <= hi) if f in known else share
            total += w
        return total

    phi = np.zeros(size)
    for i in range(size):
        others = [f for f in range(size) if f != i]
        for k in range(size):
            for s in combinations(others, k):
                weight = factorial(k) * factorial(size - k - 1) / factorial(size)
                phi[i] += weight * (value({*s, i}) - value(set(s)))
    return phi


@pytest.mark.parametrize("forest", [False, True])
def test_tree_attributions(spark, forest):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4))
    y = (x[:, 0] * x[:, 1] + x[:, 2] > 0).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], "f0 double, f1 double, f2 double, f3 double, y int")
    df = VectorAssembler(inputCols=["f0", "f1", "f2", "f3"], outputCol="_features").transform(df)
    if forest:
        model = RandomForestClassifier(featuresCol="_features", labelCol="y", numTrees=3, maxDepth=5, seed=1).fit(df)
        explained_value = F.get(vector_to_array("probability"), 1)
    else:
        model = GBTClassifier(featuresCol="_features", labelCol="y", maxIter=3, maxDepth=5, seed=1).fit(df)
        explained_value = F.get(vector_to_array("rawPrediction"), 1)
    out, base = attribution.tree_attributions(model, model.transform(df))
    rows = out.select("f0", "f1", "f2", "f3", "attributions", explained_value.alias("v")).collect()
    for r in rows:
        assert sum(r["attributions"]) + base == pytest.approx(r["v"], abs=1e-9)
    trees = attribution.tree_leaves(model)
    for r in rows[:5]:
        want = sum(brute_shapley(t, [r["f0"], r["f1"], r["f2"], r["f3"]], 4) for t in trees)
        np.testing.assert_allclose(r["attributions"], want, atol=1e-9)


def test_tree_attributions_look_leaves_up_together(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 5))
    y = (x[:, 0] * x[:, 1] + x[:, 2] > 0).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], "f0 double, f1 double, f2 double, f3 double, f4 double, y int")
    df = VectorAssembler(inputCols=[f"f{i}" for i in range(5)], outputCol="_features", handleInvalid="keep").transform(df)
    model = GBTClassifier(featuresCol="_features", labelCol="y", maxIter=4, maxDepth=6, seed=1).fit(df)
    odd = [[np.nan] * 5, [-np.inf] * 5, [np.inf] * 5, [0.0, np.nan, 1.0, np.inf, -np.inf]]
    odd = spark.createDataFrame([Row(_features=DenseVector(r)) for r in odd])
    df = df.select("_features").unionByName(odd)
    _, _, tables, single = attribution._packed(attribution.tree_leaves(model))
    leaves = sum(len(tree) for tree in attribution.tree_leaves(model))
    assert not single and len(tables) * 4 < leaves  # a row does not visit every leaf
    assert all(table.shape[1] <= max(attribution.CELLS) for _, _, table in tables)

    def explained(limits):
        monkeypatch.setattr(attribution._packed, "__defaults__", (limits,))
        out, base = attribution.tree_attributions(model, df)
        return np.array([r[0] for r in out.select("attributions").collect()]), base

    one_by_one, base = explained(())  # every leaf integrated for every row
    for limits in [attribution.CELLS, (64,), (8,)]:  # 8: some leaves in tables, some integrated
        together, same = explained(limits)
        assert same == base
        np.testing.assert_allclose(together, one_by_one, atol=1e-12)


def test_rows_to_train_on_use_every_core(spark):
    few = spark.range(1000).coalesce(1)
    assert spread(few, 1000) is few
    rows = spread(few, FEW_ROWS + 1)
    assert rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    parts = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == spark.sparkContext.defaultParallelism and max(r["count"] for r in parts) < 300
    assert spread(spark.range(10), 30 * ROWS_PER_TASK).rdd.getNumPartitions() >= 30


@pytest.mark.parametrize("params", [{"penalty": "l2", "C": 0.5}, {"penalty": "l1", "C": 0.05}, {"penalty": "elasticnet", "l1_ratio": 0.3, "C": 20.0}])
def test_folds_are_fitted_in_the_same_passes(frame, monkeypatch, params):
    table = learning.vectors(frame, "default", "loan_id", 3)
    blocks = logistic.fold_blocks(table, "default", learning.FEATURES)
    passes, summed = [], logistic._summed
    monkeypatch.setattr(logistic, "_summed", lambda *args: passes.append(1) or summed(*args))
    for weighted in (False, True):
        fitted = logistic.fit_folds(blocks, 3, {**learning.DEFAULTS["logistic_regression"], **params}, weighted)
        for f, (coefficients, intercept) in enumerate(fitted):
            training, n = learning.with_weights(table.filter(F.col("fold") != f), "logistic_regression", "default", balanced=weighted)
            want = learning.classifier("logistic_regression", n, "default", **params).setTol(1e-12).fit(training)
            np.testing.assert_allclose([*coefficients, intercept], [*want.coefficients.toArray(), want.intercept], atol=1e-5)
    assert len(passes) <= 2 * 12  # not some twenty for each of six models


def test_folds_that_need_sparks_own_trainer(spark, frame):
    table = learning.vectors(frame, "default", "loan_id", 3)
    params = learning.DEFAULTS["logistic_regression"]
    for odd in [table.filter("default = 1"), table.withColumn("default", F.col("default") + 1), table.limit(0)]:
        assert logistic.fit_folds(logistic.fold_blocks(odd, "default", learning.FEATURES), 3, params, False) is None
    assert learning.cv_rows(table.filter("default = 1"), "logistic_regression", "default", 3, {}).filter("p = 1").count() > 0
    lost = table.withColumn("fold", F.when(F.col("fold") > 0, F.col("fold")))  # rows without a fold take no part
    blocks = logistic.fold_blocks(lost, "default", learning.FEATURES)
    assert blocks.agg(F.sum("rows")).first()[0] == table.filter("fold > 0").count()


def test_versions(spark, tmp_path):
    root = str(tmp_path / "versions")
    df = spark.createDataFrame([(1, 2.0, "a"), (2, None, "b")], "i int, x double, t string")
    version = save_version(df, root, "loans", "first")
    assert save_version(df.orderBy(F.desc("i")), root, "loans") == version
    assert load_version(spark, root, "loans", version).exceptAll(df).count() == 0
    reference = register_reference(df, root, "loans")
    assert load_version(spark, root, "reference_loans", reference).count() == 2
    with pytest.raises(FileNotFoundError):
        load_version(spark, root, "loans", "00000000")
    with pytest.raises(FileNotFoundError):
        load_version(spark, str(tmp_path / "nowhere"), "loans", version)


def test_narrowed_types(spark):
    df = spark.createDataFrame([("1", "1.5", "x"), ("2", None, "3")], "a string, b string, c string")
    assert dict(narrowed(df).dtypes) == {"a": "bigint", "b": "double", "c": "string"}


def test_train_audit_promote(spark, frame, tmp_path):
    metrics, log = str(tmp_path / "metrics"), str(tmp_path / "log")
    model = train_job(frame, "logistic_regression", str(tmp_path / "model"), metrics, "run-1", folds=2)
    logged = spark.read.parquet(metrics)
    assert {"auc", "cv_auc_mean", "cv_auc_std", "recall_1"} <= {r["name"] for r in logged.collect()}
    rows = learning.scored(model, frame, keep=("c", "loan_id")).withColumn("half", (F.col("loan_id").cast("int") % 2).cast("string"))
    fair = audit(rows, ["half"], path=str(tmp_path / "fair"))
    assert spark.read.json(str(tmp_path / "fair/groups")).count() == 2
    validation = logged.filter("scope = 'validation'")
    gaps = fair["disparities"].filter("value <= 0.1")
    promote_job(validation, gaps, log, "m", 1)
    state = registry.registry_state(spark.read.parquet(log)).first()
    assert (state["stage"], state["aliases"]) == ("Staging", "champion")
    with pytest.raises(Exception, match="checks failed"):
        promote_job(validation, gaps, log, "m", 2, min_auc=1.01)
    assert spark.read.parquet(log).count() == 1


def test_pick_version_errors(spark):
    rows = [("m", 1, "Archived", None, "2024-01-01", "r1")]
    reg = spark.createDataFrame(rows, "name string, version long, stage string, alias string, ts string, run_id string")
    reg = reg.withColumn("creation_ts", F.to_timestamp("ts")).drop("ts")
    assert registry.require_version(reg, "m", 1)["run_id"] == "r1"
    with pytest.raises(ValueError):
        registry.require_version(reg, "m", "champion")


def test_build_dataset_job(spark, sf_dir, tmp_path):
    from riskframe import fixtures as fx

    source = str(tmp_path / "raw")
    frame = fx.loans(spark, sf_dir, [c for c in fx.LOAN_COLUMNS if c != "o_orderkey"])
    frame.write.option("header", "true").csv(source)
    paths = build_dataset(spark, source, str(tmp_path / "out"), schema=frame.schema)
    full, train, test = (spark.read.parquet(paths[n]) for n in ("full", "train", "test"))
    assert full.count() == 1500 and train.count() + test.count() == 1500
    assert train.join(test, "loan_id").count() == 0
    names = [r["name"] for r in spark.read.json(paths["feature_names"]).orderBy("position").collect()]
    assert names == [c for c in full.columns if c != "default"] and "loan_status" not in names
