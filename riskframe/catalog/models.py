"""Training, search, attribution and dataset versions."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskframe import fixtures as fx
from riskframe.catalog.cleaning import KEY
from riskframe.catalog.registry import query, rounded
from riskframe.catalog.views import LOANS, Y, with_
from riskframe.operators import attribution, learning
from riskframe.operators.metrics import evaluate, roc_auc
from riskframe.operators.split import split
from riskframe.operators.versioning import load_version, manifest, register_reference, save_version
from riskframe.session import materialize, new_path, spread

MODEL_COLUMNS = [
    "loan_id", "loan_amnt", "term", "installment", "grade", "home_ownership", "annual_inc", "verification_status", "dti",
    "revol_util", "open_acc", "initial_list_status",
]


def model_frame(spark, sf_dir):
    """Loan columns with the target; text columns are label-encoded by the pipeline."""
    k = F.col(KEY)
    rows = fx.loans(spark, sf_dir, [KEY, *MODEL_COLUMNS], repeats=False)
    orders = fx.table(spark, sf_dir, "orders")
    status = orders.select(KEY, fx.target_flag(k).alias("default"))
    return materialize(spread(rows.join(status, KEY).drop(KEY), orders.count()), "model")


HASHED = f"""hashed AS (
  SELECT {Y} AS y, CAST('0x' || substr(sha256(o_orderkey || '#42'), 1, 12) AS BIGINT) AS h FROM orders JOIN customer ON o_custkey = c_custkey
), held_out AS (
  SELECT y FROM hashed QUALIFY (rank() OVER (PARTITION BY y ORDER BY h) - 1) < 0.2 * count(*) OVER (PARTITION BY y)
)"""
TRAINED = """SELECT 'validation_rows' AS name, CAST(count(*) AS DOUBLE) AS value FROM held_out
UNION ALL SELECT 'validation_positives', CAST(sum(y) AS DOUBLE) FROM held_out
UNION ALL SELECT 'probabilities', CAST(count(*) AS DOUBLE) FROM held_out
UNION ALL SELECT 'auc_agrees', 1.0
UNION ALL SELECT 'confusion_adds_up', 1.0"""


def _area(rows, y: str = "y", p: str = "p") -> float:
    """The area by Spark's own evaluator."""
    vectors = rows.select(F.col(y).cast("double").alias("label"), array_to_vector(F.array(1 - F.col(p), F.col(p))).alias("raw"))
    return BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0).evaluate(vectors)


def _checked(spark, sf_dir, kind):
    """A model of default size and what must hold for its scores on the held-out rows."""
    training, validation = split(model_frame(spark, sf_dir), "loan_id", "default")
    model = learning.train(training, kind, ignore=("loan_id",))
    rows = materialize(learning.scored(model, validation), "scored")
    metrics = {r["name"]: r["value"] for r in evaluate(rows).collect()}
    counts = rows.agg(
        F.count("*").alias("n"), F.sum("y").alias("ones"), F.count_if((F.col("p") >= 0) & (F.col("p") <= 1)).alias("p"),
        F.count_if(F.col("y") == F.col("y_pred")).alias("right"),
    ).first()
    values = [
        ("validation_rows", float(counts["n"])), ("validation_positives", float(counts["ones"])), ("probabilities", float(counts["p"])),
        ("auc_agrees", float(abs(metrics["auc"] - _area(rows)) < 1e-9)),
        ("confusion_adds_up", float(abs(metrics["accuracy"] - counts["right"] / counts["n"]) < 1e-12)),
    ]
    if hasattr(model.stages[-1], "getNumTrees"):
        values.append(("trees", float(model.stages[-1].getNumTrees)))
    return spark.createDataFrame(values, "name string, value double")


@query("train_logistic_regression", with_(HASHED) + TRAINED)
def train_logistic_regression(spark, sf_dir):
    return _checked(spark, sf_dir, "logistic_regression")


@query("train_boosted_trees", with_(HASHED) + TRAINED + " UNION ALL SELECT 'trees', 100.0")
def train_boosted_trees(spark, sf_dir):
    return _checked(spark, sf_dir, "boosted_trees")


@query("train_random_forest", with_(HASHED) + TRAINED + " UNION ALL SELECT 'trees', 100.0")
def train_random_forest(spark, sf_dir):
    return _checked(spark, sf_dir, "random_forest")


@query(
    "cv_auc",
    with_(HASHED) + "SELECT CAST(h % 5 AS INT) AS fold, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, true AS auc_agrees FROM hashed GROUP BY 1",
)
def cv_auc(spark, sf_dir):
    """Rows and positives of every fold, and whether its area is that of Spark's own evaluator on the same scores."""
    table = learning.vectors(model_frame(spark, sf_dir), "default", "loan_id", 5)
    scores = materialize(learning.cv_rows(table, "logistic_regression", "default", 5, {}), "cv")
    areas = {r["fold"]: r["auc"] for r in roc_auc(scores, keys=["fold"]).collect()}
    agrees = [(f, bool(abs(a - _area(scores.filter(F.col("fold") == f))) < 1e-9)) for f, a in areas.items()]
    counts = scores.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("positives"))
    return counts.join(spark.createDataFrame(agrees, "fold int, auc_agrees boolean"), "fold")


SEARCHED = 10


@query(
    "random_search",
    f"""SELECT CAST(unnest(range({SEARCHED})) AS INT) AS trial, true AS in_range, true AS logged_once, true AS at_most_best""",
)
def random_search(spark, sf_dir):
    """Ten trials of five folds with a log, then the same search again, which finds every trial done; the default is fifty."""
    frame, log = model_frame(spark, sf_dir), new_path(spark, "trials")
    first, _, best = learning.random_search(frame, "logistic_regression", trials=SEARCHED, parallelism=5, log=log)
    again, _, same = learning.random_search(frame, "logistic_regression", trials=SEARCHED, log=log)
    written = spark.read.json(log).groupBy("trial").agg(F.count("*").alias("times"))
    params = F.from_json("params", "C double, penalty string, l1_ratio double")
    fits = params["C"].between(0.01, 100.01) & params["penalty"].isin("l1", "l2", "elasticnet") & params["l1_ratio"].between(0, 1)
    unit = F.col("cv_auc_mean").between(0, 1) & (F.col("cv_auc_std") >= 0)
    return again.join(written, "trial").select(
        "trial", (fits & unit).alias("in_range"), (F.col("times") == 1).alias("logged_once"),
        ((F.col("cv_auc_mean") <= best) & F.lit(best == same and first.count() == SEARCHED)).alias("at_most_best"),
    )


COEFFICIENTS = {"dti": 0.03, "annual_inc": -0.00002, "installment": 0.004, "open_acc": 0.1}
ATTRIBUTED = ", ".join(
    f"({c} - (SELECT avg({c}) FROM loans_once)) * CAST({w:.6f} AS DOUBLE) AS {c}" for c, w in COEFFICIENTS.items()
)


def _linear(spark, sf_dir):
    rows = fx.loans(spark, sf_dir, [KEY, *COEFFICIENTS], repeats=False)
    means = attribution.background_means(rows, list(COEFFICIENTS))
    return attribution.linear_attributions(rows, COEFFICIENTS, means, keep=(KEY,))


@query(
    "linear_attribution",
    with_(LOANS)
    + f"SELECT {KEY}, {', '.join(f'round({c}, 6) AS {c}' for c in COEFFICIENTS)} FROM (SELECT {KEY}, {ATTRIBUTED} FROM loans_once)",
)
def linear_attribution(spark, sf_dir):
    return rounded(_linear(spark, sf_dir))


@query(
    "attribution_ranking",
    with_(LOANS)
    + f", attributed AS (SELECT {ATTRIBUTED} FROM loans_once) "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg(abs({c})), 6) AS importance FROM attributed" for c in COEFFICIENTS),
)
def attribution_ranking(spark, sf_dir):
    return rounded(attribution.attribution_ranking(_linear(spark, sf_dir), list(COEFFICIENTS)))


@query(
    "background_sample",
    with_(LOANS)
    + ", sample AS (SELECT * FROM loans_once ORDER BY CAST('0x' || substr(sha256(loan_id), 1, 12) AS BIGINT), loan_id LIMIT 100) "
    + f"SELECT {KEY}, round((dti - (SELECT avg(dti) FROM sample)) * CAST(0.03 AS DOUBLE), 6) AS dti FROM loans_once",
)
def background_sample(spark, sf_dir):
    """Attributions against the mean of 100 background rows."""
    rows = fx.loans(spark, sf_dir, [KEY, "loan_id", "dti"], repeats=False)
    means = attribution.background_means(rows, ["dti"], rows=100, key="loan_id")
    return rounded(attribution.linear_attributions(rows, {"dti": 0.03}, means, keep=(KEY,)))


@query("tree_attribution")
def tree_attribution(spark, sf_dir):
    """Mean absolute attribution per feature of a boosted model, over all rows."""
    frame = model_frame(spark, sf_dir)
    model = learning.train(frame, "boosted_trees", ignore=("loan_id",), n_estimators=5, max_depth=4)
    names = model.stages[-2].getInputCols()
    explained, _ = attribution.tree_attributions(model.stages[-1], model.transform(frame))
    return rounded(attribution.attribution_ranking(attribution.spread_attributions(explained, names), names))


@query(
    "tree_attribution_full",
    "WITH n AS (SELECT count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey) SELECT n AS rows, n AS additive, 100 AS trees FROM n",
)
def tree_attribution_full(spark, sf_dir):
    """Attributions of a boosted model of default size: for how many rows they add up to the model's margin."""
    frame = model_frame(spark, sf_dir)
    model = learning.train(frame, "boosted_trees", ignore=("loan_id",))
    explained, base = attribution.tree_attributions(model.stages[-1], model.transform(frame))
    total = F.aggregate("attributions", F.lit(base), lambda a, x: a + x)
    margin = F.get(vector_to_array("rawPrediction"), 1)
    return explained.agg(
        F.count("*").alias("rows"), F.count_if(F.abs(total - margin) < 1e-6).alias("additive"),
        F.lit(model.stages[-1].getNumTrees).alias("trees"),
    )


@query(
    "dataset_versions",
    f"""WITH frame AS (SELECT o_orderkey, {Y} AS y, o_orderstatus FROM orders), digests AS (
  SELECT sha256('{{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","y":' || y || '}}') AS d FROM frame
), sums AS (
  SELECT count(*) AS rows, sum(CAST('0x' || substr(d, 1, 15) AS BIGINT)) AS a, sum(CAST('0x' || substr(d, 16, 15) AS BIGINT)) AS b FROM digests
), hashed AS (SELECT rows, sha256(rows || '|' || a || '|' || b) AS digest FROM sums)
SELECT 'reference_orders' AS name, substr(digest, 1, 8) AS version, digest, rows, 3 AS columns,
  (SELECT CAST(sum(y) AS BIGINT) FROM frame) AS loaded_positives FROM hashed""",
)
def dataset_versions(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    frame = orders.select(KEY, fx.target_flag(F.col(KEY)).alias("y"), "o_orderstatus")
    root = new_path(spark, "versions")
    version = save_version(frame, root, "reference_orders", "first")
    loaded = load_version(spark, root, "reference_orders", version)
    positives = loaded.agg(F.sum("y").alias("loaded_positives")).scalar()
    return manifest(spark, root).select(
        "name", "version", "digest", "rows", "columns", positives.alias("loaded_positives")
    )


@query(
    "registered_reference",
    f"""SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(y) AS BIGINT) AS positives, true AS found_again, 'reference_orders' AS name, 'reference dataset' AS description
FROM (SELECT o_orderkey, {Y} AS y FROM orders)""",
)
def registered_reference(spark, sf_dir):
    """A reference set registered under its own name, loaded by name and version, and registered again without a second copy."""
    orders = fx.table(spark, sf_dir, "orders")
    frame = orders.select(KEY, fx.target_flag(F.col(KEY)).alias("y"))
    root = new_path(spark, "references")
    version = register_reference(frame, root, "orders")
    again = register_reference(frame.repartition(3), root, "orders")
    loaded = load_version(spark, root, "reference_orders", version)
    entry = manifest(spark, root).select("name", "description")
    return loaded.agg(F.count("*").alias("rows"), F.sum("y").alias("positives")).select(
        "*", F.lit(version == again).alias("found_again"), *[entry.select(c).scalar().alias(c) for c in entry.columns]
    )
