import os

import pytest

import __spark_entry__ as entry
from riskframe import catalog, session
from riskframe.schemas import NA_TOKENS
from riskframe.sources.loans import scan_loans
from tests.compare import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
LIBRARY = catalog.queries(), catalog.oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


# models of full size take a minute and more each: RUN_SLOW=1 runs them too
SLOW = {"random_search", "tree_attribution_full", "train_boosted_trees", "train_random_forest"}
RUN_SLOW = os.environ.get("RUN_SLOW") == "1"


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if RUN_SLOW or n not in SLOW))
def test_query_equals_sql(spark, duck, sf_dir, name):
    ok, message, _ = compare(spark, duck, name, QUERIES[name], ORACLES[name], sf_dir)
    assert ok, message


@pytest.mark.parametrize("name", ["roc_auc", "ks_drift", "chi2_drift", "feature_lookup", "top_values", "describe_by_target",
                                  "metrics_by_group", "data_quality", "histogram", "promotion_checklist", "alerts"])
def test_plans_form_no_pairs(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name == "top_values":
        assert "WindowGroupLimit" in plan  # ranks are cut before the shuffle


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    plan = QUERIES["risk_level"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan
    plan = QUERIES["ks_drift"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_shipdate" in plan and "l_comment" not in plan


def test_stream_drift_equals_batch(spark, sf_dir):
    rows = {r["name"]: r["value"] for r in QUERIES["stream_drift"](spark, sf_dir).collect()}
    summary = QUERIES["dataset_drift"](spark, sf_dir).first()
    assert rows["drifted_columns"] == summary["drifted_columns"]
    per_column = {f"{r['column']}_p_value": r["p_value"] for r in QUERIES["column_drift"](spark, sf_dir).collect()}
    assert {k: v for k, v in rows.items() if k.endswith("_p_value")} == per_column


def test_alerts_hold_breaches_of_both_rules(spark, sf_dir):
    rows = QUERIES["alerts"](spark, sf_dir).collect()
    assert {r["metric"] for r in rows} == {"error_ratio", "p95_latency"}
    assert {r["state"] for r in rows if r["metric"] == "p95_latency"} == {"pending", "firing"}


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["income_bracket", "loans", "default_rate"] and df.count() > 0


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert set(LIBRARY[0]) - set(LIBRARY[1]) == {"tree_attribution"}


def test_scan(spark, tmp_path):
    (tmp_path / "loans.csv").write_text("a,b,c\n1.5,n/a,x\nNaN,2 years,\n")
    plain = scan_loans(spark, str(tmp_path / "loans.csv"), schema="a double, b string, c string").collect()
    assert plain[1]["a"] is None and plain[0]["b"] == "n/a"
    tokens = scan_loans(spark, str(tmp_path / "loans.csv"), na_tokens=NA_TOKENS).collect()
    assert tokens[0]["b"] is None and tokens[1]["c"] is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_loans(spark, str(tmp_path / "absent.csv"))


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


class _Cluster:
    def __init__(self, **conf):
        self.conf = _Conf(conf)
        self.sparkContext = type("C", (), {"master": "yarn", "applicationId": "app"})


def test_shared_folder_is_required_on_a_cluster():
    with pytest.raises(ValueError):
        session.work_dir(_Cluster())
    named = _Cluster()
    named.conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert session.work_dir(named) == "hdfs:///shared/riskframe-app"
