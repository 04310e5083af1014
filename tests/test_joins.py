import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators.joins import feature_lookup
from riskframe.operators import scoring

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=int(seconds))


def frames(spark, seed=0, n=400):
    rng = np.random.default_rng(seed)
    # a third and more of all rows belong to one key
    key = lambda: "hot" if rng.random() < 0.5 else f"k{rng.integers(0, 6)}"
    requests = [(i, key() if rng.random() > 0.05 else None, at(rng.integers(0, 5000)), float(i)) for i in range(n)]
    snapshots = [(key(), at(rng.integers(0, 5000)), 1000 + i, 1e6 + i) for i in range(n)]
    return (
        requests,
        snapshots,
        spark.createDataFrame(requests, "event_id long, loan_id string, req_ts timestamp, value double"),
        spark.createDataFrame(snapshots, "loan_id string, feature_ts timestamp, version long, value double"),
    )


def brute(requests, snapshots, ttl):
    out = {}
    for i, key, ts, value in requests:
        hits = [s for s in snapshots if key is not None and s[0] == key and s[1] <= ts and (ts - s[1]).total_seconds() < ttl]
        best = max(hits, key=lambda s: (s[1], s[2]), default=None)
        out[i] = (best[3], "redis_cache", best[1]) if best else (value, "request_payload", None)
    return out


@pytest.mark.parametrize("rows_per_bucket", [5, 40, 10**9])
@pytest.mark.parametrize("ttl", [60, 900, 100000])
def test_lookup_against_brute_force(spark, rows_per_bucket, ttl):
    requests, snapshots, r, s = frames(spark, seed=ttl)
    got = feature_lookup(r, s, version="version", ttl=ttl, rows_per_bucket=rows_per_bucket).collect()
    assert len(got) == len(requests)
    assert {g["event_id"]: (g["value"], g["features_source"], g["feature_ts"]) for g in got} == brute(requests, snapshots, ttl)


def brute_renewed(requests, snapshots, ttl):
    """A store that every snapshot and every served request writes to, played through in the order of time."""
    events = [(s[1], 0, str(s[2]).zfill(20), s[0], None, s[3]) for s in snapshots]
    events += [(r[2], 1, str(r[0]), r[1], r[0], r[3]) for r in requests]
    store, out = {}, {}
    for ts, _, _, key, request, value in sorted(events, key=lambda e: e[:3]):
        if request is not None:
            known = store.get(key) if key is not None else None
            hit = known is not None and (ts - known[0]).total_seconds() < ttl
            value = known[1] if hit else value
            out[request] = (value, "redis_cache", known[0]) if hit else (value, "request_payload", None)
        if key is not None:
            store[key] = (ts, value)
    return out


@pytest.mark.parametrize("rows_per_bucket", [5, 10**9])
@pytest.mark.parametrize("ttl", [8, 60, 900])
def test_renewed_lookup_against_brute_force(spark, rows_per_bucket, ttl):
    requests, snapshots, r, s = frames(spark, seed=ttl)
    few = snapshots[::20]
    s = spark.createDataFrame(few, s.schema)
    got = feature_lookup(r, s, version="version", ttl=ttl, rows_per_bucket=rows_per_bucket, renew=True).collect()
    assert len(got) == len(requests)
    wanted = brute_renewed(requests, few, ttl)
    assert {g["event_id"]: (g["value"], g["features_source"], g["feature_ts"]) for g in got} == wanted


def test_lookup_without_snapshots(spark):
    requests, _, r, s = frames(spark)
    got = feature_lookup(r, s.limit(0), version="version").collect()
    assert {g["features_source"] for g in got} == {"request_payload"} and len(got) == len(requests)


def test_routing(spark):
    df = spark.range(10000).select(F.col("id").cast("string").alias("loan_id"))
    share = lambda pct, loaded=True: scoring.route(df, pct, challenger_loaded=loaded).filter("model_type = 'challenger'").count()
    assert share(0) == 0 and share(100) == 10000 and share(50, loaded=False) == 0
    assert abs(share(30) - 3000) < 200


def test_risk_levels_are_strict(spark):
    df = spark.createDataFrame([(0.7,), (0.71,), (0.3,), (0.31,)], "p double")
    assert [r[0] for r in df.select(scoring.risk_level(F.col("p"))).collect()] == ["medium", "high", "low", "medium"]


def test_no_champion(spark):
    with pytest.raises(ValueError):
        scoring.score(spark.range(1), None)


def test_batches(spark):
    df = spark.createDataFrame([("b1", [("x", 1.0), ("y", 2.0)]), ("b2", [("z", -9.0)])], "batch string, inputs array<struct<loan_id: string, a: double>>")
    rows = scoring.explode_batches(df)
    model = scoring.ServedModel("m", "1", scoring.linear_scorer({"a": 1.0}))
    out = {r["batch"]: r for r in scoring.batch_responses(scoring.score(rows, model), "batch").collect()}
    assert out["b1"]["total_inputs"] == 2 and [p["position"] for p in out["b1"]["predictions"]] == [0, 1]
    assert out["b2"]["predictions"][0]["prediction"] == 0 and out["b2"]["predictions"][0]["risk_level"] == "low"
    with pytest.raises(Exception, match="more than 1 inputs"):
        scoring.batch_responses(scoring.score(rows, model), "batch", max_inputs=1).collect()


def test_requests_without_a_key_are_drawn_one_by_one(spark):
    df = spark.range(2000).selectExpr("cast(null as string) loan_id", "id message_id", "id * 1.5 amount")
    for options in ({}, {"request_id": "message_id"}):
        challengers = scoring.route(df, 10, **options).filter("model_type = 'challenger'").count()
        assert 120 < challengers < 280
        assert scoring.route(df, 0, **options).filter("model_type = 'challenger'").count() == 0
