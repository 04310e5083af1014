import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import drift, service
from riskframe.operators.joins import feature_lookup
from riskframe.streaming.jobs import alert_history, period_drift_stream, run_alerts, service_windows, service_windows_stream
from riskframe.streaming.messages import file_messages
from riskframe.streaming.state import FeatureTable
from riskframe.streaming.tables import newest_rows, read_batches

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


# feature table


def test_compaction_bounds_folders_and_serves_alike(spark, tmp_path):
    """Two dozen batches, merged every fifth: every lookup within the lateness finds what the whole table would give."""
    rng = random.Random(3)
    plain, table = FeatureTable(spark, str(tmp_path / "plain")), FeatureTable(spark, str(tmp_path / "kept"))
    rows = [(f"loan{rng.randrange(6)}", at(600 * b + rng.randrange(600)), float(b)) for b in range(24) for _ in range(4)]
    schema = "loan_id string, feature_ts timestamp, dti double"
    ttl, lateness = 3600, 1200
    for b in range(24):
        batch = spark.createDataFrame(rows[4 * b : 4 * b + 4], schema).coalesce(1)
        plain.write(batch, b)
        if b and b % 5 == 0:
            assert table.compact(b, ttl, lateness)
            assert not table.compact(b, ttl, lateness)  # nothing new
        table.write(batch, b)
        assert len(table.folders()) <= 6
    assert len(plain.folders()) == 24 and table.manifest()["upto"] == 19
    on_disk = [p.name for p in (tmp_path / "kept").iterdir()]
    assert sum(n.startswith("batch_id=") for n in on_disk) == 9 and sum(n.startswith("base=") for n in on_disk) == 2
    newest = max(r[1] for r in rows[: 4 * 20])
    asks = [(i, f"loan{i % 7}", newest - dt.timedelta(seconds=lateness - 30 * i), 99.0) for i in range(80)]
    requests = spark.createDataFrame(asks, "event_id long, loan_id string, req_ts timestamp, dti double")
    served = [
        sorted(feature_lookup(requests, t.read().drop("month"), version="batch_id", ttl=ttl).select("event_id", "dti", "features_source").collect())
        for t in (plain, table)
    ]
    assert served[0] == served[1] and {r["features_source"] for r in served[0]} == {"redis_cache", "request_payload"}
    assert table.read().count() < plain.read().count()
    # a batch that is run again sees the batches before it only, and replaces its own
    assert table.read(before=22).agg(F.max("batch_id")).first()[0] == 21
    table.write(spark.createDataFrame(rows[:1], schema), 23)
    assert table.read().filter("batch_id = 23").count() == 1


def test_feature_table_without_rows(spark, tmp_path):
    table = FeatureTable(spark, str(tmp_path / "none"))
    assert table.read() is None and table.folders() == [] and not table.compact(5, 10)
    table.write(spark.createDataFrame([], "loan_id string, feature_ts timestamp"), 0)
    assert table.read() is None and not table.compact(1, 10)


def test_two_writers_cannot_publish_one_version(spark, tmp_path):
    table = FeatureTable(spark, str(tmp_path / "t"))
    table._publish({"version": 1, "base": None, "upto": -1, "rows": 0})
    with pytest.raises(RuntimeError):
        table._publish({"version": 1, "base": None, "upto": -1, "rows": 0})


# panes


def test_panes_keep_one_row_a_minute_and_merge_to_windows(spark, tmp_path):
    rng = np.random.default_rng(8)
    seconds = np.sort(rng.integers(0, 1800, 30_000))
    rows = [(at(int(s)), 500 if i % 7 == 0 else 200, float(v) if i % 11 else None) for i, (s, v) in enumerate(zip(seconds, rng.gamma(2.0, 0.1, 30_000)))]
    log = spark.createDataFrame(rows, "ts timestamp, status int, latency_s double")
    panes = service.request_panes(log)
    assert panes.count() == 30 and "Expand" not in panes._jdf.queryExecution().executedPlan().toString()
    got = {r["window_start"]: r for r in service.windows_of_panes(panes).collect()}
    exact = {r["window_start"]: r for r in service.request_windows(log).collect()}
    assert {k: (r["requests"], r["errors"], r["error_ratio"]) for k, r in got.items()} == {
        k: (r["requests"], r["errors"], r["error_ratio"]) for k, r in exact.items()
    }
    base = int(START.replace(tzinfo=dt.timezone.utc).timestamp())
    for start, r in got.items():
        inside = np.sort([v for t, _, v in rows if v is not None and start <= base + (t - START).seconds < start + 300])
        rank = np.searchsorted(inside, r["p95"], side="right") / len(inside)
        assert abs(rank - 0.95) < 1.7 / service.SKETCH_K**0.9 + 1 / len(inside)
    # the stream's panes are those of the batch, in however many micro-batches
    log.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = file_messages(spark, str(tmp_path / "in"), "ts timestamp, status int, latency_s double", maxFilesPerTrigger="1")
    service_windows_stream(stream, str(tmp_path / "panes"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert newest_rows(read_batches(spark, str(tmp_path / "panes")), ["pane"]).count() == 30
    windows = {r["window_start"]: r["requests"] for r in service_windows(spark, str(tmp_path / "panes")).collect()}
    assert windows == {k: r["requests"] for k, r in exact.items()}


def test_panes_without_latencies(spark):
    log = spark.createDataFrame([(at(0), 200, None), (at(61), 500, None)], "ts timestamp, status int, latency_s double")
    assert {r["p95"] for r in service.windows_of_panes(service.request_panes(log)).collect()} == {None}


# drift by period


def drift_rows(hours, n, seed):
    rng = random.Random(seed)
    rows = []
    for h in range(hours):
        for i in range(n):
            rows.append((at(3600 * h + i * 3600 // n), rng.gauss(h / 10, 1) if i % 9 else None, rng.choice("abc" if h % 2 else "abcd"), rng.random() < 0.3, rng.choice(["x", None])))
    return rows


LOG = "ts timestamp, amount double, kind string, flag boolean, gap string"


def test_period_drift_equals_each_period_alone(spark):
    reference = spark.createDataFrame(drift_rows(3, 80, 1), LOG).drop("ts")
    logs = spark.createDataFrame(drift_rows(6, 40, 2), LOG)
    counted = drift.count_reference(reference)
    got = drift.drift_by_period(counted, drift.period_counts(logs, counted, "ts")).collect()
    assert len(got) == 24
    for h in range(6):
        alone = drift.column_drift(reference, logs.filter((F.col("ts") >= at(3600 * h)) & (F.col("ts") < at(3600 * h + 3600))).drop("ts"))
        want = {r["column"]: r for r in alone.collect()}
        for r in got:
            if r["at"] == at(3600 * h):
                w = want[r["column"]]
                assert (r["test"], r["drifted"]) == (w["test"], w["drifted"])
                assert r["statistic"] == pytest.approx(w["statistic"]) and r["p_value"] == pytest.approx(w["p_value"])


@pytest.mark.parametrize("files", [1, 5])
def test_streamed_periods_do_not_depend_on_micro_batches(spark, tmp_path, files):
    rows = drift_rows(5, 30, 4)
    reference = spark.createDataFrame(drift_rows(2, 50, 5), LOG).drop("ts")
    for i in range(files):  # in the order of time, as a log arrives
        part = rows[len(rows) * i // files : len(rows) * (i + 1) // files]
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = file_messages(spark, str(tmp_path / "in"), LOG, maxFilesPerTrigger="1")
    period_drift_stream(stream, reference, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    got = read_batches(spark, str(tmp_path / "out")).drop("batch_id").collect()
    counted = drift.count_reference(reference)
    want = drift.drift_by_period(counted, drift.period_counts(spark.createDataFrame(rows, LOG), counted, "ts"))
    assert sorted(map(str, got)) == sorted(map(str, want.filter(F.col("at") < at(3600 * 4)).collect())) and len(got) == 16


def test_chi2_of_huge_tables_does_not_cancel(spark):
    n = 10**15
    counts = spark.createDataFrame([("t", "a", n, n + 10**6), ("t", "b", n, n - 10**6)], '"column" string, value string, r long, c long'.replace('"', ""))
    row = drift._chi2(counts, 2 * n, 2 * n, 0.05).first()
    exact = 2 * (10**6 / 2) ** 2 / (n + 5 * 10**5) + 2 * (10**6 / 2) ** 2 / (n - 5 * 10**5)
    assert row["statistic"] == pytest.approx(exact, rel=1e-6)


# alerts


SERIES = [
    ("error_ratio", [(0, 0.2), (60, 0.2), (120, 0.01), (180, 0.3), (420, 0.1), (480, 0.1), (540, 0.1)]),
    ("drift_share", [(0, 0.1), (3600, 0.5), (7200, 0.6), (10800, 0.2), (14400, 0.9)]),
    ("unknown", [(0, 9.0)]),
]


def series_frame(spark):
    return spark.createDataFrame([(m, t, v) for m, ps in SERIES for t, v in ps], "metric string, at long, value double")


EPISODES = {
    ("error_ratio", 0): (60, 2, 0.2, 120, 60), ("error_ratio", 180): (180, 1, 0.3, 240, None), ("error_ratio", 420): (540, 3, 0.1, None, 480),
    ("drift_share", 3600): (7200, 2, 0.6, 10800, 3660), ("drift_share", 14400): (14400, 1, 0.9, None, 14460),
}


def episodes_of(df):
    return {(r["metric"], r["started"]): (r["last_at"], r["points"], r["peak"], r["ended"], r["fires_at"]) for r in df.collect()}


def test_alert_episodes(spark):
    assert episodes_of(service.alert_episodes(series_frame(spark))) == EPISODES


@pytest.mark.parametrize("cuts", [[10**6], [30, 60, 200, 500, 4000, 7200, 10**6], [0, 3599, 3600, 10**6]])
def test_alert_state_survives_between_runs(spark, tmp_path, cuts):
    series = series_frame(spark)
    for run, until in enumerate(cuts):
        got = run_alerts(spark, str(tmp_path), run, series.filter(F.col("at") <= until))
    assert episodes_of(got) == EPISODES
    again = run_alerts(spark, str(tmp_path), len(cuts) - 1, series)  # a repeated run replaces its own
    assert episodes_of(again) == EPISODES
    late = series.unionByName(spark.createDataFrame([("error_ratio", 90, 0.9)], series.schema))
    assert episodes_of(run_alerts(spark, str(tmp_path), len(cuts), late)) == EPISODES
    assert episodes_of(alert_history(spark, str(tmp_path))) == EPISODES
