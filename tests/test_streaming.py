import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from riskframe import session
from riskframe.catalog.serving import served
from riskframe.functions.ordered import with_bucket
from riskframe.operators import service
from riskframe.schemas import REQUEST_RULES
from riskframe.streaming.jobs import ScoringTables, feature_state, score_batch, score_stream
from riskframe.streaming.messages import BAD_JSON, drop_repeats, file_messages, parse_messages
from riskframe.streaming.tables import read_batches

START = dt.datetime(2024, 1, 1, 10)
TEXT = {
    "term": "36 months", "grade": "A", "sub_grade": "A1", "home_ownership": "RENT", "verification_status": "Verified",
    "purpose": "car", "initial_list_status": "f",
}


def request(loan_id, **fields):
    base = {r.field: TEXT.get(r.field, 1) for r in REQUEST_RULES}
    return {**base, "loan_id": loan_id, **fields}


def messages(spark, rows):
    """Rows of (message id, seconds after the start, text)."""
    return spark.createDataFrame(
        [(i, START + dt.timedelta(seconds=s), v) for i, s, v in rows], "message_id long, ts timestamp, value string"
    )


def test_parsing(spark):
    rows = [
        (1, 0, json.dumps(request("a", dti=5.0))),
        (2, 0, json.dumps({"input": request("b", dti=6.0)})),
        (3, 0, json.dumps(request("c"))[:50]),
        (4, 0, "not json"),
        (5, 0, json.dumps(request("d", grade="Z", dti=-1))),
        (6, 0, json.dumps({"loan_id": "e"})),
    ]
    got = {r["message_id"]: r for r in parse_messages(messages(spark, rows)).collect()}
    assert got[1]["errors"] == [] and got[1]["dti"] == 5.0
    assert got[2]["errors"] == [] and got[2]["loan_id"] == "b" and got[2]["dti"] == 6.0
    assert got[3]["errors"] == [BAD_JSON] and got[4]["errors"] == [BAD_JSON]
    assert [e.split(":")[0] for e in got[5]["errors"]] == ["grade", "dti"]
    assert "loan_amnt: Field required" in got[6]["errors"]


def test_values_are_read_as_they_come(spark):
    rows = [
        request("a", dti="10.5", open_acc=1.0, total_acc="7", int_rate="12", revol_util=None, emp_length=True),
        request("b", dti="much", open_acc=1.5, total_acc="7.5", int_rate=[1], purpose=3, annual_inc=None, pub_rec=2**40),
        request(5, dti="-1"),
    ]
    texts = [json.dumps(r) for r in rows] + [json.dumps({"input": rows[0]}), "[1, 2]", "7", json.dumps({"input": 5}), ""]
    got = {r["message_id"]: r for r in parse_messages(messages(spark, [(i, 0, t) for i, t in enumerate(texts)] + [(99, 0, None)])).collect()}
    for i in (0, 3):
        assert got[i]["errors"] == []
        fields = [got[i][c] for c in ("loan_id", "dti", "open_acc", "total_acc", "int_rate", "revol_util", "emp_length")]
        assert fields == ["a", 10.5, 1, 7, 12.0, None, 1.0]
    assert set(got[1]["errors"]) == {
        "dti: Input should be a valid number, unable to parse string as a number",
        "open_acc: Input should be a valid integer, got a number with a fractional part",
        "total_acc: Input should be a valid integer, unable to parse string as an integer",
        "int_rate: Input should be a valid number",
        "purpose: Input should be a valid string",
        "annual_inc: Input should be a valid number",
        "pub_rec: Input should be a valid integer",
    }
    assert got[2]["errors"] == ["loan_id: Input should be a valid string", "dti: Input should be greater than or equal to 0"]
    assert all(got[i]["errors"] == [BAD_JSON] for i in (4, 5, 7, 99))
    assert "loan_amnt: Field required" in got[6]["errors"]


def test_scoring_batches_use_and_refresh_features(spark, tmp_path):
    tables = ScoringTables.under(str(tmp_path))
    first = messages(spark, [(1, 0, json.dumps(request("x", dti=40.0))), (2, 1, json.dumps(request(None, dti=1.0))), (3, 2, "bad")])
    score_batch(first, 0, tables, served("champion"))
    second = messages(spark, [(4, 600, json.dumps(request("x", dti=2.0))), (5, 9000, json.dumps(request("x", dti=3.0)))])
    for _ in range(2):  # a repeated batch replaces its output
        score_batch(second, 1, tables, served("champion"))
    log = read_batches(spark, tables.predictions)
    assert log.groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 2), (1, 2)]
    got = {(r["batch_id"], r["features_source"], r["input_features"]["dti"]) for r in log.collect()}
    assert got == {
        (0, "request_payload", 40.0), (0, "request_payload", 1.0),
        (1, "redis_cache", 40.0),  # ten minutes old
        (1, "request_payload", 3.0),  # older than an hour
    }
    assert [r["value"] for r in read_batches(spark, tables.dead_letters).collect()] == ["bad"]
    state = feature_state(spark, tables.features).collect()
    assert [(r["loan_id"], r["dti"]) for r in state] == [("x", 3.0)]
    assert feature_state(spark, tables.features, now="2024-01-01 13:00:00", ttl=3600).count() == 1
    assert feature_state(spark, tables.features, now="2024-01-01 14:00:00", ttl=3600).count() == 0


def test_stream_equals_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(i, i, json.dumps(request(str(i), dti=float(i)))) for i in range(20)]
    messages(spark, rows).repartition(4).write.parquet(source)
    tables = ScoringTables.under(str(tmp_path / "out"))
    stream = file_messages(spark, source, "message_id long, ts timestamp, value string", maxFilesPerTrigger="1")
    score_stream(stream, tables, available_now=True, champion=served("champion")).awaitTermination()
    log = read_batches(spark, tables.predictions)
    assert log.select("batch_id").distinct().count() == 4 and log.count() == 20


def test_a_scoring_stream_leaves_no_scratch_files(spark, tmp_path, monkeypatch):
    source, work = str(tmp_path / "in"), tmp_path / "work"
    messages(spark, [(i, i, json.dumps(request(str(i % 7), dti=float(i)))) for i in range(40)]).repartition(2).write.parquet(source)
    monkeypatch.setattr(session, "work_dir", lambda spark: str(work))
    tables = ScoringTables.under(str(tmp_path / "out"))
    stream = file_messages(spark, source, "message_id long, ts timestamp, value string", maxFilesPerTrigger="1")
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    running = score_stream(stream, tables, available_now=True, champion=served("champion"))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == before
    running.awaitTermination()
    assert read_batches(spark, tables.predictions).count() == 40
    assert work.exists() and list(work.iterdir()) == []  # time lines of a batch go with it


def test_ids_of_a_stream_without_repeats_lie_on_disk(spark, tmp_path):
    source = str(tmp_path / "in")
    messages(spark, [(i % 30, i, json.dumps(request(str(i % 30)))) for i in range(60)]).write.parquet(source)
    tables = ScoringTables.under(str(tmp_path / "out"))
    stream = file_messages(spark, source, "message_id long, ts timestamp, value string")
    score_stream(stream, tables, available_now=True, repeats_within="10 minutes", champion=served("champion")).awaitTermination()
    assert read_batches(spark, tables.predictions).count() == 30
    state = [p.name for p in (tmp_path / "out" / "checkpoint" / "state").rglob("*")]
    assert any(n.endswith((".changelog", ".zip")) for n in state) and not any(n.endswith((".delta", ".snapshot")) for n in state)


def test_ranges_replace_the_rows_they_were_cut_from(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "work_dir", lambda spark: str(tmp_path))
    rows = with_bucket(spark.range(1000).withColumn("key", F.col("id") % 3), ["key"], ["id"], rows_per_bucket=100)
    assert rows.count() == 1000 and rows.select("bucket").distinct().count() == 10
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["ranges"]


def test_one_batch_or_many_serve_alike(spark, tmp_path):
    """Requests of few loans, some minutes apart, some more than an hour."""
    rows = [(i, 1500 * i, json.dumps(request("abc"[i % 3] if i % 7 else "a", dti=float(i)))) for i in range(24)]
    served_rows = []
    for cuts in ([0, 24], [0, 5, 11, 24]):
        tables = ScoringTables.under(str(tmp_path / str(len(cuts))))
        for batch, (a, b) in enumerate(zip(cuts, cuts[1:])):
            score_batch(messages(spark, rows[a:b]), batch, tables, served("champion"))
        log = read_batches(spark, tables.predictions)
        served_rows.append(sorted(log.select("loan_id", "features_source", "input_features.dti").collect()))
    assert served_rows[0] == served_rows[1]
    assert {r["features_source"] for r in served_rows[0]} == {"redis_cache", "request_payload"}


def test_repeats_within_the_watermark(spark, tmp_path):
    source = str(tmp_path / "in")
    messages(spark, [(1, 0, "a"), (1, 5, "a"), (2, 1, "b")]).write.parquet(source)
    stream = drop_repeats(file_messages(spark, source, "message_id long, ts timestamp, value string"), "message_id")
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
    query.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def log_frame(spark, rows):
    return spark.createDataFrame(
        [(START + dt.timedelta(seconds=s), code, latency) for s, code, latency in rows], "ts timestamp, status int, latency_s double"
    )


def test_windows_match_the_built_in_window(spark):
    log = log_frame(spark, [(i * 37 % 2000, 500 if i % 4 == 0 else 200, i / 100) for i in range(300)])
    ours = service.request_windows(log).select("window_start", "requests", "errors")
    built_in = log.groupBy(F.window("ts", "5 minutes", "1 minute").alias("w")).agg(
        F.count("*").alias("requests"), F.count_if(F.col("status") >= 500).alias("errors")
    )
    built_in = built_in.select(F.unix_timestamp("w.start").alias("window_start"), "requests", "errors")
    assert ours.exceptAll(built_in).count() == 0 and built_in.exceptAll(ours).count() == 0
    with pytest.raises(ValueError):
        service.request_windows(log, 100, 60)


def test_bucket_quantile(spark):
    log = log_frame(spark, [(0, 200, 0.06)] * 90 + [(0, 200, 0.3)] * 10)
    got = [r["latency"] for r in service.bucket_quantile(log).collect()]
    assert got == [pytest.approx(0.25 + 0.25 * 5 / 10)] * 5
    assert {r["latency"] for r in service.bucket_quantile(log_frame(spark, [(0, 200, 99.0)])).collect()} == {10.0}


def test_alerts_need_to_hold(spark):
    points = [(0, 0.1), (60, 0.1), (120, 0.01), (180, 0.1), (300, 0.1), (360, 0.1), (420, 0.1)]
    series = spark.createDataFrame([("error_ratio", t, v) for t, v in points], "metric string, at long, value double")
    got = {r["at"]: r["state"] for r in service.alerts(series).collect()}
    assert got == {0: "pending", 60: "firing", 180: "pending", 300: "pending", 360: "firing", 420: "firing"}
    long_hold = {r["at"]: r["state"] for r in service.alerts(series, hold=120).collect()}
    assert [t for t, s in long_hold.items() if s == "firing"] == [420]
