import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import classify as K
from tidewatch.operators import forest as X
from tidewatch.sources import files as S
from tidewatch.sources import registry as M
from tidewatch.streaming import stateful as Z
from tidewatch.streaming import telemetry as Y

T0 = dt.datetime(2024, 1, 1)


def test_metric_csv_skips_other_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("timestamp,metric_name,value\n2024-01-01 00:00:00,m,1.5\n")
    (tmp_path / "b.csv").write_text("value,extra,metric_name,timestamp\n2.5,x,m,2024-01-01T01:00:00\n")
    (tmp_path / "c.csv").write_text("timestamp,value\n2024-01-01,9\n")
    (tmp_path / "d.txt").write_text("timestamp,metric_name,value\n2024-01-01,m,9\n")
    out = S.read_metric_csv(spark, str(tmp_path)).orderBy("value").collect()
    assert [(r["timestamp"], r["value"]) for r in out] == [(T0, 1.5), (T0 + dt.timedelta(hours=1), 2.5)]
    with pytest.raises(ValueError):
        S.read_metric_csv(spark, str(tmp_path), ["nothing"])


def test_feature_csv_keeps_numbers_in_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,x,y\nn,1,2.5\n")
    (tmp_path / "b.csv").write_text("z,x\n7,3\n")
    df, columns = S.read_feature_csv(spark, str(tmp_path))
    assert set(columns) == {"x", "y", "z"} and df.count() == 2 and dict(df.dtypes) == {c: "double" for c in columns}


def test_payload_shapes(spark):
    bodies = [
        (1, '[{"timestamp":"2024-01-01","name":"a","value":1}, {"timestamp":"2024-01-01","value":1}]'),
        (2, ' {"metrics":[{"timestamp":"2024-01-01","metric_name":"b","value":2}]}'),
        (3, '{"timestamp":["2024-01-01","2024-01-02"],"metric_name":["c","c"],"value":[3,4]}'),
        (4, "metric_name,timestamp,value\r\nd,2024-01-01,5\n"), (5, "no header at all"), (6, "{broken"), (7, "[]"),
    ]
    df = spark.createDataFrame(bodies, "id int, body string")
    out = sorted((r["id"], r["metric_name"], r["value"]) for r in S.parse_metric_payload(df, "body").collect())
    assert out == [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (3, "c", 4.0), (4, "d", 5.0)]
    assert sorted(r["id"] for r in S.invalid_payloads(df, "body", "id").collect()) == [5, 6, 7]


def test_load_result_documents(spark, tmp_path):
    doc = {"timestamp": 1704067200000, "metrics": {"http_req_duration": {"values": {"avg": 1.5, "p(95)": 4.0}}, "error_rate": {"values": {"rate": 0.02}}}}
    (tmp_path / "k6-dashboard_load-1.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "k6-unknown.json").write_text(json.dumps(doc))
    rows = S.read_loadtest_json(spark, str(tmp_path)).collect()
    assert len(rows) == 1 and rows[0]["scenario"] == "dashboard_load" and rows[0]["timestamp"] == T0
    assert rows[0]["metrics"]["http_req_duration"]["p95"] == 4.0 and rows[0]["metrics"]["error_rate"]["rate"] == 0.02
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "k6-root_cause_analysis.json").write_text('{"type":"Point","metric":"m","data":{"time":"2024-01-01T00:00:00Z","value":3}}\n{"type":"Metric","metric":"m"}\n')
    point = S.read_loadtest_points(spark, str(tmp_path / "p")).collect()
    assert [(r["scenario"], r["value"]) for r in point] == [("root_cause_analysis", 3.0)]


def test_archive_rolls_at_ten_thousand(spark, tmp_path):
    df = spark.range(25_000).select("id", F.timestamp_seconds(F.lit(1704067200)).alias("timestamp"))
    S.write_archive(df, str(tmp_path / "x"))
    files = list((tmp_path / "x").rglob("part-*.json"))
    assert len(files) >= 3 and all("year=2024/month=01/day=01/hour=00" in str(f) for f in files)
    assert all(sum(1 for _ in open(f)) <= 10_000 for f in files)


def test_predictions_and_retention(spark):
    df = spark.createDataFrame([(T0, 1.0)], "timestamp timestamp, score double")
    assert json.loads(S.format_predictions(df).first()[0]) == {"timestamp": "2024-01-01T00:00:00", "score": 1.0}
    assert S.format_predictions(df, "text/csv").first()[0] == "2024-01-01T00:00:00,1.0"
    now = F.lit(T0 + dt.timedelta(days=30))
    assert S.retention(df, "raw", now).count() == 1 and S.retention(df, "topic_traces", now).count() == 0
    days = spark.createDataFrame([(T0.date(),), (T0.date() + dt.timedelta(days=1),)], "day date")
    assert [r["day"].day for r in S.expired_days(days, "raw", F.lit(T0 + dt.timedelta(days=31, hours=1))).collect()] == [1]


def test_models_round_trip(spark, tmp_path):
    root = str(tmp_path / "models")
    df = spark.createDataFrame([(i, float(i % 7), float(i % 2), i % 2) for i in range(200)], "id long, a double, b double, label int")
    forest = X.fit(df, ["a", "b"], "id", trees=10, sample=32)
    M.save_model(spark, forest, root, "iso", "v1", {"note": "first"})
    M.save_model(spark, forest, root, "iso", "v10")
    M.save_model(spark, forest, root, "iso", "v9")
    loaded, metadata = M.load_model(spark, root, "iso", "v1")
    assert metadata == {"note": "first"}
    a = [r["decision"] for r in X.score(df, forest).orderBy("id").collect()]
    assert a == [r["decision"] for r in X.score(df, loaded).orderBy("id").collect()]
    latest = M.latest_versions(M.registry(spark, root)).first()
    assert (latest["version"], latest["versions"]) == ("v9", 3) and latest["path"].endswith("/iso/v9")
    rf = K.fit_random_forest(df, ["a", "b"], "label", trees=3)
    M.save_model(spark, rf, root, "rf", "v1")
    assert K.positive_probability(M.load_model(spark, root, "rf")[0], df).count() == 200
    with pytest.raises(ValueError):
        M.load_model(spark, root, "missing")


def test_malformed_lines_go_aside_and_a_repeated_batch_is_harmless(spark, tmp_path):
    rows = spark.createDataFrame([('{"timestamp":"2024-01-01T00:00:00Z","trace_id":"t","level":"INFO"}',), ("{oops",), ('{"timestamp":"2024-01-01T00:00:01Z","trace_id":"t","level":"WARN"}',)], "value string")
    batch = Y.parse_records(rows, Y.TOPICS["logs"][1])
    path, bad = str(tmp_path / "rows"), str(tmp_path / "bad")
    write = Y.upsert_batch(path, bad, "trace_id", "timestamp")
    write(batch, 0), write(batch, 0), write(batch.where("level = 'INFO'"), 1)
    assert [(r["trace_id"], r["level"]) for r in Y.current_rows(spark, path, "trace_id").collect()] == [("t", "WARN")]
    assert spark.read.json(bad).count() == 1
    assert Y.compact(spark, path, str(tmp_path / "compact"), "trace_id").count() == 1


def test_kafka_without_package_is_a_clear_error(spark):
    with pytest.raises(RuntimeError):
        Y.telemetry_stream(spark, "logs", servers="host:1")
    with pytest.raises(ValueError):
        Y.telemetry_stream(spark, "logs")


def feed(spark, tmp_path, rows, schema, name):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, schema).write.mode("append").json(path)
    return spark.readStream.schema(schema).json(path)


def test_group_stream_sends_when_time_passes(spark, tmp_path):
    schema = "receiver string, alertname string, group_wait string, timestamp timestamp"
    at = lambda s: T0 + dt.timedelta(seconds=s)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for rows in ([("r", "a", "30s", at(0)), ("r", "a", "30s", at(5))], [("r", "a", "30s", at(400))], [("x", "z", "30s", at(2000))], [("x", "z", "30s", at(4000))]):
        stream = feed(spark, tmp_path, rows, schema, "in")
        Y.run_to_end(Z.group_stream(stream, ["alertname"]).writeStream.format("parquet").options(path=out, checkpointLocation=checkpoint))
    rows = spark.read.parquet(out).where("group = 'r|a'").collect()
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    sent = sorted(((r["sent_ms"] - base) // 1000, r["new_alerts"]) for r in rows)
    assert sent == [(30, 2), (630, 1)]


def test_watermarked_windows(spark, tmp_path):
    schema = "timestamp timestamp, k string, value double"
    at = lambda m: T0 + dt.timedelta(minutes=m)
    out, checkpoint = str(tmp_path / "w"), str(tmp_path / "wcp")
    for rows in ([(at(1), "a", 1.0), (at(2), "a", 2.0)], [(at(60), "a", 5.0)], [(at(3), "a", 99.0), (at(61), "a", 1.0)]):
        stream = feed(spark, tmp_path, rows, schema, "win")
        Y.run_to_end(Y.windowed_counts(stream, ["k"], "5 minutes").writeStream.outputMode("append").format("parquet").options(path=out, checkpointLocation=checkpoint))
    first = spark.read.parquet(out).where(F.col("window.start") == F.lit(T0)).collect()
    assert [(r["n"], r["total"]) for r in first] == [(2, 3.0)]


def test_the_book_of_a_rolling_archive(spark, tmp_path):
    """A late record reaches its closed hour, a repeated batch changes nothing, hours close as the mark passes their end."""
    hour = lambda h, m=0: dt.datetime(2024, 5, 1, h, m)
    path, hours = str(tmp_path / "rows"), str(tmp_path / "hours")
    batches = [
        [(1, hour(1, 5)), (2, hour(1, 50)), (3, hour(2, 10)), (4, None)],
        [],
        [(5, hour(1, 59)), (6, hour(3, 0)), (7, hour(3, 10))],
    ]
    write = Y.rolling_archive(path, hours, "10 minutes")
    state = lambda: sorted((r["start"].hour, r["records"], r["late"], r["complete"]) for r in Y.archive_hours(spark, hours).collect())
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "id long, timestamp timestamp")
        write(df, i)
        once = state()
        write(df, i)
        assert state() == once
        if i < 2:
            assert once == [(1, 2, 0, True), (2, 1, 0, False)]
    assert once == [(1, 3, 1, True), (2, 1, 0, True), (3, 2, 0, False)]
    assert sorted(r["id"] for r in spark.read.json(path).collect()) == [1, 2, 3, 4, 5, 6, 7]
