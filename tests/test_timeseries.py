import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import rules as R
from tidewatch.operators import timeseries as ts

T0 = dt.datetime(2024, 1, 1)
minute = lambda m: T0 + dt.timedelta(minutes=m)


def samples(spark, values, start=1, key="a"):
    return spark.createDataFrame([(key, minute(start + i), float(v)) for i, v in enumerate(values)], "k string, timestamp timestamp, value double")


def at(df, m):
    return [r["value"] for r in df.where(F.col("eval_ts") == F.lit(minute(m))).collect()]


def test_increase_with_one_reset(spark):
    df = samples(spark, [0, 5, 9, 2, 4])
    assert at(ts.increase(df, ["k"], "5m", "1m"), 5) == [13.0]
    assert at(ts.rate(df, ["k"], "5m", "1m"), 5) == [pytest.approx(13 / 300)]
    # The window is open on the left: at minute 6 the first sample is gone.
    assert at(ts.increase(df, ["k"], "5m", "1m"), 6) == [8.0]
    # One sample is no increase.
    assert at(ts.increase(df, ["k"], "5m", "1m"), 9) == []


def test_increase_does_not_depend_on_the_step(spark):
    df = samples(spark, [3, 4, 1, 8, 2, 2, 7, 9, 0, 5])
    fine = {r["eval_ts"]: r["value"] for r in ts.increase(df, ["k"], "6m", "1m").collect()}
    coarse = {r["eval_ts"]: r["value"] for r in ts.increase(df, ["k"], "6m", "3m").collect()}
    assert coarse and all(fine[t] == v for t, v in coarse.items())


def test_window_must_be_a_multiple_of_the_step(spark):
    with pytest.raises(ValueError):
        ts.increase(samples(spark, [1, 2]), ["k"], "5m", "2m")


def test_changes_and_instant(spark):
    df = samples(spark, [1, 1, 2, 2, 1])
    assert at(ts.changes(df, ["k"], "5m", "1m"), 5) == [2.0]
    inst = ts.instant(df, ["k"], "1m", "5m")
    assert at(inst, 9) == [1.0] and at(inst, 10) == []


def test_histogram_quantile(spark):
    rows = [(T0, 1.0, 10.0), (T0, 2.0, 30.0), (T0, 5.0, 40.0), (T0, float("inf"), 40.0)]
    b = spark.createDataFrame(rows, "eval_ts timestamp, le double, value double")
    assert at(ts.histogram_quantile(b, 0.5, []), 0) == [1.5]
    assert at(ts.histogram_quantile(b, 0.95, []), 0) == [pytest.approx(4.4)]
    open_end = spark.createDataFrame([(T0, 1.0, 10.0), (T0, float("inf"), 40.0)], "eval_ts timestamp, le double, value double")
    assert at(ts.histogram_quantile(open_end, 0.9, []), 0) == [1.0]
    empty = spark.createDataFrame([(T0, 1.0, 0.0), (T0, float("inf"), 0.0)], "eval_ts timestamp, le double, value double")
    assert at(ts.histogram_quantile(empty, 0.9, []), 0) == []


def test_predict_linear_is_exact_on_a_line(spark):
    v = spark.createDataFrame([("a", minute(i), 2.0 * i + 1) for i in range(10)], "k string, eval_ts timestamp, value double")
    assert at(ts.predict_linear(v, ["k"], "1h", "10m"), 9) == [pytest.approx(2.0 * 19 + 1)]


def test_alert_state_pending_then_firing(spark):
    rows = [("a", minute(i), 1.0) for i in range(5)] + [("a", minute(i), 1.0) for i in range(10, 17)]
    c = spark.createDataFrame(rows, "k string, eval_ts timestamp, value double")
    out = {r["eval_ts"]: (r["state"], r["active_since"]) for r in R.alert_state(c, ["k"], "5m", "1m").collect()}
    assert all(out[minute(i)][0] == "pending" for i in range(5))
    assert out[minute(14)] == ("pending", minute(10)) and out[minute(15)] == ("firing", minute(10))


def test_vector_ops(spark):
    a = spark.createDataFrame([("x", T0, 6.0), ("y", T0, 1.0)], "k string, eval_ts timestamp, value double")
    b = spark.createDataFrame([("x", T0, 3.0), ("z", T0, 1.0)], "k string, eval_ts timestamp, value double")
    assert [tuple(r) for r in ts.vector_binop(a, b, "/", ["k"]).select("k", "value").collect()] == [("x", 2.0)]
    assert [tuple(r) for r in ts.vector_binop(a, b, ">", ["k"]).select("k", "value").collect()] == [("x", 6.0)]
    zero = b.withColumn("value", F.lit(0.0))
    assert ts.vector_binop(a, zero, "/", ["k"]).first()["value"] is None


def test_downsample_keeps_counter_rises(spark):
    df = samples(spark, [0, 5, 9, 2, 4, 6, 1], start=1)
    blocks = ts.downsample(df, ["k"], "2m")
    hour = ts.coarsen(blocks, ["k"], "1h").first()
    assert (hour["rise"], hour["count"], hour["last"], hour["max"]) == (16.0, 7, 1.0, 9.0)


def test_every_rule_can_be_planned(spark):
    rows = [(minute(i), "up", {"job": "kubernetes-pods", "service": "s", "instance": "i"}, float(i < 3)) for i in range(12)]
    signals = R.Signals(spark.createDataFrame(rows, "timestamp timestamp, name string, labels map<string,string>, value double"), "1m")
    rules = R.rule_set()
    assert len(rules) == 35
    for rule in rules:
        assert "state" in rule.evaluate(signals).columns
    down = [r for r in rules if r.name == "ServiceDown"][0].evaluate(signals).where("state = 'firing'")
    assert down.count() > 0


def test_series_of_one_label_set_are_not_mixed(spark):
    rows = []
    for pod, base in (("p1", 0.0), ("p2", 1000.0)):
        rows += [(minute(i), "http_requests_total", {"service": "s", "status": "200", "pod": pod}, base + 10 * i) for i in range(6)]
    signals = R.Signals(spark.createDataFrame(rows, "timestamp timestamp, name string, labels map<string,string>, value double"), "1m")
    total = ts.sum_by(signals.rate("http_requests_total", ("service",), "5m"), "service")
    assert at(total, 5) == [pytest.approx(2 * 40 / 300)]


def test_rules_read_their_own_metrics_alone(spark, monkeypatch):
    """Partials are written once, of the metrics that the given rules select."""
    rows = [(T0 + dt.timedelta(seconds=15 * i), n, {"service": "a", "job": "j"}, 5.0) for i in range(40) for n in ("http_request_duration_seconds", "compliance_check_status", "unread")]
    signals = R.Signals(spark.createDataFrame(rows, "timestamp timestamp, name string, labels map<string,string>, value double"), "15s")
    rules = [r for r in R.rule_set() if r.name == "RequestHighLatency"]
    written = []
    real = R.materialise
    monkeypatch.setattr(R, "materialise", lambda df, name: written.append(real(df, name)) or written[-1])
    assert R.metrics_of(rules, signals) == {"http_request_duration_seconds"} and not written
    assert R.evaluate_rules(rules, signals).where("state = 'firing'").count() > 0
    assert [{r["name"] for r in w.select("name").distinct().collect()} for w in written] == [{"http_request_duration_seconds"}]
    assert len(R.metrics_of(R.rule_set(), signals)) > 30


def test_many_samples_are_dealt_over_more_tasks_than_cores(spark, monkeypatch):
    rows = [(minute(i // 4), f"m{i % 2}", {"job": f"j{i % 3}"}, float(i * 7 % 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "timestamp timestamp, name string, labels map<string,string>, value double")
    signals = R.Signals(df, "1m")
    keyed = df.select("name", R.series_key(), "timestamp", "value")
    assert signals._tasks() is None
    want = sorted(map(str, signals.partials.collect()))
    monkeypatch.setattr(R, "SAMPLES", 10)
    assert R.Signals(df, "1m")._tasks() == 40
    assert ts.step_blocks(keyed, ["name", "_series"], "1m", tasks=40).rdd.getNumPartitions() == 40
    assert sorted(map(str, R.Signals(df, "1m").partials.collect())) == want
