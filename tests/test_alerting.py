import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import alerting as L
from tidewatch.operators import remediation as R
from tidewatch.operators.cycles import cycle_outcomes

T0 = dt.datetime(2024, 1, 1)


def events(spark, seconds, key="k"):
    return spark.createDataFrame([(i, key, T0 + dt.timedelta(seconds=s)) for i, s in enumerate(seconds)], "id int, dedupe_key string, timestamp timestamp")


def test_suppression_boundary(spark):
    out = L.suppress_duplicates(events(spark, [0, 299, 300]), "id").collect()
    assert sorted(r["id"] for r in out) == [0, 2]


def brute(times, threshold, timeout):
    until, count, out = None, 0, []
    for t in times:
        if until is not None and t < until:
            out.append(2)
            continue
        if until is not None:
            until, count = None, 0
        count += 1
        if count >= threshold:
            until, count = t + timeout, 0
            out.append(1)
        else:
            out.append(0)
    return out


@pytest.mark.parametrize("threshold,timeout,chunk", [(1, 300, "10m"), (1, 90, "1m"), (3, 200, "5m"), (4, 30, "2m"), (2, 700, "3m")])
def test_cycles_equal_a_plain_walk(spark, threshold, timeout, chunk):
    rng = random.Random(threshold * 1000 + timeout)
    rows, want = [], {}
    for key, n in (("hot", 700), ("warm", 60), ("cold", 3), ("single", 1)):
        times = sorted(rng.sample(range(30000), n)) if key != "hot" else sorted(rng.choices(range(9000), k=n))
        ids = list(range(len(rows), len(rows) + n))
        rows += [(i, key, T0 + dt.timedelta(seconds=t)) for i, t in zip(ids, times)]
        want.update(zip(ids, brute(times, threshold, timeout)))
    df = spark.createDataFrame(rows, "id int, k string, timestamp timestamp").repartition(5)
    got = {r["id"]: r["outcome"] for r in cycle_outcomes(df, "k", "id", "timestamp", threshold, f"{timeout}s", chunk).collect()}
    assert got == want


def test_rate_limit_drops_the_eleventh(spark):
    out = L.rate_limit(events(spark, list(range(0, 55, 5)) + [60]), ["id"], 10).collect()
    assert sorted(r["id"] for r in out) == [*range(10), 11]


def test_alert_defaults_and_percent(spark):
    df = spark.createDataFrame([(T0, "cart", 0.759), (T0, None, None)], "timestamp timestamp, service string, confidence double")
    rows = L.to_alerts(df, "predictive").orderBy("source").collect()
    assert rows[0]["title"] == "Predicted Issue: cart - unknown" and "Confidence: 75%" in rows[0]["message"]
    assert rows[1]["source"] == "unknown" and "Confidence: 0%" in rows[1]["message"] and rows[0]["dedupe_key"].endswith(":202401010000")
    assert len(L.TEMPLATES) == 9


def test_route_continue_and_default(spark):
    df = spark.createDataFrame([("critical", "sre"), ("warning", "sre"), ("info", "sre"), ("info", "x")], "severity string, team string")
    out = {(r["severity"], r["team"], r["receiver"]) for r in L.route(df).collect()}
    assert out == {
        ("critical", "sre", "pagerduty-critical"), ("critical", "sre", "slack-critical"), ("warning", "sre", "slack-warnings"),
        ("info", "sre", "team-sre"), ("info", "x", "slack-notifications"),
    }


def test_inhibition_needs_equal_labels_and_firing(spark):
    rows = [
        ("A", "c", "s", "n", "critical", "firing", T0), ("A", "c", "s", "n", "warning", "firing", T0),
        ("A", "c", "t", "n", "warning", "firing", T0), ("A", "c", "u", "n", "critical", "pending", T0), ("A", "c", "u", "n", "warning", "firing", T0),
    ]
    df = spark.createDataFrame(rows, "alertname string, cluster string, service string, namespace string, severity string, state string, eval_ts timestamp")
    out = sorted((r["service"], r["severity"]) for r in L.inhibit(df).collect())
    assert out == [("s", "critical"), ("t", "warning"), ("u", "critical"), ("u", "warning")]


def test_group_notifications(spark):
    rows = [("r", "a", "c", "s", "30s", T0 + dt.timedelta(seconds=s)) for s in (0, 10, 100, 1000)]
    df = spark.createDataFrame(rows, "receiver string, alertname string, cluster string, service string, group_wait string, timestamp timestamp")
    until = F.lit(T0 + dt.timedelta(seconds=30 + 300 * 60))
    out = L.group_notifications(df, until=until).orderBy("sent_at").collect()
    got = [((r["sent_at"] - T0).seconds, r["new_alerts"], r["repeated"]) for r in out]
    assert got == [(30, 2, False), (330, 1, False), (1230, 1, False), (1230 + 14400, 0, True)]


def test_mildest_action_and_approval(spark):
    df = spark.createDataFrame([("api_abuse",), ("timeout",), ("none",)], "issue string")
    planned = R.plan_remediation(df)
    rows = {r["issue"]: r for r in planned.collect()}
    assert rows["api_abuse"]["action"] == "add_rate_limiting" and rows["api_abuse"]["candidates"] == ["add_rate_limiting", "block_ip"]
    assert rows["none"]["action"] is None and rows["none"]["message"] == R.NO_ACTION
    nobody = spark.createDataFrame([("medium", True)], "severity string, approved boolean")
    verdicts = lambda a, dry=False: {r["issue"]: (r["allowed"], r["message"]) for r in R.needs_approval(planned, a, dry).collect()}
    assert verdicts(nobody)["timeout"] == (False, R.NO_APPROVER) and verdicts(nobody)["api_abuse"][0]
    refuses = spark.createDataFrame([("high", False)], "severity string, approved boolean")
    assert verdicts(refuses)["timeout"] == (False, R.NOT_APPROVED) and verdicts(nobody, True)["timeout"][0]


def test_target_replicas(spark):
    df = spark.createDataFrame([(1,), (4,), (8,), (12,)], "n int").select(R.target_replicas(F.col("n")).alias("a"), R.target_replicas(F.col("n"), None).alias("b"))
    assert [tuple(r) for r in df.collect()] == [(2, 2), (6, 6), (10, 12), (12, 18)]


def test_health_and_ejection(spark):
    oks = [True, True, True, False, True, False, False, True]
    df = spark.createDataFrame([(i, "t", T0 + dt.timedelta(seconds=i), ok) for i, ok in enumerate(oks)], "id int, target string, timestamp timestamp, ok boolean")
    states = [r["state"] for r in R.health_state(df, "target", ["id"], chunk="2s").orderBy("id").collect()]
    assert states == ["unknown", "unknown", "healthy", "healthy", "healthy", "healthy", "unhealthy", "unhealthy"]
    codes = [503, 503, 200, 503, 503, 503, 503, 503, 503]
    req = spark.createDataFrame([(i, "h", T0 + dt.timedelta(seconds=i), c) for i, c in enumerate(codes)], "id int, host string, timestamp timestamp, status_code int")
    out = R.eject_outliers(req, "host", ["id"]).collect()
    assert [((r["ejected_at"] - T0).seconds, (r["back_at"] - T0).seconds) for r in out] == [(7, 37)]


def test_a_burst_behind_an_old_error_ejects_and_the_count_starts_anew(spark):
    """One error, ten minutes later eleven in eleven seconds; a good answer in between breaks a run."""
    at = [0, *range(600, 611), 700, 701, 702, 703, 704, 705]
    codes = [503] * 12 + [503, 503, 200, 503, 503, 503]
    req = spark.createDataFrame([(i, "h", T0 + dt.timedelta(seconds=s), c) for i, (s, c) in enumerate(zip(at, codes))], "id int, host string, timestamp timestamp, status_code int")
    for chunk in ("3s", "1h", None):
        out = R.eject_outliers(req, "host", ["id"], chunk=chunk).collect()
        assert sorted((r["ejected_at"] - T0).seconds for r in out) == [604, 609]
