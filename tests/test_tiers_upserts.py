"""Ranges over tiers, and the table of newest rows with its manifest."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import sketches as Q
from tidewatch.operators import tiers as G
from tidewatch.operators import timeseries as ts
from tidewatch.streaming.upserts import UpsertTable

T0 = dt.datetime(2024, 1, 1)
DAY, HOUR = 86_400_000_000, 3_600_000_000


def test_every_time_is_read_once():
    now = 19_800 * DAY + 5 * HOUR + 7
    for step in ("5m", "15m", "1h", "6h"):
        found = G.stretches(now, step)
        assert all(a[2] == b[1] for a, b in zip(found, found[1:])) and found[-1][0] == "raw" and found[-1][2] >= now
        assert found[0][0] == "1h" and found[0][1] >= now - 365 * DAY
    tiers = {t: (now - a, now - b) for t, a, b in G.stretches(now, "1h")}
    # At steps of an hour the hours serve as soon as they are built; at shorter ones only where nothing finer is left.
    assert abs(tiers["1h"][1] - 10 * DAY) < 2 * HOUR and tiers["5m"][1] < 2 * DAY
    fine = {t: (now - a, now - b) for t, a, b in G.stretches(now, "15m")}
    assert abs(fine["1h"][1] - 90 * DAY) < 2 * HOUR
    with pytest.raises(ValueError):
        G.stretches(now, "1h", {"raw": "1d", "5m": "20d", "1h": "100d"}, {"5m": "1h", "1h": "30d"})


def test_a_range_over_three_tiers_equals_the_raw_answer(spark):
    """Resets, gaps and single samples on every side of the seams."""
    rng = np.random.default_rng(0)
    at = np.sort(rng.choice(40 * 1440, 1500, replace=False))
    rows = [(f"s{i % 2}", T0 + dt.timedelta(minutes=int(m), seconds=1), float(v)) for i, (m, v) in enumerate(zip(at, np.cumsum(rng.integers(0, 5, 1500)) % 60))]
    samples = spark.createDataFrame(rows, "s string, timestamp timestamp, value double")
    now = T0 + dt.timedelta(days=40)
    kept = {"raw": "9d", "5m": "20d", "1h": "100d"}
    fine = ts.step_blocks(samples, ["s"], "5m")
    tiers = {"5m": fine.where(F.timestamp_micros("_end") > F.lit(now - dt.timedelta(days=20))), "1h": ts.coarser_blocks(fine, ["s"], "1h")}
    raw = samples.where(F.col("timestamp") >= F.lit(now - dt.timedelta(days=9)))
    blocks = G.read_blocks(raw, tiers, ["s"], "2h", now, kept, {"5m": "2d", "1h": "15d"})
    got = ts.increase_of(ts.entered(blocks, ["s"]), ["s"], "12h", "2h")
    want = ts.increase(samples, ["s"], "12h", "2h")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {t for t, _, _ in G.stretches(int(now.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000, "2h", kept, {"5m": "2d", "1h": "15d"})} == {"raw", "5m", "1h"}


def test_merged_sketches_keep_their_error(spark):
    """40 000 names and 300 000 values in 5m blocks, merged to hours, then to all: within what the header states."""
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("s"), F.timestamp_seconds(1_704_067_201 + F.col("id") % 86_400).alias("timestamp"),
        F.when(F.col("id") % 1000 > 0, F.pmod(F.xxhash64("id"), F.lit(40_000))).alias("who"), F.pow(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 20)).cast("double"), F.lit(2.0)).alias("value"),
    )
    days = Q.coarser_sketches(Q.coarser_sketches(Q.sketch_blocks(rows, ["s"], "5m", "who", "value"), ["s"], "1h"), ["s"], "1d")
    got = {r["s"]: r for r in Q.estimates(days, ["s"], {"p50": 0.5, "p99": 0.99}).collect()}
    want = {r["s"]: r for r in rows.groupBy("s").agg(F.count("*").alias("n"), F.count_distinct("who").alias("names")).collect()}
    for s, w in want.items():
        assert got[s]["n"] == w["n"] and abs(got[s]["names"] / w["names"] - 1) < Q.DISTINCT_ERROR
        for p, q in (("p50", 0.5), ("p99", 0.99)):
            rank = rows.where((F.col("s") == s) & (F.col("value") <= got[s][p])).count() / w["n"]
            assert abs(rank - q) < Q.RANK_ERROR


def test_sketches_of_nothing(spark):
    rows = spark.createDataFrame([("a", T0, None, None), ("a", T0, None, float("nan")), ("b", T0, "x", 2.0)], "s string, timestamp timestamp, who string, value double")
    blocks = Q.sketch_blocks(rows, ["s"], "5m", "who", "value")
    got = {r["s"]: (r["n"], r["names"], r["p"]) for r in Q.estimates(Q.coarser_sketches(blocks, ["s"], "1h"), ["s"], {"p": 0.5}).collect()}
    assert got == {"a": (2, 0, None), "b": (1, 1, 2.0)}
    assert Q.estimates(Q.coarser_sketches(blocks.limit(0), ["s"], "1h"), ["s"], {"p": 0.5}).count() == 0


@pytest.fixture
def table(spark, tmp_path):
    return UpsertTable(spark, str(tmp_path / "table"), "k", buckets=4, most_files=2)


def batch(spark, rows):
    return spark.createDataFrame([(k, T0 + dt.timedelta(seconds=s), v) for k, s, v in rows], "k string, timestamp timestamp, v string")


def test_newest_rows_whatever_the_order_of_batches(spark, table):
    batches = [[("a", 5, "a5"), ("b", 1, "b1"), ("a", 3, "a3")], [("a", 4, "late"), (None, 1, "n1")], [("b", 9, "b9"), ("c", 1, "c1")], [("b", 9, "b9z")], [("a", 6, "a6")]]
    for i, rows in enumerate(batches):
        table.write(batch(spark, rows), i)
        before = sorted(map(str, table.read().collect()))
        table.write(batch(spark, [("a", 99, "repeated")]), i)
        assert sorted(map(str, table.read().collect())) == before
    assert {r["k"]: r["v"] for r in table.read().collect()} == {"a": "a6", "b": "b9z", "c": "c1", None: "n1"}
    assert {r["k"]: r["v"] for r in table.read(1).collect()} == {"a": "a5", "b": "b1", None: "n1"}
    sets = table._sets(4)
    assert all(len(s) <= 2 for s in sets.values()) and any(s[0].startswith("m") for s in sets.values())
    # A bucket without new rows keeps its files.
    assert any(s == ["b0"] or "b2" in s or "b1" in s for s in sets.values())


def test_vacuum_leaves_what_is_read(spark, table):
    for i in range(6):
        table.write(batch(spark, [("a", i, f"a{i}"), (f"k{i}", 1, "x")]), i)
    want = sorted(map(str, table.read().collect()))
    assert table.vacuum() and sorted(map(str, table.read().collect())) == want and len(table.versions()) == 2
    table.write(batch(spark, [("a", 50, "new")]), 6)
    assert {r["k"]: r["v"] for r in table.read().collect()}["a"] == "new"


def test_a_batch_that_broke_off_is_written_anew(spark, table, monkeypatch):
    table.write(batch(spark, [("a", 1, "a1")]), 0)
    with monkeypatch.context() as m:
        m.setattr(table, "_publish", lambda *x: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.write(batch(spark, [("a", 2, "half")]), 1)
    assert [r["v"] for r in table.read().collect()] == ["a1"]
    table.write(batch(spark, [("a", 2, "whole")]), 1)
    assert [r["v"] for r in table.read().collect()] == ["whole"]
