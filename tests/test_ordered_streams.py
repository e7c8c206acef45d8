"""Streams in order of event time: the same rows for any cut into batches, state that ends, late rows kept."""

import datetime as dt
import os
import sys

import pytest
from pyspark.sql import functions as F

from tidewatch.plans import catalog, streams
from tidewatch.session import ROCKSDB
from tidewatch.sources.tables import Tables
from tidewatch.streaming import ordered as O
from tidewatch.streaming import telemetry as Y

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize(("name", "parts"), [("A01_history_stream", 2), ("T01_rate_stream", 4), ("T16_alert_state_stream", 2), ("L04_admit_stream", 5)])
def test_any_cut_gives_the_rows_of_the_sql(spark, tiny, name, parts):
    """The registered queries cut otherwise."""
    from check import rows_of

    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tiny}/events.parquet'")
    made = getattr(streams, name.split("_", 1)[1])(Tables(spark, tiny), parts)
    df = catalog.tidy(made, 9 if name.startswith("T01") else 6)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(catalog.ORACLES[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())


def run(spark, tmp_path, batches, schema, transform):
    """What the stream appends, batch by batch of its input."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    found = []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
        stream = transform(spark.readStream.schema(schema).json(source))
        Y.run_to_end(stream.writeStream.format("parquet").options(path=out, checkpointLocation=checkpoint))
        found.append(sorted(tuple(r) for r in spark.read.schema(stream.schema).parquet(out).collect()))
    return found


def at(s):
    return T0 + dt.timedelta(seconds=s)


def test_an_alert_is_resolved_when_its_condition_ends(spark, tmp_path):
    """Rows out of order inside the watermark; a null value holds; the run ends once the watermark passes its next step."""
    schema = "service string, eval_ts timestamp, value double"
    batches = [[("a", at(30), 1.0), ("a", at(15), 2.0)], [("a", at(45), None)], [("z", at(300), 0.0)], [("a", at(400), 5.0), ("z", at(900), 0.0)]]
    states = run(spark, tmp_path, batches, schema, lambda r: O.alert_state_stream(r, ["service"], "30s", "15s", "10 seconds"))
    a = [(r[1], r[4]) for r in states[2] if r[0] == "a"]
    assert a == [(at(15), "pending"), (at(30), "pending"), (at(45), "firing"), (at(60), "resolved")]
    assert [(r[1], r[3], r[4]) for r in states[3] if r[0] == "a"][4:] == [(at(400), at(400), "pending"), (at(415), at(400), "resolved")]


def test_history_keeps_the_newest_and_can_forget(spark, tmp_path):
    schema = "metric string, id long, timestamp timestamp, value double"
    batches = [[("m", 1, at(1), 1.0), ("m", 2, at(2), None), ("m", None, at(3), 3.0)], [("m", 4, at(4), 5.0), ("z", 9, at(50), 0.0)], [("m", 5, at(60), 7.0), ("z", 10, at(500), 0.0)]]
    rows = run(spark, tmp_path, batches, schema, lambda r: O.history_stream(r, ["metric"], ["id"], keep=2, watermark="1 second", forget="30s"))[-1]
    got = [(r["id"], r["value"], r["hist_n"], r["hist_mean"]) for r in map(lambda x: dict(zip(["timestamp", "metric", "id", "value", "hist_mean", "hist_std", "hist_n"], x, strict=True)), rows) if r["metric"] == "m"]
    # The sample at 60 s comes 56 s after the one before: the history is gone.
    assert got == [(1, 1.0, 0, None), (2, None, 1, 1.0), (None, 3.0, 1, 1.0), (4, 5.0, 2, 2.0), (5, 7.0, 0, None)]


def test_windows_over_panes_count_a_reset_and_skip_the_first_rise(spark, tmp_path):
    schema = "k string, timestamp timestamp, value double"
    batches = [[("a", at(1), 10.0), ("a", at(14), 12.0)], [("a", at(16), 3.0), ("a", at(15), 13.0)], [("z", at(200), 0.0)], [("a", at(250), 4.0), ("z", at(900), 0.0)]]
    rows = run(spark, tmp_path, batches, schema, lambda r: O.sliding_stream(r, ["k"], "30s", "15s", watermark="5 seconds"))[-1]
    got = [((r[1] - T0).seconds, r[2], r[3], r[4]) for r in rows if r[0] == "a"]
    # Steps are open on the left: 15 s belongs to the first. Rises: 2, 1, and 3 after the reset.
    assert got == [(15, 3, 3.0, 35.0), (30, 4, 6.0, 38.0), (45, 1, 0.0, 3.0), (255, 1, 0.0, 4.0), (270, 1, 0.0, 4.0)]


def test_late_rows_are_kept_aside_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    main, side, marks = (str(tmp_path / x) for x in ("main", "side", "marks"))
    split = Y.split_late(Y.update_batch(main), side, marks, "10 seconds")
    frame = lambda rows: spark.createDataFrame(rows, "id long, timestamp timestamp")
    batches = [[(1, at(100)), (2, at(0)), (3, None)], [(4, at(89)), (5, at(90)), (6, at(300))], [], [(7, at(289)), (8, at(295))]]
    for i, rows in enumerate(batches):
        split(frame(rows), i)
        split(frame(rows), i)
    ids = lambda path: sorted(r["id"] for r in spark.read.schema("id long").parquet(f"{path}/batch=*").collect())
    assert ids(main) == [1, 2, 5, 6, 8] and ids(side) == [3, 4, 7]


def test_a_late_sample_evaluates_its_own_stretches_only(spark, tmp_path):
    hour = 3_600_000_000
    rows = spark.createDataFrame([(5 * hour,), (6 * hour,), (40 * hour,), (40 * hour,), (None,)], "_part long")
    assert Y.touched_stretches(rows, "_part", hour, hour) == [(5 * hour, 7 * hour), (40 * hour, 41 * hour)]
    samples, out = str(tmp_path / "samples"), str(tmp_path / "out")
    update = Y.recording_batch(samples, out, "5m", "1m", "1h")
    labels = F.create_map(F.lit("job"), F.lit("j"))
    frame = lambda times: spark.createDataFrame([(at(s), "request_total", float(s)) for s in times], "timestamp timestamp, name string, value double").withColumn("labels", labels)
    update(frame([*range(0, 36_000, 60)]), 0)
    files = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}
    update(frame([90, 34_000]), 1)
    again = {str(p) for p in (tmp_path / "out").rglob("*.parquet")}
    kept = {p.split("_part=")[1].split("/")[0] for p in files if p in again}
    assert len(kept) >= 6 and len(files) > len(set(files) & again)
    assert spark.read.option("basePath", out).parquet(out).where("request_rate5m IS NOT NULL").count() > 500
