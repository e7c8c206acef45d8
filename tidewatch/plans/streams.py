"""Streams over the given tables, run to their end and read back."""

from pyspark.sql import functions as F

from tidewatch.operators import alerting as L
from tidewatch.operators import anomaly as A
from tidewatch.operators.timeseries import threshold_filter
from tidewatch.plans.alerting import base, keyed, routable
from tidewatch.plans.catalog import ORACLES, plain, query
from tidewatch.plans.selectors import LOGS
from tidewatch.plans.timeseries import CONDITION, SERIES, hourly, recorded_samples, state_sql, sum_avg
from tidewatch.session import ROCKSDB, scratch_path
from tidewatch.sources.files import ISO_MICROS, read_archive
from tidewatch.streaming import ordered as O
from tidewatch.streaming import stateful as Z
from tidewatch.streaming import telemetry as S
from tidewatch.streaming.upserts import UpsertTable


def as_files(t, df, name):
    """The rows as JSON lines, for streams whose result does not depend on the order of files."""
    path = scratch_path(t.spark, name)
    df.write.option("timestampFormat", ISO_MICROS).json(path)
    return path


def in_stretches(t, df, name, writer, parts=3, ts="timestamp"):
    """Write the rows stretch of time (``ts``) by stretch of time, and run the stream after each until it has read all.

    ``writer`` turns the stream into its writer (with its checkpoint), so state lives on from stretch to stretch.
    """
    t.spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    path = scratch_path(t.spark, name)
    # The number of state stores is fixed when a stream first starts: one per core.
    shuffles = t.spark.conf.get("spark.sql.shuffle.partitions")
    t.spark.conf.set("spark.sql.shuffle.partitions", str(t.spark.sparkContext.defaultParallelism))
    try:
        us = F.unix_micros(ts)
        ends = df.agg(F.min(us).alias("lo"), F.max(us).alias("hi")).first()
        width = (ends["hi"] - ends["lo"]) // parts + 1
        for i in range(parts):
            low = ends["lo"] + i * width
            df.where((us >= low) & (us < low + width)).write.mode("append").option("timestampFormat", ISO_MICROS).json(path)
            S.run_to_end(writer(t.spark.readStream.schema(df.schema).json(path)))
    finally:
        t.spark.conf.set("spark.sql.shuffle.partitions", shuffles)


def flushed(df, ts="timestamp", days=4, **key):
    """The rows and one of another key, days later, that lets the watermark pass all of them."""
    end = df.agg((F.max(ts) + F.expr(f"INTERVAL {days} DAYS")).alias(ts))
    return df.unionByName(end.select(ts, *[F.lit(v).alias(k) for k, v in key.items()]), allowMissingColumns=True)


def appended(t, df, name, transform, parts=3, ts="timestamp"):
    """What an append-mode stream over the stretches wrote in all."""
    out, checkpoint = scratch_path(t.spark, f"{name}-out"), scratch_path(t.spark, f"{name}-checkpoint")
    in_stretches(t, df, name, lambda rows: transform(rows).writeStream.format("parquet").options(path=out, checkpointLocation=checkpoint), parts, ts)
    return t.spark.read.parquet(out)


@query("S05_telemetry_stream", plain(f"SELECT service, level, count(*)::BIGINT AS n, max(timestamp) AS last FROM {LOGS} GROUP BY 1, 2", ts="last"))
def telemetry_stream(t):
    logs = t.logs().select("timestamp", "level", "message", "service", "trace_id", F.col("span_id").cast("string").alias("span_id"))
    good, _ = S.good_and_bad(S.telemetry_stream(t.spark, "logs", folder=as_files(t, logs, "telemetry")))
    out, checkpoint = scratch_path(t.spark, "telemetry-out"), scratch_path(t.spark, "telemetry-checkpoint")
    S.run_to_end(good.writeStream.format("parquet").options(path=out, checkpointLocation=checkpoint))
    return t.spark.read.schema(good.schema).parquet(out).groupBy("service", "level").agg(F.count("*").alias("n"), F.max("timestamp").alias("last"))


@query("S07_upsert_sink", plain(f"SELECT trace_id, max(timestamp) AS timestamp, arg_max(level, timestamp) AS level, arg_max(span_id, timestamp)::VARCHAR AS span_id FROM {LOGS} GROUP BY 1", ts="timestamp"))
def upsert_sink(t):
    logs = t.logs().select("timestamp", "level", "message", "service", "trace_id", F.col("span_id").cast("string").alias("span_id"))
    folder = as_files(t, logs, "upsert-in")
    logs.select(F.concat(F.lit("{broken "), F.col("span_id")).alias("value")).where("level = 'ERROR'").write.mode("append").text(folder)
    path, bad, checkpoint = (scratch_path(t.spark, f"upsert-{x}") for x in ("rows", "bad", "checkpoint"))
    S.run_to_end(S.upsert_stream(S.telemetry_stream(t.spark, "logs", folder=folder, max_files=2), path, bad, checkpoint, "trace_id"))
    return S.current_rows(t.spark, path, "trace_id").select("trace_id", "timestamp", "level", "span_id")


@query("S07_upsert_table", ORACLES["S07_upsert_sink"])
def upsert_table(t):
    """The same rows from a table of key buckets with a manifest, written batch by batch."""
    logs = t.logs().select("timestamp", "level", "message", "service", "trace_id", F.col("span_id").cast("string").alias("span_id"))
    table = UpsertTable(t.spark, scratch_path(t.spark, "upsert-table"), "trace_id", buckets=8, most_files=2)
    checkpoint = scratch_path(t.spark, "upsert-table-checkpoint")
    in_stretches(t, logs, "upsert-table-in", lambda rows: table.stream(rows, checkpoint), 4)
    return table.read().select("trace_id", "timestamp", "level", "span_id")


HISTORY = """(SELECT *, m - 3 * s AS lower_threshold, m + 3 * s AS upper_threshold, coalesce(n >= 30 AND (value < m - 3 * s OR value > m + 3 * s), false) AS is_anomaly FROM (
   SELECT event_id, event_type AS metric_name, ts AS timestamp, value, avg(value) OVER w AS m, stddev_samp(value) OVER w AS s, count(*) OVER w AS n
   FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 1000 PRECEDING AND 1 PRECEDING)))"""


def judged(rows):
    return A.flagged(O.history_stream(rows, ["metric_name"], ["event_id"]))


@query("A01_history_stream", plain(f"SELECT event_id, metric_name, timestamp, value, lower_threshold, upper_threshold, least(1.0, abs(value - m) / s / 3) AS anomaly_probability FROM {HISTORY} WHERE is_anomaly", "value lower_threshold upper_threshold anomaly_probability", "timestamp"))
def history_stream(t, parts=3):
    """Every sample against the newest 1000 of its metric before it, from keyed state."""
    rows = flushed(t.metrics().select("event_id", "metric_name", "timestamp", "value"), metric_name="flush")
    found = appended(t, rows, "history", judged, parts).where("is_anomaly")
    return found.select("event_id", "metric_name", "timestamp", "value", "lower_threshold", "upper_threshold", "anomaly_probability")


@query("S10_periodic_scoring", f"SELECT metric_name, is_anomaly, count(*)::BIGINT AS n FROM {HISTORY} GROUP BY 1, 2")
def periodic_scoring(t):
    """Predictions of every interval, each sample scored by what came before it."""
    rows = flushed(t.metrics().select("event_id", "metric_name", "timestamp", "value"), metric_name="flush")
    path, checkpoint = scratch_path(t.spark, "scored"), scratch_path(t.spark, "scored-checkpoint")
    in_stretches(t, rows, "scoring-in", lambda stream: S.periodic_scoring(judged(stream), path, checkpoint), 2)
    scored = t.spark.read.schema("metric_name string, is_anomaly boolean").json(path).where("metric_name != 'flush'")
    return scored.groupBy("metric_name", "is_anomaly").agg(F.count("*").alias("n"))


@query("S05_late_rows_stream", """WITH a AS (SELECT event_id, ts, ts + CASE WHEN event_id % 20 = 0 THEN INTERVAL 12 DAY ELSE INTERVAL 0 DAY END AS arrival FROM events),
   s AS (SELECT a.*, (epoch_us(arrival) - lo) // ((hi - lo) // 3 + 1) AS part FROM a, (SELECT epoch_us(min(arrival)) AS lo, epoch_us(max(arrival)) AS hi FROM a)),
   m AS (SELECT s.part, max(p.ts) - INTERVAL 1 DAY AS mark FROM (SELECT DISTINCT part FROM s) s JOIN s p ON p.part < s.part GROUP BY 1)
   SELECT event_id, coalesce(ts < mark, false) AS late FROM s LEFT JOIN m USING (part)""")
def late_rows_stream(t):
    """One event in twenty arrives twelve days late: those behind the watermark are in the side table, all others are not."""
    arrival = F.col("ts") + F.when(F.col("event_id") % 20 == 0, F.expr("INTERVAL 12 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    rows = t.events.select("event_id", F.col("ts").alias("timestamp"), arrival.alias("arrival"))
    main, side, marks, checkpoint = (scratch_path(t.spark, f"late-{x}") for x in ("main", "side", "marks", "checkpoint"))
    split = S.split_late(S.update_batch(main), side, marks, "1 day")
    in_stretches(t, rows, "late-in", lambda r: r.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint), ts="arrival")
    told = lambda path, late: t.spark.read.schema("event_id long").option("basePath", path).parquet(path).select("event_id", F.lit(late).alias("late"))
    return told(main, False).unionByName(told(side, True))


@query("S06_archive_stream", ORACLES["S06_archive_sink"])
def archive_stream(t):
    """The archive written as a stream, hour by hour of the records, read back."""
    path, checkpoint = scratch_path(t.spark, "archive"), scratch_path(t.spark, "archive-checkpoint")
    events = t.events.select("event_id", "user_id", F.col("ts").alias("timestamp"))
    in_stretches(t, events, "archive-in", lambda rows: S.archive_stream(rows, path, checkpoint), 2)
    return read_archive(t.spark, path, "event_id long, user_id long, timestamp timestamp, year string, month string, day string, hour string")


ARRIVED = """WITH a AS (SELECT event_id, ts, ts + CASE WHEN event_id % 20 = 0 THEN INTERVAL 12 DAY ELSE INTERVAL 0 DAY END AS arrival FROM events),
   s AS (SELECT a.*, (epoch_us(arrival) - lo) // ((hi - lo) // {parts} + 1) AS part FROM a, (SELECT epoch_us(min(arrival)) AS lo, epoch_us(max(arrival)) AS hi FROM a)),
   m AS (SELECT s.part, max(p.ts) - INTERVAL 1 DAY AS mark FROM (SELECT DISTINCT part FROM s) s JOIN s p ON p.part < s.part GROUP BY 1)"""


@query("S06_rolling_archive_stream", plain(ARRIVED.format(parts=3) + """ SELECT date_trunc('hour', ts) AS start, count(*)::BIGINT AS records, count(*)::BIGINT AS found, (count(*) FILTER (WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark))::BIGINT AS late,
   date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 DAY FROM s) AS complete FROM s LEFT JOIN m USING (part) GROUP BY 1""", ts="start"))
def rolling_archive_stream(t, parts=3):
    """The book of an archive's hours beside what its files hold; one event in twenty arrives twelve days late."""
    arrival = F.col("ts") + F.when(F.col("event_id") % 20 == 0, F.expr("INTERVAL 12 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    rows = t.events.select("event_id", F.col("ts").alias("timestamp"), arrival.alias("arrival"))
    path, hours, checkpoint = (scratch_path(t.spark, f"rolling-{x}") for x in ("rows", "hours", "checkpoint"))
    in_stretches(t, rows, "rolling-in", lambda r: S.rolling_archive_stream(r, path, hours, checkpoint, "1 day"), parts, "arrival")
    stored = t.spark.read.schema("event_id long, timestamp timestamp, year string, month string, day string, hour string, batch long").json(path)
    at = F.to_timestamp(F.concat_ws("-", "year", "month", "day", "hour"), "yyyy-MM-dd-HH")
    return S.archive_hours(t.spark, hours).join(stored.groupBy(at.alias("start")).agg(F.count("*").alias("found")), "start", "left")


def sliding_rates(t, parts=2):
    rows = flushed(t.counters(), service="flush", status="flush")
    return appended(t, rows, "sliding", lambda r: O.rate_stream(r, SERIES, "6h", "1h"), parts)


@query("T01_rate_stream", ORACLES["T01_rate"], digits=9)
def rate_stream(t, parts=2):
    """Rates of six hours at every hour, from panes in state."""
    return sliding_rates(t, parts)


@query("T03_sum_avg_by_stream", ORACLES["T03_sum_avg_by"], digits=8)
def sum_avg_by_stream(t):
    return sum_avg(sliding_rates(t, 3))


@query("T16_alert_state_stream", plain(f"""WITH s AS (SELECT * FROM {state_sql(CONDITION, 'service, metric_name', '3 HOUR')})
   SELECT * FROM s UNION ALL SELECT service, metric_name, max(eval_ts) + INTERVAL 1 HOUR AS eval_ts, NULL AS value, active_since, 'resolved' AS state FROM s GROUP BY 1, 2, 5""", "value", "eval_ts active_since"))
def alert_state_stream(t, parts=3):
    """Pending and firing as event time passes, and when each run ended."""
    rows = threshold_filter(hourly(t), ">", 60).select("service", "metric_name", "eval_ts", "value")
    rows = flushed(rows, "eval_ts", service="flush", metric_name="flush")
    states = appended(t, rows, "alert-state", lambda r: O.alert_state_stream(r, ["service", "metric_name"], "3h", "1h"), parts, "eval_ts")
    return states.where("service != 'flush'")


@query("L04_admit_stream", ORACLES["L04_admit"])
def admit_stream(t, parts=3):
    """Budget and duplicates together, a queue per service, from keyed state."""
    alerts = flushed(keyed(t).join(base(t).select("event_id", "service"), "event_id"), service="flush", event_id=-1)
    admitted = appended(t, alerts, "admit", lambda r: O.admission_stream(r, "event_id", ["service"], 1, "1h", "12h"), parts)
    return admitted.where("service != 'flush'")


@query("F07_update_history_stream", ORACLES["F07_update_history_batch"], digits=2)
def update_history_stream(t):
    tx = t.transactions().select("user_id", "amount", "timestamp", F.col("email_is_disposable").alias("is_fraud"))
    path, checkpoint = scratch_path(t.spark, "history"), scratch_path(t.spark, "history-checkpoint")
    in_stretches(t, tx, "history-in", lambda rows: Z.history_stream(rows).writeStream.outputMode("update").foreachBatch(S.update_batch(path)).option("checkpointLocation", checkpoint))
    return S.latest_rows(t.spark, path, "user_id")


@query("L03_suppress_duplicates_stream", ORACLES["L03_suppress_duplicates"])
def suppress_duplicates_stream(t):
    alerts = keyed(t)
    alerts_and_end = flushed(alerts, dedupe_key="flush", event_id=-1)
    kept = appended(t, alerts_and_end, "suppress", lambda rows: Z.suppress_stream(rows, "event_id", "12h"), 2)
    return alerts.join(kept.select("event_id"), "event_id", "left_semi")


@query("L04_rate_limit_stream", ORACLES["L04_rate_limit"])
def rate_limit_stream(t):
    alerts = base(t).select("event_id", "timestamp")
    path, checkpoint = scratch_path(t.spark, "limited"), scratch_path(t.spark, "limited-checkpoint")
    in_stretches(t, alerts, "limited-in", lambda rows: Z.rate_limit_stream(rows, path, checkpoint, ["event_id"], 10, "1h"))
    return t.spark.read.schema("event_id long, timestamp timestamp").option("basePath", path).parquet(path).select("event_id", "timestamp")


@query("L15_circuit_state_stream", ORACLES["L15_circuit_state"])
def circuit_state_stream(t):
    failures = base(t).where("event_type = 'error'").select("event_id", "service", "timestamp")
    failures = flushed(failures, service="flush", event_id=-1)
    rows = appended(t, failures, "circuit", lambda r: Z.circuit_stream(r, "service", "event_id", 3, "1d"), 2)
    return rows.withColumnRenamed("key", "service").where("service != 'flush'")


@query("L09_group_notifications_stream", f"""SELECT concat_ws('|', receiver, alertname, cluster, service) AS "group", sent_at[:23] || '000' AS sent_at, new_alerts FROM ({ORACLES['L09_group_notifications']}) WHERE NOT repeated""")
def group_notifications_stream(t):
    """What each group sends, tick by tick, in whole milliseconds; a last row a day later lets the watermark pass the last tick."""
    columns = ("receiver", "alertname", "cluster", "service", "group_wait", "timestamp")
    rows = L.route(routable(t)).select(*columns)
    end = rows.agg((F.max("timestamp") + F.expr("INTERVAL 1 DAY")).alias("timestamp"))
    flush = end.select(*[F.lit("flush").alias(c) for c in columns[:-1]], "timestamp")
    sent = appended(t, rows.unionByName(flush), "groups", lambda r: Z.group_stream(r, columns[1:4], "6h", "24h"), 2)
    return sent.where("group NOT LIKE 'flush%' AND new_alerts > 0").select("group", F.timestamp_millis("sent_ms").alias("sent_at"), "new_alerts")


@query("T15_recording_stream", ORACLES["T15_recording_rules"])
def recording_stream(t):
    samples = recorded_samples(t)
    stored, out, checkpoint = (scratch_path(t.spark, f"recording-{x}") for x in ("samples", "rows", "checkpoint"))
    update = S.recording_batch(stored, out, "12h", "6h", "1d")
    in_stretches(t, samples, "recording-in", lambda rows: rows.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint), 2)
    return t.spark.read.option("basePath", out).parquet(out).drop("_part")


