"""Traces and logs over the given tables."""

from pyspark.sql import functions as F

from tidewatch.operators import tracing as X
from tidewatch.plans.catalog import plain, query
from tidewatch.plans.selectors import FNV, LOGS, SVC

SPANS = f"""(SELECT md5(user_id || '-' || strftime(ts, '%Y%m%d')) AS trace_id, event_id AS span_id, CASE WHEN event_id % 5 != 0 THEN event_id - event_id % 5 END AS parent_span_id, {SVC} AS service, event_type AS operation,
   ts AS start, value AS duration_ms, CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status, user_id::VARCHAR AS session_id, CASE WHEN event_type = 'purchase' THEN 'ORD-' || (user_id % 40) END AS order_id FROM events)"""
BOUNDS = X.LATENCY_BOUNDS_MS


@query("X01_span_metrics", plain(f"SELECT service, operation, status, count(*)::BIGINT AS calls, sum(duration_ms) AS latency_sum, {', '.join(f'count(*) FILTER (duration_ms <= {b})::BIGINT AS le_{b}' for b in BOUNDS)} FROM {SPANS} GROUP BY 1, 2, 3", "latency_sum"))
def span_metrics(t):
    return X.span_metrics(t.spans(), ["service", "operation", "status"])


@query("X02_sample_traces", f"""SELECT span_id, service FROM {SPANS} WHERE {FNV.format('trace_id')} / 4294967296 < CASE service WHEN 'svc-1' THEN 1.0 WHEN 'svc-2' THEN 0.8 WHEN 'svc-3' THEN 0.5 ELSE 0.1 END""")
def sample_traces(t):
    return X.sample_traces(t.spans(), {"svc-1": 1.0, "svc-2": 0.8, "svc-3": 0.5}).select("span_id", "service")


@query("X03_join_logs_to_spans", f"""SELECT l.log_id, s.span_id, s.operation FROM {LOGS} l JOIN {SPANS} s ON l.trace_id = s.trace_id AND l.service = s.service AND l.timestamp >= s.start - INTERVAL 1 HOUR
   AND epoch_us(l.timestamp) <= epoch_us(s.start) + (s.duration_ms * 1000)::BIGINT + 3600000000""")
def join_logs_to_spans(t):
    return X.join_logs_to_spans(t.logs(), t.spans(), same_span=False).select("log_id", "span_id", "operation")


LE = "CASE " + " ".join(f"WHEN duration_ms <= {b} THEN '{b}'" for b in BOUNDS) + " ELSE 'inf' END"


@query("X04_exemplars", plain(f"SELECT service, {LE} AS le, arg_max(trace_id, (duration_ms, span_id)) AS trace_id, max(duration_ms) AS value FROM {SPANS} GROUP BY 1, 2", "value"))
def exemplars(t):
    rows = X.exemplars(t.spans(), ["service"])
    return rows.withColumn("le", F.when(F.col("le") == float("inf"), "inf").otherwise(F.col("le").cast("long").cast("string")))


@query("X05_user_journey", f"""WITH path AS (SELECT * FROM {SPANS} WHERE order_id IN (SELECT order_id FROM {SPANS} WHERE order_id IS NOT NULL AND session_id IN (SELECT session_id FROM {SPANS} GROUP BY 1 HAVING count(*) > 75)))
   SELECT 'span' AS kind, span_id AS id FROM path UNION ALL SELECT 'log', log_id FROM {LOGS} WHERE level = 'ERROR' AND trace_id IN (SELECT trace_id FROM path)""")
def user_journey(t):
    busy = t.spans().groupBy("session_id").agg(F.count("*").alias("n")).where("n > 75")
    path, errors = X.user_journey(t.spans(), t.logs(), busy)
    return path.select(F.lit("span").alias("kind"), F.col("span_id").alias("id")).unionByName(errors.select(F.lit("log").alias("kind"), F.col("log_id").alias("id")))


@query("X06_broken_traces", f"SELECT span_id, parent_span_id, trace_id FROM {SPANS} s WHERE parent_span_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {SPANS} p WHERE p.trace_id = s.trace_id AND p.span_id = s.parent_span_id)")
def broken_traces(t):
    return X.broken_traces(t.spans()).select("span_id", "parent_span_id", "trace_id")
