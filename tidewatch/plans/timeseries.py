"""Time-series functions, alert state, recording rules and alert rules."""

from pyspark.sql import functions as F

from tidewatch.functions.durations import micros, step_end
from tidewatch.operators import rules as R
from tidewatch.operators import sketches as Q
from tidewatch.operators import tiers as G
from tidewatch.operators import timeseries as ts
from tidewatch.plans.catalog import ORACLES, plain, query
from tidewatch.plans.selectors import STATUS, SVC

COUNTERS = f"(SELECT ts, {SVC} AS service, {STATUS} AS status, (event_id % 1000)::DOUBLE AS value FROM events)"
GAUGE = f"(SELECT ts, {SVC} AS service, event_type AS metric_name, value, event_id FROM events)"
GRID = """(SELECT unnest(generate_series(date_trunc('{unit}', min(ts)), date_trunc('{unit}', max(ts)) + INTERVAL {window} + INTERVAL 1 DAY, INTERVAL {step})) AS eval_ts FROM events)"""


def windowed(source, keys, window, step="1 HOUR", unit="hour", pick=None):
    """SQL: per series and grid time, the window's reset-corrected increase, changes, count and last value."""
    grid = GRID.format(unit=unit, window=window, step=step)
    return f"""(SELECT {keys}, eval_ts, sum(rise) - arg_min(rise, ts) AS inc, sum(moved) - arg_min(moved, ts) AS moves,
        count(*) AS n, arg_max(value, ts) AS last_value FROM (
          SELECT *, CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS rise,
            (prev IS NOT NULL AND prev != value)::INT AS moved FROM (
              SELECT *, lag(value) OVER (PARTITION BY {keys} ORDER BY ts) AS prev FROM {source}))
        JOIN {grid} ON ts > eval_ts - INTERVAL {window} AND ts <= eval_ts GROUP BY ALL)"""


RATES = f"(SELECT service, status, eval_ts, inc / 21600 AS value FROM {windowed(COUNTERS, 'service, status', '6 HOUR')} WHERE n >= 2)"
SERIES = ["service", "status"]


def rates(t):
    return ts.rate(t.counters(), SERIES, "6h", "1h")


def hourly(t, lookback="6h"):
    return ts.instant(t.metrics(), ["service", "metric_name"], "1h", lookback)


HOURLY = f"(SELECT service, metric_name, eval_ts, last_value AS value FROM {windowed(GAUGE, 'service, metric_name', '6 HOUR')})"


@query("T01_rate", plain(f"SELECT * FROM {RATES}", "value", "eval_ts", 9), digits=9)
def rate(t):
    return rates(t)


@query("T02_increase", plain(f"SELECT service, status, eval_ts, inc AS value FROM {windowed(COUNTERS, 'service, status', '30 DAY', '1 DAY', 'day')} WHERE n >= 2", "value", "eval_ts"))
def increase(t):
    return ts.increase(t.counters(), SERIES, "30d", "1d")


@query("T03_sum_avg_by", plain(f"SELECT status, eval_ts, sum(value) AS total, avg(value) AS mean FROM {RATES} GROUP BY 1, 2", "total mean", "eval_ts", 8), digits=8)
def sum_avg_by(t):
    return sum_avg(rates(t))


def sum_avg(v):
    return ts.sum_by(v, "status").withColumnRenamed("value", "total").join(
        ts.avg_by(v, "status").withColumnRenamed("value", "mean"), ["status", "eval_ts"])


@query("T04_vector_binop", plain(f"SELECT a.service, a.eval_ts, a.value / b.value AS value FROM {RATES} a JOIN {RATES} b USING (service, eval_ts) WHERE a.status = '500' AND b.status = '200' AND b.value != 0", "value", "eval_ts"))
def vector_binop(t):
    v = rates(t)
    return ts.vector_binop(v.where("status = '500'").drop("status"), v.where("status = '200'").drop("status"), "/", ["service"]).where("value IS NOT NULL")


@query("T05_vector_eq", plain(f"SELECT a.service, a.eval_ts, a.value FROM (SELECT service, eval_ts, floor(value / 25) AS value FROM {HOURLY} WHERE metric_name = 'error') a JOIN (SELECT service, eval_ts, floor(value / 25) AS value FROM {HOURLY} WHERE metric_name = 'view') b USING (service, eval_ts) WHERE a.value = b.value", "value", "eval_ts"))
def vector_eq(t):
    v = hourly(t).withColumn("value", F.floor(F.col("value") / 25).cast("double"))
    return ts.vector_eq(v.where("metric_name = 'error'").drop("metric_name"), v.where("metric_name = 'view'").drop("metric_name"), ["service"])


@query("T06_threshold_filter", plain(f"SELECT * FROM {HOURLY} WHERE value > 150", "value", "eval_ts"))
def threshold_filter(t):
    return ts.threshold_filter(hourly(t), ">", 150)


BUCKETS = f"""(SELECT {SVC} AS service, date_trunc('hour', ts) AS eval_ts, le, count(*) FILTER (value <= le)::DOUBLE AS cum
  FROM events, (SELECT unnest([1, 2, 5, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000, 10000, 'Infinity'::DOUBLE]) AS le) GROUP BY ALL)"""


def quantile_sql(q, keys):
    return f"""(WITH b AS (SELECT {keys}, le, sum(cum) AS cum FROM {BUCKETS} GROUP BY ALL),
      r AS (SELECT *, coalesce(lag(cum) OVER w, 0) AS below, lag(le) OVER w AS frm, max(cum) OVER (PARTITION BY {keys}) AS total FROM b WINDOW w AS (PARTITION BY {keys} ORDER BY le)),
      h AS (SELECT * FROM r WHERE total > 0 AND cum >= {q} * total QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY le) = 1)
      SELECT {keys}, CASE WHEN isinf(le) THEN frm ELSE coalesce(frm, 0) + (le - coalesce(frm, 0)) * ({q} * total - below) / (cum - below) END AS value FROM h)"""


@query("T07_histogram_quantile", plain(" UNION ALL ".join(f"SELECT {q}::DOUBLE AS q, * FROM {quantile_sql(q, 'service, eval_ts')}" for q in (0.5, 0.9, 0.95, 0.99)), "q value", "eval_ts"))
def histogram_quantile(t):
    b = t.latency_buckets()
    out = None
    for q in (0.5, 0.9, 0.95, 0.99):
        one = ts.histogram_quantile(b, q, ["service"]).select(F.lit(q).alias("q"), "service", "eval_ts", "value")
        out = one if out is None else out.unionByName(one)
    return out


SUMCOUNT = f"(SELECT ts, {SVC} AS service, (event_id // 10 * 3)::DOUBLE AS s, (event_id)::DOUBLE AS c FROM events)"


@query("T08_mean_from_sum_count", plain(f"""SELECT eval_ts, sum(a.inc) / sum(b.inc) AS value FROM {windowed(f"(SELECT ts, service, s AS value FROM {SUMCOUNT})", 'service', '6 HOUR')} a
   JOIN {windowed(f"(SELECT ts, service, c AS value FROM {SUMCOUNT})", 'service', '6 HOUR')} b USING (service, eval_ts) WHERE a.n >= 2 GROUP BY 1""", "value", "eval_ts", 4), digits=4)
def mean_from_sum_count(t):
    base = t.events.select(F.col("ts").alias("timestamp"), F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string")).alias("service"), "event_id")
    sums = base.withColumn("value", (F.floor(F.col("event_id") / 10) * 3).cast("double"))
    return ts.mean_from_sum_count(sums, base.withColumn("value", F.col("event_id").cast("double")), [], ["service"], "6h", "1h")


TOTAL_RATE = f"(SELECT status, eval_ts, sum(value) AS value FROM {RATES} GROUP BY 1, 2)"
PREDICT = f"""(SELECT status, eval_ts, avg(value) OVER w + regr_slope(value, t) OVER w * (t + 3600 - avg(t) OVER w) AS value, count(*) OVER w AS n
   FROM (SELECT *, epoch(eval_ts)::DOUBLE AS t FROM {TOTAL_RATE}) WINDOW w AS (PARTITION BY status ORDER BY eval_ts RANGE BETWEEN INTERVAL '11 hour 59 minute' PRECEDING AND CURRENT ROW))"""


@query("T09_predict_linear", plain(f"SELECT status, eval_ts, value FROM {PREDICT} WHERE n >= 2", "value", "eval_ts"))
def predict_linear(t):
    return ts.predict_linear(ts.sum_by(rates(t), "status"), ["status"], "12h", "1h")


@query("T10_offset", plain(f"SELECT service, status, eval_ts + INTERVAL 7 DAY AS eval_ts, value FROM {RATES}", "value", "eval_ts", 9), digits=9)
def offset(t):
    return ts.offset(rates(t), SERIES, "7d")


@query("T11_topk", plain(f"SELECT service, metric_name, eval_ts, value FROM {HOURLY} QUALIFY row_number() OVER (PARTITION BY eval_ts ORDER BY value DESC, service, metric_name) <= 10", "value", "eval_ts"))
def topk(t):
    return ts.topk(hourly(t), 10, ["service", "metric_name"])


STEPPED = "(SELECT ts, event_type, floor(value / 20)::DOUBLE AS value FROM events)"


@query("T12_changes", plain(f"SELECT event_type, eval_ts, moves::DOUBLE AS value FROM {windowed(STEPPED, 'event_type', '6 HOUR')}", "value", "eval_ts"))
def changes(t):
    rows = t.events.select(F.col("ts").alias("timestamp"), "event_type", F.floor(F.col("value") / 20).cast("double").alias("value"))
    return ts.changes(rows, ["event_type"], "6h", "1h")


@query("T13_instant", plain(f"SELECT metric_name, eval_ts, last_value AS value FROM {windowed('(SELECT ts, event_type AS metric_name, value FROM events)', 'metric_name', '5 MINUTE', '1 MINUTE', 'minute')}", "value", "eval_ts"))
def instant(t):
    return ts.instant(t.metrics(), ["metric_name"], "1m", "5m")


@query("T14_reduce", plain(f"SELECT service, metric_name, arg_max(value, eval_ts) AS last_not_null, avg(value) AS mean, max(value) AS max, sum(value) AS sum FROM {HOURLY} GROUP BY 1, 2", "last_not_null mean max sum"))
def reduce_series(t):
    return ts.reduce_series(hourly(t), ["service", "metric_name"])


# name -> counter value of one event, for the recorded signals
RECORDED = {
    "request_total": "event_id", "request_errors_total": "event_id // 5", "orders_total": "event_id // 7",
    "order_value_total": "event_id // 7 * 31", "cart_abandoned_total": "event_id // 9", "cart_created_total": "event_id // 6",
    "request_latency_seconds_sum": "event_id // 4", "request_latency_seconds_count": "event_id",
}


def recorded_samples(t):
    e = t.events
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.expr(x.replace("//", "div")).cast("double").alias("value")) for n, x in RECORDED.items()])
    base = e.select(F.col("ts").alias("timestamp"), "user_id", F.inline(rows))
    labels = F.create_map(F.lit("job"), F.concat(F.lit("job-"), (F.col("user_id") % 3).cast("string")),
                          F.lit("service"), F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string")))
    return base.select("timestamp", "name", labels.alias("labels"), "value")


RECORDED_SQL = f"""(SELECT ts, 'job-' || (user_id % 3) AS job, {SVC} AS service, r.name AS name, r.value AS value FROM (
   SELECT *, unnest([{', '.join(f"{{'name': '{n}', 'value': ({x})::DOUBLE}}" for n, x in RECORDED.items())}]) AS r FROM events))"""
WIDE = f"""(SELECT job, eval_ts, {', '.join(f"sum(CASE WHEN name = '{n}' THEN inc / 43200 END) AS {n}" for n in RECORDED)}
   FROM {windowed(RECORDED_SQL, 'name, job, service', '12 HOUR', '6 HOUR', 'day')} WHERE n >= 2 GROUP BY 1, 2)"""


@query("T15_recording_rules", plain(f"""SELECT job, eval_ts, request_latency_seconds_sum / nullif(request_latency_seconds_count, 0) AS request_latency_mean5m, request_errors_total AS request_errors_rate5m,
   request_total AS request_rate5m, orders_total AS orders_rate5m, order_value_total AS order_value_rate5m, cart_abandoned_total / nullif(cart_created_total, 0) AS cart_abandonment_rate5m FROM {WIDE}""",
   "request_latency_mean5m request_errors_rate5m request_rate5m orders_rate5m order_value_rate5m cart_abandonment_rate5m", "eval_ts"))
def recording_rules(t):
    return R.recording_rules(R.Signals(recorded_samples(t), "6h"), "12h")


def state_sql(condition, keys, hold, step="1 HOUR"):
    return f"""(SELECT {keys}, eval_ts, value, since AS active_since, CASE WHEN eval_ts - since >= INTERVAL {hold} THEN 'firing' ELSE 'pending' END AS state FROM (
      SELECT *, min(eval_ts) OVER (PARTITION BY {keys}, island) AS since FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY {keys} ORDER BY eval_ts) AS island FROM (
          SELECT *, (lag(eval_ts) OVER (PARTITION BY {keys} ORDER BY eval_ts) IS DISTINCT FROM eval_ts - INTERVAL {step})::INT AS fresh FROM {condition}))))"""


CONDITION = f"(SELECT * FROM {HOURLY} WHERE value > 60)"


@query("T16_alert_state", plain(f"SELECT * FROM {state_sql(CONDITION, 'service, metric_name', '3 HOUR')}", "value", "eval_ts active_since"))
def alert_state(t):
    return R.alert_state(ts.threshold_filter(hourly(t), ">", 60), ["service", "metric_name"], "3h", "1h")


# Samples of the rule set: every label set holds several series (job, instance), with a step that suits the sparse data.
GAUGES = {
    "http_request_duration_seconds": "value", "kubecost_idle_cost": "value / 2", "container_memory_working_set_bytes": "value",
    "container_spec_memory_limit_bytes": "event_id % 7 * 20", "compliance_check_status": "event_id % 3", "db_connections_current": "event_id % 50",
    "db_connections_max": "40", "node_filesystem_avail_bytes": "event_id % 30", "node_filesystem_size_bytes": "100", "edge_storage_free_bytes": "event_id % 25",
    "edge_storage_total_bytes": "100", "namespace:container_cpu_usage:sum": "event_id % 9", "namespace:resource_quota:cpu": "event_id % 5 + 1",
}
ALIKE = ("service", "namespace", "database", "device_id", "pod", "mountpoint")


def rule_samples(t):
    """Events as labelled samples: request counters, and one gauge of every name above per event."""
    service = F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string"))
    base = F.create_map(
        *[x for k in ALIKE for x in (F.lit(k), service)], F.lit("job"), F.concat(F.lit("job-"), (F.col("user_id") % 3).cast("string")),
        F.lit("instance"), F.concat(F.lit("i-"), (F.col("user_id") % 2).cast("string")), F.lit("container"), F.lit("app"),
    )
    gauges = [F.struct(F.lit(n).alias("name"), base.alias("labels"), F.expr(x).cast("double").alias("value")) for n, x in GAUGES.items()]
    counted = F.map_concat(base, F.create_map(F.lit("status"), F.when(F.col("event_type") == "error", "500").otherwise("200")))
    requests = F.struct(F.lit("http_requests_total").alias("name"), counted.alias("labels"), (F.col("event_id") % 1000).cast("double").alias("value"))
    return t.events.select(F.col("ts").alias("timestamp"), F.inline(F.array(requests, *gauges)))


LABELLED = "'job-' || (user_id % 3) AS job, 'i-' || (user_id % 2) AS instance"
ERROR_SHARE = f"""(SELECT service, eval_ts, a / nullif(b, 0) AS value FROM (SELECT service, eval_ts, sum(inc) FILTER (status = '500') AS a, sum(inc) AS b
   FROM {windowed(COUNTERS.replace("SELECT ts,", f"SELECT ts, {LABELLED},"), 'service, status, job, instance', '5 MINUTE', '5 MINUTE', 'hour')} WHERE n >= 2 GROUP BY 1, 2) WHERE a IS NOT NULL)"""


def now_sql(name):
    """SQL: the last value of every series of a gauge at every step."""
    rows = f"(SELECT ts, {SVC} AS service, {LABELLED}, ({GAUGES[name]})::DOUBLE AS value FROM events)"
    return f"(SELECT service, job, instance, eval_ts, last_value AS value FROM {windowed(rows, 'service, job, instance', '5 MINUTE', '5 MINUTE', 'hour')})"


def share_sql(top, bottom, scale=1):
    return f"(SELECT service, job, instance, eval_ts, a.value / nullif(b.value, 0) * {scale} AS value FROM {now_sql(top)} a JOIN {now_sql(bottom)} b USING (service, job, instance, eval_ts))"


EACH = "service, job, instance"
# Rule: severity, the published expression in SQL, its condition, the labels that tell instances apart, how long it must hold.
RULE_SQL = {
    "RequestHighLatency": ("critical", now_sql("http_request_duration_seconds"), "value > 1", EACH, "5 MINUTE"),
    "ServiceHighErrorRate": ("critical", ERROR_SHARE, "value > 0.05", "service", "5 MINUTE"),
    "HighErrorRateAnomaly": ("critical", ERROR_SHARE, "value > 0.2", "service", "5 MINUTE"),
    "UnusedResourceCost": ("info", f"(SELECT service, eval_ts, sum(value) AS value FROM {now_sql('kubecost_idle_cost')} GROUP BY 1, 2)", "value > 100", "service", "24 HOUR"),
    "HighMemoryUsage": ("warning", share_sql("container_memory_working_set_bytes", "container_spec_memory_limit_bytes"), "value > 0.8", EACH, "10 MINUTE"),
    "ComplianceViolation": ("critical", now_sql("compliance_check_status"), "value = 0", EACH, "1 MINUTE"),
    "DatabaseConnectionPoolSaturation": ("warning", share_sql("db_connections_current", "db_connections_max"), "value > 0.8", EACH, "5 MINUTE"),
    "DiskSpaceRunningOut": ("warning", share_sql("node_filesystem_avail_bytes", "node_filesystem_size_bytes", 100), "value < 10", EACH, "5 MINUTE"),
    "EdgeDeviceStorageCritical": ("critical", share_sql("edge_storage_free_bytes", "edge_storage_total_bytes", 100), "value < 10", EACH, "5 MINUTE"),
    "TenantResourceQuotaExceeded": ("warning", f"""(SELECT service, job, instance, eval_ts, a.value FROM {now_sql('namespace:container_cpu_usage:sum')} a
        JOIN {now_sql('namespace:resource_quota:cpu')} b USING (service, job, instance, eval_ts) WHERE a.value > b.value)""", "true", EACH, "15 MINUTE"),
}


def alerts_sql(name):
    severity, vector, condition, keys, hold = RULE_SQL[name]
    return f"SELECT '{name}' AS alert, '{severity}' AS severity, service, state, value, eval_ts, active_since FROM {state_sql(f'(SELECT * FROM {vector} WHERE {condition})', keys, hold, '5 MINUTE')}"


@query("T17_rule_set", plain(" UNION ALL ".join(map(alerts_sql, RULE_SQL)), "value", "eval_ts active_since"))
def rule_set(t):
    rules = [r for r in R.rule_set({"error_rate": 0.2}) if r.name in RULE_SQL]
    service = F.coalesce(*[F.col("labels")[k] for k in ALIKE])
    return R.evaluate_rules(rules, R.Signals(rule_samples(t), "5m")).select("alert", "severity", service.alias("service"), "state", "value", "eval_ts", "active_since")


@query("T18_active_alerts", plain(f"""SELECT alert AS "Alert", service AS "Service", severity AS "Severity", state AS "Status", eval_ts AS "Time"
   FROM ({alerts_sql('RequestHighLatency')} UNION ALL {alerts_sql('ServiceHighErrorRate')} UNION ALL {alerts_sql('ComplianceViolation')}) WHERE state = 'firing'""", ts='"Time"'))
def active_alerts(t):
    rules = [r for r in R.rule_set() if r.name in ("RequestHighLatency", "ServiceHighErrorRate", "ComplianceViolation")]
    return R.active_alerts(R.evaluate_rules(rules, R.Signals(rule_samples(t), "5m")))


@query("T19_slo_availability", plain(f"SELECT service, eval_ts, 100 * (1 - coalesce(sum(value) FILTER (status = '500'), 0) / nullif(sum(value), 0)) AS value FROM {RATES} GROUP BY 1, 2 HAVING sum(value) != 0", "value", "eval_ts"))
def slo_availability(t):
    return ts.slo_availability(t.counters(), SERIES, ["service"], F.col("status").rlike("^5..$"), "6h", "1h").where("value IS NOT NULL")


@query("T20_error_budget", plain(f"SELECT eval_ts, 100 * (1 - coalesce(sum(inc) FILTER (status = '500'), 0) / (sum(inc) * 0.001)) AS value FROM {windowed(COUNTERS, 'service, status', '30 DAY', '1 DAY', 'day')} WHERE n >= 2 GROUP BY 1 HAVING sum(inc) != 0", "value", "eval_ts", 4), digits=4)
def error_budget(t):
    return ts.error_budget(t.counters(), SERIES, [], F.col("status").rlike("^5..$"), "30d", "1d").where("value IS NOT NULL")


@query("T21_downsample", plain(f"""SELECT service, status, b AS block_end, count(*)::BIGINT AS count, sum(value) AS sum, min(value) AS min, max(value) AS max, arg_max(value, ts) AS last, max(ts) AS last_ts,
    sum(CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END) AS rise FROM (
    SELECT *, lag(value) OVER (PARTITION BY service, status ORDER BY ts) AS prev, date_trunc('hour', ts - INTERVAL 1 MICROSECOND) + INTERVAL 1 HOUR AS b FROM {COUNTERS}) GROUP BY 1, 2, 3""",
    "sum min max last rise", "block_end last_ts"))
def downsample(t):
    return ts.coarsen(ts.downsample(t.counters(), SERIES, "5m"), SERIES, "1h")


@query("T21_tier_read", ORACLES["T01_rate"], digits=9)
def tier_read(t):
    """Rates over a month of which a week is left raw and two in 5m blocks: the same as from all samples."""
    counters = t.counters()
    now = counters.agg(F.max("timestamp").alias("now"))
    keep = {"raw": "7d", "5m": "14d", "1h": "60d"}
    since = lambda name: now.scalar() - F.expr(f"INTERVAL {keep[name].removesuffix('d')} DAYS")
    fine = ts.step_blocks(counters, SERIES, "5m")
    tiers = {"5m": fine.where(F.timestamp_micros("_end") >= since("5m")), "1h": ts.coarser_blocks(fine, SERIES, "1h")}
    raw = counters.where(F.col("timestamp") >= since("raw"))
    blocks = G.read_blocks(raw, tiers, SERIES, "1h", now.first()["now"], keep, {"5m": "3d", "1h": "10d"})
    return ts.increase_of(ts.entered(blocks, SERIES), SERIES, "6h", "1h").withColumn("value", F.col("value") / 21600)


@query("T21_sketch_tier", plain(f"""SELECT service, date_trunc('day', ts - INTERVAL 1 MICROSECOND) + INTERVAL 1 DAY AS block_end, count(*)::BIGINT AS n, count(DISTINCT user_id)::BIGINT AS users, true AS users_close, true AS p50_close, true AS p95_close
   FROM (SELECT *, {SVC} AS service FROM events) GROUP BY 1, 2""", ts="block_end"))
def sketch_tier(t):
    """Days from merged 5m sketches, beside the exact counts and ranks they are held to."""
    rows = t.metrics().join(t.events.select("event_id", "user_id"), "event_id")
    fine = Q.sketch_blocks(rows, ["service"], "5m", "user_id", "value")
    days = Q.coarser_sketches(Q.coarser_sketches(fine, ["service"], "1h"), ["service"], "1d")
    told = Q.estimates(days, ["service"], {"p50": 0.5, "p95": 0.95})
    end = F.timestamp_micros(step_end(F.col("timestamp"), micros("1d"))).alias("block_end")
    both = rows.select("service", end, "user_id", "value").join(told, ["service", "block_end"])
    v, share = F.col("value"), lambda c: F.avg(c.cast("double"))
    exact = both.groupBy("service", "block_end", "n", "names").agg(
        F.count_distinct("user_id").alias("users"), *[share(v < F.col(p)).alias(f"{p}_below") for p in ("p50", "p95")], *[share(v <= F.col(p)).alias(f"{p}_upto") for p in ("p50", "p95")],
    )
    slack = Q.RANK_ERROR + 1 / F.col("n")
    close = lambda p, q: ((F.col(f"{p}_below") <= q + slack) & (F.col(f"{p}_upto") >= q - slack)).alias(f"{p}_close")
    near = F.abs(F.col("names") - F.col("users")) <= F.greatest(F.lit(1.0), Q.DISTINCT_ERROR * F.col("users"))
    return exact.select("service", "block_end", "n", "users", near.alias("users_close"), close("p50", 0.5), close("p95", 0.95))


@query("T22_dedup_replicas", plain("SELECT event_type, ts AS timestamp, value + event_id % 2 AS value FROM events", "value", "timestamp"))
def dedup_replicas(t):
    names = F.when(F.col("event_id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("c"), F.lit("b")))
    rows = t.events.select("event_type", F.col("ts").alias("timestamp"), F.col("value").alias("v"), F.explode(names).alias("replica"))
    rows = rows.select("event_type", "timestamp", "replica", (F.col("v") + F.when(F.col("replica") == "a", 0).when(F.col("replica") == "c", 7).otherwise(1)).alias("value"))
    return ts.dedup_replicas(rows, ["event_type"])


@query("T23_dependency_success", plain(f"SELECT service, eval_ts, sum(value) FILTER (status = '200') / sum(value) AS value FROM {RATES} GROUP BY 1, 2 HAVING sum(value) != 0 AND count(*) FILTER (status = '200') > 0", "value", "eval_ts"))
def dependency_success(t):
    return ts.ratio(rates(t), ["service"], F.col("status") == "200").where("value IS NOT NULL")


@query("T24_resource_utilisation", plain(f"""SELECT service, eval_ts, a / b AS value FROM (SELECT service, eval_ts, sum(value) FILTER (metric_name IN ('view', 'click')) AS a, sum(value) FILTER (metric_name IN ('error', 'purchase')) AS b
   FROM {HOURLY} GROUP BY 1, 2) WHERE a IS NOT NULL AND b IS NOT NULL""", "value", "eval_ts"))
def resource_utilisation(t):
    v = hourly(t)
    return ts.utilisation(v.where("metric_name IN ('view', 'click')"), v.where("metric_name IN ('error', 'purchase')"), ["service"])
