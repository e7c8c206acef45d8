"""Alerts, routing and remediation over the given tables."""

from pyspark.sql import functions as F

from tidewatch.operators import alerting as L
from tidewatch.operators import remediation as R
from tidewatch.plans.catalog import plain, query
from tidewatch.plans.selectors import SVC

ISO = "yyyy-MM-dd HH:mm:ss"
BASE = f"(SELECT event_id, ts AS timestamp, event_type, value, {SVC} AS service, user_id FROM events)"


def base(t):
    return t.events.select("event_id", F.col("ts").alias("timestamp"), "event_type", "value", F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string")).alias("service"), "user_id")


def findings(t):
    """Findings of every kind, from the events."""
    b = base(t)
    v = F.col("value")
    ip = F.concat(F.lit("10.0.0."), F.col("user_id").cast("string"))
    return {
        "anomaly": b.select("timestamp", "service", F.col("event_type").alias("metric_name"), "value", F.lit(None).cast("double").alias("lower_bound")),
        "predictive": b.select("timestamp", "service", F.col("event_type").alias("metric_name"), (F.col("user_id") % 24).alias("time_until_hours"), (F.col("event_id") % 4 / 4).alias("confidence")),
        "service_health": b.select("timestamp", "service", F.col("event_type").alias("status")),
        "resource_utilization": b.select("timestamp", "service", F.lit("cpu").alias("resource"), "value"),
        "security": b.select("timestamp", F.col("event_type").alias("type"), ip.alias("source")),
        "dependency_failure": b.select("timestamp", "service", F.col("event_type").alias("dependency"), v.alias("error_rate")),
        "fraud": b.select("timestamp", F.col("event_id").alias("transaction_id"), v.alias("risk_score")),
        "inventory": b.select("timestamp", F.col("event_type").alias("product"), v.alias("level")),
        "intrusion": b.select("timestamp", ip.alias("source_ip"), F.col("event_type").alias("attack_type")),
    }


ALERTS = f"""(SELECT 'anomaly' AS kind, 'Anomaly Detected: ' || service || ' - ' || event_type AS title, 'An anomaly was detected in ' || service || ' for metric ' || event_type || '. Current value: ' || value || ', expected range: 0 - 0.' AS message, 'warning' AS severity, service AS source, timestamp, 'anomaly,ml,observability' AS tags FROM {BASE}
   UNION ALL SELECT 'predictive', 'Predicted Issue: ' || service || ' - ' || event_type, 'A potential issue is predicted in ' || service || ' for metric ' || event_type || ' in ' || (user_id % 24) || ' hours. Confidence: ' || (event_id % 4 * 25) || '%.', 'info', service, timestamp, 'predictive,ml,observability' FROM {BASE}
   UNION ALL SELECT 'service_health', 'Service Health Issue: ' || service, 'Service ' || service || ' is experiencing health issues. Status: ' || event_type || '.', 'error', service, timestamp, 'service-health,infrastructure' FROM {BASE}
   UNION ALL SELECT 'resource_utilization', 'High Resource Utilization: ' || service || ' - cpu', 'Service ' || service || ' is experiencing high cpu utilization (' || value || '%).', 'warning', service, timestamp, 'resource,infrastructure' FROM {BASE}
   UNION ALL SELECT 'security', 'Security Alert: ' || event_type, 'A security issue of type ' || event_type || ' was detected. Source: 10.0.0.' || user_id || '.', 'critical', '10.0.0.' || user_id, timestamp, 'security,threat' FROM {BASE}
   UNION ALL SELECT 'dependency_failure', 'Dependency Failure: ' || service || ' -> ' || event_type, 'Service ' || service || ' is experiencing issues with dependency ' || event_type || '. Error rate: ' || value || '%.', 'error', service, timestamp, 'dependency,infrastructure' FROM {BASE}
   UNION ALL SELECT 'fraud', 'Potential Fraud Detected: ' || event_id, 'Potential fraudulent activity detected for transaction ' || event_id || '. Risk score: ' || value || '.', 'critical', 'fraud-detection', timestamp, 'fraud,security,business' FROM {BASE}
   UNION ALL SELECT 'inventory', 'Inventory Alert: ' || event_type, 'Product ' || event_type || ' inventory level is ' || value || ', which is below the threshold of 0.', 'warning', 'inventory-management', timestamp, 'inventory,business' FROM {BASE}
   UNION ALL SELECT 'intrusion', 'Intrusion Attempt Detected: 10.0.0.' || user_id, 'Potential intrusion attempt detected from 10.0.0.' || user_id || '. Attack type: ' || event_type || '.', 'critical', 'intrusion-detection', timestamp, 'intrusion,security,threat' FROM {BASE})"""


def alerts(t):
    out = None
    for kind, rows in findings(t).items():
        one = L.to_alerts(rows, kind)
        out = one if out is None else out.unionByName(one)
    return out


@query("L01_to_alerts", plain(f"SELECT * FROM {ALERTS}", ts="timestamp"))
def to_alerts(t):
    return alerts(t).drop("details", "dedupe_key").withColumn("tags", F.array_join("tags", ","))


@query("L02_dedupe_key", f"SELECT source || ':' || title || ':' || strftime(timestamp, '%Y%m%d%H%M') AS dedupe_key, count(*)::BIGINT AS n FROM {ALERTS} GROUP BY 1")
def dedupe_key(t):
    return alerts(t).groupBy("dedupe_key").agg(F.count("*").alias("n"))


def keyed(t):
    return base(t).select("event_id", "timestamp", F.concat_ws(":", "service", "event_type").alias("dedupe_key"))


@query("L03_suppress_duplicates", plain(f"""WITH RECURSIVE a AS (SELECT event_id, timestamp, service || ':' || event_type AS dedupe_key FROM {BASE}),
   k AS (SELECT dedupe_key, min(timestamp) AS t FROM a GROUP BY 1 UNION ALL SELECT k.dedupe_key, (SELECT min(timestamp) FROM a WHERE a.dedupe_key = k.dedupe_key AND a.timestamp >= k.t + INTERVAL 12 HOUR) FROM k WHERE k.t IS NOT NULL)
   SELECT a.* FROM a JOIN k ON a.dedupe_key = k.dedupe_key AND a.timestamp = k.t""", ts="timestamp"))
def suppress_duplicates(t):
    return L.suppress_duplicates(keyed(t), "event_id", "12h", chunk="2d")


@query("L03_suppress_tumbling", plain(f"SELECT arg_min(event_id, timestamp) AS event_id, min(timestamp) AS timestamp, service || ':' || event_type AS dedupe_key FROM {BASE} GROUP BY dedupe_key, epoch_us(timestamp) // 300000000", ts="timestamp"))
def suppress_tumbling(t):
    return L.suppress_tumbling(keyed(t), ["event_id"])


@query("L04_rate_limit", plain(f"SELECT event_id, timestamp FROM {BASE} QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', timestamp) ORDER BY timestamp, event_id) <= 10", ts="timestamp"))
def rate_limit(t):
    return L.rate_limit(base(t).select("event_id", "timestamp"), ["event_id"], 10, "1h")


@query("L04_admit", plain(f"""WITH RECURSIVE a AS MATERIALIZED (SELECT event_id, timestamp, service, service || ':' || event_type AS k, date_trunc('hour', timestamp) AS slot, row_number() OVER (PARTITION BY service ORDER BY timestamp, event_id) AS i FROM {BASE}),
   walk AS (SELECT DISTINCT service, 0::BIGINT AS i, NULL::BIGINT AS event_id, NULL::TIMESTAMP AS timestamp, NULL::TIMESTAMP AS slot, 0 AS taken, false AS ok, [{{'k': '', 't': TIMESTAMP '1970-01-01'}}] AS held FROM a
     UNION ALL SELECT service, i, event_id, timestamp, slot, used + ok::INT, ok, CASE WHEN ok THEN list_append(list_filter(held, lambda x: timestamp - x.t < INTERVAL 12 HOUR), {{'k': k, 't': timestamp}}) ELSE held END FROM (
       SELECT *, used < 1 AND len(list_filter(held, lambda x: x.k = k AND timestamp - x.t < INTERVAL 12 HOUR)) = 0 AS ok FROM (
         SELECT a.*, w.held, CASE WHEN w.slot = a.slot THEN w.taken ELSE 0 END AS used FROM walk w JOIN a ON a.service = w.service AND a.i = w.i + 1)))
   SELECT service, event_id, timestamp FROM walk WHERE ok""", ts="timestamp"))
def admit(t):
    """Budget and duplicates together, a queue per service, against a walk over each queue's alerts in order."""
    alerts = keyed(t).join(base(t).select("event_id", "service"), "event_id")
    return L.admit(alerts, "event_id", ["service"], limit=1, slot="1h", window="12h").select("service", "event_id", "timestamp")


@query("L05_fan_out", f"""SELECT kind, severity, channel, count(*)::BIGINT AS n FROM {ALERTS}, (VALUES ('general-slack', NULL, NULL, true), ('critical-slack', ['critical'], NULL, true), ('pagerduty', ['error', 'critical'], NULL, true), ('email-digest', NULL, NULL, true), ('webhook', NULL, NULL, true), ('business', NULL, ['business'], true), ('off', NULL, NULL, false)) c(channel, sev, tag, enabled)
   WHERE enabled AND (sev IS NULL OR list_contains(sev, severity)) AND (tag IS NULL OR list_has_any(tag, string_split(tags, ','))) GROUP BY 1, 2, 3""")
def fan_out(t):
    channels = [*L.CHANNELS, {"name": "business", "type": "email", "tag_filter": ["business"]}, {"name": "off", "type": "slack", "enabled": False}]
    return L.fan_out(alerts(t), channels).groupBy("kind", "severity", "channel").agg(F.count("*").alias("n"))


@query("L06_retry_candidates", f"SELECT event_id, (user_id % 5)::BIGINT AS delivery_attempts FROM {BASE} WHERE event_type = 'error' AND user_id % 5 < 3")
def retry_candidates(t):
    rows = base(t).select("event_id", (F.col("event_type") != "error").alias("delivered"), (F.col("user_id") % 5).alias("delivery_attempts"))
    return L.retry_candidates(rows).drop("delivered")


@query("L07_alert_history", plain(f"SELECT event_id, timestamp, service FROM {BASE} ORDER BY timestamp DESC, event_id DESC LIMIT 100", ts="timestamp"))
def alert_history(t):
    return L.alert_history(base(t).select("event_id", "timestamp", "service"), ["event_id"])


TEAMS = ["platform", "application", "database", "security", "sre", "other"]
ROUTED_BASE = f"""(SELECT event_id, timestamp, event_type AS alertname, 'c' || (user_id % 2) AS cluster, service, CASE event_id % 3 WHEN 0 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'info' END AS severity,
   ['platform', 'application', 'database', 'security', 'sre', 'other'][1 + event_id % 6] AS team FROM {BASE})"""


def routable(t):
    e = F.col("event_id")
    return base(t).select(
        "event_id", "timestamp", F.col("event_type").alias("alertname"), F.concat(F.lit("c"), (F.col("user_id") % 2).cast("string")).alias("cluster"), "service",
        F.when(e % 3 == 0, "critical").when(e % 3 == 1, "warning").otherwise("info").alias("severity"),
        F.array(*[F.lit(x) for x in TEAMS])[(e % 6).cast("int")].alias("team"))


ROUTED = f"""(SELECT event_id, timestamp, alertname, cluster, service, unnest(CASE WHEN severity = 'critical' THEN ['pagerduty-critical', 'slack-critical'] WHEN severity = 'warning' THEN ['slack-warnings']
   WHEN team != 'other' THEN ['team-' || team] ELSE ['slack-notifications'] END) AS receiver FROM {ROUTED_BASE})"""


@query("L08_route", f"SELECT event_id, receiver FROM {ROUTED}")
def route(t):
    return L.route(routable(t)).select("event_id", "receiver")


@query("L09_group_notifications", plain(f"""WITH r AS (SELECT *, epoch_us(timestamp) / 1e6 AS t, CASE WHEN receiver = 'slack-critical' THEN 15 ELSE 30 END AS w FROM {ROUTED}),
   g AS (SELECT receiver, alertname, cluster, service, min(t) + min(w) AS f FROM r GROUP BY ALL),
   s AS (SELECT receiver, alertname, cluster, service, f, greatest(0, ceil((t - f) / 21600))::BIGINT AS k, count(*)::BIGINT AS new_alerts FROM r JOIN g USING (receiver, alertname, cluster, service) GROUP BY ALL),
   x AS (SELECT *, unnest(generate_series(k, coalesce(lead(k) OVER (PARTITION BY receiver, alertname, cluster, service ORDER BY k) - 1, k), 4)) AS a FROM s)
   SELECT receiver, alertname, cluster, service, make_timestamp(((f + a * 21600) * 1000000)::BIGINT) AS sent_at, CASE WHEN a = k THEN new_alerts ELSE 0 END AS new_alerts, a != k AS repeated FROM x""", ts="sent_at"))
def group_notifications(t):
    rows = L.group_notifications(L.route(routable(t)), interval="6h", repeat="24h")
    return rows.withColumn("sent_at", F.timestamp_micros(F.unix_micros("sent_at")))


GRIDDED = "(SELECT DISTINCT alertname, cluster, service, 'default' AS namespace, severity, date_trunc('hour', timestamp) AS eval_ts FROM (SELECT * REPLACE (CASE alertname WHEN 'error' THEN 'ServiceDown' WHEN 'click' THEN 'PodNotReady' ELSE alertname END AS alertname) FROM {0}))".format(ROUTED_BASE)


@query("L10_inhibit", plain(f"""WITH a AS (SELECT * FROM {GRIDDED}) SELECT * FROM a WHERE NOT (severity = 'warning' AND EXISTS (SELECT 1 FROM a s WHERE s.severity = 'critical' AND s.alertname = a.alertname AND s.cluster = a.cluster AND s.service = a.service AND s.eval_ts = a.eval_ts))
   AND NOT (alertname = 'PodNotReady' AND EXISTS (SELECT 1 FROM a s WHERE s.alertname = 'ServiceDown' AND s.service = a.service AND s.namespace = a.namespace AND s.eval_ts = a.eval_ts))""", ts="eval_ts"))
def inhibit(t):
    names = F.when(F.col("alertname") == "error", "ServiceDown").when(F.col("alertname") == "click", "PodNotReady").otherwise(F.col("alertname"))
    rows = routable(t).select(names.alias("alertname"), "cluster", "service", F.lit("default").alias("namespace"), "severity", F.date_trunc("hour", "timestamp").alias("eval_ts")).distinct()
    return L.inhibit(rows)


ISSUES = ["high_request_rate", "api_abuse", "high_error_rate", "timeout", "unknown_issue"]


def issues(t):
    return base(t).select("event_id", F.array(*[F.lit(x) for x in ISSUES])[(F.col("event_id") % 5).cast("int")].alias("issue"))


PLANNED = """(SELECT event_id, (['high_request_rate', 'api_abuse', 'high_error_rate', 'timeout', 'unknown_issue'])[1 + event_id % 5] AS issue, (['scale_up_deployment', 'add_rate_limiting', 'restart_pod', 'circuit_breaker', NULL])[1 + event_id % 5] AS action,
   (['scale_up_deployment,add_rate_limiting', 'add_rate_limiting,block_ip', 'restart_pod', 'circuit_breaker', ''])[1 + event_id % 5] AS candidates, CASE WHEN event_id % 5 = 4 THEN 'No applicable remediation actions found' END AS message FROM events)"""


@query("L11_plan_remediation", f"SELECT * FROM {PLANNED}")
def plan_remediation(t):
    rows = R.plan_remediation(issues(t))
    return rows.select("event_id", "issue", "action", F.array_join("candidates", ",").alias("candidates"), "message")


@query("L12_needs_approval", f"""SELECT event_id, action, action IS NOT NULL AND action != 'circuit_breaker' AS allowed, CASE WHEN action = 'circuit_breaker' THEN 'Remediation action requires approval, but no approval callback registered' ELSE message END AS message FROM {PLANNED}""")
def needs_approval(t):
    approvals = t.events.select(F.when(F.col("event_type") == "view", "medium").otherwise("critical").alias("severity"), F.lit(True).alias("approved"))
    return R.needs_approval(R.plan_remediation(issues(t)), approvals).select("event_id", "action", "allowed", "message")


@query("L13_target_replicas", "SELECT event_id, (user_id % 12)::BIGINT AS replicas, greatest(user_id % 12, least(10, greatest(user_id % 12 + 1, floor((user_id % 12) * 1.5))))::BIGINT AS target FROM events")
def target_replicas(t):
    return t.events.select("event_id", (F.col("user_id") % 12).alias("replicas"), R.target_replicas(F.col("user_id") % 12).alias("target"))


@query("L14_rollback_plan", f"""SELECT 'rollback_scale_up_deployment' AS action, service, 'ns' AS namespace, (user_id % 5 + 2)::BIGINT AS current_replicas, (user_id % 5 + 1)::BIGINT AS rollback_replicas FROM {BASE} WHERE event_type IN ('view', 'click') AND event_id % 2 = 0""")
def rollback_plan(t):
    action = F.when(F.col("event_type").isin("view", "click"), "scale_up_deployment").otherwise("restart_pod")
    rows = base(t).select(action.alias("action"), "service", F.lit("ns").alias("namespace"), (F.col("user_id") % 5 + 2).alias("new_replicas"),
        (F.col("user_id") % 5 + 1).alias("previous_replicas"), (F.col("event_id") % 2 == 0).alias("success"), F.lit(None).cast("boolean").alias("dry_run"))
    return R.rollback_plan(rows)


@query("L15_circuit_state", f"""WITH RECURSIVE f AS (SELECT event_id, service, timestamp, row_number() OVER (PARTITION BY service ORDER BY timestamp, event_id) AS r FROM {BASE} WHERE event_type = 'error'),
   w AS (SELECT service, event_id, r, timestamp, 1 AS c, NULL::TIMESTAMP AS until, 'counted' AS breaker FROM f WHERE r = 1
     UNION ALL SELECT f.service, f.event_id, f.r, f.timestamp, CASE WHEN w.until IS NOT NULL AND f.timestamp < w.until THEN 0 WHEN w.until IS NOT NULL THEN 1 ELSE w.c + 1 END AS c2,
       CASE WHEN w.until IS NOT NULL AND f.timestamp < w.until THEN w.until WHEN w.until IS NULL AND w.c + 1 >= 3 THEN f.timestamp + INTERVAL 1 DAY END,
       CASE WHEN w.until IS NOT NULL AND f.timestamp < w.until THEN 'refused' WHEN w.until IS NULL AND w.c + 1 >= 3 THEN 'opened' ELSE 'counted' END FROM w JOIN f ON f.service = w.service AND f.r = w.r + 1)
   SELECT event_id, service, breaker FROM w""")
def circuit_state(t):
    failures = base(t).where("event_type = 'error'").select("event_id", "service", "timestamp")
    return R.circuit_state(failures, "service", "event_id", 3, "1d", "2d").drop("timestamp")


@query("L16_eject_outliers", plain(f"""WITH RECURSIVE r AS MATERIALIZED (SELECT service, timestamp, event_type IN ('error', 'view', 'click') AS bad, row_number() OVER (PARTITION BY service ORDER BY timestamp, event_id) AS i FROM {BASE}),
   w AS (SELECT DISTINCT service, 0::BIGINT AS i, NULL::TIMESTAMP AS timestamp, false AS out, []::TIMESTAMP[] AS held FROM r
     UNION ALL SELECT service, i, timestamp, out, CASE WHEN out THEN [] ELSE held END FROM (
       SELECT *, len(held) = 5 AND timestamp - held[1] <= INTERVAL 12 HOUR AS out FROM (
         SELECT r.service, r.i, r.timestamp, CASE WHEN bad THEN list_append(w.held, r.timestamp)[-5:] ELSE [] END AS held FROM w JOIN r ON r.service = w.service AND r.i = w.i + 1)))
   SELECT service, timestamp AS ejected_at, timestamp + INTERVAL 30 SECOND AS back_at FROM w WHERE out""", ts="ejected_at back_at"))
def eject_outliers(t):
    """Five errors in a row within the interval, then the count starts anew: against a walk over each service's requests."""
    rows = base(t).select("service", "timestamp", "event_id", F.when(F.col("event_type").isin("error", "view", "click"), 503).otherwise(200).alias("status_code"))
    return R.eject_outliers(rows, "service", ["event_id"], interval="12h")


@query("L17_health_state", f"""SELECT event_id, service, coalesce(last_value(turn IGNORE NULLS) OVER (PARTITION BY service ORDER BY timestamp, event_id), 'unknown') AS state FROM (
   SELECT *, CASE WHEN ok AND lag(ok) OVER w AND lag(ok, 2) OVER w THEN 'healthy' WHEN NOT ok AND NOT lag(ok) OVER w THEN 'unhealthy' END AS turn FROM (SELECT *, event_type NOT IN ('error', 'click') AS ok FROM {BASE}) WINDOW w AS (PARTITION BY service ORDER BY timestamp, event_id))""")
def health_state(t):
    probes = base(t).select("event_id", "service", "timestamp", (~F.col("event_type").isin("error", "click")).alias("ok"))
    return R.health_state(probes, "service", ["event_id"]).select("event_id", "service", "state")
