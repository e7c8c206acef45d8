"""Edge fleet and load tests over the given tables."""

from pyspark.sql import functions as F

from tidewatch.functions.hashing import cohort, fnv1a32
from tidewatch.operators import fleet as E
from tidewatch.operators import loadtest as B
from tidewatch.plans.catalog import plain, query
from tidewatch.session import scratch_path
from tidewatch.plans.selectors import COHORT, FNV


@query("E01_cohort", f"SELECT c_name, {FNV.format('c_name')} AS hash, {COHORT.format('c_name')} AS cohort FROM customer")
def device_cohort(t):
    return t.customer.select("c_name", fnv1a32(F.col("c_name")).alias("hash"), cohort(F.col("c_name")).alias("cohort"))


def rollouts(t):
    """One roll-out per nation: odd ones run, every tenth is for everyone, the rest for one segment; two phases each."""
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    k = F.col("n_nationkey")
    phase = lambda name, pct, ask, ok: F.struct(F.lit(name).alias("id"), pct.cast("double").alias("percentage"), F.lit("1h").alias("duration"), F.lit(ask).alias("require_approval"),
        ok.alias("approved"), F.array(F.lit("latency")).alias("metrics"), F.create_map(F.lit("latency"), F.lit(60.0), F.lit("error_rate"), F.lit(0.25)).alias("thresholds"))
    return t.read("nation").select(
        F.format_string("r%02d", k).alias("id"), F.concat(F.lit("v"), (k % 3).cast("string")).alias("version"), F.when(k % 2 == 1, "in-progress").otherwise("pending").alias("status"),
        F.when(k % 10 == 9, F.array(F.lit("all"))).otherwise(F.array(F.array(*[F.lit(s) for s in segments])[(k % 5).cast("int")])).alias("target_groups"),
        (k % 3).cast("int").alias("current_phase"), F.array(phase("p0", k * 4, False, F.lit(False)), phase("p1", F.lit(50), True, k % 4 == 1)).alias("phases"), F.sha2("n_name", 256).alias("package_hash"))


RUNNING = """(SELECT printf('r%02d', n_nationkey) AS id, 'v' || (n_nationkey % 3) AS version, n_nationkey AS k, CASE WHEN n_nationkey % 10 = 9 THEN 'all' ELSE (['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'])[1 + n_nationkey % 5] END AS grp FROM nation WHERE n_nationkey % 2 = 1)"""
TARGETED = f"(SELECT c_name AS device_id, 'v' || (c_custkey % 3) AS current_version, c_mktsegment AS device_group, r.* FROM customer JOIN {RUNNING} r ON grp = 'all' OR grp = c_mktsegment QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY id) = 1)"


@query("E02_active_rollout", f"SELECT device_id, device_group, id AS rollout_id, version FROM {TARGETED}")
def active_rollout(t):
    return E.active_rollout(t.devices(), rollouts(t)).select("device_id", "device_group", F.col("rollout.id").alias("rollout_id"), F.col("rollout.version").alias("version"))


@query("E03_eligible_devices", f"""SELECT device_id, id AS rollout_id, 'p' || (k % 3) AS phase_id, {COHORT.format('device_id')} AS cohort FROM {TARGETED}
   WHERE current_version != version AND k % 3 < 2 AND (k % 3 = 0 OR k % 4 = 1) AND {COHORT.format('device_id')} <= CASE WHEN k % 3 = 0 THEN k * 4 ELSE 50 END""")
def eligible_devices(t):
    rows = E.eligible_devices(E.active_rollout(t.devices(), rollouts(t)))
    return rows.select("device_id", F.col("rollout.id").alias("rollout_id"), "phase_id", "cohort")


@query("E04_phase_gate", """WITH m AS (SELECT printf('r%02d', user_id % 25) AS rollout_id, ts, CASE WHEN event_id % 2 = 0 THEN 'latency' ELSE 'error_rate' END AS metric, CASE WHEN event_id % 2 = 0 THEN value ELSE value / 400 END AS value FROM events),
   p AS (SELECT printf('r%02d', n_nationkey) AS rollout_id, TIMESTAMP '2024-01-05' + n_nationkey * INTERVAL 1 HOUR AS start FROM nation),
   x AS (SELECT rollout_id, l.metric, mx, count(m.ts) FILTER (m.ts >= start AND m.ts <= start + INTERVAL 6 HOUR) AS seen, count(m.ts) FILTER (m.ts >= start AND m.ts <= start + INTERVAL 6 HOUR AND value > mx) AS over
     FROM (SELECT * FROM p, (VALUES ('latency', 60.0), ('error_rate', 0.25)) l(metric, mx)) l LEFT JOIN m USING (rollout_id, metric) GROUP BY 1, 2, 3)
   SELECT rollout_id, bool_and(seen > 0 AND over = 0) AS may_advance, coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (NOT (seen > 0 AND over = 0)), '') AS failing FROM x GROUP BY 1""")
def phase_gate(t):
    first = rollouts(t).select(F.col("id").alias("rollout_id"), F.inline("phases")).where("id = 'p0'")
    phases = first.select("rollout_id", F.col("id").alias("phase_id"), "thresholds", F.lit("6h").alias("duration"),
        F.timestamp_micros(F.unix_micros(F.lit("2024-01-05").cast("timestamp")) + F.substring("rollout_id", 2, 2).cast("long") * 3_600_000_000).alias("start"))
    measured = t.events.select(F.format_string("r%02d", F.col("user_id") % 25).alias("rollout_id"), F.col("ts").alias("timestamp"),
        F.when(F.col("event_id") % 2 == 0, "latency").otherwise("error_rate").alias("metric"), F.when(F.col("event_id") % 2 == 0, F.col("value")).otherwise(F.col("value") / 400).alias("value"))
    return E.phase_gate(phases, measured).select("rollout_id", "may_advance", F.array_join("failing", ",").alias("failing"))


UPDATES = "(SELECT 'r' || (user_id % 4) AS rollout_id, 'd' || user_id AS device_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'pending' ELSE 'success' END AS status, 'm' || event_id AS message, ts AS timestamp FROM events)"


@query("E05_rollout_status", plain(f"""SELECT rollout_id, count(*)::BIGINT AS devices, count(*) FILTER (s = 'success')::BIGINT AS succeeded, count(*) FILTER (s = 'failed')::BIGINT AS failed, arg_max(m, t) AS last_message, max(t) AS last_time
   FROM (SELECT rollout_id, device_id, arg_max(status, timestamp) AS s, arg_max(message, timestamp) AS m, max(timestamp) AS t FROM {UPDATES} GROUP BY 1, 2) GROUP BY 1""", ts="last_time"))
def rollout_status(t):
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "pending").otherwise("success")
    return E.rollout_status(t.events.select(F.concat(F.lit("r"), (F.col("user_id") % 4).cast("string")).alias("rollout_id"), F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("device_id"),
        status.alias("status"), F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("message"), F.col("ts").alias("timestamp")))


def writes(t, kinds):
    return t.events.where(F.col("event_type").isin(kinds)).select(F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("device_id"), F.concat(F.lit("k"), (F.col("event_id") % 3).cast("string")).alias("key"),
        F.col("event_type").alias("data_type"), F.col("event_id").cast("string").alias("data"), F.col("event_id").cast("string").alias("value"), F.col("ts").alias("timestamp"))


WRITES = "(SELECT 'd' || user_id AS device_id, 'k' || (event_id % 3) AS key, event_type AS data_type, event_id::VARCHAR AS data, ts AS timestamp FROM events WHERE event_type IN ({0}))"


@query("E06_merge_changes", f"""SELECT device_id, key, arg_max(data, (r, timestamp)) AS data, 'devices/' || device_id || '/data/' || key AS path FROM (SELECT device_id, CASE WHEN key = 'k0' THEN 'click/k0' ELSE key END AS key, data, timestamp, 0 AS r FROM {WRITES.format("'view', 'error'")}
   UNION ALL SELECT device_id, data_type || '/' || key, data, timestamp, 1 FROM {WRITES.format("'click'")}) GROUP BY 1, 2""")
def merge_changes(t):
    pending = writes(t, ["view", "error"]).withColumn("key", F.when(F.col("key") == "k0", "click/k0").otherwise(F.col("key")))
    return E.merge_changes(pending, writes(t, ["click"])).drop("timestamp")


@query("E07_incremental_updates", plain(f"""SELECT device_id, key, data_type, timestamp FROM {WRITES.format("'view', 'purchase'")} LEFT JOIN (SELECT 'd' || user_id AS device_id, max(ts) AS last_sync FROM events WHERE event_type = 'error' AND user_id % 5 != 0 GROUP BY 1) USING (device_id) WHERE last_sync IS NULL OR timestamp > last_sync""", ts="timestamp"))
def incremental_updates(t):
    manifests = writes(t, ["view", "purchase"]).groupBy("device_id", F.to_date("timestamp").alias("d")).agg(F.collect_list(F.struct("key", "timestamp", "data_type")).alias("updates")).drop("d")
    last = t.events.where("event_type = 'error' AND user_id % 5 != 0").groupBy(F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("device_id")).agg(F.max("ts").alias("last_sync"))
    return E.incremental_updates(manifests, last)


SIDES = "(SELECT device_id, key, arg_max(data_type, timestamp) AS data_type, arg_max(data, timestamp) AS value, max(timestamp) AS timestamp FROM {0} GROUP BY 1, 2)"


def last_write(rows):
    return rows.groupBy("device_id", "key").agg(F.max_by("data_type", "timestamp").alias("data_type"), F.max_by("value", "timestamp").alias("value"), F.max("timestamp").alias("timestamp"))


@query("E08_resolve_conflicts", f"""SELECT device_id, key, coalesce(l.data_type, r.data_type) AS data_type, CASE WHEN r.timestamp IS NULL THEN l.value WHEN l.timestamp IS NULL THEN r.value WHEN l.data_type = 'view' THEN r.value WHEN l.timestamp >= r.timestamp THEN l.value ELSE r.value END AS value,
   l.timestamp IS NOT NULL AND r.timestamp IS NOT NULL AS conflict FROM {SIDES.format(WRITES.format("'view', 'error'"))} l FULL JOIN {SIDES.format(WRITES.format("'click'"))} r USING (device_id, key)""")
def resolve_conflicts(t):
    return E.resolve_conflicts(last_write(writes(t, ["view", "error"])), last_write(writes(t, ["click"])), {"default": "newest", "view": "remote"})


@query("E09_read_through", """WITH k AS (SELECT DISTINCT user_id AS key FROM events), p AS (SELECT user_id AS key, arg_max(event_id, ts)::VARCHAR AS v FROM events WHERE event_type = 'error' AND value > 80 GROUP BY 1), s AS (SELECT user_id AS key, arg_max(event_id, ts)::VARCHAR AS v FROM events WHERE event_type = 'view' AND value > 60 GROUP BY 1),
   c AS (SELECT user_id AS key, arg_max(event_id, ts)::VARCHAR AS v FROM events WHERE value > 100 GROUP BY 1) SELECT key, coalesce(p.v, s.v, c.v) AS value, CASE WHEN p.v IS NOT NULL THEN 'pending' WHEN s.v IS NOT NULL THEN 'store' WHEN c.v IS NOT NULL THEN 'cache' END AS origin FROM k LEFT JOIN p USING (key) LEFT JOIN s USING (key) LEFT JOIN c USING (key)""")
def read_through(t):
    last = lambda cond: t.events.where(cond).groupBy(F.col("user_id").alias("key")).agg(F.max_by(F.col("event_id"), F.col("ts")).cast("string").alias("value"))
    keys = t.events.select(F.col("user_id").alias("key")).distinct()
    return E.read_through(keys, last("event_type = 'error' AND value > 80"), last("event_type = 'view' AND value > 60"), last("value > 100"))


@query("E10_sync_status", plain("""SELECT c_name AS device_id, last_sync, coalesce(online, false) AS online, coalesce(n, 0)::BIGINT AS pending_changes FROM customer LEFT JOIN (SELECT user_id, max(ts) AS last_sync, arg_max(event_type != 'error', ts) AS online FROM events WHERE event_type != 'click' GROUP BY 1) s ON s.user_id = c_custkey
   LEFT JOIN (SELECT user_id, count(DISTINCT event_id % 3) AS n FROM events WHERE event_type = 'click' GROUP BY 1) p ON p.user_id = c_custkey""", ts="last_sync"))
def sync_status(t):
    name = F.format_string("Customer#%09d", F.col("user_id")).alias("device_id")
    pending = t.events.where("event_type = 'click'").select(name, (F.col("event_id") % 3).alias("key"))
    syncs = t.events.where("event_type != 'click'").select(name, F.col("ts").alias("timestamp"), (F.col("event_type") != "error").alias("online"))
    return E.sync_status(t.devices(), pending, syncs)


@query("E11_verify_packages", "SELECT doc_id, sha256(text) AS actual_hash, doc_id % 10 != 0 AS accepted FROM documents")
def verify_packages(t):
    digest = F.when(F.col("doc_id") % 10 == 0, F.sha2("lang", 256)).otherwise(F.upper(F.sha2("text", 256)))
    rows = t.documents.select("doc_id", F.encode("text", "UTF-8").alias("content"), digest.alias("package_hash"))
    return E.verify_packages(rows).select("doc_id", "actual_hash", "accepted")


@query("E11_verify_package_files", """SELECT source AS package, sha256(string_agg(replace(text, chr(10), ' '), chr(10) ORDER BY doc_id) || chr(10)) AS actual_hash, source != 'src3' AS accepted FROM documents GROUP BY source""")
def verify_package_files(t):
    """A package of files per source, written, read again and checked; the third source's expected hash is wrong."""
    root = scratch_path(t.spark, "packages")
    lines = t.documents.where("text IS NOT NULL").select("doc_id", F.col("source").alias("package"), F.translate("text", "\n", " ").alias("line"))
    E.write_packages(lines, root, "doc_id")
    told = E.package_hashes(lines.withColumn("content", F.encode(F.concat("line", F.lit("\n")), "UTF-8")), "doc_id")
    expected = told.select("package", F.when(F.col("package") == "src3", "0").otherwise(F.col("hash")).alias("package_hash"))
    found = E.package_hashes(E.read_packages(t.spark, root), "place").withColumnRenamed("hash", "actual_hash")
    return E.verify_hashes(found.join(expected, "package")).select("package", "actual_hash", "accepted")


@query("E12_last_good_version", plain("""SELECT environment, version, timestamp FROM (SELECT 'env-' || (user_id % 20) AS environment, 'v' || event_id AS version, ts AS timestamp, row_number() OVER (PARTITION BY user_id % 20 ORDER BY ts DESC) AS r FROM events WHERE event_type = 'purchase') WHERE r = 2""", ts="timestamp"))
def last_good_version(t):
    rows = t.events.select(F.concat(F.lit("env-"), (F.col("user_id") % 20).cast("string")).alias("environment"), F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("version"),
        F.col("ts").alias("timestamp"), F.when(F.col("event_type") == "purchase", "succeeded").otherwise("failed").alias("result"))
    return E.last_good_version(rows).drop("result")


POINTS = "(SELECT (['anomaly_detection', 'root_cause_analysis', 'predictive_alerting', 'dashboard_load'])[1 + user_id % 4] AS scenario, value * 10 AS latency_ms, event_type = 'error' AS failed FROM events)"
SUMMARY = f"""(SELECT scenario, avg(latency_ms) AS avg, min(latency_ms) AS min, max(latency_ms) AS max, count(*)::BIGINT AS requests, avg(failed::INT) AS error_rate, quantile_cont(latency_ms, 0.5) AS med, quantile_cont(latency_ms, 0.9) AS p90,
   quantile_cont(latency_ms, 0.95) AS p95, quantile_cont(latency_ms, 0.99) AS p99 FROM {POINTS} GROUP BY 1)"""
NUMBERS = "avg min max error_rate med p90 p95 p99"


def summary(t):
    names = F.array(*[F.lit(s) for s in B.SCENARIOS])
    return B.summarise_load(t.events.select(names[(F.col("user_id") % 4).cast("int")].alias("scenario"), (F.col("value") * 10).alias("latency_ms"), (F.col("event_type") == "error").alias("failed")))


@query("B01_summarise_load", plain(f"SELECT * FROM {SUMMARY}", NUMBERS))
def summarise_load(t):
    return summary(t)


@query("B02_latest_run", plain("""SELECT scenario, timestamp, CASE WHEN own THEN v ELSE 2 * v END AS p95 FROM (SELECT (['anomaly_detection', 'root_cause_analysis', 'predictive_alerting', 'dashboard_load'])[1 + user_id % 4] AS scenario, max(ts) AS timestamp, arg_max(value, ts) AS v, arg_max(event_id % 2 = 0, ts) AS own FROM events GROUP BY 1)""", "p95", "timestamp"))
def latest_run(t):
    names = F.array(*[F.lit(s) for s in B.SCENARIOS])
    scenario = names[(F.col("user_id") % 4).cast("int")]
    stats = lambda c: F.struct(c.alias("p95"))
    metrics = F.map_filter(F.create_map(F.concat(scenario, F.lit("_latency")), F.when(F.col("event_id") % 2 == 0, stats(F.col("value"))), F.lit("http_req_duration"), stats(F.col("value") * 2)), lambda _, v: v.isNotNull())
    rows = t.events.select(scenario.alias("scenario"), F.col("ts").alias("timestamp"), metrics.alias("metrics"))
    return B.latest_run(rows).select("scenario", "timestamp", F.col("latency.p95").alias("p95"))


@query("B03_check_thresholds", plain(f"""SELECT scenario, p95, error_rate, lim AS p95_limit, p95 < lim AS latency_ok, error_rate < 0.1 AS errors_ok FROM {SUMMARY} JOIN (VALUES ('anomaly_detection', 500.0), ('root_cause_analysis', 1000.0), ('predictive_alerting', 2000.0), ('dashboard_load', 3000.0)) l(scenario, lim) USING (scenario)""", "p95 error_rate p95_limit"))
def check_thresholds(t):
    return B.check_thresholds(summary(t)).select("scenario", "p95", "error_rate", "p95_limit", "latency_ok", "errors_ok")
