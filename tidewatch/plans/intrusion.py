"""Intrusion detection over the given tables."""

from pyspark.sql import functions as F

from tidewatch.operators import intrusion as N
from tidewatch.operators import tree_density
from tidewatch.operators.density import density_noise
from tidewatch.operators.prepare import apply_scaler, fit_scaler
from tidewatch.plans.catalog import plain, query

API = """(SELECT event_id AS request_id, ts AS timestamp, user_id::VARCHAR AS user_id, '10.0.' || (user_id % 4) || '.' || user_id AS ip_address, '/' || event_type AS endpoint, CASE WHEN user_id % 2 = 0 THEN 'GET' ELSE 'POST' END AS method,
   CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code, (props->>'$.k')::DOUBLE AS params_count, value AS response_time FROM events)"""
NETWORK = f"""(SELECT ip_address, date_trunc('day', timestamp) AS window_start, count(*)::BIGINT AS request_count, avg(response_time) AS response_time, avg((status_code >= 400)::INT) AS error_rate, count(DISTINCT endpoint)::BIGINT AS distinct_endpoints,
   avg(gap) AS avg_request_interval, max(gap) AS max_request_interval, min(gap) AS min_request_interval, stddev_samp(gap) AS std_request_interval
   FROM (SELECT *, (epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER (PARTITION BY ip_address ORDER BY timestamp, request_id)) / 1e6 AS gap FROM {API}) GROUP BY 1, 2)"""
NETWORK_NUMBERS = "response_time error_rate avg_request_interval max_request_interval min_request_interval std_request_interval"


@query("N01_network_features", plain(f"SELECT * FROM {NETWORK}", NETWORK_NUMBERS, "window_start", 5), digits=5)
def network_features(t):
    return N.network_features(t.api_calls(), "1d")


ACTIONS = {"view": "page_view", "error": "failed_login", "signup": "login", "click": "profile_change", "purchase": "password_change"}
ACTIVITY = "(SELECT user_id, ts AS timestamp, CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ACTIONS.items()) + " END AS action, event_id % 3 AS device FROM events)"
USER = f"""(WITH a AS (SELECT *, date_trunc('day', timestamp) AS window_start FROM {ACTIVITY}),
   c AS (SELECT user_id, window_start, count(*) FILTER (action = 'login')::BIGINT AS login_count, count(*) FILTER (action = 'page_view')::BIGINT AS page_views, count(*) FILTER (action = 'failed_login')::BIGINT AS failed_logins,
     count(*) FILTER (action = 'password_change')::BIGINT AS password_changes, count(*) FILTER (action = 'profile_change')::BIGINT AS profile_changes, 0::BIGINT AS unusual_activity_flags, count(DISTINCT device)::BIGINT AS distinct_devices,
     sum(hour(timestamp) + minute(timestamp) / 60) FILTER (action = 'login') AS hs, count(*) FILTER (action = 'login') AS ls FROM a GROUP BY 1, 2),
   m AS (SELECT user_id, timestamp, sum(fresh) OVER (PARTITION BY user_id ORDER BY timestamp) AS sid FROM (SELECT *, (lag(timestamp) OVER w IS NULL OR timestamp - lag(timestamp) OVER w >= INTERVAL 30 MINUTE)::INT AS fresh FROM a WINDOW w AS (PARTITION BY user_id ORDER BY timestamp))),
   s AS (SELECT user_id, sid, min(timestamp) AS b, max(timestamp) AS e FROM m GROUP BY 1, 2),
   g AS (SELECT user_id, date_trunc('day', b) AS window_start, (epoch_us(e) - epoch_us(b)) / 1e6 AS d, (epoch_us(b) - lag(epoch_us(e)) OVER (PARTITION BY user_id ORDER BY b)) / 1e6 AS gap FROM s),
   w AS (SELECT user_id, window_start, sum(d) AS session_duration, avg(gap) AS avg_session_interval, max(gap) AS max_session_interval, min(gap) AS min_session_interval, stddev_samp(gap) AS std_session_interval FROM g GROUP BY 1, 2)
   SELECT c.* EXCLUDE (hs, ls), abs(hs / ls - sum(hs) OVER (PARTITION BY user_id) / sum(ls) OVER (PARTITION BY user_id)) AS login_time_deviation,
     coalesce(date_diff('day', lag(window_start) OVER (PARTITION BY user_id ORDER BY window_start), window_start) - 1, 0) AS inactive_days, w.* EXCLUDE (user_id, window_start) FROM c LEFT JOIN w USING (user_id, window_start))"""
USER_NUMBERS = "login_time_deviation session_duration avg_session_interval max_session_interval min_session_interval std_session_interval"


def activity(t):
    action = F.col("event_type")
    names = F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv])
    return t.events.select("user_id", F.col("ts").alias("timestamp"), names[action].alias("action"), (F.col("event_id") % 3).alias("device"))


@query("N02_user_features", plain(f"SELECT * FROM {USER}", USER_NUMBERS, "window_start", 4), digits=4)
def user_features(t):
    return N.user_features(activity(t))


@query("N03_api_features", plain(f"""SELECT request_id, coalesce(params_count, 0) AS params_count, response_time, (endpoint = '/error')::BIGINT AS "endpoint_/error", (endpoint = '/purchase')::BIGINT AS "endpoint_/purchase", (endpoint = '/signup')::BIGINT AS "endpoint_/signup",
   (endpoint = '/view')::BIGINT AS "endpoint_/view", (method = 'POST')::BIGINT AS "method_POST", (status_code = 500)::BIGINT AS "status_code_500" FROM {API}""", "params_count response_time"))
def api_features(t):
    calls = t.api_calls()
    return N.api_features(calls, {"endpoint": ["/click", "/error", "/purchase", "/signup", "/view"], "method": ["GET", "POST"], "status_code": [200, 500]})


NET_FOUND = f"""(SELECT 'network_anomaly' AS type, ip_address AS source_ip, window_start AS timestamp, s AS anomaly_score,
   CASE WHEN ip_address IN ('10.0.1.5', '10.0.2.10') THEN 'blacklisted_ip' WHEN request_count > 5 THEN 'rate_limiting_violation' ELSE 'unusual_traffic_pattern' END AS attack_type,
   CASE WHEN ip_address IN ('10.0.1.5', '10.0.2.10') THEN 'critical' WHEN request_count > 5 THEN 'high' ELSE 'medium' END AS severity FROM (SELECT *, 1 - (-request_count / 10 + 0.5) / 2 AS s FROM {NETWORK}) WHERE request_count > 3 AND s >= 0.95)"""


def found_network(t):
    rows = N.network_features(t.api_calls(), "1d").withColumn("decision", -F.col("request_count") / 10)
    rows = rows.withColumn("label", F.when(F.col("request_count") > 3, -1).otherwise(1))
    return N.detect_network(rows, ["10.0.1.5", "10.0.2.10"], max_rate=5)


@query("N04_detect_network", plain(f"SELECT * FROM {NET_FOUND}", "anomaly_score", "timestamp"))
def detect_network(t):
    return found_network(t)


USER_FOUND = f"""(SELECT 'user_anomaly' AS type, user_id, window_start AS timestamp, least(1, failed_logins / 2) AS anomaly_score, CASE WHEN failed_logins > 2 THEN 'brute_force_attempt' ELSE 'unusual_user_behavior' END AS attack_type,
   CASE WHEN user_id % 7 = 0 AND (user_id % 100) / 100.0 > 0.8 THEN 'critical' WHEN failed_logins > 2 THEN 'high' ELSE 'medium' END AS severity FROM {USER} WHERE least(1, failed_logins / 2) >= 0.95)"""


def found_user(t):
    rows = N.user_features(activity(t)).withColumn("probability", F.least(F.lit(1.0), F.col("failed_logins") / 2))
    risk = t.events.where(F.col("user_id") % 7 == 0).select("user_id", ((F.col("user_id") % 100) / 100.0).alias("risk")).distinct()
    return N.detect_user(rows, risk, max_failed=2)


@query("N05_detect_user", plain(f"SELECT * FROM {USER_FOUND}", "anomaly_score", "timestamp"))
def detect_user(t):
    return found_user(t)


def noise_sql(points, key, dims, eps, least):
    near = " + ".join(f"(a.{d} - b.{d}) * (a.{d} - b.{d})" for d in dims)
    return f"""(WITH pts AS MATERIALIZED {points}, near AS MATERIALIZED (SELECT a.{key} AS p, b.{key} AS q FROM pts a JOIN pts b ON abs(a.{dims[0]} - b.{dims[0]}) <= {eps} AND {near} <= {eps} * {eps}),
      core AS (SELECT p FROM near GROUP BY 1 HAVING count(*) >= {least}), ok AS (SELECT DISTINCT near.p FROM near JOIN core ON near.q = core.p)
      SELECT {key} FROM pts WHERE {key} NOT IN (SELECT p FROM ok))"""


# All 64 components, as the sums of three stretches of them.
STRETCHES = ((1, 21), (22, 42), (43, 64))
SCALED = "(SELECT vec_id, " + ", ".join(f"(x{i} - avg(x{i}) OVER ()) / stddev_pop(x{i}) OVER () AS x{i}" for i in range(3)) + " FROM (SELECT vec_id, " + ", ".join(
    f"list_sum(list_transform(embedding[{a}:{b}], lambda x: x::DOUBLE)) AS x{i}" for i, (a, b) in enumerate(STRETCHES)) + " FROM embeddings))"


@query("N06_density_noise", f"SELECT vec_id FROM {noise_sql(SCALED, 'vec_id', ['x0', 'x1', 'x2'], 0.5, 5)}")
def density(t):
    """The vectors projected to three dimensions: density needs few of them."""
    dims = ["x0", "x1", "x2"]
    total = lambda a, b: F.aggregate(F.slice("embedding", a, b - a + 1), F.lit(0.0), lambda s, x: s + x.cast("double"))
    rows = t.embeddings.select("vec_id", *[total(*ends).alias(d) for d, ends in zip(dims, STRETCHES)])
    return density_noise(apply_scaler(rows, dims, fit_scaler(rows, dims)), "vec_id", dims).select("vec_id")


@query("N06_density_noise_vectors", """WITH pts AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), near AS MATERIALIZED (SELECT a.vec_id AS p, b.vec_id AS q FROM pts a JOIN pts b ON list_distance(a.v, b.v) <= 1.14),
   core AS (SELECT p FROM near GROUP BY 1 HAVING count(*) >= 5), ok AS (SELECT DISTINCT near.p FROM near JOIN core ON near.q = core.p)
   SELECT vec_id FROM pts WHERE vec_id NOT IN (SELECT p FROM ok)""")
def density_vectors(t):
    """All components as they are: leaves of a tree of boxes instead of a grid."""
    return tree_density.noise_keys(t.embeddings, "vec_id", "embedding", 1.14, 5, leaf=256)


API_SCALED = f"(SELECT request_id, (params_count - avg(params_count) OVER ()) / stddev_pop(params_count) OVER () AS a, (response_time - avg(response_time) OVER ()) / stddev_pop(response_time) OVER () AS b FROM {API})"
API_FOUND = f"""(SELECT 'api_anomaly' AS type, ip_address AS source_ip, user_id, endpoint, method, timestamp, 0.9 AS anomaly_score, CASE WHEN endpoint LIKE '%login%' OR endpoint LIKE '%auth%' THEN 'authentication_anomaly' WHEN endpoint LIKE '%admin%' THEN 'admin_access_anomaly' ELSE 'unusual_api_pattern' END AS attack_type,
   CASE WHEN endpoint LIKE '%login%' OR endpoint LIKE '%auth%' THEN 'high' WHEN endpoint LIKE '%admin%' THEN 'critical' ELSE 'medium' END AS severity, request_id
   FROM (SELECT * REPLACE (CASE WHEN endpoint = '/signup' THEN '/Login' WHEN endpoint = '/error' THEN '/admin' ELSE endpoint END AS endpoint) FROM {API}) WHERE request_id IN {noise_sql(API_SCALED, 'request_id', ['a', 'b'], 0.3, 5)})""".replace("endpoint LIKE", "lower(endpoint) LIKE")


def found_api(t):
    path = F.when(F.col("endpoint") == "/signup", "/Login").when(F.col("endpoint") == "/error", "/admin").otherwise(F.col("endpoint"))
    return N.detect_api(t.api_calls().withColumn("endpoint", path), ["params_count", "response_time"], eps=0.3)


@query("N07_detect_api", plain(f"SELECT * FROM {API_FOUND}", "anomaly_score", "timestamp"))
def detect_api(t):
    return found_api(t)


REQUESTS = """(SELECT event_id AS request_id, '/' || CASE event_type WHEN 'signup' THEN 'login' WHEN 'view' THEN 'file' ELSE event_type END AS endpoint, CASE WHEN user_id % 2 = 0 THEN 'GET' ELSE 'POST' END AS method,
   CASE WHEN event_id % 4 = 0 THEN 'id=1''OR 1=1' WHEN event_id % 4 = 1 THEN 'q=<script>' WHEN event_id % 4 = 2 THEN 'p=../../../etc' END AS request_params, (event_id % 9)::BIGINT AS failed_attempts,
   CASE WHEN event_id % 50 = 0 THEN 2000 ELSE 10 END AS request_count, (user_id % 20)::BIGINT AS distinct_endpoints, CASE WHEN event_id % 100 != 0 THEN 60 END AS time_window_seconds FROM events)"""


def found_signatures(t):
    e = F.col("event_id")
    path = F.when(F.col("event_type") == "signup", "login").when(F.col("event_type") == "view", "file").otherwise(F.col("event_type"))
    params = F.when(e % 4 == 0, "id=1'OR 1=1").when(e % 4 == 1, "q=<script>").when(e % 4 == 2, "p=../../../etc")
    rows = t.events.select(e.alias("request_id"), F.concat(F.lit("/"), path).alias("endpoint"), F.when(F.col("user_id") % 2 == 0, "GET").otherwise("POST").alias("method"),
        params.alias("request_params"), (e % 9).alias("failed_attempts"), F.when(e % 50 == 0, 2000).otherwise(10).alias("request_count"), (F.col("user_id") % 20).alias("distinct_endpoints"), F.when(e % 100 != 0, 60).alias("time_window_seconds"))
    return N.match_signatures(rows).select("type", "request_id", "attack_name", "severity")


SIGNED = f"""(SELECT 'signature_attack' AS type, request_id, 'sql_injection' AS attack_name, 'critical' AS severity FROM {REQUESTS} WHERE contains(request_params, '''OR 1=1') AND contains(endpoint, 'login') AND method = 'POST'
   UNION ALL SELECT 'signature_attack', request_id, 'xss_attack', 'high' FROM {REQUESTS} WHERE contains(request_params, '<script>') AND method = 'POST'
   UNION ALL SELECT 'signature_attack', request_id, 'path_traversal', 'critical' FROM {REQUESTS} WHERE contains(request_params, '../../../') AND contains(endpoint, 'file')
   UNION ALL SELECT 'signature_attack', request_id, 'brute_force', 'high' FROM {REQUESTS} WHERE contains(endpoint, 'login') AND method = 'POST' AND failed_attempts >= 5
   UNION ALL SELECT 'signature_attack', request_id, 'ddos_attack', 'critical' FROM {REQUESTS} WHERE request_count >= 1000 AND distinct_endpoints >= 10 AND time_window_seconds IS NOT NULL)"""


@query("N08_match_signatures", f"SELECT * FROM {SIGNED}")
def match_signatures(t):
    return found_signatures(t)


@query("N09_all_intrusions", f"""SELECT type, severity, count(*)::BIGINT AS n FROM (SELECT type, severity FROM {NET_FOUND} UNION ALL SELECT type, severity FROM {USER_FOUND} UNION ALL SELECT type, severity FROM {API_FOUND} UNION ALL SELECT type, severity FROM {SIGNED}) GROUP BY 1, 2""")
def all_intrusions(t):
    rows = N.all_intrusions(found_network(t), found_user(t).withColumn("user_id", F.col("user_id").cast("string")), found_api(t), found_signatures(t))
    return rows.groupBy("type", "severity").agg(F.count("*").alias("n"))


@query("N10_update_blacklist_risk", plain("""SELECT b.ip_address, r.risk FROM (SELECT DISTINCT '10.0.' || (user_id % 4) || '.' || user_id AS ip_address, user_id FROM events WHERE event_type = 'error' OR value > 200) b
   JOIN (SELECT user_id, arg_max(value / 500, ts) AS risk FROM events GROUP BY 1) r USING (user_id)""", "risk"))
def update_blacklist_risk(t):
    ip = F.concat(F.lit("10.0."), (F.col("user_id") % 4).cast("string"), F.lit("."), F.col("user_id").cast("string")).alias("ip_address")
    blocked = N.update_blacklist(t.events.where("event_type = 'error'").select(ip), t.events.where("value > 200").select(ip))
    writes = t.events.select("user_id", (F.col("value") / 500).alias("risk"), F.col("ts").alias("timestamp"))
    half = F.lit("2024-01-15").cast("timestamp")
    risk = N.update_user_risk(writes.where(F.col("timestamp") < half), writes.where(F.col("timestamp") >= half))
    user = F.element_at(F.split("ip_address", r"\."), -1).cast("long")
    return blocked.withColumn("user_id", user).join(risk, "user_id").select("ip_address", "risk")


@query("N11_ip_rate_limit", plain(f"""WITH RECURSIVE c AS (SELECT ip_address, floor(epoch_us(timestamp) / 21600000000)::BIGINT AS tick, count(*)::DOUBLE AS n, row_number() OVER (PARTITION BY ip_address ORDER BY tick) AS r FROM {API} GROUP BY 1, 2),
   s AS (SELECT ip_address, tick, r, n, greatest(0, n - 1 - 3) AS refused, least(3, greatest(0, n - 1)) AS level FROM c WHERE r = 1
     UNION ALL SELECT c.ip_address, c.tick, c.r, c.n, greatest(0, greatest(0, s.level - (c.tick - s.tick - 1)) + c.n - 1 - 3), least(3, greatest(0, greatest(0, s.level - (c.tick - s.tick - 1)) + c.n - 1)) FROM s JOIN c ON c.ip_address = s.ip_address AND c.r = s.r + 1)
   SELECT ip_address, make_timestamp(tick * 21600000000) AS window_start, n::BIGINT AS requests, refused, level, CASE WHEN refused > 0 THEN 429 ELSE 200 END::BIGINT AS status FROM s""", "refused level", "window_start"))
def ip_rate_limit(t):
    return N.ip_rate_limit(t.api_calls(), rate=1, burst=3, unit="6h")


@query("N12_flow_rollup", plain(f"SELECT ip_address, endpoint, date_trunc('minute', timestamp) AS window_start, count(*)::BIGINT AS flows, sum(response_time) AS response_time FROM {API} GROUP BY 1, 2, 3", "response_time", "window_start"))
def flow_rollup(t):
    return N.flow_rollup(t.api_calls(), ["ip_address", "endpoint"], "60s", ["response_time"])
