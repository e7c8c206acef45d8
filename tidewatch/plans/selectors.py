"""Selectors, relabelling, projections and scalar functions over the given tables."""

from pyspark.sql import functions as F

from tidewatch.functions import labels as L
from tidewatch.functions.hashing import cohort
from tidewatch.operators import fraud, quantiles
from tidewatch.operators import selectors as S
from tidewatch.plans.catalog import plain, query

SVC = "'svc-' || (user_id % 10)"
STATUS = "CASE WHEN event_type = 'error' THEN '500' ELSE '200' END"
LOGS = f"""(SELECT event_id AS log_id, ts + INTERVAL 500 MILLISECOND AS timestamp,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' WHEN 'view' THEN 'DEBUG' WHEN 'click' THEN 'TRACE' ELSE 'INFO' END AS level,
  'traceID=' || md5(user_id || '-' || strftime(ts, '%Y%m%d')) || ' ' || event_type || ' took ' || value || ' password=hunter' || user_id || ' user=u' || user_id AS message,
  {SVC} AS service, md5(user_id || '-' || strftime(ts, '%Y%m%d')) AS trace_id, event_id AS span_id, props FROM events)"""
FNV = (
    "list_reduce(list_transform(string_split({0}, ''), lambda c: ord(c)::BIGINT), "
    "lambda h, c: (xor(h, c) * 16777619) % 4294967296, 2166136261::BIGINT)"
)
COHORT = "(" + FNV + " % 100)"


@query("R01_match_labels", plain(
    f"""SELECT event_id, event_type, {SVC} AS service, value FROM events
    WHERE regexp_full_match(event_type, '(view|click|pur).*') AND {SVC} != 'svc-3' AND ({STATUS}) = '200'""", "value"))
def match_labels(t):
    df = t.events.withColumn("service", F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string"))).withColumn(
        "status", F.when(F.col("event_type") == "error", "500").otherwise("200"))
    df = S.match(S.match(S.match(df, "event_type", "=~", "(view|click|pur).*"), "service", "!=", "svc-3"), "status", "=", "200")
    return df.select("event_id", "event_type", "service", "value")


@query("R02_relabel_keep_drop", plain(
    f"""SELECT name, service, count(*)::BIGINT AS n FROM (
      SELECT unnest(['http_requests_total', 'http_request_duration_seconds', 'up']) AS name, {SVC} AS service,
        'job-' || (user_id % 3) AS job FROM events)
    WHERE regexp_full_match(job || ';' || service, 'job-[01];svc-[1-5]') AND NOT regexp_full_match(name, 'up|scrape_.*')
    GROUP BY ALL"""))
def relabel_keep_drop(t):
    df = S.relabel_drop(S.relabel_keep(t.labelled(), ["job", "service"], "job-[01];svc-[1-5]"), ["name"], "up|scrape_.*")
    return df.groupBy("name", F.col("labels")["service"].alias("service")).agg(F.count("*").alias("n"))


@query("R03_relabel_replace",
    """SELECT page_id, url, CASE WHEN regexp_full_match(url || ';' || page_id, '[a-z]+://([^/:]+)(?::\\d+)?/.*;(\\d*[02468])')
      THEN regexp_replace(url || ';' || page_id, '^(?:[a-z]+://([^/:]+)(?::\\d+)?/.*;(\\d*[02468]))$', '\\1:\\2') ELSE NULL END AS address FROM pages""")
def relabel_replace(t):
    df = t.pages.select("page_id", "url", F.col("page_id").cast("string").alias("port"))
    return S.relabel_replace(df, ["url", "port"], "address", r"[a-z]+://([^/:]+)(?::\d+)?/.*;(\d*[02468])", "${1}:$2").drop("port")


@query("R04_labelmap", f"""SELECT event_id, 'app=' || {SVC} || ',kind=' || event_type AS labels FROM events""")
def labelmap(t):
    labels = F.create_map(
        F.lit("__meta_kubernetes_pod_label_app"), F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string")),
        F.lit("__meta_kubernetes_pod_label_kind"), F.col("event_type"))
    df = t.events.select("event_id", L.labelmap(labels, "__meta_kubernetes_pod_label_(.+)").alias("labels"))
    text = F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return df.select("event_id", F.array_join(text, ",").alias("labels"))


@query("R05_attribute_actions",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'staging' ELSE 'production' END AS environment,
       'v' || (user_id % 4) AS version, 'eu' AS region FROM events""")
def attribute_actions(t):
    attrs = F.when(F.col("event_id") % 3 == 0, F.create_map(F.lit("environment"), F.lit("staging"), F.lit("service.version"), F.lit("old"))
        ).otherwise(F.create_map(F.lit("source"), F.col("event_type")))
    attrs = L.attribute_insert(attrs, "environment", F.lit("production"))
    attrs = L.attribute_upsert(attrs, "service.version", F.concat(F.lit("v"), (F.col("user_id") % 4).cast("string")))
    attrs = L.attribute_insert(attrs, "deployment.region", F.lit("eu"))
    df = t.events.select("event_id", attrs.alias("a"))
    return df.select("event_id", F.col("a")["environment"].alias("environment"), F.col("a")["service.version"].alias("version"),
                     F.col("a")["deployment.region"].alias("region"))


@query("R06_include_metrics", plain(
    "SELECT event_type AS metric_name, count(*)::BIGINT AS n, sum(value) AS total FROM events WHERE regexp_matches(event_type, 'error|user|order|cart') OR event_type LIKE '%checkout%' GROUP BY 1",
    "total", digits=3), digits=3)
def include_metrics(t):
    return S.include_metrics(t.metrics()).groupBy("metric_name").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("R07_log_search", plain(
    f"""SELECT log_id, timestamp, service, (props->>'$.k')::BIGINT AS k FROM {LOGS} WHERE service = 'svc-3' AND contains(message, 'error')
    ORDER BY timestamp DESC, log_id DESC LIMIT 1000""", ts="timestamp"))
def log_search(t):
    logs = t.logs().withColumn("k", F.from_json("props", "k LONG")["k"])
    return S.log_search(logs, {"service": "svc-3"}, "error").select("log_id", "timestamp", "service", "k")


@query("R08_min_level", f"SELECT level, count(*)::BIGINT AS n FROM {LOGS} WHERE level IN ('WARN', 'ERROR') GROUP BY 1")
def min_level(t):
    return S.min_level(t.logs(), "WARN").groupBy("level").agg(F.count("*").alias("n"))


@query("R09_trace_ids", f"""SELECT log_id, trace_id, substr(md5(span_id::VARCHAR), 1, 16) AS span, '01' AS flags FROM {LOGS}""")
def trace_ids(t):
    header = F.concat(F.lit("00-"), F.col("trace_id"), F.lit("-"), F.substring(F.md5(F.col("span_id").cast("string")), 1, 16), F.lit("-01"))
    df = t.logs().select("log_id", L.trace_id_of(F.col("message")).alias("from_text"), L.traceparent(header).alias("p"))
    return df.where(F.col("from_text") == F.col("p.trace_id")).select(
        "log_id", F.col("from_text").alias("trace_id"), F.col("p.span_id").alias("span"), F.col("p.flags").alias("flags"))


TX = """(SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_totalprice AS amount, o_orderdate AS timestamp,
  CASE WHEN o_orderkey % 7 != 0 THEN (o_custkey % 60 + 18)::DOUBLE END AS user_age,
  CASE WHEN o_orderkey % 5 != 0 THEN (o_custkey % 900)::DOUBLE END AS account_age_days,
  CASE WHEN o_orderkey % 11 != 0 THEN o_orderkey % 2 = 0 END AS shipping_billing_address_match,
  o_orderpriority = '1-URGENT' AS device_is_new, o_orderkey % 13 != 0 AS ip_address_country_match,
  o_orderkey % 17 = 0 AS email_is_disposable, (o_orderkey % 4)::DOUBLE AS failed_payment_attempts FROM orders)"""


@query("R11_impute_transactions", plain(
    f"""SELECT transaction_id, coalesce(user_age, (SELECT quantile_cont(user_age, 0.5) FROM {TX})) AS user_age,
      coalesce(account_age_days, (SELECT quantile_cont(account_age_days, 0.5) FROM {TX})) AS account_age_days,
      coalesce(shipping_billing_address_match, false) AS shipping_billing_address_match FROM {TX}""", "user_age account_age_days"))
def impute_transactions(t):
    tx = t.transactions()
    return fraud.impute_transactions(tx, fraud.learn_medians(tx)).select(
        "transaction_id", "user_age", "account_age_days", "shipping_billing_address_match")


@query("R12_one_hot",
    """SELECT event_id, (event_type = 'error')::BIGINT AS event_type_error, (event_type = 'purchase')::BIGINT AS event_type_purchase,
      (event_type = 'signup')::BIGINT AS event_type_signup, (event_type = 'view')::BIGINT AS event_type_view, (value > 50)::BIGINT AS large FROM events""")
def one_hot(t):
    df = t.events.select("event_id", "event_type", (F.col("value") > 50).alias("large"))
    return S.one_hot(S.bools_to_int(df, ["large"]), "event_type", S.levels_of(df, "event_type"))


@query("R13_calendar_features",
    """SELECT hour(ts)::BIGINT AS hour_of_day, (isodow(ts) - 1)::BIGINT AS day_of_week, (isodow(ts) >= 6)::BIGINT AS is_weekend,
      month(ts)::BIGINT AS month, count(*)::BIGINT AS n FROM events GROUP BY ALL""")
def calendar_features(t):
    parts = [c.alias(n) for n, c in L.calendar(F.col("ts")).items()]
    return t.events.select(*parts).groupBy("hour_of_day", "day_of_week", "is_weekend", "month").agg(F.count("*").alias("n"))


@query("R14_band",
    """SELECT event_type, CASE WHEN value / 100 >= 1 THEN 'red' WHEN value / 100 >= 0.5 THEN 'yellow' ELSE 'green' END AS latency,
      CASE WHEN value >= 99 THEN 'green' WHEN value >= 95 THEN 'yellow' ELSE 'red' END AS slo, count(*)::BIGINT AS n FROM events GROUP BY ALL""")
def band(t):
    return t.events.select("event_type", L.band(F.col("value") / 100, L.BANDS["latency"]).alias("latency"),
        L.band(F.col("value"), L.BANDS["slo"]).alias("slo")).groupBy("event_type", "latency", "slo").agg(F.count("*").alias("n"))


@query("R15_organize_sort", plain(
    'SELECT c_mktsegment AS "Segment", sum(c_acctbal) AS "Balance" FROM customer GROUP BY 1', '"Balance"', digits=2), digits=2)
def organize_sort(t):
    df = t.customer.groupBy("c_mktsegment").agg(F.sum("c_acctbal").alias("total"), F.count("*").alias("rows"))
    df = S.organize(df, exclude=["rows"], rename={"c_mktsegment": "Segment", "total": "Balance"})
    return S.sort_by(df, "Balance", "Segment")


@query("R16_label_values", f"SELECT DISTINCT {SVC} AS service FROM events ORDER BY 1")
def label_values(t):
    return S.label_values(t.labelled(), "service")


@query("R17_render_template",
    """SELECT event_id, 'Anomaly Detected: ' || event_type || ' - ' || value AS title,
      'Current value: ' || value || ', expected {lower_bound}.' AS message FROM events""")
def render_template(t):
    context = {"service": F.col("event_type"), "value": F.col("value")}
    return t.events.select("event_id",
        L.render("Anomaly Detected: {service} - {value}", context).alias("title"),
        L.render(F.lit("Current value: {value}, expected {lower_bound}."), context).alias("message"))


HOST = "regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)"


@query("R18_shard_of_host",
    f"""SELECT host, CASE WHEN host = 'api1.example.com' OR host LIKE '%.api1.example.com' THEN 'nginx-shard1'
      WHEN host = 'api2.example.com' OR host LIKE '%.api2.example.com' THEN 'nginx-shard2'
      WHEN host = 'api3.example.com' OR host LIKE '%.api3.example.com' THEN 'nginx-shard3' ELSE 'nginx-default' END AS shard,
      count(*)::BIGINT AS n FROM (SELECT CASE WHEN page_id % 3 = 0 THEN 'a.api' || (page_id % 4) || '.example.com' ELSE {HOST} END AS host FROM pages)
      GROUP BY ALL""")
def shard_of_host(t):
    host = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("a.api"), (F.col("page_id") % 4).cast("string"), F.lit(".example.com"))
        ).otherwise(F.regexp_extract("url", "^[a-z]+://([^/:?#]+)", 1))
    return t.pages.select(host.alias("host")).select("host", S.shard_of(F.col("host")).alias("shard")).groupBy("host", "shard").agg(F.count("*").alias("n"))


@query("R19_weighted_split",
    f"""SELECT event_id, CASE WHEN {COHORT.format("event_id::VARCHAR")} < 90 THEN 'v1' ELSE 'v2' END AS subset FROM events""")
def weighted_split(t):
    return t.events.select("event_id", S.weighted_split(F.col("event_id").cast("string"), {"v1": 90, "v2": 10}).alias("subset"))


# What follows a message, and what is left of it.
SECRETS = [
    (" Authorization: Bearer abc123", " Authorization: ***"), (' {"password": "two words, \\"more\\"", "user": "u"}', ' {"password": "***", "user": "u"}'),
    (" token=xyz next", " token=*** next"), (' {"authorization": "Basic dXNlcjpw"}', ' {"authorization": "***"}'), (" password='two words' user=u", " password='***' user=u"),
    (" Authorization: ApiKey abc123", " Authorization: ***"), (" client_secret=s3cr3t&user=u", " client_secret=***"), (" access_token: abc, db_password=x; pwd=y", " access_token: ***, db_password=***; pwd=***"),
    (' password="open ended', ' password="*** ended'), (" tokens=3 secretary=ann", " tokens=3 secretary=ann"),
]


def _cases(number, column):
    quoted = [x[column].replace("'", "''") for x in SECRETS]
    return f"CASE {number} % {len(SECRETS)} " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(quoted)) + " END"


@query("R20_mask_secrets", f"SELECT log_id, regexp_replace(message, 'password=[^ ]+', 'password=***') || {_cases('log_id', 1)} AS message FROM {LOGS}")
def mask_secrets(t):
    """The messages, each followed by one of the forms a secret comes in, or by words that only look like one."""
    more = F.lit(None).cast("string")
    for i, (text, _) in enumerate(SECRETS):
        more = F.when(F.col("log_id") % len(SECRETS) == i, text).otherwise(more)
    return t.logs().select("log_id", L.mask_secrets(F.concat("message", more)).alias("message"))
