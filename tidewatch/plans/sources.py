"""Sources and sinks, written and read back whole."""

from pyspark.sql import functions as F

from tidewatch.plans.catalog import plain, query
from tidewatch.plans.selectors import LOGS, SVC
from tidewatch.session import scratch_path
from tidewatch.sources import files as S
from tidewatch.sources import registry as M


@query("S01_read_metric_csv", plain("SELECT ts AS timestamp, event_type AS metric_name, value FROM events WHERE event_type != 'error'", "value", "timestamp"))
def read_metric_csv(t):
    root = scratch_path(t.spark, "metric-csv")
    rows = t.metrics().select("timestamp", "metric_name", "value")
    options = {"header": True, "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    rows.where("metric_name IN ('view', 'click')").write.options(**options).csv(f"{root}/a")
    rows.where("metric_name IN ('signup', 'purchase')").select("value", "timestamp", "metric_name").write.mode("append").options(**options).csv(f"{root}/b")
    rows.where("metric_name = 'error'").select("timestamp", "value").write.options(**options).csv(f"{root}/c")
    return S.read_metric_csv(t.spark, f"{root}/*")


@query("S02_read_feature_csv", plain("SELECT event_id::DOUBLE AS event_id, value, (event_id % 3)::DOUBLE AS extra FROM events WHERE event_type = 'view' UNION ALL SELECT event_id, value, NULL FROM events WHERE event_type != 'view'", "event_id value extra"))
def read_feature_csv(t):
    root = scratch_path(t.spark, "feature-csv")
    rows = t.events.select("event_id", "event_type", "value", (F.col("event_id") % 3).alias("extra"))
    rows.where("event_type = 'view'").write.option("header", True).csv(f"{root}/a")
    rows.where("event_type != 'view'").drop("extra").write.option("header", True).csv(f"{root}/b")
    return S.read_feature_csv(t.spark, f"{root}/*")[0].select("event_id", "value", "extra")


@query("S03_parse_metric_payload", plain("SELECT user_id, ts AS timestamp, event_type || ', \"' || user_id || '\"' AS metric_name, value FROM events", "value", "timestamp"))
def parse_metric_payload(t):
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    rows = t.events.select("user_id", F.floor(F.col("event_id") / 10).alias("batch"), stamp.alias("timestamp"), F.format_string('%s, "%d"', "event_type", "user_id").alias("metric_name"), "value")
    bodies = rows.groupBy("user_id", "batch").agg(F.collect_list(F.struct("timestamp", "metric_name", "value")).alias("s"))
    kind = F.col("batch") % 4
    listed = F.to_json("s")
    named = F.to_json(F.struct(F.transform("s", lambda x: F.struct(x["timestamp"].alias("timestamp"), x["metric_name"].alias("name"), x["value"].alias("value"))).alias("metrics")))
    columnar = F.to_json(F.struct(F.col("s.timestamp").alias("timestamp"), F.col("s.metric_name").alias("metric_name"), F.col("s.value").alias("value")))
    text = F.concat(F.lit("value,timestamp,metric_name\n"), F.array_join(F.transform("s", lambda x: F.concat_ws(",", x["value"].cast("string"), x["timestamp"], F.concat(F.lit('"'), F.replace(x["metric_name"], F.lit('"'), F.lit('""')), F.lit('"')))), "\n"))
    body = F.when(kind == 0, listed).when(kind == 1, named).when(kind == 2, columnar).otherwise(text)
    return S.parse_metric_payload(bodies.select("user_id", body.alias("body")), "body")


SCENARIO = "list_value('anomaly_detection', 'root_cause_analysis', 'predictive_alerting', 'dashboard_load')[user_id % 4 + 1]"


@query("S04_read_loadtest_json", f"""SELECT {SCENARIO} AS scenario, strftime(date_trunc('second', max(ts)), '%Y-%m-%d %H:%M:%S.%f') AS timestamp, max(value) AS max, min(value) AS min,
   count(*)::DOUBLE AS count, 0.0::DOUBLE AS p99, count(*) FILTER (event_type = 'error')::DOUBLE AS failed FROM events GROUP BY 1""")
def read_loadtest_json(t):
    """Summary documents of each scenario, written as a test run writes them, through the reader."""
    from tidewatch.operators import loadtest as B

    root = scratch_path(t.spark, "loadtest")
    names = F.array(*[F.lit(s) for s in B.SCENARIOS])
    value = lambda c, n: F.create_map(F.lit(n), c.cast("double"))
    entry = lambda c: F.struct(c.alias("values"))
    runs = t.events.groupBy(names[(F.col("user_id") % 4).cast("int")].alias("scenario")).agg(
        (F.unix_seconds(F.max("ts")) * 1000).alias("timestamp"),
        F.create_map(
            F.lit("http_req_duration"), entry(F.map_concat(value(F.max("value"), "max"), value(F.min("value"), "min"), value(F.count("*"), "count"))),
            F.lit("http_req_failed"), entry(value(F.count_if(F.col("event_type") == "error"), "count")),
        ).alias("metrics"),
    )
    for name in B.SCENARIOS:
        runs.where(F.col("scenario") == name).drop("scenario").write.json(f"{root}/k6-{name}-1.json")
    read = S.read_loadtest_json(t.spark, root)
    took = F.col("metrics")["http_req_duration"]
    return read.select("scenario", "timestamp", *[took[n].alias(n) for n in ("max", "min", "count", "p99")], F.col("metrics")["http_req_failed"]["count"].alias("failed"))


ARCHIVED = "SELECT event_id, user_id, ts AS timestamp, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour FROM events"


@query("S06_archive_sink", plain(ARCHIVED, ts="timestamp"))
def archive_sink(t):
    path = scratch_path(t.spark, "archive")
    S.write_archive(t.events.select("event_id", "user_id", F.col("ts").alias("timestamp")), path)
    return S.read_archive(t.spark, path, "event_id long, user_id long, timestamp timestamp, year string, month string, day string, hour string")


@query("S08_daily_index", plain(f"SELECT service, strftime(timestamp, '%Y.%m.%d') AS dt, 'logs-' || service || '-' || strftime(timestamp, '%Y.%m.%d') AS name, count(*)::BIGINT AS n FROM {LOGS} GROUP BY 1, 2, 3"))
def daily_index(t):
    path = scratch_path(t.spark, "index")
    S.write_daily_index(t.logs(), path)
    rows = t.spark.read.option("basePath", path).parquet(path)
    return rows.withColumn("name", S.index_name(F.col("service"), F.col("timestamp"))).groupBy("service", F.col("dt").cast("string").alias("dt"), "name").agg(F.count("*").alias("n"))


@query("S09_prediction_sink", """SELECT '{"event_id":' || event_id || ',"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '","is_anomaly":' || (value > 200) || '}' AS record FROM events""")
def prediction_sink(t):
    path = scratch_path(t.spark, "predictions")
    S.write_predictions(t.events.select("event_id", F.col("ts").alias("timestamp"), (F.col("value") > 200).alias("is_anomaly")), path)
    return t.spark.read.text(path).withColumnRenamed("value", "record")


@query("S11_chargeback_report", plain("SELECT strftime(o_orderdate, '%Y-%m-01') AS period, c_mktsegment AS team, sum(o_totalprice) AS cost FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2", "cost", digits=1), digits=1)
def chargeback_report(t):
    path = scratch_path(t.spark, "chargeback")
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.trunc("o_orderdate", "month").alias("month"), F.col("c_mktsegment").alias("team")).agg(F.sum("o_totalprice").alias("cost"))
    S.write_chargeback_report(rows, path)
    return t.spark.read.option("header", True).schema("month date, team string, cost double, period string").csv(path).drop("month")


@query("S12_latest_version", "SELECT 'model-' || (user_id % 6) AS name, max('v' || event_id) AS version, 'p/' || max('v' || event_id) AS path, count(*)::BIGINT AS versions FROM events GROUP BY 1")
def latest_version(t):
    version = F.concat(F.lit("v"), F.col("event_id").cast("string"))
    rows = t.events.select(F.concat(F.lit("model-"), (F.col("user_id") % 6).cast("string")).alias("name"), version.alias("version"),
        F.concat(F.lit("p/"), version).alias("path"), F.col("ts").alias("saved_at"))
    return M.latest_versions(rows)


@query("S13_retention", plain("""SELECT event_id, 'raw' AS tier FROM events WHERE ts >= TIMESTAMP '2024-02-15' - INTERVAL 30 DAY UNION ALL SELECT event_id, '5m' FROM events WHERE ts >= TIMESTAMP '2024-04-15' - INTERVAL 90 DAY
   UNION ALL SELECT event_id, 'edge_cache' FROM events WHERE ts >= TIMESTAMP '2024-02-01' - INTERVAL 7 DAY"""))
def retention(t):
    out = None
    for tier, now in (("raw", "2024-02-15"), ("5m", "2024-04-15"), ("edge_cache", "2024-02-01")):
        rows = S.retention(t.events, tier, F.lit(now).cast("timestamp"), "ts").select("event_id", F.lit(tier).alias("tier"))
        out = rows if out is None else out.unionByName(rows)
    return out
