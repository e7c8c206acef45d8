"""Commerce indicators over the given tables."""

from pyspark.sql import functions as F

from tidewatch.functions import labels as L
from tidewatch.operators import commerce as K
from tidewatch.operators import timeseries as ts
from tidewatch.plans.catalog import plain, query
from tidewatch.plans.selectors import SVC
from tidewatch.plans.timeseries import windowed

REVENUE = f"(SELECT ts, event_type AS category, {SVC} AS service, (event_id % 1000) * 1.5 AS value FROM events)"


def revenue(t):
    return t.events.select(F.col("ts").alias("timestamp"), F.col("event_type").alias("category"),
        F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string")).alias("service"), ((F.col("event_id") % 1000) * 1.5).alias("value"))


@query("K01_revenue_rate", plain(f"""SELECT category, arg_max(value, eval_ts) AS last_not_null, avg(value) AS mean, max(value) AS max, sum(value) AS sum FROM (
   SELECT category, eval_ts, sum(inc) / 86400 AS value FROM {windowed(REVENUE, 'category, service', '1 DAY', '6 HOUR', 'day')} WHERE n >= 2 GROUP BY 1, 2) GROUP BY 1""", "last_not_null mean max sum"))
def revenue_rate(t):
    return ts.reduce_series(K.revenue_rate(revenue(t), ["category"], ["category", "service"], "1d", "6h"), ["category"])


@query("K02_funnel", """SELECT position::BIGINT AS position, stage, total FROM (SELECT count(*) FILTER (event_type = 'view')::BIGINT a, count(*) FILTER (event_type = 'click')::BIGINT b, count(*) FILTER (event_type = 'signup')::BIGINT c,
   count(*) FILTER (event_type IN ('signup', 'purchase'))::BIGINT d, count(*) FILTER (event_type = 'purchase')::BIGINT e FROM events),
   LATERAL (VALUES (0, 'page_views', a), (1, 'product_views', b), (2, 'cart_adds', c), (3, 'checkout_starts', d), (4, 'orders', e)) v(position, stage, total)""")
def funnel(t):
    return K.funnel(t.events)


@query("K03_conversion_rate", plain("""SELECT *, CASE WHEN conversion_pct >= 2 THEN 'green' WHEN conversion_pct >= 1 THEN 'yellow' WHEN conversion_pct IS NOT NULL THEN 'red' END AS band FROM (
   SELECT user_id, 100 * count(*) FILTER (event_type = 'purchase') / nullif(count(*) FILTER (event_type = 'view'), 0) AS conversion_pct FROM events GROUP BY 1)""", "conversion_pct"))
def conversion_rate(t):
    rows = K.conversion_rate(t.events, ["user_id"], ["purchase"], ["view"])
    return rows.withColumn("band", L.band(F.col("conversion_pct"), L.BANDS["conversion"]))


CARTS = f"(SELECT ts, {SVC} AS service, 'job-' || (user_id % 3) AS job, (event_id // 9)::DOUBLE AS a, (event_id // 6)::DOUBLE AS c FROM events)"


@query("K04_cart_abandonment", plain(f"""SELECT x.job, x.eval_ts, x.v / y.v AS value FROM (SELECT job, eval_ts, sum(inc) AS v FROM {windowed(f"(SELECT ts, service, job, a AS value FROM {CARTS})", 'service, job', '1 DAY', '6 HOUR', 'day')} WHERE n >= 2 GROUP BY 1, 2) x
   JOIN (SELECT job, eval_ts, sum(inc) AS v FROM {windowed(f"(SELECT ts, service, job, c AS value FROM {CARTS})", 'service, job', '1 DAY', '6 HOUR', 'day')} WHERE n >= 2 GROUP BY 1, 2) y USING (job, eval_ts) WHERE y.v != 0""", "value", "eval_ts", 3), digits=3)
def cart_abandonment(t):
    base = t.events.select(F.col("ts").alias("timestamp"), F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string")).alias("service"),
        F.concat(F.lit("job-"), (F.col("user_id") % 3).cast("string")).alias("job"), "event_id")
    one = lambda n: ts.rate(base.withColumn("value", F.floor(F.col("event_id") / n).cast("double")), ["service", "job"], "1d", "6h")
    return K.cart_abandonment(one(9), one(6), ["job"]).where("value IS NOT NULL")


@query("K05_average_order_value", plain("SELECT o_orderpriority, count(*)::BIGINT AS orders, avg(o_totalprice) AS average_order_value FROM orders GROUP BY 1", "average_order_value", digits=2), digits=2)
def average_order_value(t):
    return K.average_order_value(t.orders, ["o_orderpriority"], "o_totalprice")


@query("K06_top_products", plain("SELECT l_partkey, sum(l_extendedprice * (1 - l_discount)) AS revenue FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", "revenue", digits=2), digits=2)
def top_products(t):
    return K.top_products(t.lineitem, "l_partkey", F.col("l_extendedprice") * (1 - F.col("l_discount")))


@query("K07_revenue_by_segment", plain("SELECT c_mktsegment, sum(o_totalprice) AS revenue FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1", "revenue", digits=2), digits=2)
def revenue_by_segment(t):
    return K.revenue_by_segment(t.orders, t.customer)


ORDER_COUNTER = f"(SELECT ts, event_type AS status, {SVC} AS service, (event_id // 3)::DOUBLE AS n_orders, (event_id // 3 * 41)::DOUBLE AS worth FROM events)"


@query("K08_order_rate", plain(f"""SELECT status, eval_ts, x.v AS orders_rate, y.v AS value_rate FROM (SELECT status, eval_ts, sum(inc) / 21600 AS v FROM {windowed(f"(SELECT ts, status, service, n_orders AS value FROM {ORDER_COUNTER})", 'status, service', '6 HOUR', '3 HOUR', 'day')} WHERE n >= 2 GROUP BY 1, 2) x
   JOIN (SELECT status, eval_ts, sum(inc) / 21600 AS v FROM {windowed(f"(SELECT ts, status, service, worth AS value FROM {ORDER_COUNTER})", 'status, service', '6 HOUR', '3 HOUR', 'day')} WHERE n >= 2 GROUP BY 1, 2) y USING (status, eval_ts)""", "orders_rate value_rate", "eval_ts"))
def order_rate(t):
    base = t.events.select(F.col("ts").alias("timestamp"), F.col("event_type").alias("status"), F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string")).alias("service"),
        F.floor(F.col("event_id") / 3).cast("double").alias("n"))
    one = lambda c: K.revenue_rate(base.withColumn("value", c), ["status"], ["status", "service"], "6h", "3h")
    return one(F.col("n")).withColumnRenamed("value", "orders_rate").join(one(F.col("n") * 41).withColumnRenamed("value", "value_rate"), ["status", "eval_ts"])


@query("K09_session_duration", plain("""WITH m AS (SELECT user_id, ts, (lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 4 HOUR)::INT AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
   s AS (SELECT user_id, sid, epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6 AS d FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM m) GROUP BY 1, 2)
   SELECT CASE WHEN user_id % 2 = 0 THEN 'guest' ELSE 'member' END AS user_type, b::VARCHAR AS le, count(*) FILTER (d <= b)::DOUBLE AS value FROM s, (SELECT unnest([10, 30, 60, 300, 600, 1800, 3600]) AS b) GROUP BY 1, 2
   UNION ALL SELECT CASE WHEN user_id % 2 = 0 THEN 'guest' ELSE 'member' END, 'inf', count(*)::DOUBLE FROM s GROUP BY 1""", "value"))
def session_duration(t):
    users = t.events.select("user_id").distinct().withColumn("user_type", F.when(F.col("user_id") % 2 == 0, "guest").otherwise("member"))
    rows = K.session_duration(t.events.withColumnRenamed("ts", "timestamp"), "user_id", "4h", users)
    return rows.withColumn("le", F.when(F.col("le") == float("inf"), "inf").otherwise(F.col("le").cast("long").cast("string")))


@query("K10_checkout_counters", plain("""SELECT date_trunc('hour', ts) AS window_start, count(*) FILTER (event_type IN ('signup', 'purchase'))::BIGINT AS checkout_started, count(*) FILTER (event_type = 'purchase')::BIGINT AS checkout_completed,
   count(*) FILTER (event_type = 'click')::BIGINT AS product_views, count(*) FILTER (event_type = 'signup')::BIGINT AS add_to_cart, count(*) FILTER (event_type = 'signup')::BIGINT AS checkout_abandoned FROM events GROUP BY 1""", ts="window_start"))
def checkout_counters(t):
    return K.checkout_counters(t.events, ts_col="ts")


ACTIVE = f"(SELECT ts, {SVC} AS service, user_id % 4 AS pod, floor(value / 10)::DOUBLE AS value FROM events)"


@query("K11_active_sessions", plain(f"SELECT service, eval_ts, sum(last_value) AS value FROM {windowed(ACTIVE, 'service, pod', '6 HOUR')} GROUP BY 1, 2", "value", "eval_ts"))
def active_sessions(t):
    rows = t.events.select(F.col("ts").alias("timestamp"), F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string")).alias("service"),
        (F.col("user_id") % 4).alias("pod"), F.floor(F.col("value") / 10).cast("double").alias("value"))
    return K.active_sessions(ts.instant(rows, ["service", "pod"], "1h", "6h"), ["service"])
