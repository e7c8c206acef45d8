"""Inventory over the given tables (I01 to I04, the I05 baseline, I06 to I10)."""

from pyspark.sql import functions as F

from tidewatch.operators import inventory as I
from tidewatch.plans.anomaly import forecast_sql, yhat_sql
from tidewatch.plans.catalog import plain, query

# Demand per brand: 30 sales per single part are too few for a forecast.
BRANDS = "(SELECT p_brand AS product_id, l_shipdate::DATE AS date, sum(l_quantity) AS quantity FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"
SERIES = f"(SELECT product_id, date::TIMESTAMP AS timestamp, quantity AS value FROM {BRANDS})"
SEASONS = (("weekly", 1, "isodow(timestamp) - 1"), ("yearly", 365, "month(timestamp)"))
FUTURE = "(SELECT product_id, unnest(generate_series(last_ts + INTERVAL 1 DAY, last_ts + INTERVAL 90 DAY, INTERVAL 1 DAY)) AS timestamp FROM par)"
FORECAST = f"""(WITH {forecast_sql(SERIES, 'product_id', SEASONS)} SELECT product_id, strftime(timestamp, '%Y-%m-%d') AS date, greatest(0, round_even(yhat, 0)) AS demand, greatest(0, round_even(yhat_lower, 0)) AS demand_lower,
   greatest(0, round_even(yhat_upper, 0)) AS demand_upper FROM {yhat_sql(FUTURE, 'product_id', (("weekly", "isodow(f.timestamp) - 1"), ("yearly", "month(f.timestamp)")))})"""
STATS = f"""(SELECT product_id, sum(demand) AS total_demand, avg(demand) AS avg_daily_demand, max(demand) AS max_daily_demand, stddev_pop(demand) AS demand_std,
   CASE WHEN avg(demand) > 0 THEN stddev_pop(demand) / avg(demand) ELSE 0 END AS demand_cv FROM {FORECAST} GROUP BY 1)"""


def by_brand(t):
    parts = t.part.select(F.col("p_partkey").alias("product_id"), "p_brand")
    return t.sales().join(parts, "product_id").select(F.col("p_brand").alias("product_id"), "date", "quantity")


def brand_stats(t):
    return I.demand_stats(I.forecast_demand(I.daily_demand(by_brand(t))))


@query("I01_daily_demand", plain("SELECT l_partkey AS product_id, strftime(l_shipdate, '%Y-%m-%d') AS date, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2", "quantity"))
def daily_demand(t):
    return I.daily_demand(t.sales())


@query("I02_forecast_demand", plain(f"SELECT * FROM {FORECAST}", "demand demand_lower demand_upper"))
def forecast_demand(t):
    return I.forecast_demand(I.daily_demand(by_brand(t)))


@query("I03_demand_stats", plain(f"SELECT * FROM {STATS}", "total_demand avg_daily_demand max_daily_demand demand_std demand_cv"))
def demand_stats(t):
    return brand_stats(t)


LEADS = "(SELECT l_partkey AS product_id, l_suppkey AS supplier_id, l_quantity AS quantity, o_orderdate::DATE AS order_date, (l_shipdate::DATE - o_orderdate::DATE)::BIGINT AS lead_time_days FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate::DATE > o_orderdate::DATE)"


@query("I04_lead_times", plain(f"SELECT supplier_id, count(*)::BIGINT AS n, min(lead_time_days) AS shortest, max(lead_time_days) AS longest, avg(lead_time_days) AS mean FROM {LEADS} GROUP BY 1", "mean"))
def lead_times(t):
    return I.lead_times(t.purchase_orders()).groupBy("supplier_id").agg(
        F.count("*").alias("n"), F.min("lead_time_days").alias("shortest"), F.max("lead_time_days").alias("longest"), F.avg("lead_time_days").alias("mean"))


WANTED = "(SELECT p_partkey AS product_id, s AS supplier_id FROM part JOIN (SELECT l_partkey, min(l_suppkey) AS s FROM lineitem GROUP BY 1) ON l_partkey = p_partkey)"
BASELINE = f"""(SELECT product_id, supplier_id, greatest(1, round_even(coalesce(p.m, s.m, (SELECT avg(lead_time_days) FROM {LEADS})), 0)) AS lead_time_days FROM {WANTED}
   LEFT JOIN (SELECT supplier_id, product_id, avg(lead_time_days) AS m FROM {LEADS} GROUP BY 1, 2) p USING (supplier_id, product_id)
   LEFT JOIN (SELECT supplier_id, avg(lead_time_days) AS m FROM {LEADS} GROUP BY 1) s USING (supplier_id))"""


def baseline(t):
    wanted = t.products().where(F.col("supplier_id").isNotNull()).select("product_id", "supplier_id")
    return I.baseline_lead_time(I.lead_times(t.purchase_orders()), wanted)


@query("I05_baseline_lead_time", plain(f"SELECT * FROM {BASELINE}", "lead_time_days"))
def baseline_lead_time(t):
    return baseline(t)


PART_STATS = """(SELECT product_id, avg(q) AS avg_daily_demand, stddev_pop(q) AS demand_std FROM (SELECT l_partkey AS product_id, l_shipdate::DATE AS date, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) GROUP BY 1)"""


def part_stats(t):
    return I.demand_stats(I.daily_demand(t.sales()), value="quantity").select("product_id", "avg_daily_demand", "demand_std")


SAFETY = "round_even(greatest(avg_daily_demand * 7, least(1.96 * demand_std * sqrt(lead_time_days), avg_daily_demand * 30)), 0)"
EOQ = "greatest(1, round_even(sqrt(2 * avg_daily_demand * 365 * 100 / (p_retailprice * 0.25)), 0))"


@query("I06_I07_safety_stock_reorder_point", plain(f"SELECT product_id, {SAFETY} AS safety_stock, round_even(avg_daily_demand * lead_time_days + {SAFETY}, 0) AS reorder_point FROM {PART_STATS} JOIN {BASELINE} USING (product_id)", "safety_stock reorder_point"))
def safety_stock_reorder_point(t):
    rows = part_stats(t).join(baseline(t), "product_id")
    safety = I.safety_stock(F.col("avg_daily_demand"), F.col("demand_std"), F.col("lead_time_days"))
    return rows.withColumn("safety_stock", safety).select("product_id", "safety_stock", I.reorder_point(F.col("avg_daily_demand"), F.col("lead_time_days"), F.col("safety_stock")).alias("reorder_point"))


@query("I08_eoq", plain(f"SELECT product_id, {EOQ} AS eoq FROM {PART_STATS} JOIN part ON p_partkey = product_id", "eoq"))
def eoq(t):
    return part_stats(t).join(t.products(), "product_id").select("product_id", I.eoq(F.col("avg_daily_demand"), F.col("cost"), F.col("order_cost"), F.col("holding_cost_pct"), F.col("min_order_quantity")).alias("eoq"))


@query("I09_recommendations", plain(f"""SELECT product_id, error IS NULL AS success, error, * EXCLUDE (product_id, error, ok) REPLACE (CASE WHEN ok THEN current_stock END AS current_stock, CASE WHEN ok THEN reorder_point END AS reorder_point) FROM (
   SELECT w.product_id, CASE WHEN p_partkey IS NULL THEN 'No product data available' WHEN b.supplier_id IS NULL THEN 'No supplier ID available' WHEN avg_daily_demand IS NULL THEN 'No demand model available for this product' END AS error,
     error IS NULL AS ok, p_size * 10.0 AS current_stock, round_even(avg_daily_demand * lead_time_days + {SAFETY}, 0) AS reorder_point, CASE WHEN ok THEN {SAFETY} END AS safety_stock, CASE WHEN ok THEN {EOQ} END AS eoq,
     CASE WHEN ok THEN lead_time_days END AS lead_time_days, CASE WHEN ok THEN avg_daily_demand END AS avg_daily_demand, CASE WHEN ok THEN round(p_size * 10.0 / avg_daily_demand, 1) END AS days_of_supply,
     CASE WHEN ok THEN p_size * 10.0 <= reorder_point END AS reorder_needed, CASE WHEN ok THEN CASE WHEN reorder_needed THEN {EOQ} ELSE 0 END END AS order_quantity, CASE WHEN ok THEN order_quantity * p_retailprice END AS order_cost,
     CASE WHEN ok THEN b.supplier_id END AS supplier_id
   FROM (SELECT p_partkey AS product_id FROM part UNION ALL SELECT -1 - p_partkey FROM part WHERE p_partkey < 3) w LEFT JOIN part ON p_partkey = w.product_id LEFT JOIN {PART_STATS} s ON s.product_id = w.product_id LEFT JOIN {BASELINE} b ON b.product_id = w.product_id)""",
   "current_stock reorder_point safety_stock eoq lead_time_days avg_daily_demand days_of_supply order_quantity order_cost"))
def recommendations(t):
    asked = t.part.select(F.col("p_partkey").alias("product_id"))
    asked = asked.unionByName(asked.where("product_id < 3").select((-1 - F.col("product_id")).alias("product_id")))
    return I.recommendations(t.products(), part_stats(t), baseline(t), asked)


MOVES = "(SELECT l_partkey AS product_id, l_shipdate AS timestamp, l_orderkey, l_linenumber, CASE WHEN (l_orderkey + l_linenumber) % 2 = 0 THEN -l_quantity ELSE l_quantity END AS delta FROM lineitem)"


@query("I10_low_stock_events", plain(f"""SELECT product_id, timestamp, l_orderkey, l_linenumber::BIGINT AS l_linenumber, quantity FROM (SELECT *, 60 + sum(delta) OVER (PARTITION BY product_id ORDER BY timestamp, l_orderkey, l_linenumber, delta ROWS UNBOUNDED PRECEDING) AS quantity FROM {MOVES})
   WHERE quantity < 10 AND quantity - delta >= 10""", "quantity", "timestamp"))
def low_stock_events(t):
    sign = F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 2 == 0, -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    moves = t.lineitem.select(F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("timestamp"), "l_orderkey", "l_linenumber", sign.alias("delta"))
    return I.low_stock_events(moves, 10.0, 60.0, ["l_orderkey", "l_linenumber", "delta"]).drop("delta")
