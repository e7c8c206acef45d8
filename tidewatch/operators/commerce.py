"""Commerce indicators from behaviour events, orders and counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import timeseries as ts
from tidewatch.operators.sequence import sessions
from tidewatch.operators.tracing import bucket_counts

# Which event types count as which stage of the shop.
STAGES = {
    "page_views": ["view"], "product_views": ["click"], "cart_adds": ["signup"], "checkout_starts": ["signup", "purchase"],
    "orders": ["purchase"],
}
SESSION_BOUNDS_S = [10, 30, 60, 300, 600, 1800, 3600]


def _count(types: Sequence[str], event: str = "event_type") -> Column:
    return F.count(F.when(F.col(event).isin(list(types)), 1))


def revenue_rate(counters: DataFrame, by: Sequence[str], series: Sequence[str], window: str = "5m", step: str = "1m") -> DataFrame:
    """Summed revenue rate by category."""
    return ts.sum_by(ts.rate(counters, series, window, step), *by)


def funnel(events: DataFrame, stages: Mapping[str, Sequence[str]] = STAGES, by: Sequence[str] = ()) -> DataFrame:
    """One row per stage with its total, from one pass."""
    wide = events.groupBy(*by).agg(*[_count(types).alias(f"_{name}") for name, types in stages.items()])
    rows = F.array(
        *[F.struct(F.lit(i).alias("position"), F.lit(n).alias("stage"), F.col(f"_{n}").alias("total")) for i, n in enumerate(stages)]
    )
    return wide.select(*by, F.inline(rows))


def conversion_rate(events: DataFrame, by: Sequence[str], converted: Sequence[str], started: Sequence[str]) -> DataFrame:
    counts = events.groupBy(*by).agg(_count(converted).alias("_c"), _count(started).alias("_s"))
    return counts.select(*by, (100 * F.try_divide("_c", "_s")).alias("conversion_pct"))


def cart_abandonment(abandoned: DataFrame, created: DataFrame, by: Sequence[str]) -> DataFrame:
    """Abandoned rate over created rate, from two summed rates."""
    return ts.vector_binop(ts.sum_by(abandoned, *by), ts.sum_by(created, *by), "/", by)


def average_order_value(orders: DataFrame, by: Sequence[str], amount: str) -> DataFrame:
    return orders.groupBy(*by).agg(F.count(F.lit(1)).alias("orders"), F.avg(amount).alias("average_order_value"))


def top_products(sales: DataFrame, product: str, revenue: Column, k: int = 10) -> DataFrame:
    """The k products with the largest revenue; ties by product."""
    return sales.groupBy(product).agg(F.sum(revenue).alias("revenue")).orderBy(F.col("revenue").desc(), product).limit(k)


def revenue_by_segment(orders: DataFrame, customers: DataFrame, segment: str = "c_mktsegment") -> DataFrame:
    """Revenue per segment; orders are summed per customer before the join."""
    per_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("_r"))
    return per_customer.join(customers.select("c_custkey", segment), "c_custkey").groupBy(segment).agg(F.sum("_r").alias("revenue"))


def session_duration(events: DataFrame, user: str, gap: str, by_user: DataFrame | None = None) -> DataFrame:
    """Histogram of session lengths (seconds), by user type when a user table is given."""
    runs = sessions(events, [user], gap, {"events": F.lit(1)})
    keys = []
    if by_user is not None:
        runs = runs.join(by_user, user, "left")
        keys = ["user_type"]
    return bucket_counts(runs, keys, "duration_s", SESSION_BOUNDS_S)


def checkout_counters(events: DataFrame, width: str = "1 hour", ts_col: str = "timestamp") -> DataFrame:
    """Started, completed and abandoned checkouts, product views and cart adds per window."""
    counted = events.groupBy(F.window(ts_col, width).start.alias("window_start")).agg(
        _count(STAGES["checkout_starts"]).alias("checkout_started"), _count(STAGES["orders"]).alias("checkout_completed"),
        _count(STAGES["product_views"]).alias("product_views"), _count(STAGES["cart_adds"]).alias("add_to_cart"),
    )
    return counted.withColumn("checkout_abandoned", F.col("checkout_started") - F.col("checkout_completed"))


def active_sessions(gauges: DataFrame, by: Sequence[str]) -> DataFrame:
    return ts.sum_by(gauges, *by)


def business_features(events: DataFrame, by: Sequence[str]) -> DataFrame:
    """The five features of the business detector."""
    bought, viewed, clicked = _count(["purchase"]), _count(["view"]), _count(["click"])
    return events.groupBy(*by).agg(
        F.try_divide(bought, viewed).alias("conversion_rate"),
        (1 - F.try_divide(bought, clicked)).alias("cart_abandonment_rate"),
        F.avg(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("average_order_value"),
        F.try_divide(bought, _count(["signup", "purchase"])).alias("checkout_success_rate"),
        F.try_divide(bought, _count(["purchase", "error"])).alias("payment_success_rate"),
    )
