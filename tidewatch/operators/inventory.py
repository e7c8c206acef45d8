"""Demand, lead time, safety stock, reorder points and order recommendations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import anomaly as A
from tidewatch.operators import classify as K
from tidewatch.operators.sequence import running_total
from tidewatch.schema import require_columns
from tidewatch.session import materialise

HORIZON_DAYS = 90
Z_VALUE = 1.96
MIN_SAFETY_DAYS = 7
MAX_SAFETY_DAYS = 30
DEFAULT_ORDER_COST = 100.0
DEFAULT_HOLDING_PCT = 0.25
DEFAULT_MIN_ORDER = 1.0


def _whole(col: Column) -> Column:
    """Half-even rounding to a whole number."""
    return F.bround(col, 0)


def daily_demand(sales: DataFrame, product: str = "product_id") -> DataFrame:
    require_columns(sales, ["date", product, "quantity"])
    return sales.groupBy(product, "date").agg(F.sum("quantity").alias("quantity"))


def forecast_demand(demand: DataFrame, days: int = HORIZON_DAYS, product: str = "product_id") -> DataFrame:
    """Whole, non-negative demand and its bounds for each of the next ``days`` days of every product."""
    series = demand.select(product, F.col("date").cast("timestamp").alias("timestamp"), F.col("quantity").alias("value"))
    params = A.fit_forecast(series, [product], A.DAILY_SEASONS)
    rows = A.predict_forecast(params, A.future_grid(params, "1d", days, [product]), [product])
    positive = lambda c: F.greatest(F.lit(0.0), _whole(F.col(c)))
    return rows.select(
        product, F.to_date("timestamp").alias("date"), positive("yhat").alias("demand"),
        positive("yhat_lower").alias("demand_lower"), positive("yhat_upper").alias("demand_upper"),
    )


def demand_stats(forecast: DataFrame, product: str = "product_id", value: str = "demand") -> DataFrame:
    out = forecast.groupBy(product).agg(
        F.sum(value).alias("total_demand"), F.avg(value).alias("avg_daily_demand"),
        F.max(value).alias("max_daily_demand"), F.stddev_pop(value).alias("demand_std"),
    )
    cv = F.coalesce(F.try_divide("demand_std", "avg_daily_demand"), F.lit(0.0))
    return out.withColumn("demand_cv", F.when(F.col("avg_daily_demand") > 0, cv).otherwise(0.0))


def lead_times(purchase_orders: DataFrame) -> DataFrame:
    """Days from order to delivery; orders delivered on or before their order day are invalid."""
    require_columns(purchase_orders, ["order_date", "delivery_date", "product_id", "supplier_id", "quantity"])
    days = F.datediff("delivery_date", "order_date")
    return purchase_orders.withColumn("lead_time_days", days).where(F.col("lead_time_days") > 0)


def lead_time_features(leads: DataFrame, additional: Sequence[str] = ("distance_km", "is_international", "shipping_method", "priority")) -> DataFrame:
    """Month and weekday of the order next to product, supplier and quantity; optional columns as they are."""
    extra = [c for c in additional if c in leads.columns]
    return leads.select(
        "product_id", "supplier_id", F.col("quantity").cast("double").alias("quantity"),
        F.month("order_date").cast("double").alias("month"), F.weekday("order_date").cast("double").alias("day_of_week"),
        *[F.col(c).cast("double").alias(c) if leads.schema[c].dataType.typeName() != "string" else F.col(c) for c in extra], F.col("lead_time_days").cast("double").alias("lead_time_days"),
    )


@dataclass(frozen=True)
class LeadTimeModel:
    """Smoothed mean lead time of every product, supplier and other name, a table (``_k_<name>``, ``_f_<name>``) for each,
    what a name that is missing or was not met stands for, and the forest on these and the numbers."""

    means: Mapping[str, DataFrame]
    others: Mapping[str, float]
    forest: PipelineModel

    def encode(self, rows: DataFrame) -> DataFrame:
        """The rows with each name's mean: joined, so that the plan does not grow with the names."""
        for name, mean in self.means.items():
            rows = rows.withColumn(f"_k_{name}", F.col(name).cast("string")).join(mean, f"_k_{name}", "left")
            rows = rows.withColumn(f"_f_{name}", F.coalesce(f"_f_{name}", F.lit(self.others[name])))
        return rows.drop(*[f"_k_{name}" for name in self.means])

    def transform(self, rows: DataFrame) -> DataFrame:
        return K.mean_prediction(self.forest, self.encode(rows))


def fit_lead_time(leads: DataFrame, trees: int = 100, depth: int = 10, seed: int = 42, smoothing: float = 1.0) -> LeadTimeModel:
    """Random forest regression on product, supplier, quantity, month, weekday and the optional columns that are there.

    Product and supplier enter as their mean lead time (smoothed towards the mean of all), so their number does not
    matter and none collide; shipping method and priority likewise.
    """
    rows = materialise(lead_time_features(leads), "lead-times")
    kinds = dict(rows.dtypes)
    numbers = [c for c in rows.columns if c not in ("product_id", "supplier_id", "lead_time_days") and kinds[c] != "string"]
    names = ["product_id", "supplier_id", *[c for c in rows.columns if kinds[c] == "string" and c not in ("product_id", "supplier_id")]]
    overall = rows.agg(F.avg("lead_time_days").alias("mean")).first()["mean"]
    if overall is None:
        raise ValueError("empty training data")
    smoothed = (F.sum("lead_time_days") + F.lit(smoothing * overall)) / (F.count(F.lit(1)) + F.lit(smoothing))
    means, others = {}, {}
    for name in names:
        mean = rows.groupBy(F.col(name).cast("string").alias(f"_k_{name}")).agg(smoothed.alias(f"_f_{name}"))
        mean = materialise(mean, f"lead-times-{name}")
        missing = mean.where(F.col(f"_k_{name}").isNull()).first()
        means[name] = mean.where(F.col(f"_k_{name}").isNotNull())
        others[name] = overall if missing is None else missing[f"_f_{name}"]
    encoded = LeadTimeModel(means, others, None).encode(rows)
    return LeadTimeModel(means, others, K.fit_mean_forest(encoded, [*[f"_f_{c}" for c in names], *numbers], "lead_time_days", "_days", trees, depth, seed))


def predict_lead_time(model, requests: DataFrame) -> DataFrame:
    """Whole days, at least one. Requests carry product, supplier, quantity, month and weekday."""
    rows = model.transform(requests)
    days = F.greatest(F.lit(1.0), _whole(F.col("_days")))
    rows = rows.withColumn("lead_time_days", days)
    return rows.drop("_features", "_days", *[c for c in rows.columns if c.startswith("_f_")])


def baseline_lead_time(leads: DataFrame, wanted: DataFrame) -> DataFrame:
    """Mean lead time of the pair, else of the supplier, else of all orders; whole days, at least one."""
    pair = leads.groupBy("supplier_id", "product_id").agg(F.avg("lead_time_days").alias("_pair"))
    supplier = leads.groupBy("supplier_id").agg(F.avg("lead_time_days").alias("_supplier"))
    overall = leads.agg(F.avg("lead_time_days").alias("_all"))
    rows = wanted.join(pair, ["supplier_id", "product_id"], "left").join(supplier, "supplier_id", "left")
    mean = F.coalesce("_pair", "_supplier", F.col("_all"))
    rows = rows.withColumn("_all", overall.scalar())
    return rows.withColumn("lead_time_days", F.greatest(F.lit(1.0), _whole(mean))).drop("_pair", "_supplier", "_all")


def safety_stock(avg: Column, std: Column, lead: Column, z: float = Z_VALUE) -> Column:
    wanted = z * std * F.sqrt(lead)
    return _whole(F.greatest(avg * MIN_SAFETY_DAYS, F.least(wanted, avg * MAX_SAFETY_DAYS)))


def reorder_point(avg: Column, lead: Column, safety: Column) -> Column:
    return _whole(avg * lead + safety)


def eoq(avg: Column, cost: Column, order_cost: Column | None = None, holding_pct: Column | None = None, min_order: Column | None = None) -> Column:
    order = F.coalesce(order_cost, F.lit(DEFAULT_ORDER_COST)) if order_cost is not None else F.lit(DEFAULT_ORDER_COST)
    holding = F.coalesce(holding_pct, F.lit(DEFAULT_HOLDING_PCT)) if holding_pct is not None else F.lit(DEFAULT_HOLDING_PCT)
    least = F.coalesce(min_order, F.lit(DEFAULT_MIN_ORDER)) if min_order is not None else F.lit(DEFAULT_MIN_ORDER)
    return F.greatest(least, _whole(F.sqrt(F.try_divide(2 * avg * 365 * order, cost * holding))))


def recommendations(products: DataFrame, stats: DataFrame, leads: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """One row per product: stock position and what to order, or the reason why not.

    ``requested`` (product_id) may name products the master does not have; without it every master product is asked for.
    """
    known = products.withColumn("_known", F.lit(True))
    rows = known if requested is None else requested.select("product_id").join(known, "product_id", "left")
    rows = rows.join(stats, "product_id", "left").join(leads.select("product_id", "lead_time_days"), "product_id", "left")
    error = (
        F.when(F.col("_known").isNull(), "No product data available")
        .when(F.col("supplier_id").isNull(), "No supplier ID available")
        .when(F.col("avg_daily_demand").isNull(), "No demand model available for this product")
        .when(F.col("lead_time_days").isNull(), "No lead time model available")
    )
    avg, lead = F.col("avg_daily_demand"), F.col("lead_time_days")
    stock = F.coalesce(F.col("current_stock"), F.lit(0.0))
    rows = rows.withColumns({"error": error, "success": error.isNull(), "_stock": stock})
    rows = rows.withColumns(
        {
            "safety_stock": safety_stock(avg, F.col("demand_std"), lead),
            "eoq": eoq(avg, F.col("cost"), F.col("order_cost"), F.col("holding_cost_pct"), F.col("min_order_quantity")),
        }
    ).withColumn("reorder_point", reorder_point(avg, lead, F.col("safety_stock")))
    rows = rows.withColumn("reorder_needed", F.col("_stock") <= F.col("reorder_point"))
    supply = F.when(avg > 0, F.round(F.col("_stock") / avg, 1)).otherwise(float("inf"))
    quantity = F.when(F.col("reorder_needed"), F.col("eoq")).otherwise(0.0)
    ok = lambda c: F.when(F.col("success"), c)
    return rows.select(
        "product_id", "success", "error", ok(F.col("_stock")).alias("current_stock"), ok(F.col("reorder_point")).alias("reorder_point"),
        ok(F.col("safety_stock")).alias("safety_stock"), ok(F.col("eoq")).alias("eoq"), ok(lead).alias("lead_time_days"),
        ok(avg).alias("avg_daily_demand"), ok(supply).alias("days_of_supply"), ok(F.col("reorder_needed")).alias("reorder_needed"),
        ok(quantity).alias("order_quantity"), ok(quantity * F.col("cost")).alias("order_cost"), ok(F.col("supplier_id")).alias("supplier_id"),
    )


def low_stock_events(movements: DataFrame, threshold: float, opening: float, tie: Sequence[str], chunk: str | None = None) -> DataFrame:
    """Stock movements (product_id, timestamp, delta) after which the stock fell below the threshold."""
    rows = running_total(movements, ["product_id"], {"_moved": "delta"}, tie=tie, chunk=chunk)
    level = F.lit(opening) + F.col("_moved")
    rows = rows.withColumns({"quantity": level, "_before": level - F.col("delta")})
    return rows.where((F.col("quantity") < threshold) & (F.col("_before") >= threshold)).drop("_moved", "_before")

