"""The given tables, and the model tables derived from them (one method per model table)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import ship

# File schemas seen so far: reading a footer costs a job, once per file is enough.
_SCHEMAS: dict[str, T.StructType] = {}


class Tables:
    """Lazy access to one folder of Parquet tables; nothing runs until a result is asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship(spark)
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        df = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        naive = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.read("lineitem")

    @cached_property
    def customer(self) -> DataFrame:
        return self.read("customer")

    @cached_property
    def part(self) -> DataFrame:
        return self.read("part")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.read("supplier")

    @cached_property
    def documents(self) -> DataFrame:
        return self.read("documents")

    @cached_property
    def embeddings(self) -> DataFrame:
        return self.read("embeddings")

    @cached_property
    def pages(self) -> DataFrame:
        return self.read("pages")

    def metrics(self) -> DataFrame:
        """timestamp, metric_name, value, service (and event_id as a tie-break)."""
        return self.events.select(
            F.col("ts").alias("timestamp"),
            F.col("event_type").alias("metric_name"),
            "value",
            F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string")).alias("service"),
            "event_id",
        )

    def counters(self) -> DataFrame:
        """Request counter samples per service and status; the counter restarts every 1000 events."""
        return self.events.select(
            F.col("ts").alias("timestamp"),
            F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string")).alias("service"),
            F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status"),
            (F.col("event_id") % 1000).cast("double").alias("value"),
        )

    def labelled(self) -> DataFrame:
        """Labelled samples: request counters, a latency gauge and an up gauge, one row per event and name."""
        e = self.events
        service = F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string"))
        status = F.when(F.col("event_type") == "error", "500").otherwise("200")
        base = F.create_map(
            F.lit("service"), service, F.lit("job"), F.concat(F.lit("job-"), (F.col("user_id") % 3).cast("string"))
        )
        rows = F.array(
            F.struct(
                F.lit("http_requests_total").alias("name"),
                F.map_concat(base, F.create_map(F.lit("status"), status)).alias("labels"),
                (F.col("event_id") % 1000).cast("double").alias("value"),
            ),
            F.struct(F.lit("http_request_duration_seconds").alias("name"), base.alias("labels"), F.col("value")),
            F.struct(
                F.lit("up").alias("name"),
                base.alias("labels"),
                F.when(F.col("event_type") == "error", 0.0).otherwise(1.0).alias("value"),
            ),
        )
        return e.select(F.col("ts").alias("timestamp"), F.inline(rows))

    def latency_buckets(self) -> DataFrame:
        """Cumulative latency counts per service and hour, one row per bound."""
        from tidewatch.operators.tracing import LATENCY_BOUNDS_MS, bucket_counts

        e = self.events.select(
            F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string")).alias("service"),
            F.date_trunc("hour", "ts").alias("eval_ts"),
            "value",
        )
        return bucket_counts(e, ["service", "eval_ts"], "value", LATENCY_BOUNDS_MS)

    def transactions(self) -> DataFrame:
        """One transaction per order, with the optional features the table can supply."""
        return self.orders.select(
            F.col("o_orderkey").alias("transaction_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_totalprice").alias("amount"),
            F.col("o_orderdate").alias("timestamp"),
            F.when(F.col("o_orderkey") % 7 != 0, (F.col("o_custkey") % 60 + 18).cast("double")).alias("user_age"),
            F.when(F.col("o_orderkey") % 5 != 0, (F.col("o_custkey") % 900).cast("double")).alias("account_age_days"),
            F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey") % 2 == 0).alias(
                "shipping_billing_address_match"
            ),
            (F.col("o_orderpriority") == "1-URGENT").alias("device_is_new"),
            (F.col("o_orderkey") % 13 != 0).alias("ip_address_country_match"),
            (F.col("o_orderkey") % 17 == 0).alias("email_is_disposable"),
            (F.col("o_orderkey") % 4).cast("double").alias("failed_payment_attempts"),
        )

    def sales(self) -> DataFrame:
        return self.lineitem.select(
            F.to_date("l_shipdate").alias("date"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
        )

    def purchase_orders(self) -> DataFrame:
        return self.lineitem.join(self.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.to_date("o_orderdate").alias("order_date"),
            F.to_date("l_shipdate").alias("delivery_date"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_quantity").alias("quantity"),
        )

    def products(self) -> DataFrame:
        suppliers = self.lineitem.groupBy(F.col("l_partkey").alias("product_id")).agg(
            F.min("l_suppkey").alias("supplier_id")
        )
        return self.part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_retailprice").alias("cost"),
            (F.col("p_size") * 10).cast("double").alias("current_stock"),
            F.lit(0.25).alias("holding_cost_pct"),
            F.lit(100.0).alias("order_cost"),
            F.lit(1.0).alias("min_order_quantity"),
        ).join(suppliers, "product_id", "left")

    def spans(self) -> DataFrame:
        """One span per event; a trace is a user's day; the parent is the user's event five ids back, if any."""
        e = self.events
        user_day = F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"))
        return e.select(
            F.md5(user_day).alias("trace_id"),
            F.col("event_id").alias("span_id"),
            F.when(F.col("event_id") % 5 != 0, F.col("event_id") - F.col("event_id") % 5).alias("parent_span_id"),
            F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string")).alias("service"),
            F.col("event_type").alias("operation"),
            F.col("ts").alias("start"),
            F.col("value").alias("duration_ms"),
            F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status"),
            F.col("user_id").cast("string").alias("session_id"),
            F.when(F.col("event_type") == "purchase", F.concat(F.lit("ORD-"), (F.col("user_id") % 40).cast("string"))).alias(
                "order_id"
            ),
        )

    def logs(self) -> DataFrame:
        e = self.events
        user_day = F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"))
        level = (
            F.when(F.col("event_type") == "error", "ERROR")
            .when(F.col("event_type") == "signup", "WARN")
            .when(F.col("event_type") == "view", "DEBUG")
            .when(F.col("event_type") == "click", "TRACE")
            .otherwise("INFO")
        )
        return e.select(
            F.col("event_id").alias("log_id"),
            F.timestamp_micros(F.unix_micros("ts") + 500_000).alias("timestamp"),
            level.alias("level"),
            F.concat(
                F.lit("traceID="), F.md5(user_day), F.lit(" "), F.col("event_type"), F.lit(" took "),
                F.col("value").cast("string"), F.lit(" password=hunter"), F.col("user_id").cast("string"),
                F.lit(" user=u"), F.col("user_id").cast("string"),
            ).alias("message"),
            F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string")).alias("service"),
            F.md5(user_day).alias("trace_id"),
            F.col("event_id").alias("span_id"),
            F.col("props"),
        )

    def api_calls(self) -> DataFrame:
        u = F.col("user_id")
        return self.events.select(
            F.col("event_id").alias("request_id"),
            F.col("ts").alias("timestamp"),
            u.cast("string").alias("user_id"),
            F.concat(F.lit("10.0."), (u % 4).cast("string"), F.lit("."), u.cast("string")).alias("ip_address"),
            F.concat(F.lit("/"), F.col("event_type")).alias("endpoint"),
            F.when(u % 2 == 0, "GET").otherwise("POST").alias("method"),
            F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
            F.get_json_object("props", "$.k").cast("double").alias("params_count"),
            F.col("value").alias("response_time"),
        )

    def costs(self) -> DataFrame:
        """Daily cost rows with tenant labels."""
        nation = self.read("nation")
        region = self.read("region")
        return (
            self.lineitem.join(self.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.to_date("o_orderdate").alias("day"),
                F.concat(F.lit("team-"), F.lower("c_mktsegment")).alias("namespace"),
                F.create_map(
                    F.lit("team"), F.col("c_mktsegment"),
                    F.lit("department"), F.col("n_name"),
                    F.lit("cost-center"), F.col("r_name"),
                ).alias("labels"),
                (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("cost"),
                F.col("l_quantity").alias("cpu"),
            )
        )

    def devices(self) -> DataFrame:
        return self.customer.select(
            F.col("c_name").alias("device_id"),
            F.col("c_mktsegment").alias("device_group"),
            F.concat(F.lit("v"), (F.col("c_custkey") % 3).cast("string")).alias("current_version"),
            F.col("c_custkey").alias("device_key"),
        )
