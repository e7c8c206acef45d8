"""Traces and logs: span metrics, sampling, correlation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.durations import micros, step_start
from tidewatch.functions.hashing import hash_fraction

# Latency bounds in milliseconds, and sampling probability per service.
LATENCY_BOUNDS_MS = [1, 2, 5, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000, 10000]
SAMPLING = {
    "checkout-service": 1.0, "payment-service": 1.0, "inventory-service": 0.8, "product-service": 0.5,
    "user-service": 0.5, "cart-service": 0.8, "search-service": 0.3,
}
DEFAULT_SAMPLING = 0.1


def bucket_counts(df: DataFrame, by: Sequence[str], value: str, bounds: Sequence[float]) -> DataFrame:
    """Cumulative counts per group and bound (the open bound included), from one aggregation without row explosion."""
    edges = [*[float(b) for b in bounds], float("inf")]
    wide = df.groupBy(*by).agg(*[F.count(F.when(F.col(value) <= e, 1)).alias(f"_le{i}") for i, e in enumerate(edges)])
    long = F.array(*[F.struct(F.lit(e).alias("le"), F.col(f"_le{i}").cast("double").alias("value")) for i, e in enumerate(edges)])
    return wide.select(*by, F.inline(long))


def span_metrics(spans: DataFrame, dimensions: Sequence[str], duration: str = "duration_ms") -> DataFrame:
    """Calls, total latency and cumulative latency buckets by span dimensions."""
    edges = [float(b) for b in LATENCY_BOUNDS_MS]
    return spans.groupBy(*dimensions).agg(
        F.count(F.lit(1)).alias("calls"), F.sum(duration).alias("latency_sum"),
        *[F.count(F.when(F.col(duration) <= e, 1)).alias(f"le_{b}") for b, e in zip(LATENCY_BOUNDS_MS, edges)],
    )


def sample_traces(
    spans: DataFrame, probabilities: Mapping[str, float] = SAMPLING, default: float = DEFAULT_SAMPLING
) -> DataFrame:
    """Keep a span if its trace id falls below its service's probability; the same trace always decides alike."""
    limit = F.lit(default)
    for service, p in probabilities.items():
        limit = F.when(F.col("service") == service, F.lit(p)).otherwise(limit)
    return spans.where(hash_fraction(F.col("trace_id")) < limit)


def join_logs_to_spans(logs: DataFrame, spans: DataFrame, slack: str = "1h", same_span: bool = True) -> DataFrame:
    """Logs with the spans of their trace (and span) whose time, widened by ``slack``, holds the log's time.

    Time buckets are part of the key, so one very large trace is cut by time instead of pairing up as a whole.
    """
    width = 2 * micros(slack)
    begin = F.unix_micros("start")
    end = begin + (F.col("duration_ms") * 1000).cast("long")
    bucket = lambda us: F.floor(us / width)
    side = spans.select(
        "trace_id", "span_id", "service", "operation", (begin - micros(slack)).alias("_from"),
        (end + micros(slack)).alias("_to"),
    ).withColumn("_bucket", F.explode(F.sequence(bucket(F.col("_from")), bucket(F.col("_to")))))
    lines = logs.withColumn("_us", F.unix_micros("timestamp")).withColumn("_bucket", bucket(F.col("_us")))
    on = ["trace_id", "service", "_bucket", *(["span_id"] if same_span else [])]
    if not same_span:
        lines = lines.drop("span_id")
    hit = lines.join(side, on).where((F.col("_us") >= F.col("_from")) & (F.col("_us") <= F.col("_to")))
    return hit.drop("_us", "_from", "_to", "_bucket")


def exemplars(spans: DataFrame, by: Sequence[str], value: str = "duration_ms") -> DataFrame:
    """Per group and latency bucket: the trace of the slowest span in the bucket."""
    le = F.lit(float("inf"))
    for bound in reversed(LATENCY_BOUNDS_MS):
        le = F.when(F.col(value) <= bound, F.lit(float(bound))).otherwise(le)
    return spans.groupBy(*by, le.alias("le")).agg(
        F.max_by("trace_id", F.struct(F.col(value), F.col("span_id"))).alias("trace_id"), F.max(value).alias("value")
    )


def user_journey(spans: DataFrame, logs: DataFrame, sessions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From sessions to their orders, to every span of those orders, and the error logs of those traces."""
    orders = (
        spans.where(F.col("order_id").isNotNull())
        .join(sessions.select("session_id").distinct(), "session_id", "left_semi")
        .select("order_id").distinct()
    )
    path = spans.join(orders, "order_id", "left_semi")
    errors = logs.where(F.col("level") == "ERROR").join(path.select("trace_id").distinct(), "trace_id", "left_semi")
    return path, errors


def broken_traces(spans: DataFrame) -> DataFrame:
    """Spans that name a parent their trace does not have."""
    parents = spans.select("trace_id", F.col("span_id").alias("parent_span_id"))
    return spans.where(F.col("parent_span_id").isNotNull()).join(parents, ["trace_id", "parent_span_id"], "left_anti")


def daily_buckets(ts: str, width: str = "1d"):
    return F.timestamp_micros(step_start(F.col(ts), micros(width)))
