"""Load-test results: summaries, latest run and threshold checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.quantiles import exact_quantiles

SCENARIOS = ["anomaly_detection", "root_cause_analysis", "predictive_alerting", "dashboard_load"]
# p95 limits in milliseconds and the highest error rate.
P95_LIMITS = {"anomaly_detection": 500.0, "root_cause_analysis": 1000.0, "predictive_alerting": 2000.0, "dashboard_load": 3000.0}
MAX_ERROR_RATE = 0.1


def scenario_of(name: Column) -> Column:
    """The first known scenario contained in a file name."""
    expr = F.lit(None).cast("string")
    for scenario in reversed(SCENARIOS):
        expr = F.when(name.contains(scenario), scenario).otherwise(expr)
    return expr


def summarise_load(points: DataFrame, by: str = "scenario") -> DataFrame:
    """Latency statistics, requests and error rate per scenario from points (scenario, latency_ms, failed)."""
    base = points.groupBy(by).agg(
        F.avg("latency_ms").alias("avg"), F.min("latency_ms").alias("min"), F.max("latency_ms").alias("max"),
        F.count(F.lit(1)).alias("requests"), F.avg(F.col("failed").cast("double")).alias("error_rate"),
    )
    quantiles = exact_quantiles(points, [by], "latency_ms", {"med": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}).drop("n")
    return base.join(quantiles, by)


def latest_run(results: DataFrame) -> DataFrame:
    """The newest result per scenario; its own latency, else the overall request duration.

    ``results``: scenario, timestamp, and metrics as map of name to struct of statistics.
    """
    rest = [c for c in results.columns if c != "scenario"]
    newest = results.groupBy("scenario").agg(F.max_by(F.struct(*rest), "timestamp").alias("_r"))
    rows = newest.select("scenario", "_r.*")
    own = F.col("metrics")[F.concat(F.col("scenario"), F.lit("_latency"))]
    return rows.withColumn("latency", F.coalesce(own, F.col("metrics")["http_req_duration"])).drop("metrics")


def check_thresholds(summary: DataFrame, limits: Mapping[str, float] = P95_LIMITS, max_error_rate: float = MAX_ERROR_RATE) -> DataFrame:
    limit = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))])[F.col("scenario")]
    rows = summary.withColumn("p95_limit", limit)
    return rows.withColumns({"latency_ok": F.col("p95") < F.col("p95_limit"), "errors_ok": F.col("error_rate") < max_error_rate})
