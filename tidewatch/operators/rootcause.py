"""Root causes: service graph, neighbours, correlated metrics, classified causes, ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UPSTREAM_CONFIDENCE = 0.6
CORRELATED_ABOVE = 0.7
MAX_CAUSES = 5


def service_graph(dependencies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct nodes and distinct directed edges."""
    edges = dependencies.select("source", "target").where(F.col("source").isNotNull() & F.col("target").isNotNull()).distinct()
    nodes = edges.select(F.explode(F.array("source", "target")).alias("service")).distinct()
    return nodes, edges


def neighbours(affected: DataFrame, edges: DataFrame) -> DataFrame:
    """Related services of each affected service: callers may be the cause, callees are effects."""
    a = affected.select("service").distinct()
    up = a.join(edges, F.col("service") == F.col("target")).select(
        "service", F.col("source").alias("related"), F.lit("upstream").alias("relationship"), F.lit(True).alias("potential_cause"),
        F.lit(UPSTREAM_CONFIDENCE).alias("confidence"),
    )
    down = a.join(edges, F.col("service") == F.col("source")).select(
        "service", F.col("target").alias("related"), F.lit("downstream").alias("relationship"), F.lit(False).alias("potential_cause"),
        F.lit(None).cast("double").alias("confidence"),
    )
    return up.unionByName(down)


def dependency_causes(related: DataFrame) -> DataFrame:
    """The upstream services as candidate causes."""
    return related.where("potential_cause").select(
        "service", F.col("related").alias("cause"), F.lit("dependency").alias("type"), "confidence",
        F.concat(F.lit("Upstream service "), F.col("related"), F.lit(" may be causing issues in "), F.col("service")).alias("description"),
    )


def correlated_contributors(anomalous: DataFrame, corr: DataFrame, above: float = CORRELATED_ABOVE) -> DataFrame:
    """Per anomalous metric the others with |r| above the limit, strongest first."""
    strong = corr.where(F.abs("corr") > above).select(F.col("a").alias("metric"), F.col("b").alias("contributor"), F.abs("corr").alias("correlation"))
    return anomalous.select("metric").distinct().join(strong, "metric").orderBy("metric", F.col("correlation").desc(), "contributor")


def metric_features(incidents: DataFrame, metrics: Sequence[str], map_column: str = "metrics") -> DataFrame:
    """Metric map to columns in sorted name order; a metric the incident lacks counts as 0."""
    return incidents.withColumns({f"f_{m}": F.coalesce(F.col(map_column)[m], F.lit(0.0)) for m in sorted(metrics)})


def model_causes(scored: DataFrame) -> DataFrame:
    """The classifier's best class per incident as a candidate cause."""
    return scored.select(
        F.col("affected_service").alias("service"), F.col("predicted_cause").alias("cause"), F.lit("ml_prediction").alias("type"),
        "confidence", F.concat(F.lit("ML model predicts "), F.col("predicted_cause"), F.lit(" as the root cause")).alias("description"),
    )


def rank_causes(causes: DataFrame, by: Sequence[str] = ("service",), limit: int = MAX_CAUSES) -> DataFrame:
    """The best candidates per affected service with the overall confidence (that of the best one)."""
    order = W.partitionBy(*by).orderBy(F.col("confidence").desc(), "type", "cause")
    ranked = causes.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    return ranked.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("rank", "cause", "type", "confidence", "description"))).alias("root_causes"),
        F.max("confidence").alias("confidence"),
    )


def top_metrics(incidents: DataFrame, importance: DataFrame, key: str, map_column: str = "metrics", k: int = 5) -> DataFrame:
    """The k most important metrics of each incident, with their values. ``importance`` has one row per metric."""
    long = incidents.select(key, F.explode(map_column).alias("metric", "value"))
    order = W.partitionBy(key).orderBy(F.col("importance").desc(), "metric")
    rows = long.join(importance.select("metric", "importance"), "metric")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
