"""Row selection, relabelling and projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import labels as L
from tidewatch.functions.hashing import cohort

# Metric names kept by the collector.
KEPT_METRICS = [
    ".*error.*", ".*latency.*", ".*request.*", ".*order.*", ".*payment.*", ".*inventory.*", ".*user.*", ".*cart.*",
    ".*checkout.*",
]

# Host suffix -> ingress shard.
HOST_SHARDS = {
    "api1.example.com": "nginx-shard1",
    "api2.example.com": "nginx-shard2",
    "api3.example.com": "nginx-shard3",
}
DEFAULT_SHARD = "nginx-default"


def label(df: DataFrame, name: str) -> Column:
    """A label as a column: a promoted column if there is one, else the map entry."""
    return F.col(name) if name in df.columns else F.col("labels")[name]


def match(df: DataFrame, name: str, op: str, pattern: str) -> DataFrame:
    return df.filter(L.matches(label(df, name), op, pattern))


def relabel_keep(df: DataFrame, sources: Sequence[str], pattern: str) -> DataFrame:
    return df.filter(L.joined([label(df, s) for s in sources]).rlike(L.anchored(pattern)))


def relabel_drop(df: DataFrame, sources: Sequence[str], pattern: str) -> DataFrame:
    return df.filter(~L.joined([label(df, s) for s in sources]).rlike(L.anchored(pattern)))


def relabel_replace(
    df: DataFrame, sources: Sequence[str], target: str, pattern: str = "(.*)", replacement: str = "$1"
) -> DataFrame:
    """Write ``replacement`` into the target label where the joined sources match; other rows are unchanged."""
    text = L.joined([label(df, s) for s in sources])
    hit = text.rlike(L.anchored(pattern))
    # (?s) keeps one replacement per value: an anchored pattern matches at most once.
    new = F.regexp_replace(text, L.anchored(pattern), L.java_replacement(replacement))
    if target in df.columns or "labels" not in df.columns:
        old = F.col(target) if target in df.columns else F.lit(None).cast("string")
        return df.withColumn(target, F.when(hit, new).otherwise(old))
    return df.withColumn("labels", F.when(hit, L.attribute_upsert(F.col("labels"), target, new)).otherwise(F.col("labels")))


def include_metrics(df: DataFrame, patterns: Sequence[str] = tuple(KEPT_METRICS), name: str = "metric_name") -> DataFrame:
    return df.filter(L.any_match(F.col(name), patterns))


def log_search(
    logs: DataFrame, selector: Mapping[str, str], contains: str, json_schema: str | None = None, limit: int = 1000
) -> DataFrame:
    """Lines of the selected streams that contain a text, newest first, at most ``limit`` of them."""
    for name, value in selector.items():
        logs = match(logs, name, "=", value)
    logs = logs.filter(F.col("message").contains(contains))
    if json_schema:
        logs = logs.withColumn("parsed", F.from_json("message", json_schema))
    tie = [F.col("log_id").desc()] if "log_id" in logs.columns else []
    return logs.orderBy(F.col("timestamp").desc(), *tie).limit(limit)


def min_level(logs: DataFrame, level: str, column: str = "level") -> DataFrame:
    return logs.filter(L.level_rank(F.col(column)) >= L.LOG_RANK.get(level, 1))


def organize(df: DataFrame, exclude: Sequence[str] = (), rename: Mapping[str, str] | None = None) -> DataFrame:
    return df.drop(*exclude).withColumnsRenamed(dict(rename or {}))


def sort_by(df: DataFrame, column: str, *ties: str, descending: bool = True) -> DataFrame:
    first = F.col(column).desc() if descending else F.col(column)
    return df.orderBy(first, *ties)


def label_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(label(df, name).alias(name)).where(F.col(name).isNotNull()).distinct().orderBy(name)


def shard_of(host: Column, shards: Mapping[str, str] = HOST_SHARDS, default: str = DEFAULT_SHARD) -> Column:
    """Shard of a host: an exact or sub-domain match of a configured suffix."""
    expr = F.lit(default)
    for suffix, shard in shards.items():
        expr = F.when((host == suffix) | host.endswith("." + suffix), shard).otherwise(expr)
    return expr


def weighted_split(key: Column, weights: Mapping[str, int]) -> Column:
    """Stable traffic split; weights sum to 100."""
    bucket, expr, bound = cohort(key), F.lit(None).cast("string"), 100
    if sum(weights.values()) != 100:
        raise ValueError("weights must sum to 100")
    for name in reversed(list(weights)):
        expr = F.when(bucket < bound, name).otherwise(expr)
        bound -= weights[name]
    return expr


def bools_to_int(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in columns if c in df.columns})


def one_hot(df: DataFrame, column: str, levels: Sequence[str], drop_first: bool = True) -> DataFrame:
    """0/1 columns ``column_level`` for the given sorted levels, the first one left out."""
    kept = sorted(levels)[1 if drop_first else 0 :]
    return df.withColumns({f"{column}_{v}": (F.coalesce(F.col(column), F.lit("")) == v).cast("int") for v in kept}).drop(
        column
    )


def levels_of(df: DataFrame, column: str, limit: int = 1000) -> list[str]:
    """The distinct levels of a categorical column, learned at fit time; too many is an error, not a cut."""
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} levels; index it instead of one-hot encoding")
    return sorted(found)
