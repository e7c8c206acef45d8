"""Alerts: rows from findings, de-duplication, rate limit, fan-out, routing, grouping and inhibition."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.durations import duration_seconds, micros, seconds, step_start
from tidewatch.functions.labels import one_row_per_hit, render
from tidewatch.operators.cycles import cycle_outcomes
from tidewatch.operators.ordered import in_order

DEDUPE_WINDOW = "300s"
RATE_LIMIT = 10
CONFIGURED_RATE_LIMIT = 20
MAX_RETRIES = 3

# Per kind the title, message, severity, tags, source (a field name or a fixed text) and field defaults.
TEMPLATES: dict[str, dict[str, Any]] = {
    "anomaly": {
        "title": "Anomaly Detected: {service} - {metric}",
        "message": "An anomaly was detected in {service} for metric {metric}. Current value: {value}, expected range: {lower_bound} - {upper_bound}.",
        "severity": "warning", "tags": ["anomaly", "ml", "observability"], "source": "{service}",
        "fields": {"service": "unknown", "metric": "unknown", "value": 0, "expected_value": 0, "lower_bound": 0, "upper_bound": 0, "anomaly_score": 0},
    },
    "predictive": {
        "title": "Predicted Issue: {service} - {metric}",
        "message": "A potential issue is predicted in {service} for metric {metric} in {time_until} hours. Confidence: {confidence}%.",
        "severity": "info", "tags": ["predictive", "ml", "observability"], "source": "{service}",
        "fields": {"service": "unknown", "metric": "unknown", "time_until": 0, "confidence": 0, "severity": "unknown", "predicted_value": 0, "current_value": 0},
    },
    "service_health": {
        "title": "Service Health Issue: {service}",
        "message": "Service {service} is experiencing health issues. Status: {status}.",
        "severity": "error", "tags": ["service-health", "infrastructure"], "source": "{service}",
        "fields": {"service": "unknown", "status": "unknown", "message": ""},
    },
    "resource_utilization": {
        "title": "High Resource Utilization: {service} - {resource}",
        "message": "Service {service} is experiencing high {resource} utilization ({value}%).",
        "severity": "warning", "tags": ["resource", "infrastructure"], "source": "{service}",
        "fields": {"service": "unknown", "resource": "unknown", "value": 0, "threshold": 0},
    },
    "security": {
        "title": "Security Alert: {type}",
        "message": "A security issue of type {type} was detected. Source: {source}.",
        "severity": "critical", "tags": ["security", "threat"], "source": "{source}",
        "fields": {"type": "unknown", "source": "unknown", "details": ""},
    },
    "dependency_failure": {
        "title": "Dependency Failure: {service} -> {dependency}",
        "message": "Service {service} is experiencing issues with dependency {dependency}. Error rate: {error_rate}%.",
        "severity": "error", "tags": ["dependency", "infrastructure"], "source": "{service}",
        "fields": {"service": "unknown", "dependency": "unknown", "error_rate": 0, "message": ""},
    },
    "fraud": {
        "title": "Potential Fraud Detected: {transaction_id}",
        "message": "Potential fraudulent activity detected for transaction {transaction_id}. Risk score: {risk_score}.",
        "severity": "critical", "tags": ["fraud", "security", "business"], "source": "fraud-detection",
        "fields": {"transaction_id": "unknown", "risk_score": 0, "user_id": "unknown", "amount": 0},
    },
    "inventory": {
        "title": "Inventory Alert: {product}",
        "message": "Product {product} inventory level is {level}, which is below the threshold of {threshold}.",
        "severity": "warning", "tags": ["inventory", "business"], "source": "inventory-management",
        "fields": {"product": "unknown", "level": 0, "threshold": 0, "warehouse": "unknown"},
    },
    "intrusion": {
        "title": "Intrusion Attempt Detected: {source_ip}",
        "message": "Potential intrusion attempt detected from {source_ip}. Attack type: {attack_type}.",
        "severity": "critical", "tags": ["intrusion", "security", "threat"], "source": "intrusion-detection",
        "fields": {"source_ip": "unknown", "attack_type": "unknown", "target": "unknown", "severity": "unknown"},
    },
}
# Input columns with another name than their template field.
RENAMED = {"metric": "metric_name", "time_until": "time_until_hours"}

# Delivery channels.
CHANNELS = [
    {"name": "general-slack", "type": "slack", "enabled": True},
    {"name": "critical-slack", "type": "slack", "enabled": True, "severity_filter": ["critical"]},
    {"name": "pagerduty", "type": "pagerduty", "enabled": True, "severity_filter": ["error", "critical"]},
    {"name": "email-digest", "type": "email", "enabled": True},
    {"name": "webhook", "type": "webhook", "enabled": True},
]

# Routes in order, the receiver of everything else, and timing.
ROUTES = [
    {"match": {"severity": "critical"}, "receiver": "pagerduty-critical", "continue": True},
    {"match": {"severity": "critical"}, "receiver": "slack-critical", "group_wait": "15s"},
    {"match": {"severity": "warning"}, "receiver": "slack-warnings"},
    {"match": {"team": "platform"}, "receiver": "team-platform"},
    {"match": {"team": "application"}, "receiver": "team-application"},
    {"match": {"team": "database"}, "receiver": "team-database"},
    {"match": {"team": "security"}, "receiver": "team-security"},
    {"match": {"team": "sre"}, "receiver": "team-sre"},
]
DEFAULT_RECEIVER = "slack-notifications"
GROUP_BY = ["alertname", "cluster", "service"]
GROUP_WAIT, GROUP_INTERVAL, REPEAT_INTERVAL = "30s", "5m", "4h"

# Inhibition rules.
INHIBITIONS = [
    {"source": {"severity": "critical"}, "target": {"severity": "warning"}, "equal": ["alertname", "cluster", "service"]},
    {"source": {"alertname": "ServiceDown"}, "target": {"alertname": "PodNotReady"}, "equal": ["service", "namespace"]},
]


def dedupe_key(source: Column, title: Column, ts: Column) -> Column:
    return F.concat_ws(":", source, title, F.date_format(ts, "yyyyMMddHHmm"))


def to_alerts(findings: DataFrame, kind: str, ts: str = "timestamp") -> DataFrame:
    """Findings of one kind as alert rows; a missing or null field takes its default."""
    spec = TEMPLATES[kind]
    context: dict[str, Column] = {}
    for name, default in spec["fields"].items():
        column = RENAMED.get(name, name)
        fallback = F.lit(str(default))
        if column not in findings.columns:
            context[name] = fallback
        elif kind == "predictive" and name == "confidence":
            context[name] = F.coalesce((F.col(column) * 100).cast("int").cast("string"), fallback)
        else:
            context[name] = F.coalesce(F.col(column).cast("string"), fallback)
    title = render(spec["title"], context)
    source = render(spec["source"], context)
    return findings.select(
        F.lit(kind).alias("kind"), title.alias("title"), render(spec["message"], context).alias("message"),
        F.lit(spec["severity"]).alias("severity"), source.alias("source"), F.col(ts).alias("timestamp"),
        F.create_map(*[x for k, v in context.items() for x in (F.lit(k), v)]).alias("details"),
        F.array(*[F.lit(x) for x in spec["tags"]]).alias("tags"), dedupe_key(source, title, F.col(ts)).alias("dedupe_key"),
    )


def suppress_duplicates(alerts: DataFrame, ident: str, window: str = DEDUPE_WINDOW, key: str = "dedupe_key", chunk: str | None = None) -> DataFrame:
    """Drop an alert if one of its key was accepted less than ``window`` before; exact for keys of any size."""
    kept = cycle_outcomes(alerts, key, ident, "timestamp", 1, window, chunk).where(F.col("outcome") == 1)
    return alerts.join(kept.select(ident), ident, "left_semi")


def suppress_tumbling(alerts: DataFrame, tie: Sequence[str], window: str = DEDUPE_WINDOW, key: str = "dedupe_key") -> DataFrame:
    """The first alert of each key and fixed window; an approximation of the rule above without order dependence."""
    slot = step_start(F.col("timestamp"), micros(window)).alias("_slot")
    rest = [c for c in alerts.columns if c != key]
    first = alerts.groupBy(key, slot).agg(F.min_by(F.struct(*rest), F.struct("timestamp", *tie)).alias("_row"))
    return first.select(key, "_row.*")


def rate_limit(alerts: DataFrame, tie: Sequence[str], limit: int = RATE_LIMIT, window: str = "60s", by: Sequence[str] = ()) -> DataFrame:
    """At most ``limit`` alerts per fixed window, the earliest; the rest is dropped (before the shuffle, where possible)."""
    order = W.partitionBy("_slot", *by).orderBy("timestamp", *tie)
    slotted = alerts.withColumn("_slot", step_start(F.col("timestamp"), micros(window)))
    return slotted.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit).drop("_slot", "_rank")


def _admit(limit: int, slot: int, window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queue, current, taken, accepted = None, None, 0, {}
        for pdf in batches:
            ok = np.zeros(len(pdf), dtype=bool)
            for i, (who, key, us) in enumerate(zip(pdf["_queue"], pdf["_key"], pdf["_us"])):
                if who != queue:
                    queue, current, accepted = who, None, {}
                if us // slot != current:
                    # What is held: keys accepted within the window, at most ``limit`` per slot.
                    current, taken = us // slot, 0
                    accepted = {k: t for k, t in accepted.items() if us - t < window}
                if taken < limit and us - accepted.get(key, us - window) >= window:
                    ok[i], accepted[key] = True, us
                    taken += 1
            yield pdf.loc[ok, ["_id"]]

    return run


def admit(
    alerts: DataFrame, ident: str, by: Sequence[str], limit: int = RATE_LIMIT, slot: str = "60s", window: str = DEDUPE_WINDOW, key: str = "dedupe_key",
) -> DataFrame:
    """The alerts a queue lets through: at most ``limit`` accepted per fixed ``slot``, and none whose key was accepted
    less than ``window`` before. Only accepted alerts count: a duplicate uses no budget, a limited alert is not remembered.

    A queue is sequential by nature: its alerts stream through one task in order, with the keys accepted within the
    window as its state. ``by`` names the columns that make queues of their own, which run side by side.
    """
    queue = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by])
    rows = alerts.select(queue.alias("_queue"), F.col(ident).alias("_id"), F.coalesce(F.col(key), F.lit("")).alias("_key"), F.unix_micros("timestamp").alias("_us"))
    kept = in_order(rows, ["_queue"], ["_us", "_id"]).mapInPandas(_admit(limit, micros(slot), micros(window)), f"_id {dict(alerts.dtypes)[ident]}")
    return alerts.join(kept.withColumnRenamed("_id", ident), ident, "left_semi")


def fan_out(alerts: DataFrame, channels: Sequence[Mapping[str, Any]] = CHANNELS) -> DataFrame:
    """One row per alert and channel that takes it. The channels are expressions on the alert's row: no join."""
    hits = []
    for channel in channels:
        takes = F.lit(bool(channel.get("enabled", True)))
        if channel.get("severity_filter"):
            takes &= F.col("severity").isin(list(channel["severity_filter"]))
        if channel.get("source_filter"):
            takes &= F.col("source").isin(list(channel["source_filter"]))
        if channel.get("tag_filter"):
            takes &= F.arrays_overlap("tags", F.array(*[F.lit(x) for x in channel["tag_filter"]]))
        hits.append(F.when(takes, F.struct(F.lit(channel["name"]).alias("channel"), F.lit(channel["type"]).alias("channel_type"))))
    return one_row_per_hit(alerts, hits)


def retry_candidates(deliveries: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    return deliveries.where(~F.col("delivered") & (F.col("delivery_attempts") < max_retries))


def alert_history(alerts: DataFrame, tie: Sequence[str], limit: int = 100) -> DataFrame:
    """The last ``limit`` alerts, newest first."""
    return alerts.orderBy(F.col("timestamp").desc(), *[F.col(c).desc() for c in tie]).limit(limit)


def route(alerts: DataFrame, routes: Sequence[Mapping[str, Any]] = ROUTES, default: str = DEFAULT_RECEIVER) -> DataFrame:
    """One row per alert and receiver: routes in order, the first match ends the search unless it continues."""
    stopped, matched, hits = F.lit(False), F.lit(False), []
    for entry in routes:
        hit = F.lit(True)
        for label, value in entry["match"].items():
            column = F.col(label) if label in alerts.columns else F.col("labels")[label]
            hit &= F.coalesce(column == value, F.lit(False))
        taken = hit & ~stopped
        row = F.struct(F.lit(entry["receiver"]).alias("receiver"), F.lit(entry.get("group_wait", GROUP_WAIT)).alias("group_wait"))
        hits.append(F.when(taken, row))
        matched |= taken
        if not entry.get("continue"):
            stopped |= taken
    fallback = F.struct(F.lit(default).alias("receiver"), F.lit(GROUP_WAIT).alias("group_wait"))
    return one_row_per_hit(alerts, [*hits, F.when(~matched, fallback)])


def group_notifications(
    routed: DataFrame, by: Sequence[str] = GROUP_BY, interval: str = GROUP_INTERVAL, repeat: str = REPEAT_INTERVAL,
    until: Column | None = None,
) -> DataFrame:
    """Notifications per receiver and group.

    A group is first sent ``group_wait`` after its first alert, then looked at every ``interval``: sent again when new
    alerts came, or when the last sending is ``repeat`` ago (until the given end, or the group's last alert). The ticks
    follow from the group's first alert, so this is two aggregations.
    """
    size, again = seconds(interval), int(-(-seconds(repeat) // seconds(interval)))
    keys = ["receiver", *by]
    wait = F.coalesce(duration_seconds(F.col("group_wait")), F.lit(seconds(GROUP_WAIT)))
    t = F.unix_micros("timestamp") / 1_000_000
    groups = routed.groupBy(*keys).agg((F.min(t) + F.min(wait)).alias("_first"))
    tick = F.greatest(F.lit(0), F.ceil((t - F.col("_first")) / size)).cast("long")
    sent = routed.join(groups, keys).groupBy(*keys, "_first", tick.alias("_tick")).agg(F.count(F.lit(1)).alias("new_alerts"))
    following = F.lead("_tick").over(W.partitionBy(*keys).orderBy("_tick"))
    end = F.floor((F.unix_micros(until) / 1_000_000 - F.col("_first")) / size) if until is not None else F.col("_tick")
    last = F.coalesce(following - 1, F.greatest(end, F.col("_tick")))
    sent = sent.withColumn("_until", last.cast("long"))
    sent = sent.withColumn("_at", F.explode(F.sequence("_tick", "_until", F.lit(again).cast("long"))))
    return sent.select(
        *keys, F.timestamp_micros(((F.col("_first") + F.col("_at") * size) * 1_000_000).cast("long")).alias("sent_at"),
        F.when(F.col("_at") == F.col("_tick"), F.col("new_alerts")).otherwise(0).alias("new_alerts"),
        (F.col("_at") != F.col("_tick")).alias("repeated"),
    )


def inhibit(alerts: DataFrame, rules: Sequence[Mapping[str, Any]] = INHIBITIONS, at: str = "eval_ts") -> DataFrame:
    """Drop a target alert at the times a source alert with equal labels fires.

    Alerts are state rows on the evaluation grid, so overlap is equality of time: an anti join on labels and time.
    """
    out = alerts
    for rule in rules:
        is_source = F.col("state") == "firing" if "state" in alerts.columns else F.lit(True)
        for label, value in rule["source"].items():
            is_source &= F.col(label) == value
        is_target = F.lit(True)
        for label, value in rule["target"].items():
            is_target &= F.coalesce(F.col(label) == value, F.lit(False))
        equal = [*rule["equal"], at]
        sources = alerts.where(is_source).select(*[F.col(c).alias(f"_s_{c}") for c in equal]).distinct()
        on = is_target
        for c in equal:
            on &= F.col(c).eqNullSafe(F.col(f"_s_{c}")) if c != at else F.col(c) == F.col(f"_s_{c}")
        out = out.join(sources, on, "left_anti")
    return out
