"""Remediation planning, breakers and health states. Nothing here acts on a system."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.durations import micros
from tidewatch.operators.cycles import cycle_outcomes
from tidewatch.operators.sequence import running_total, suggest_chunk, with_last_known, with_previous
from tidewatch.session import materialise

SEVERITY_ORDER = {"low": 0, "medium": 1, "high": 2, "critical": 3}
MAX_REPLICAS = 10

# Actions in configuration order.
ACTIONS: list[dict[str, Any]] = [
    {"name": "scale_up_deployment", "severity": "medium", "requires_approval": False, "issues": ["high_cpu_usage", "high_memory_usage", "high_request_rate"]},
    {"name": "restart_pod", "severity": "medium", "requires_approval": False, "issues": ["memory_leak", "stuck_process", "high_error_rate"]},
    {"name": "circuit_breaker", "severity": "high", "requires_approval": True, "issues": ["dependency_failure", "high_latency", "timeout"]},
    {"name": "rollback_deployment", "severity": "critical", "requires_approval": True, "issues": ["deployment_failure", "critical_error_rate", "service_outage"]},
    {"name": "adjust_resource_limits", "severity": "medium", "requires_approval": False, "issues": ["resource_constraint", "oom_killed", "throttled_cpu"]},
    {"name": "purge_cache", "severity": "low", "requires_approval": False, "issues": ["cache_inconsistency", "stale_data"]},
    {"name": "toggle_feature_flag", "severity": "medium", "requires_approval": True, "issues": ["feature_error", "performance_degradation"]},
    {"name": "scale_database", "severity": "high", "requires_approval": True, "issues": ["database_bottleneck", "high_db_cpu", "high_db_memory", "high_db_connections"]},
    {"name": "add_rate_limiting", "severity": "medium", "requires_approval": False, "issues": ["api_abuse", "ddos_attack", "high_request_rate"]},
    {"name": "block_ip", "severity": "high", "requires_approval": True, "issues": ["security_threat", "brute_force_attack", "api_abuse"]},
]
NO_ACTION = "No applicable remediation actions found"
NOT_APPROVED = "Remediation action not approved"
NO_APPROVER = "Remediation action requires approval, but no approval callback registered"


def plan_remediation(issues: DataFrame, actions: Sequence[Mapping[str, Any]] = ACTIONS, issue: str = "issue") -> DataFrame:
    """The mildest action for each issue and all candidates in order; a message where there is none."""
    ranked = sorted(enumerate(actions), key=lambda a: (SEVERITY_ORDER.get(a[1]["severity"], 4), a[0]))
    options = []
    for _, action in ranked:
        row = F.struct(
            F.lit(action["name"]).alias("action"), F.lit(action["severity"]).alias("action_severity"),
            F.lit(action["requires_approval"]).alias("requires_approval"),
        )
        options.append(F.when(F.col(issue).isin(list(action["issues"])), row))
    rows = issues.withColumn("_options", F.filter(F.array(*options), lambda x: x.isNotNull()))
    chosen = F.try_element_at("_options", F.lit(1))
    return rows.withColumn("_chosen", chosen).select(
        *issues.columns, "_chosen.*", F.transform("_options", lambda x: x["action"]).alias("candidates"),
        F.when(F.size("_options") == 0, NO_ACTION).alias("message"),
    )


def needs_approval(planned: DataFrame, approvals: DataFrame, dry_run: bool = False) -> DataFrame:
    """Planned actions with the verdict of the approver of their severity (approvals: severity, approved)."""
    verdicts = approvals.groupBy(F.col("severity").alias("action_severity")).agg(F.max("approved").alias("_approved"))
    rows = planned.join(verdicts, "action_severity", "left")
    asked = F.coalesce(F.col("requires_approval"), F.lit(False)) & ~F.lit(dry_run)
    refused = F.when(asked & F.col("_approved").isNull(), NO_APPROVER).when(asked & ~F.col("_approved"), NOT_APPROVED)
    message = F.coalesce(F.col("message"), refused)
    return rows.withColumns({"message": message, "allowed": message.isNull()}).drop("_approved")


def target_replicas(current: Column, cap: int | None = MAX_REPLICAS) -> Column:
    """Half as many more, at least one more; never beyond the cap, never below what runs."""
    wanted = F.greatest(current + 1, (current * 1.5).cast("int"))
    return wanted if cap is None else F.greatest(current, F.least(wanted, F.lit(cap)))


def rollback_plan(executions: DataFrame) -> DataFrame:
    """The inverse of each successful scaling; other actions have nothing to undo, failed ones cannot be undone."""
    undone = executions.where(F.col("success") & ~F.coalesce(F.col("dry_run"), F.lit(False)) & (F.col("action") == "scale_up_deployment"))
    return undone.select(
        F.concat(F.lit("rollback_"), F.col("action")).alias("action"), "service", "namespace",
        F.col("new_replicas").alias("current_replicas"), F.col("previous_replicas").alias("rollback_replicas"),
    )


def circuit_state(failures: DataFrame, context: str, ident: str, threshold: int, reset: str, chunk: str | None = None) -> DataFrame:
    """What each failure meets: counted, the one that opens the breaker, or refused while it is open."""
    names = F.create_map(F.lit(0), F.lit("counted"), F.lit(1), F.lit("opened"), F.lit(2), F.lit("refused"))
    out = cycle_outcomes(failures, context, ident, "timestamp", threshold, reset, chunk)
    return failures.join(out.select(ident, names[F.col("outcome")].alias("breaker")), ident)


def eject_outliers(
    requests: DataFrame, host: str, tie: Sequence[str], errors: int = 5, interval: str = "30s", ejection: str = "30s", chunk: str | None = None,
) -> DataFrame:
    """Hosts with ``errors`` server errors in a row within one interval, and how long they stay out.

    Any ``errors`` errors in a row count that span no more than the interval, wherever their run began; after an
    ejection the count starts anew. Of the errors that end such a span, one is passed over if fewer than ``errors`` of
    the host's errors came since the last ejection: the rule that suppresses duplicates, with the running number of
    errors as its clock. Numbers and spans are carried over chunks, so a host of any size is split.
    """
    order = {"ts": "timestamp", "tie": tie, "chunk": chunk or suggest_chunk(requests, [host])}
    rows = requests.withColumn("_bad", (F.col("status_code") >= 500).cast("long"))
    rows = running_total(rows, [host], {"_errors": "_bad"}, **order)
    rows = rows.withColumn("_at_good", F.when(F.col("_bad") == 0, F.col("_errors")))
    rows = with_last_known(rows, [host], {"_before": "_at_good"}, **order)
    last = "timestamp"
    for i in range(1, errors):
        rows = with_previous(rows, [host], {f"_t{i}": last}, **order)
        last = f"_t{i}"
    place = F.col("_errors") - F.coalesce("_before", F.lit(0))
    span = F.unix_micros("timestamp") - F.unix_micros(last)
    rows = rows.where((F.col("_bad") == 1) & (place >= errors) & (span <= micros(interval)))
    # An error's number tells it apart inside its host; a stretch of numbers fills a task.
    named = F.concat_ws("|", F.col(host).cast("string"), F.col("_errors").cast("string"))
    ends = materialise(rows.select(host, "timestamp", named.alias("_id"), F.timestamp_micros("_errors").alias("_clock")), "ejections")
    kept = cycle_outcomes(ends, host, "_id", "_clock", 1, errors / 1_000_000, chunk="1s").where(F.col("outcome") == 1)
    return ends.join(kept, "_id", "left_semi").select(
        host, F.col("timestamp").alias("ejected_at"), F.timestamp_micros(F.unix_micros("timestamp") + micros(ejection)).alias("back_at")
    )


def health_state(probes: DataFrame, target: str, tie: Sequence[str], good: int = 3, bad: int = 2, chunk: str | None = None) -> DataFrame:
    """State after each probe: healthy after ``good`` successes in a row, unhealthy after ``bad`` failures in a row."""
    chunk = chunk or suggest_chunk(probes, [target])
    rows, last = probes, "ok"
    seen = ["ok"]
    for i in range(1, max(good, bad)):
        rows = with_previous(rows, [target], {f"_ok{i}": last}, tie=tie, chunk=chunk)
        last = f"_ok{i}"
        seen.append(last)
    run = lambda n, value: F.forall(F.array(*[F.col(c) for c in seen[:n]]), lambda x: F.coalesce(x == value, F.lit(False)))
    rows = rows.withColumn("_turn", F.when(run(good, True), "healthy").when(run(bad, False), "unhealthy"))
    rows = with_last_known(rows, [target], {"state": "_turn"}, tie=tie, chunk=chunk)
    return rows.withColumn("state", F.coalesce("state", F.lit("unknown"))).drop("_turn", *seen[1:])
