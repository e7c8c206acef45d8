"""Alert state over step-evaluated conditions, recording rules and the alert rule set."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.durations import micros, seconds
from tidewatch.functions.labels import matches
from tidewatch.operators import timeseries as ts
from tidewatch.session import materialise


#: Samples that one task orders, about.
SAMPLES = 2_000_000


def alert_state(condition: DataFrame, by: Sequence[str], hold: str, step: str) -> DataFrame:
    """Pending or firing for every time the condition holds.

    ``condition`` has one row per label set and evaluation time at which the expression returned a sample; a missing
    step ends the run. Firing means the run has lasted at least ``hold``.
    """
    size = micros(step)
    order = W.partitionBy(*by).orderBy("_t")
    rows = condition.withColumn("_t", F.unix_micros("eval_ts"))
    rows = rows.withColumn("_new", F.coalesce((F.col("_t") - F.lag("_t").over(order) > size).cast("int"), F.lit(1)))
    rows = rows.withColumn(
        "_since", F.max(F.when(F.col("_new") == 1, F.col("_t"))).over(order.rowsBetween(W.unboundedPreceding, 0))
    )
    firing = F.col("_t") - F.col("_since") >= micros(hold)
    return rows.select(
        *by, "eval_ts", "value", F.timestamp_micros("_since").alias("active_since"),
        F.when(firing, "firing").otherwise("pending").alias("state"),
    )


def series_key() -> Column:
    """One text per label set, whatever the order of the map entries."""
    return F.to_json(F.sort_array(F.map_entries(F.col("labels")))).alias("_series")


@dataclass(frozen=True)
class Signals:
    """Labelled samples (timestamp, name, labels, value) and the grid rules are evaluated on.

    The samples are read once: partials per series and step are written, and every rule starts from those.
    """

    samples: DataFrame
    step: str = "15s"

    @cached_property
    def partials(self) -> DataFrame:
        """Step partials of every series of every metric, with the series' labels."""
        return self._labelled(materialise(self._parts(self._tasks()), "rule-partials"))

    def _tasks(self) -> int | None:
        """Over how many tasks the samples are dealt, where the cores alone would get too many each."""
        n = self.samples.count()
        return ceil(n / SAMPLES) if n > SAMPLES * self.samples.sparkSession.sparkContext.defaultParallelism else None

    def _parts(self, tasks: int | None = None) -> DataFrame:
        return ts.step_partials(self.samples.select("name", series_key(), "timestamp", "value"), ["name", "_series"], self.step, tasks=tasks)

    def _labelled(self, parts: DataFrame) -> DataFrame:
        entries = F.from_json("_series", "array<struct<key:string,value:string>>")
        return parts.withColumn("labels", F.map_from_entries(entries))

    def only(self, names: Sequence[str]) -> Signals:
        """The same signals, of the named metrics alone."""
        return Signals(self.samples.where(F.col("name").isin(sorted(names))), self.step)

    def select(self, names: str | Sequence[str], labels: Sequence[str], where: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
        """Partials of the metrics after the matchers: name, the named labels as columns, and ``_series`` for all labels."""
        df = self.partials.where(F.col("name").isin([names] if isinstance(names, str) else list(names)))
        for key, (op, pattern) in (where or {}).items():
            df = df.where(matches(F.col("labels")[key], op, pattern))
        return df.withColumns({k: F.col("labels")[k] for k in labels}).drop("labels")

    def now(self, name, labels, where=None) -> DataFrame:
        """The last sample of every series of the metric, each still on its own."""
        return ts.instant_of(self.select(name, labels, where), [*labels, "_series"], self.step)

    def rate(self, names, labels, window, where=None) -> DataFrame:
        """Rates of every series of the metrics, each still on its own."""
        out = ts.increase_of(self.select(names, labels, where), ["name", *labels, "_series"], window, self.step)
        return out.withColumn("value", F.col("value") / seconds(window))


@dataclass(frozen=True)
class Rule:
    name: str
    expr: Callable[[Signals], DataFrame]
    by: tuple[str, ...]
    hold: str
    severity: str
    labels: Mapping[str, str] = field(default_factory=dict)
    summary: str = ""

    def evaluate(self, signals: Signals) -> DataFrame:
        """alert, severity, labels, state, value and times of every pending or firing instance."""
        rows = alert_state(self.expr(signals), self.by, self.hold, signals.step)
        entries = [x for k in self.by if not k.startswith("_") for x in (F.lit(k), F.coalesce(F.col(k).cast("string"), F.lit("")))]
        fixed = [x for k, v in self.labels.items() for x in (F.lit(k), F.lit(v))]
        labels = F.create_map(*entries, *fixed) if entries or fixed else F.create_map().cast("map<string,string>")
        return rows.select(
            F.lit(self.name).alias("alert"), F.lit(self.severity).alias("severity"), labels.alias("labels"),
            "state", "value", "eval_ts", "active_since", F.lit(self.summary).alias("summary"),
        )


@dataclass(frozen=True)
class _Asked(Signals):
    """Takes down which metrics the expressions select; nothing is read or written."""

    names: set[str] = field(default_factory=set)

    @cached_property
    def partials(self) -> DataFrame:
        return self._labelled(self._parts())

    def select(self, names, labels, where=None) -> DataFrame:
        self.names.update([names] if isinstance(names, str) else names)
        return super().select(names, labels, where)


def metrics_of(rules: Sequence[Rule], signals: Signals) -> set[str]:
    """The metrics that the rules' expressions select."""
    asked = _Asked(signals.samples, signals.step)
    for rule in rules:
        rule.expr(asked)
    return asked.names


def evaluate_rules(rules: Sequence[Rule], signals: Signals) -> DataFrame:
    """All rules' instances; partials are made of the metrics that the rules select, and of no others."""
    signals = signals.only(metrics_of(rules, signals))
    out = None
    for rule in rules:
        rows = rule.evaluate(signals)
        out = rows if out is None else out.unionByName(rows)
    return out


def active_alerts(alerts: DataFrame) -> DataFrame:
    """The firing alerts as the panel shows them."""
    return alerts.where(F.col("state") == "firing").select(
        F.col("alert").alias("Alert"), F.col("labels")["service"].alias("Service"),
        F.col("severity").alias("Severity"), F.col("state").alias("Status"), F.col("eval_ts").alias("Time"),
    )


# The counters behind the recorded signals.
RECORDED = {
    "request_latency_seconds_sum": "latency_sum", "request_latency_seconds_count": "latency_count",
    "request_errors_total": "errors", "request_total": "requests", "orders_total": "orders",
    "order_value_total": "order_value", "cart_abandoned_total": "abandoned", "cart_created_total": "created",
}


def recording_rules(signals: Signals, window: str = "5m", by: str = "job") -> DataFrame:
    """The six recorded per-job signals as one wide table per (job, eval_ts), in one pass over the samples."""
    rates = signals.rate(list(RECORDED), (by,), window)
    wide = rates.groupBy(by, "eval_ts").agg(
        *[F.sum(F.when(F.col("name") == metric, F.col("value"))).alias(f"_{c}") for metric, c in RECORDED.items()]
    )
    return wide.select(
        by, "eval_ts",
        F.try_divide("_latency_sum", "_latency_count").alias("request_latency_mean5m"),
        F.col("_errors").alias("request_errors_rate5m"), F.col("_requests").alias("request_rate5m"),
        F.col("_orders").alias("orders_rate5m"), F.col("_order_value").alias("order_value_rate5m"),
        F.try_divide("_abandoned", "_created").alias("cart_abandonment_rate5m"),
    )


def _share(s: Signals, metric: str, by: tuple[str, ...], window: str, status: str = "5..") -> DataFrame:
    rates = s.rate(metric, (*by, "status"), window)
    return ts.ratio(rates, by, matches(F.col("status"), "=~", status))


def _quantile(s: Signals, metric: str, q: float, by: tuple[str, ...], window: str) -> DataFrame:
    rates = s.rate(metric, (*by, "le"), window)
    bound = F.when(F.col("le") == "+Inf", float("inf")).otherwise(F.col("le").cast("double"))
    return ts.histogram_quantile(rates.withColumn("le", bound), q, by)


def _over(vector: DataFrame, op: str, limit: float) -> DataFrame:
    return ts.threshold_filter(vector, op, limit)


def _fraction(s: Signals, top: str, bottom: str, by: tuple[str, ...], where=None, scale: float = 1.0) -> DataFrame:
    """One metric over the other, series by series: both carry the same labels."""
    on = (*by, "_series")
    out = ts.vector_binop(s.now(top, by, where), s.now(bottom, by, where), "/", on)
    return out.withColumn("value", F.col("value") * scale)


def _cpu_share(s: Signals, by: tuple[str, ...]) -> DataFrame:
    where = {"container": ("!=", "")}
    used = ts.sum_by(s.rate("container_cpu_usage_seconds_total", by, "5m", where), *by)
    quota = ts.vector_binop(
        s.now("container_spec_cpu_quota", by, where), s.now("container_spec_cpu_period", by, where), "/", (*by, "_series")
    )
    return ts.vector_binop(used, ts.sum_by(quota, *by), "/", by)


def _recorded(s: Signals, column: str) -> DataFrame:
    return recording_rules(s).where(F.col(column).isNotNull()).select(
        "job", "eval_ts", F.col(column).alias("value")
    )


def _job_error_ratio(s: Signals) -> DataFrame:
    table = recording_rules(s)
    share = F.try_divide("request_errors_rate5m", "request_rate5m")
    return table.select("job", "eval_ts", share.alias("value")).where(F.col("value").isNotNull())


def _order_drop(s: Signals) -> DataFrame:
    now = _recorded(s, "orders_rate5m")
    ahead = ts.predict_linear(now, ["job"], "1h", 3600).withColumn("value", F.col("value") * 0.8)
    return ts.vector_binop(now, ahead, "<", ["job"])


def _grown(s: Signals, metric: str, by: tuple[str, ...], back: str, factor: float) -> DataFrame:
    now = ts.sum_by(s.now(metric, by), *by)
    before = ts.offset(now, by, back).withColumn("value", F.col("value") * factor)
    return ts.vector_binop(now, before, ">", by)


def _unsummed_error_ratio(s: Signals) -> DataFrame:
    on = ("service", "status", "_series")
    failed = s.rate("http_requests_total", on[:2], "5m", {"status": ("=~", "5..")})
    return ts.vector_binop(failed, s.rate("http_requests_total", on[:2], "5m"), "/", on)


POD = ("container", "pod", "namespace")
SERVICE = ("service", "kubernetes_namespace")
KUBE_STATE = {"job": ("=", "kube-state-metrics")}


def rule_set(thresholds: Mapping[str, float] | None = None) -> list[Rule]:
    """The 35 alert rules. ``thresholds`` holds generated limits for the two anomaly rules."""
    limits = {"latency": 0.5, "error_rate": 0.05, **(thresholds or {})}
    named = {"container": ("!=", "")}
    team = lambda t: {"team": t}
    return [
        Rule("ServiceDown", lambda s: _over(s.now("up", ("job", "service", "instance"), {"job": ("=", "kubernetes-pods")}), "==", 0),
             ("job", "service", "instance", "_series"), "1m", "critical", team("platform")),
        Rule("HighErrorRate", lambda s: _over(_share(s, "http_requests_total", SERVICE, "5m"), ">", 0.05),
             SERVICE, "5m", "critical", team("application")),
        Rule("APIEndpointDown", lambda s: _over(s.now("probe_success", ("job", "instance"), {"job": ("=", "blackbox")}), "==", 0),
             ("job", "instance", "_series"), "5m", "critical", team("application")),
        Rule("HighLatency", lambda s: _over(_quantile(s, "http_request_duration_seconds_bucket", 0.95, SERVICE, "5m"), ">", 0.5),
             SERVICE, "5m", "warning", team("application")),
        Rule("HighCPUUsage", lambda s: _over(_cpu_share(s, POD), ">", 0.8), POD, "10m", "warning", team("platform")),
        Rule("HighMemoryUsage",
             lambda s: _over(_fraction(s, "container_memory_working_set_bytes", "container_spec_memory_limit_bytes", POD, named), ">", 0.8),
             (*POD, "_series"), "10m", "warning", team("platform")),
        Rule("DiskSpaceRunningOut",
             lambda s: _over(_fraction(s, "node_filesystem_avail_bytes", "node_filesystem_size_bytes", ("instance", "mountpoint"), scale=100), "<", 10),
             ("instance", "mountpoint", "_series"), "5m", "warning", team("platform")),
        Rule("HorizontalPodAutoscalerMaxed",
             lambda s: ts.vector_eq(
                 s.now("kube_horizontalpodautoscaler_status_current_replicas", ("namespace", "horizontalpodautoscaler"), KUBE_STATE),
                 s.now("kube_horizontalpodautoscaler_spec_max_replicas", ("namespace", "horizontalpodautoscaler"), KUBE_STATE),
                 ("namespace", "horizontalpodautoscaler", "_series")),
             ("namespace", "horizontalpodautoscaler", "_series"), "15m", "warning", team("platform")),
        Rule("KubePodPending", lambda s: _over(s.now("kube_pod_status_phase", ("namespace", "pod"), {"phase": ("=", "Pending")}), "==", 1),
             ("namespace", "pod", "_series"), "15m", "warning", team("platform")),
        Rule("DatabaseConnectionPoolSaturation",
             lambda s: _over(_fraction(s, "db_connections_current", "db_connections_max", ("database",)), ">", 0.8),
             ("database", "_series"), "5m", "warning", team("database")),
        Rule("HighDatabaseCPU", lambda s: _over(s.rate("pg_stat_activity_count", ("database",), "5m", {"state": ("=", "active")}), ">", 20),
             ("database", "_series"), "5m", "warning", team("database")),
        Rule("SLOAvailabilityBreach",
             lambda s: _over(ts.availability_of(s.rate("http_requests_total", ("status",), "1h"), (), matches(F.col("status"), "=~", "5..")), "<", 99.9),
             (), "5m", "critical", team("sre")),
        Rule("SLOLatencyBreach", lambda s: _over(_quantile(s, "http_request_duration_seconds_bucket", 0.95, (), "1h"), ">", 0.3),
             (), "5m", "critical", team("sre")),
        Rule("ContainerRunningAsRoot", lambda s: _over(s.now("container_spec_security_context_run_as_user", POD, named), "==", 0),
             (*POD, "_series"), "5m", "warning", team("security")),
        Rule("PrivilegedContainer", lambda s: s.now("kube_pod_container_info", POD, named), (*POD, "_series"), "5m", "warning", team("security")),
        Rule("UnusualNetworkTraffic",
             lambda s: _over(ts.sum_by(s.rate("container_network_transmit_bytes_total", ("pod", "namespace"), "5m",
                                              {"namespace": ("!=", "kube-system")}), "pod", "namespace"), ">", 100 * 1024 * 1024),
             ("pod", "namespace"), "15m", "warning", team("security")),
        Rule("JobHighLatency", lambda s: _over(_recorded(s, "request_latency_mean5m"), ">", 0.5), ("job",), "5m", "warning"),
        Rule("JobHighErrorRate", lambda s: _over(_job_error_ratio(s), ">", 0.05), ("job",), "5m", "warning"),
        Rule("OrderRateDrop", _order_drop, ("job",), "15m", "warning"),
        Rule("CartAbandonmentRateHigh", lambda s: _over(_recorded(s, "cart_abandonment_rate5m"), ">", 0.7), ("job",), "15m", "warning"),
        Rule("RequestHighLatency", lambda s: _over(s.now("http_request_duration_seconds", ("service",)), ">", 1), ("service", "_series"), "5m", "critical"),
        Rule("ErrorRateHigh", lambda s: _over(_unsummed_error_ratio(s), ">", 0.01), ("service", "status", "_series"), "5m", "critical"),
        Rule("ComplianceViolation", lambda s: _over(s.now("compliance_check_status", ("service",)), "==", 0), ("service", "_series"), "1m", "critical"),
        Rule("TenantCostSpike", lambda s: _grown(s, "kubecost_namespace_cost", ("namespace",), "7d", 1.5), ("namespace",), "24h", "warning", {"category": "cost"}),
        Rule("ClusterCostIncrease", lambda s: _grown(s, "kubecost_cluster_total_cost", (), "1d", 1.2), (), "6h", "warning", {"category": "cost"}),
        Rule("UnusedResourceCost", lambda s: _over(ts.sum_by(s.now("kubecost_idle_cost", ("namespace",)), "namespace"), ">", 100),
             ("namespace",), "24h", "info", {"category": "cost"}),
        Rule("TenantResourceQuotaExceeded",
             lambda s: ts.vector_binop(s.now("namespace:container_cpu_usage:sum", ("namespace",)), s.now("namespace:resource_quota:cpu", ("namespace",)), ">", ("namespace", "_series")),
             ("namespace", "_series"), "15m", "warning"),
        Rule("EdgeDeviceOffline", lambda s: _over(s.now("up", ("job", "device_id"), {"job": ("=", "edge-device")}), "==", 0),
             ("job", "device_id", "_series"), "5m", "warning"),
        Rule("EdgeDeviceHighLatency", lambda s: _over(s.now("edge_latency_seconds", ("device_id",), {"quantile": ("=", "0.9")}), ">", 1),
             ("device_id", "_series"), "10m", "warning"),
        Rule("EdgeDeviceStorageCritical",
             lambda s: _over(_fraction(s, "edge_storage_free_bytes", "edge_storage_total_bytes", ("device_id",), scale=100), "<", 10),
             ("device_id", "_series"), "5m", "critical"),
        Rule("ServiceHighErrorRate", lambda s: _over(_share(s, "http_requests_total", ("service",), "5m"), ">", 0.05), ("service",), "5m", "critical"),
        Rule("SlowResponseTime", lambda s: _over(_quantile(s, "http_request_duration_seconds_bucket", 0.95, ("service",), "5m"), ">", 2),
             ("service",), "5m", "warning"),
        Rule("PodHighCPUUsage", lambda s: _over(ts.sum_by(s.rate("container_cpu_usage_seconds_total", ("pod",), "5m"), "pod"), ">", 0.8),
             ("pod",), "5m", "warning"),
        Rule("HighLatencyAnomaly", lambda s: _over(_quantile(s, "http_request_duration_seconds_bucket", 0.95, ("service",), "5m"), ">", limits["latency"]),
             ("service",), "5m", "warning", {"type": "dynamic_threshold"}),
        Rule("HighErrorRateAnomaly", lambda s: _over(_share(s, "http_requests_total", ("service",), "5m"), ">", limits["error_rate"]),
             ("service",), "5m", "critical", {"type": "dynamic_threshold"}),
    ]


def error_ratio_summed(signals: Signals, by: Sequence[str] = ("service",), window: str = "5m") -> DataFrame:
    """The corrected form of the unsummed error-rate rule."""
    return _share(signals, "http_requests_total", tuple(by), window)


def database_load_gauge(signals: Signals) -> DataFrame:
    """The corrected form of the rule that takes a rate of a gauge: its mean over the lookback."""
    return ts.avg_by(signals.now("pg_stat_activity_count", ("database",), {"state": ("=", "active")}), "database")
