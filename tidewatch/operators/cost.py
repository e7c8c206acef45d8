"""Tenant cost: attribution, shared and idle cost, budgets, chargeback, spikes and quotas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.session import materialise

from tidewatch.functions.labels import one_row_per_hit

# Shared services, tenants, budgets, quota defaults.
SHARED_SERVICES = ["monitoring", "logging", "ingress-nginx", "cert-manager"]
TENANTS = [
    {"name": "team-a", "namespaces": ["team-a"], "team": "team-a", "department": "engineering", "cost_center": "CC001", "billing_account": "BA001"},
    {"name": "team-b", "namespaces": ["team-b"], "team": "team-b", "department": "marketing", "cost_center": "CC002", "billing_account": "BA002"},
    {"name": "team-c", "namespaces": ["team-c"], "team": "team-c", "department": "finance", "cost_center": "CC003", "billing_account": "BA003"},
]
BUDGETS = [
    {"name": "team1-budget", "namespace": "^team1.*", "amount": 5000.0},
    {"name": "team2-budget", "namespace": "^team2.*", "amount": 3000.0},
    {"name": "engineering-budget", "label": ("department", "engineering"), "amount": 10000.0},
    {"name": "finance-budget", "label": ("department", "finance"), "amount": 5000.0},
]
BUDGET_ALERT_AT = 0.8
QUOTAS = {"requests.cpu": 20.0, "limits.cpu": 40.0, "requests.memory": 40.0, "limits.memory": 80.0, "pods": 100.0}


def attribute(costs: DataFrame, by: str, extra: Sequence[str] = ()) -> DataFrame:
    """Cost by team (namespaces named team...), or by a label that must be there."""
    if by == "team":
        rows = costs.where(F.col("namespace").rlike("^team.*"))
        keys = [F.col("namespace"), F.col("labels")["team"].alias("team")]
    else:
        rows = costs.where(F.map_contains_key("labels", by))
        keys = [F.col("labels")[by].alias(by)]
    return rows.groupBy(*keys, *extra).agg(F.sum("cost").alias("cost"), F.sum("cpu").alias("cpu"))


def share_costs(
    costs: DataFrame, tenant: str, period: Sequence[str], shared: Column | None = None, weight: str = "cpu", out: str = "shared_cost"
) -> DataFrame:
    """Spread the cost of the shared rows over the tenants of the same period, in proportion to their weight."""
    is_shared = F.col("namespace").isin(SHARED_SERVICES) if shared is None else shared
    own = lambda c: F.when(~is_shared, c)
    # One pass: tenants and the pool are sums of the same rows; what is left holds one row per period and tenant.
    sums = costs.groupBy(*period, tenant).agg(
        F.sum(own(F.col("cost"))).alias("cost"), F.sum(own(F.col(weight))).alias("_w"), F.count_if(~is_shared).alias("_rows"),
        F.sum(F.when(is_shared, F.col("cost"))).alias("_shared"),
    )
    whole = W.partitionBy(*period)
    rows = sums.withColumns({"_all": F.sum("_w").over(whole), "_pool": F.sum("_shared").over(whole)}).where("_rows > 0")
    part = F.coalesce(F.col("_pool"), F.lit(0.0)) * F.coalesce(F.try_divide("_w", "_all"), F.lit(0.0))
    return rows.select(*period, tenant, "cost", part.alias(out), (F.col("cost") + part).alias("total_cost"))


def share_idle(costs: DataFrame, idle: DataFrame, tenant: str, period: Sequence[str], weight: str = "cpu") -> DataFrame:
    """Spread idle cost (period columns, idle_cost) over the tenants of its period."""
    own = costs.groupBy(*period, tenant).agg(F.sum("cost").alias("cost"), F.sum(weight).alias("_w"))
    pool = idle.groupBy(*period).agg(F.sum("idle_cost").alias("_pool"))
    rows = own.withColumn("_all", F.sum("_w").over(W.partitionBy(*period))).join(pool, list(period), "left")
    part = F.coalesce(F.col("_pool"), F.lit(0.0)) * F.coalesce(F.try_divide("_w", "_all"), F.lit(0.0))
    return rows.select(*period, tenant, "cost", part.alias("idle_cost"), (F.col("cost") + part).alias("total_cost"))


def budget_status(costs: DataFrame, budgets: Sequence[Mapping[str, Any]] = BUDGETS, day: str = "day", alert_at: float = BUDGET_ALERT_AT) -> DataFrame:
    """Month-to-date cost per budget and day against its amount. Budgets are expressions on the cost row: no join."""
    hits = []
    for budget in budgets:
        if "namespace" in budget:
            mine = F.col("namespace").rlike(budget["namespace"])
        else:
            label, value = budget["label"]
            mine = F.coalesce(F.col("labels")[label] == value, F.lit(False))
        hits.append(F.when(mine, F.struct(F.lit(budget["name"]).alias("budget"), F.lit(float(budget["amount"])).alias("amount"))))
    rows = one_row_per_hit(costs, hits)
    daily = rows.groupBy("budget", "amount", day).agg(F.sum("cost").alias("_cost"))
    to_date = W.partitionBy("budget", "month").orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    out = daily.withColumn("month", F.trunc(day, "month")).withColumn("spent", F.sum("_cost").over(to_date))
    used = F.col("spent") / F.col("amount")
    status = F.when(used > 1, "exceeded").when(used >= alert_at, "alert").otherwise("ok")
    return out.select("budget", day, "amount", "spent", used.alias("used"), status.alias("status"))


def chargeback(costs: DataFrame, keys: Sequence[str] = ("team", "department", "cost_center"), day: str = "day") -> DataFrame:
    """Monthly cost by every level of the key hierarchy, days with cost counted. Daily sums are made before the roll-up."""
    month = F.trunc(day, "month").alias("month")
    daily = costs.groupBy(month, *keys, day).agg(F.sum("cost").alias("cost"))
    rolled = daily.rollup("month", *keys).agg(
        F.sum("cost").alias("cost"), F.count_distinct(day).alias("days"), F.grouping_id().alias("level")
    )
    return rolled.where(F.col("month").isNotNull())


def cost_spike(daily: DataFrame, by: Sequence[str], back_days: int, factor: float, day: str = "day") -> DataFrame:
    """Days whose cost exceeds ``factor`` times that of ``back_days`` before: an equi-join on the shifted day."""
    daily = materialise(daily, "daily-cost")  # read twice below
    before = daily.select(*by, F.date_add(day, back_days).alias(day), F.col("cost").alias("cost_before"))
    rows = daily.join(before, [*by, day])
    return rows.where(F.col("cost") > F.col("cost_before") * factor)


def idle_alert(idle: DataFrame, by: Sequence[str], limit: float = 100.0) -> DataFrame:
    return idle.groupBy(*by).agg(F.sum("idle_cost").alias("idle_cost")).where(F.col("idle_cost") > limit)


def quota_breach(usage: DataFrame, quotas: DataFrame | None = None, defaults: Mapping[str, float] = QUOTAS) -> DataFrame:
    """Usage (namespace, resource, used) above its quota; a namespace without its own quota has the default."""
    default = F.create_map(*[x for k, v in defaults.items() for x in (F.lit(k), F.lit(float(v)))])[F.col("resource")]
    rows = usage
    if quotas is not None:
        rows = rows.join(quotas.select("namespace", "resource", F.col("quota").alias("_own")), ["namespace", "resource"], "left")
        rows = rows.withColumn("quota", F.coalesce(F.col("_own"), default)).drop("_own")
    else:
        rows = rows.withColumn("quota", default)
    return rows.where(F.col("used") > F.col("quota"))


def tenant_dim(tenants: DataFrame) -> DataFrame:
    """One row per tenant namespace."""
    return tenants.select("name", F.explode("namespaces").alias("namespace"), *[c for c in tenants.columns if c not in ("name", "namespaces")])
