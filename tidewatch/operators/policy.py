"""Access decisions, plan compliance and replica comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _true(col: Column) -> Column:
    return F.coalesce(col, F.lit(False))


def authorise(requests: DataFrame, required_role: str) -> DataFrame:
    """One audit row per request; whatever is missing does not allow.

    ``requests`` has ``user`` (id, authenticated, mfa_verified, roles) and ``request`` (encryption,
    data_classification, contains_pii, action, resource).
    """
    authenticated = _true(F.col("user.authenticated")) & _true(F.col("user.mfa_verified"))
    authorized = _true(F.array_contains("user.roles", required_role))
    compliant = (
        _true(F.col("request.encryption") == "TLS1.3") & _true(F.col("request.data_classification") != "PCI")
        & ~_true(F.col("request.contains_pii"))
    )
    kept = [c for c in requests.columns if c not in ("user", "request")]
    return requests.select(
        *kept, F.col("user.id").alias("user_id"), F.col("request.action").alias("action"), F.col("request.resource").alias("resource"),
        authenticated.alias("authenticated"), authorized.alias("authorized"), compliant.alias("compliant"),
        (authenticated & authorized & compliant).alias("allowed"),
    )


def plan_compliance(changes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every rule over all resource changes (type, encrypted, mfa_enabled, enable_flow_logs, endpoint) of a plan.

    A rule concerns the resources of its type; a plan without such resources satisfies it. A cloud resource that names no
    endpoint does not use a validated one.
    """
    kind = F.col("type")
    every = lambda applies, ok: F.coalesce(F.bool_and(F.when(applies, _true(ok))), F.lit(True))
    rules = {
        "enforce_encryption": every(F.col("encrypted").isNotNull(), F.col("encrypted")),
        "enforce_mfa": every(kind == "aws_iam_user", F.col("mfa_enabled")),
        "enforce_flow_logs": every(kind == "aws_vpc", F.col("enable_flow_logs")),
        "enforce_fips_endpoints": every(kind.startswith("aws_"), F.col("endpoint").contains("fips")),
    }
    out = changes.groupBy(*by).agg(*[c.alias(n) for n, c in rules.items()])
    passed = F.lit(True)
    for name in rules:
        passed &= F.col(name)
    return out.withColumn("main", passed)


def replica_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that differ between two copies and how. Rows travel as one hash each, not whole."""
    columns = [c for c in left.columns if c != key]
    digest = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns])
    a = left.select(key, digest.alias("_l"))
    b = right.select(key, digest.alias("_r"))
    rows = a.join(b, key, "full_outer").where(~F.col("_l").eqNullSafe(F.col("_r")))
    status = F.when(F.col("_r").isNull(), "missing_right").when(F.col("_l").isNull(), "missing_left").otherwise("changed")
    return rows.select(key, status.alias("status"))


def replication_lag(primary: DataFrame, replica: DataFrame, ts: str, limit_s: float = 30.0) -> DataFrame:
    """Newest time on both sides, the lag in seconds and whether it is within the limit."""
    newest = replica.agg(F.max(ts).alias("replica_ts"))
    out = primary.agg(F.max(ts).alias("primary_ts")).withColumn("replica_ts", newest.scalar())
    lag = (F.unix_micros("primary_ts") - F.unix_micros("replica_ts")) / 1_000_000
    return out.withColumn("lag_s", lag).withColumn("within_limit", F.col("lag_s") <= limit_s)
