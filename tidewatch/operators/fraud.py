"""Fraud scoring: features, user history, ensemble score, risk adjustment and level."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.operators.selectors import bools_to_int
from tidewatch.schema import present

# Model features in model order.
FEATURES = [
    "amount", "user_age", "account_age_days", "days_since_last_purchase", "purchase_count_30d",
    "avg_purchase_value_30d", "max_purchase_value_30d", "min_purchase_value_30d", "std_purchase_value_30d",
    "purchase_frequency_30d", "shipping_billing_address_match", "shipping_address_change", "billing_address_change",
    "email_domain_match", "phone_number_match", "ip_address_risk_score", "device_risk_score", "browser_risk_score",
    "time_of_day_risk_score", "day_of_week_risk_score", "payment_method_risk_score", "product_category_risk_score",
    "shipping_method_risk_score", "coupon_code_risk_score", "cart_abandonment_count", "failed_payment_attempts",
    "checkout_time_seconds", "page_views_count", "device_is_mobile", "device_is_new", "ip_address_is_proxy",
    "ip_address_country_match", "email_is_free", "email_is_disposable", "card_bin_risk_score",
    "card_issuer_risk_score", "card_type_risk_score",
]
# Flags, the flags that default to true, features filled with the median, and everything else.
FLAGS = [
    "shipping_billing_address_match", "shipping_address_change", "billing_address_change", "email_domain_match",
    "phone_number_match", "device_is_mobile", "device_is_new", "ip_address_is_proxy", "ip_address_country_match",
    "email_is_free", "email_is_disposable",
]
TRUE_BY_DEFAULT = {"email_domain_match", "phone_number_match", "ip_address_country_match"}
MEDIAN_FILLED = ["user_age", "account_age_days", "days_since_last_purchase", "checkout_time_seconds", "page_views_count"]
UNKNOWN_RISK = 0.5
WEIGHTS = {"random_forest": 0.4, "boosting": 0.4, "isolation_forest": 0.2}
FRAUD_AT = 0.7
HIGH_RISK_AT = 0.9


def default_of(feature: str) -> bool | float | None:
    """The constant a missing feature is filled with; None means the learned median."""
    if feature in MEDIAN_FILLED:
        return None
    if feature in FLAGS:
        return feature in TRUE_BY_DEFAULT
    return UNKNOWN_RISK if feature.endswith("_risk_score") else 0.0


def learn_medians(transactions: DataFrame) -> DataFrame:
    """One row per median-filled column: column, median. Learned at fit time and kept with the model."""
    columns = present(transactions, MEDIAN_FILLED)
    long = transactions.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]))
    )
    return exact_quantiles(long, ["column"], "x", {"median": 0.5}).select("column", "median")


def impute_transactions(transactions: DataFrame, medians: DataFrame) -> DataFrame:
    """Missing features get their constant, or the learned median. ``medians`` has at most five rows."""
    stored = medians.agg(F.map_from_entries(F.collect_list(F.struct("column", "median"))).alias("m"))
    df = transactions.withColumn("_medians", stored.scalar())
    filled = {}
    for c in present(df, FEATURES):
        fill = default_of(c)
        value = F.col("_medians")[c] if fill is None else F.lit(fill)
        filled[c] = F.coalesce(F.col(c), value)
    return df.withColumns(filled).drop("_medians")


def fraud_features(transactions: DataFrame, medians: DataFrame) -> DataFrame:
    """Keys plus the present features in model order, flags as 0/1."""
    df = bools_to_int(impute_transactions(transactions, medians), FLAGS)
    keys = present(df, ["transaction_id", "user_id", "timestamp"])
    return df.select(*keys, *present(df, FEATURES))


def ensemble_score(scores: Mapping[str, Column], weights: Mapping[str, float] = WEIGHTS) -> Column:
    """Weighted mean of the model scores that are there; 0 when none is."""
    total = sum((F.when(c.isNotNull(), c * weights.get(m, 0.0)).otherwise(0.0) for m, c in scores.items()), F.lit(0.0))
    weight = sum((F.when(c.isNotNull(), F.lit(weights.get(m, 0.0))).otherwise(0.0) for m, c in scores.items()), F.lit(0.0))
    return F.when(weight > 0, total / weight).otherwise(0.0)


def user_history(transactions: DataFrame, population_std: bool = False) -> DataFrame:
    """Per user: count, mean, max and standard deviation of the amount, last time."""
    spread = F.stddev_pop if population_std else F.stddev_samp
    return transactions.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.avg("amount").alias("avg_amount"),
        F.max("amount").alias("max_amount"),
        spread("amount").alias("std_amount"),
        F.max("timestamp").alias("last_transaction_timestamp"),
    )


def _flag_is(df: DataFrame, name: str, value: bool) -> Column:
    return (F.col(name) == F.lit(value)) if name in df.columns else F.lit(False)


def adjust_risk(scored: DataFrame, history: DataFrame) -> DataFrame:
    """Risk score after the user's history, the user's risk level and the factors found, in this order."""
    seen = history.select("user_id", "transaction_count", "max_amount")
    df = scored.join(seen, "user_id", "left")
    unknown = F.col("transaction_count").isNull()
    unusual = ~unknown & (F.col("amount") > F.col("max_amount") * 2)
    by_count = (
        F.when(unknown, F.col("risk_score"))
        .when(F.col("transaction_count") > 10, F.col("risk_score") * 0.8)
        .when(F.col("transaction_count") < 3, F.least(F.col("risk_score") * 1.2, F.lit(1.0)))
        .otherwise(F.col("risk_score"))
    )
    level = (
        F.when(unknown, "high").when((F.col("transaction_count") < 3), "medium").otherwise("low")
    )
    attempts = F.col("failed_payment_attempts") > 1 if "failed_payment_attempts" in df.columns else F.lit(False)
    checks = [
        ("unusual_amount", unusual),
        ("unknown_user", unknown),
        ("address_mismatch", _flag_is(df, "shipping_billing_address_match", False)),
        ("ip_country_mismatch", _flag_is(df, "ip_address_country_match", False)),
        ("disposable_email", _flag_is(df, "email_is_disposable", True)),
        ("new_device", _flag_is(df, "device_is_new", True)),
        ("multiple_payment_attempts", attempts),
    ]
    factors = F.filter(F.array(*[F.when(cond, name) for name, cond in checks]), lambda x: x.isNotNull())
    return (
        df.withColumns({"risk_factors": factors, "user_risk_level": level, "_counted": by_count, "_unusual": unusual})
        .withColumn(
            "risk_score",
            F.when(unknown, F.least(F.col("_counted") * 1.5, F.lit(1.0)))
            .when(F.col("_unusual"), F.least(F.col("_counted") * 1.3, F.lit(1.0)))
            .otherwise(F.col("_counted")),
        )
        .drop("_counted", "_unusual")
    )


def risk_level(score: Column) -> Column:
    return F.when(score >= HIGH_RISK_AT, "high").when(score >= FRAUD_AT, "medium").otherwise("low")


def with_risk_level(df: DataFrame) -> DataFrame:
    score = F.col("risk_score")
    return df.withColumns({"is_fraud": score >= FRAUD_AT, "risk_level": risk_level(score)})


def trailing_user_stats(transactions: DataFrame, days: int = 30) -> DataFrame:
    """Per transaction: what the same user bought in the ``days`` before it (the row's own time excluded).

    Transactions of one user and time are first combined, and a user's time line is cut into blocks of ``days`` that
    also see the block before, so a very busy user is spread over many tasks.
    """
    span = days * 86400
    t = F.unix_seconds("timestamp")
    moments = transactions.groupBy("user_id", t.alias("_t")).agg(
        F.count("amount").alias("_n"), F.sum("amount").alias("_s"), F.sum(F.col("amount") * F.col("amount")).alias("_ss"),
        F.min("amount").alias("_lo"), F.max("amount").alias("_hi"),
    )
    home = F.floor(F.col("_t") / span)
    placed = moments.withColumn("_block", F.explode(F.array(home, home + 1)))
    frame = W.partitionBy("user_id", "_block").orderBy("_t").rangeBetween(-span, -1)
    seen = placed.withColumns(
        {
            "purchase_count_30d": F.coalesce(F.sum("_n").over(frame), F.lit(0)),
            "_sum": F.sum("_s").over(frame), "_sq": F.sum("_ss").over(frame),
            "min_purchase_value_30d": F.min("_lo").over(frame), "max_purchase_value_30d": F.max("_hi").over(frame),
            "_last": F.max("_t").over(frame),
        }
    ).where(F.col("_block") == home)
    n = F.col("purchase_count_30d")
    mean = F.col("_sum") / n
    variance = F.greatest((F.col("_sq") - n * mean * mean) / (n - 1), F.lit(0.0))
    seen = seen.select(
        "user_id", "_t", "purchase_count_30d",
        F.when(n > 0, mean).alias("avg_purchase_value_30d"), "max_purchase_value_30d", "min_purchase_value_30d",
        F.when(n > 1, F.sqrt(variance)).alias("std_purchase_value_30d"),
        (n / F.lit(float(days))).alias("purchase_frequency_30d"),
        ((F.col("_t") - F.col("_last")) / 86400).alias("days_since_last_purchase"),
    )
    return transactions.withColumn("_t", t).join(seen, ["user_id", "_t"]).drop("_t")
