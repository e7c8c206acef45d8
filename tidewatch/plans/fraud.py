"""Fraud over the given tables."""

from pyspark.sql import functions as F

from tidewatch.operators import fraud as X
from tidewatch.plans.catalog import plain, query
from tidewatch.plans.selectors import TX


@query("F01_fraud_features", plain(f"""SELECT transaction_id, user_id, timestamp, amount, coalesce(user_age, (SELECT quantile_cont(user_age, 0.5) FROM {TX})) AS user_age,
   coalesce(account_age_days, (SELECT quantile_cont(account_age_days, 0.5) FROM {TX})) AS account_age_days, coalesce(shipping_billing_address_match, false)::BIGINT AS shipping_billing_address_match,
   failed_payment_attempts, device_is_new::BIGINT AS device_is_new, ip_address_country_match::BIGINT AS ip_address_country_match, email_is_disposable::BIGINT AS email_is_disposable FROM {TX}""",
   "amount user_age account_age_days failed_payment_attempts", "timestamp"))
def fraud_features(t):
    tx = t.transactions()
    return X.fraud_features(tx, X.learn_medians(tx))


SCORES = "(SELECT o_orderkey AS transaction_id, CASE WHEN o_orderkey % 3 != 0 THEN (o_orderkey % 101) / 100.0 END AS a, CASE WHEN o_orderkey % 5 != 0 THEN (o_orderkey % 89) / 88.0 END AS b, CASE WHEN o_orderkey % 15 != 0 THEN (o_custkey % 50) / 49.0 END AS c FROM orders)"


def scores():
    k, u = F.col("transaction_id"), F.col("user_id")
    return {"random_forest": F.when(k % 3 != 0, (k % 101) / 100.0), "boosting": F.when(k % 5 != 0, (k % 89) / 88.0), "isolation_forest": F.when(k % 15 != 0, (u % 50) / 49.0)}


ENSEMBLE = f"""(SELECT transaction_id, CASE WHEN w > 0 THEN (coalesce(a * 0.4, 0) + coalesce(b * 0.4, 0) + coalesce(c * 0.2, 0)) / w ELSE 0 END AS risk_score FROM (
   SELECT *, (a IS NOT NULL)::INT * 0.4::DOUBLE + (b IS NOT NULL)::INT * 0.4::DOUBLE + (c IS NOT NULL)::INT * 0.2::DOUBLE AS w FROM {SCORES}))"""


@query("F05_ensemble_score", plain(f"SELECT * FROM {ENSEMBLE}", "risk_score"))
def ensemble_score(t):
    return t.transactions().select("transaction_id", X.ensemble_score(scores()).alias("risk_score"))


def history_sql(spread, where="true"):
    return f"(SELECT o_custkey AS user_id, count(*)::BIGINT AS transaction_count, avg(o_totalprice) AS avg_amount, max(o_totalprice) AS max_amount, {spread}(o_totalprice) AS std_amount, max(o_orderdate) AS last_transaction_timestamp FROM orders WHERE {where} GROUP BY 1)"


@query("F06_user_history", plain(f"SELECT * FROM {history_sql('stddev_samp')}", "avg_amount max_amount std_amount", "last_transaction_timestamp", 2), digits=2)
def user_history(t):
    return X.user_history(t.transactions())


@query("F07_update_history_batch", plain(f"SELECT * FROM {history_sql('stddev_pop', 'o_orderkey % 17 != 0')}", "avg_amount max_amount std_amount", "last_transaction_timestamp", 2), digits=2)
def update_history_batch(t):
    return X.user_history(t.transactions().where(~F.col("email_is_disposable")), population_std=True)


# Known before 1998; transactions of 1998 and later are scored.
ADJUSTED = f"""(SELECT transaction_id, user_id, factors, level, risk, CASE WHEN n IS NULL THEN least(1, risk * 1.5) WHEN amount > mx * 2 THEN least(1, risk * 1.3) ELSE risk END AS risk_score FROM (
   SELECT t.*, n, mx, CASE WHEN n IS NULL THEN 'high' WHEN n < 3 THEN 'medium' ELSE 'low' END AS level,
     CASE WHEN n > 10 THEN risk_score * 0.8 WHEN n < 3 THEN least(1, risk_score * 1.2) ELSE risk_score END AS risk,
     array_to_string(list_filter([CASE WHEN n IS NOT NULL AND amount > mx * 2 THEN 'unusual_amount' END, CASE WHEN n IS NULL THEN 'unknown_user' END, CASE WHEN NOT shipping_billing_address_match THEN 'address_mismatch' END,
       CASE WHEN NOT ip_address_country_match THEN 'ip_country_mismatch' END, CASE WHEN email_is_disposable THEN 'disposable_email' END, CASE WHEN device_is_new THEN 'new_device' END,
       CASE WHEN failed_payment_attempts > 1 THEN 'multiple_payment_attempts' END], lambda x: x IS NOT NULL), ',') AS factors
   FROM {TX} t JOIN {ENSEMBLE} e USING (transaction_id) LEFT JOIN (SELECT o_custkey AS user_id, count(*) AS n, max(o_totalprice) / 3 AS mx FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1) h USING (user_id)
   WHERE timestamp >= TIMESTAMP '1998-01-01'))"""


def adjusted(t):
    tx = t.transactions()
    start = F.lit("1998-01-01").cast("timestamp")
    history = X.user_history(tx.where(F.col("timestamp") < start)).withColumn("max_amount", F.col("max_amount") / 3)
    new = tx.where(F.col("timestamp") >= start).withColumn("risk_score", X.ensemble_score(scores()))
    return X.adjust_risk(new, history)


@query("F08_adjust_risk", plain(f"SELECT transaction_id, level AS user_risk_level, risk_score FROM {ADJUSTED}", "risk_score"))
def adjust_risk(t):
    return adjusted(t).select("transaction_id", "user_risk_level", "risk_score")


@query("F09_risk_factors", f"SELECT transaction_id, factors AS risk_factors FROM {ADJUSTED}")
def risk_factors(t):
    return adjusted(t).select("transaction_id", F.array_join("risk_factors", ",").alias("risk_factors"))


@query("F10_risk_level", f"SELECT transaction_id, risk_score >= 0.7 AS is_fraud, CASE WHEN risk_score >= 0.9 THEN 'high' WHEN risk_score >= 0.7 THEN 'medium' ELSE 'low' END AS risk_level FROM {ADJUSTED}")
def risk_level(t):
    return X.with_risk_level(adjusted(t)).select("transaction_id", "is_fraud", "risk_level")


@query("F11_trailing_user_stats", plain("""SELECT transaction_id, count(amount) OVER w AS purchase_count_30d, avg(amount) OVER w AS avg_purchase_value_30d, max(amount) OVER w AS max_purchase_value_30d, min(amount) OVER w AS min_purchase_value_30d,
   stddev_samp(amount) OVER w AS std_purchase_value_30d, count(amount) OVER w / 30 AS purchase_frequency_30d, (epoch(timestamp) - epoch(max(timestamp) OVER w)) / 86400 AS days_since_last_purchase
   FROM (SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_totalprice AS amount, o_orderdate AS timestamp FROM orders)
   WINDOW w AS (PARTITION BY user_id ORDER BY timestamp RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 SECOND PRECEDING)""",
   "avg_purchase_value_30d max_purchase_value_30d min_purchase_value_30d std_purchase_value_30d purchase_frequency_30d days_since_last_purchase", digits=2), digits=2)
def trailing_user_stats(t):
    return X.trailing_user_stats(t.transactions().select("transaction_id", "user_id", "amount", "timestamp")).drop("user_id", "amount", "timestamp")
