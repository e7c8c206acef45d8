"""Fitted models over the given tables (A06, A07, A16, F02 to F04, G04, I05), and what must hold of them as SQL."""

from pyspark.sql import functions as F

from tidewatch.operators import anomaly as A
from tidewatch.operators import classify as K
from tidewatch.operators import commerce as C
from tidewatch.operators import forest as X
from tidewatch.operators import fraud
from tidewatch.operators import inventory as I
from tidewatch.operators import prepare as P
from tidewatch.operators import rootcause as G
from tidewatch.plans.anomaly import calls
from tidewatch.plans.catalog import query
from tidewatch.session import materialise, spread

TYPES = ["click", "error", "purchase", "signup", "view"]


def scaled(t):
    """Standardised hourly metric matrix; the hour is the row key."""
    rows = t.metrics().withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    wide = P.impute_mean(P.to_wide(rows, TYPES), TYPES)
    return P.apply_scaler(wide, TYPES, P.fit_scaler(wide, TYPES)).withColumn("key", F.unix_seconds("timestamp"))


@query("A06_isolation_forest_fit")
def isolation_forest_fit(t):
    nodes = X.fit_nodes(scaled(t), TYPES, "key")
    return nodes.select("tree", "rows", "depth", F.size("feature").alias("nodes"))


@query("A07_isolation_forest_score")
def isolation_forest_score(t):
    rows = materialise(scaled(t), "scaled")
    return X.score(rows, X.fit(rows, TYPES, "key")).select("timestamp", "decision", "label")


@query("A16_score_endpoints")
def score_endpoints(t):
    """All four detectors: calls with sessions, and the shop's features of the day."""
    made = calls(t).withColumn("session_id", F.concat_ws("-", "user_id", F.date_format("timestamp", "yyyyMMddHH")))
    shop = C.business_features(t.events.select(F.date_trunc("day", "ts").alias("window_start"), "event_type", "value"), ["window_start"])
    rows = A.service_features(made, "1d").join(shop, "window_start", "left").withColumn("key", F.xxhash64("service", "endpoint", "window_start"))
    rows = materialise(rows, "service-features")
    models = {n: X.fit(rows, d[1], "key") for n, d in A.DETECTORS.items()}
    return X.score_endpoints(rows, models, A.DETECTORS)


def training(t):
    """Transactions with a planted label: disposable address, or several failed payments on a large amount."""
    tx = t.transactions()
    rows = fraud.fraud_features(tx, fraud.learn_medians(tx))
    planted = (F.col("email_is_disposable") == 1) | ((F.col("failed_payment_attempts") >= 2) & (F.col("amount") > 400000))
    rows = materialise(spread(rows.withColumn("label", planted.cast("int"))), "fraud-training")
    return rows, [c for c in rows.columns if c in fraud.FEATURES]


@query("F02_random_forest")
def random_forest(t):
    rows, features = training(t)
    model = K.fit_random_forest(rows, features, "label")
    return K.positive_probability(model, rows).select("transaction_id", "label", "probability")


@query("F03_boosting")
def boosting(t):
    rows, features = training(t)
    model = K.fit_boosting(rows, features, "label")
    return K.positive_probability(model, rows).select("transaction_id", "label", "probability")


@query("F04_feature_importance")
def feature_importance(t):
    rows, features = training(t)
    return K.feature_importance(t.spark, K.fit_random_forest(rows, features, "label"), features)


@query("G04_classify_cause")
def classify_cause(t):
    per = t.events.groupBy((F.col("user_id") % 10).alias("s"), F.to_date("ts").alias("d"), "event_type").agg(F.sum("value").alias("v"))
    incidents = per.groupBy("s", "d").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias("metrics"))
    incidents = G.metric_features(incidents.withColumn("affected_service", F.concat(F.lit("svc-"), F.col("s").cast("string"))), TYPES)
    features = [f"f_{m}" for m in TYPES]
    largest = F.greatest(*features)
    cause = F.coalesce(*[F.when(F.col(f) == largest, f[2:]) for f in features])
    rows = incidents.withColumn("root_cause", cause)
    model = K.fit_cause_classifier(rows, features, "root_cause")
    return K.best_class(model, rows).select("affected_service", "d", "root_cause", "predicted_cause", "confidence")


@query("I05_fit_lead_time")
def fit_lead_time(t):
    leads = I.lead_times(t.purchase_orders())
    model = I.fit_lead_time(leads)
    asked = I.lead_time_features(leads).drop("lead_time_days")
    return I.predict_lead_time(model, asked).groupBy("supplier_id").agg(F.avg("lead_time_days").alias("lead_time_days"), F.count("*").alias("n"))


# --- what must hold of every fitted model, as SQL ----------------------------------------------------------------------

HOURS = "(SELECT count(DISTINCT date_trunc('hour', ts)) AS n FROM events)"


@query("A06_forest_invariants", f"SELECT 100::BIGINT AS trees, least(256, n)::BIGINT AS rows, ceil(log2(least(256, n)))::BIGINT AS depth, true AS bounded FROM {HOURS}")
def forest_invariants(t):
    nodes = X.fit_nodes(scaled(t), TYPES, "key")
    whole = (F.size("feature") <= 2 * F.col("rows") - 1) & (F.size("left") == F.size("feature")) & (F.size("path") == F.size("feature"))
    return nodes.agg(F.count("*").alias("trees"), F.max("rows").alias("rows"), F.max("depth").alias("depth"), F.bool_and(whole).alias("bounded"))


@query("A07_score_invariants", f"SELECT n + 5 AS rows, true AS few, true AS planted_first FROM {HOURS}")
def score_invariants(t):
    """One in a hundred rows lies below zero, and five planted hours far from all others rank first."""
    rows = scaled(t)
    far = rows.limit(5).select((-F.col("key")).alias("key"), *[F.lit(25.0).alias(c) for c in TYPES])
    rows = materialise(rows.select("key", *TYPES).unionByName(far), "scaled")
    scored = X.score(rows, X.fit(rows, TYPES, "key"))
    share = F.count_if(F.col("label") == -1) / F.count("*")
    least, planted = F.min(F.when(F.col("key") >= 0, F.col("decision"))), F.max(F.when(F.col("key") < 0, F.col("decision")))
    return scored.agg(F.count("*").alias("rows"), (share <= 0.02).alias("few"), (planted <= least).alias("planted_first"))


@query("A16_detector_invariants", f"""SELECT d AS detector, n AS rows, true AS in_range, true AS by_limit FROM (SELECT unnest(['latency', 'error', 'traffic', 'business']) AS d),
   (SELECT count(*)::BIGINT AS n FROM (SELECT DISTINCT user_id % 10, event_type, date_trunc('day', ts) FROM events))""")
def detector_invariants(t):
    limit = F.element_at(F.create_map(*[F.lit(x) for n, d in A.DETECTORS.items() for x in (n, d[0])]), F.col("detector"))
    return score_endpoints(t).groupBy("detector").agg(
        F.count("*").alias("rows"), F.bool_and(F.col("anomaly_score").between(0, 1)).alias("in_range"), F.bool_and(F.col("is_anomaly") == (F.col("anomaly_score") > limit)).alias("by_limit"))


def _separates(rows):
    """Rows scored, and whether planted fraud ranks above the rest."""
    rows = materialise(rows, "scored")
    return P.auc(rows, "label", "probability").select((F.col("auc") > 0.95).alias("separates"), rows.agg(F.count("*")).scalar().alias("rows"))


@query("F02_forest_invariants", "SELECT count(*)::BIGINT AS rows, true AS separates FROM orders")
def random_forest_invariants(t):
    return _separates(random_forest(t).select("label", "probability"))


@query("F03_boosting_invariants", "SELECT count(*)::BIGINT AS rows, true AS separates FROM orders")
def boosting_invariants(t):
    return _separates(boosting(t).select("label", "probability"))


@query("F04_importance_invariants", "SELECT true AS whole, true AS ranked, true AS planted_first")
def importance_invariants(t):
    rows = feature_importance(t)
    planted = F.col("feature").isin("email_is_disposable", "failed_payment_attempts") | F.col("feature").contains("amount")
    return rows.agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("whole"), (F.max("rank") == F.count("*")).alias("ranked"), F.max_by(planted, "importance").alias("planted_first"))


@query("G04_cause_invariants", "SELECT count(*)::BIGINT AS rows, true AS found FROM (SELECT DISTINCT user_id % 10, ts::DATE FROM events)")
def cause_invariants(t):
    told = classify_cause(t)
    return told.agg(F.count("*").alias("rows"), (F.avg((F.col("root_cause") == F.col("predicted_cause")).cast("int")) > 0.9).alias("found"))


@query("I05_lead_time_invariants", "SELECT true AS whole_days, true AS no_worse_than_the_mean")
def lead_time_invariants(t):
    leads = I.lead_times(t.purchase_orders())
    told = I.predict_lead_time(I.fit_lead_time(leads), I.lead_time_features(leads).withColumnRenamed("lead_time_days", "real"))
    told = told.withColumn("mean", leads.agg(F.avg("lead_time_days")).scalar())
    error = lambda c: F.avg(F.abs(F.col("real") - c))
    return told.agg(F.bool_and((F.col("lead_time_days") >= 1) & (F.col("lead_time_days") == F.floor("lead_time_days"))).alias("whole_days"), (error(F.col("lead_time_days")) <= error(F.col("mean")) + 0.5).alias("no_worse_than_the_mean"))
