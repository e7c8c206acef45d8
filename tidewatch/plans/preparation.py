"""Preparation and statistics over the given tables."""

from pyspark.sql import functions as F

from tidewatch.operators import prepare as P
from tidewatch.plans.catalog import plain, query
from tidewatch.plans.selectors import SVC

TYPES = ["click", "error", "purchase", "signup", "view"]
GAPPY = "(SELECT ts, event_type AS metric_name, CASE WHEN event_id % 3 != 0 THEN value END AS value FROM events)"


def gappy(t):
    return t.metrics().select("timestamp", "metric_name", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"))


@query("P01_dedup_samples", plain(
    "SELECT event_type AS metric_name, date_trunc('hour', ts) AS timestamp, arg_min(value, event_id) AS value, min(event_id)::BIGINT AS event_id FROM events GROUP BY 1, 2", "value", "timestamp"))
def dedup_samples(t):
    rows = t.metrics().drop("service").withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    return P.dedup_samples(rows, ["event_id"])


@query("P02_interpolate_time", plain(f"""SELECT metric_name, ts AS timestamp, coalesce(value, CASE WHEN v1 IS NULL THEN v0 ELSE v0 + (v1 - v0) * ((epoch_us(ts) - t0) / (t1 - t0)) END) AS value FROM (
   SELECT *, last_value(value IGNORE NULLS) OVER p AS v0, first_value(value IGNORE NULLS) OVER n AS v1,
     last_value(k IGNORE NULLS) OVER p AS t0, first_value(k IGNORE NULLS) OVER n AS t1 FROM (SELECT *, CASE WHEN value IS NOT NULL THEN epoch_us(ts) END AS k FROM {GAPPY})
   WINDOW p AS (PARTITION BY metric_name ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
          n AS (PARTITION BY metric_name ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) WHERE value IS NOT NULL OR v0 IS NOT NULL""", "value", "timestamp"))
def interpolate_time(t):
    return P.interpolate_time(gappy(t))


SPIKY = "(SELECT event_id, event_type AS metric_name, CASE WHEN event_id % 500 = 7 THEN value * 1000 ELSE value END AS value FROM events)"


@query("P03_trim_extremes", plain(f"""SELECT event_id, metric_name, value FROM {SPIKY} JOIN (SELECT metric_name, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM {SPIKY} GROUP BY 1) USING (metric_name)
   WHERE value BETWEEN lo - 10 * (hi - lo) AND hi + 10 * (hi - lo)""", "value"))
def trim_extremes(t):
    rows = t.metrics().select("event_id", "metric_name", F.when(F.col("event_id") % 500 == 7, F.col("value") * 1000).otherwise(F.col("value")).alias("value"))
    return P.trim_extremes(rows)


def wide(t):
    rows = t.metrics().withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    return P.to_wide(rows, TYPES)


WIDE = "(SELECT date_trunc('hour', ts) AS timestamp, " + ", ".join(f"avg(value) FILTER (event_type = '{c}') AS {c}" for c in TYPES) + " FROM events GROUP BY 1)"
NAMES = " ".join(TYPES)


@query("P04_to_wide", plain(f"SELECT * FROM {WIDE}", NAMES, "timestamp"))
def to_wide(t):
    return wide(t)


@query("P05_ffill", plain(f"""SELECT metric_name, ts AS timestamp, last_value(value IGNORE NULLS) OVER (PARTITION BY metric_name ORDER BY ts) AS value FROM {GAPPY}""", "value", "timestamp"))
def ffill(t):
    return P.ffill(gappy(t)).select("metric_name", "timestamp", "value")


IMPUTED = "(SELECT timestamp, " + ", ".join(f"coalesce({c}, avg({c}) OVER ()) AS {c}" for c in TYPES) + f" FROM {WIDE})"


@query("P06_impute_mean", plain(f"SELECT * FROM {IMPUTED}", NAMES, "timestamp"))
def impute_mean(t):
    return P.impute_mean(wide(t), TYPES)


@query("P07_standardise", plain("SELECT timestamp, " + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in TYPES) + f" FROM {IMPUTED}", NAMES, "timestamp"))
def standardise(t):
    rows = P.impute_mean(wide(t), TYPES)
    return P.apply_scaler(rows, TYPES, P.fit_scaler(rows, TYPES))


CORR = f"""(WITH h AS (SELECT date_trunc('hour', ts) AS timestamp, event_type AS metric, avg(value) AS v FROM events GROUP BY 1, 2)
   SELECT x.metric AS a, y.metric AS b, corr(x.v, y.v) AS corr FROM h x JOIN h y USING (timestamp) WHERE x.metric != y.metric GROUP BY 1, 2)"""


@query("P08_corr_matrix", plain(f"SELECT * FROM {CORR}", "corr"))
def corr_matrix(t):
    return P.corr_matrix(wide(t), TYPES)


SERIES = [f"svc-{i}/{m}" for i in range(10) for m in TYPES]
SERIES_CORR = f"""(WITH h AS (SELECT date_trunc('day', ts) AS timestamp, {SVC} || '/' || event_type AS metric, avg(value) AS v FROM events GROUP BY 1, 2)
   SELECT x.metric AS a, y.metric AS b, corr(x.v, y.v) AS corr FROM h x JOIN h y USING (timestamp) WHERE x.metric != y.metric GROUP BY 1, 2)"""


def series_corr(t):
    rows = t.metrics().select(F.date_trunc("day", "timestamp").alias("timestamp"), F.concat_ws("/", "service", "metric_name").alias("metric_name"), "value")
    return P.corr_matrix(P.to_wide(rows, SERIES), SERIES)


@query("P09_top_correlated", plain(f"SELECT a, b, abs(corr) AS corr, row_number() OVER (PARTITION BY a ORDER BY round(abs(corr), 9) DESC, b)::BIGINT AS rank FROM {SERIES_CORR} WHERE NOT isnan(corr) QUALIFY rank <= 5", "corr"))
def top_correlated(t):
    return P.top_correlated(series_corr(t))


DESCRIBED = """(SELECT event_type AS metric_name, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max, count(value)::BIGINT AS count,
   quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.9) AS p90, quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99 FROM events GROUP BY 1)"""


@query("P10_describe_metric", plain(f"SELECT *, 13::BIGINT AS hour_of_day, 2::BIGINT AS day_of_week, 0::BIGINT AS is_weekend FROM {DESCRIBED}", "mean std min max median p90 p95 p99"))
def describe_metric(t):
    return P.describe_metric(t.metrics(), now=F.lit("2024-01-31 13:05:00").cast("timestamp"))


def exclusive(p):
    j = f"greatest(1, least(n - 1, floor({p} * (n + 1))::BIGINT))"
    return f"list_extract(s, {j}) * (1 - ({p} * (n + 1) - {j})) + list_extract(s, {j} + 1) * ({p} * (n + 1) - {j})"


@query("P11_quantiles_exclusive", plain(f"SELECT event_type, n, {exclusive(0.5)} AS p50, {exclusive(0.95)} AS p95, {exclusive(0.99)} AS p99 FROM (SELECT event_type, count(*)::BIGINT AS n, list(value ORDER BY value) AS s FROM events GROUP BY 1)", "p50 p95 p99"))
def quantiles_exclusive(t):
    return P.quantiles_exclusive(t.events, ["event_type"], "value")


@query("P12_recent", plain("SELECT event_type AS metric_name, ts AS timestamp, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 1000", "value", "timestamp"))
def recent(t):
    return P.recent(t.metrics(), tie=["event_id"]).select("metric_name", "timestamp", "value")


def scored(t):
    return t.documents.join(t.read("labels"), "doc_id").select(
        F.col("quality").alias("label"), (F.col("n_chars") > 1500).cast("int").alias("prediction"), F.col("n_chars").cast("double").alias("score"))


SCORED = "(SELECT quality AS label, (n_chars > 1500)::INT AS prediction, n_chars::DOUBLE AS score FROM documents JOIN labels USING (doc_id))"
MEASURES = f"""(SELECT tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1, auc FROM (
   SELECT count(*) FILTER (label = 1 AND prediction = 1)::DOUBLE AS tp, count(*) FILTER (label = 0 AND prediction = 1)::DOUBLE AS fp,
     count(*) FILTER (label = 1 AND prediction = 0)::DOUBLE AS fn FROM {SCORED}),
   (SELECT sum(CASE WHEN p.score > n.score THEN 1 WHEN p.score = n.score THEN 0.5 ELSE 0 END) / count(*) AS auc FROM {SCORED} p, {SCORED} n WHERE p.label = 1 AND n.label = 0))"""


@query("P13_evaluate", plain(" UNION ALL ".join(f"SELECT '{m}' AS measure, {m} AS value, {x}::DOUBLE AS target, {m} >= {x} AS met FROM {MEASURES}" for m, x in P.TARGETS["fraud_detector"].items()), "value target"))
def evaluate(t):
    rows = scored(t)
    both = P.confusion(rows).withColumn("auc", P.auc(rows).scalar())
    return P.meets_targets(both, "fraud_detector")


def targets_sql(model, measures, source):
    limits = P.TARGETS[model]
    return " UNION ALL ".join(f"SELECT '{m}' AS measure, ({measures[m]})::DOUBLE AS value, {x}::DOUBLE AS target, ({measures[m]}) {'<=' if m in P.UPPER_LIMITS else '>='} {x} AS met FROM {source}" for m, x in limits.items())


CONFUSION = f"""(SELECT tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1, fp / (fp + tn) AS false_positive_rate, (tp + tn) / (tp + fp + fn + tn) AS accuracy FROM (
   SELECT count(*) FILTER (label = 1 AND prediction = 1)::DOUBLE AS tp, count(*) FILTER (label = 0 AND prediction = 1)::DOUBLE AS fp,
     count(*) FILTER (label = 1 AND prediction = 0)::DOUBLE AS fn, count(*) FILTER (label = 0 AND prediction = 0)::DOUBLE AS tn FROM {SCORED}))"""
SAME = {m: m for m in ("precision", "recall", "f1", "false_positive_rate", "accuracy")}


@query("P13_evaluate_detection", plain(f"SELECT 'anomaly_detector' AS model, * FROM ({targets_sql('anomaly_detector', SAME, CONFUSION)}) UNION ALL SELECT 'intrusion_detector', * FROM ({targets_sql('intrusion_detector', SAME, CONFUSION)})", "value target"))
def evaluate_detection(t):
    measured = P.confusion(scored(t))
    kinds = [P.meets_targets(measured, m).select(F.lit(m).alias("model"), "*") for m in ("anomaly_detector", "intrusion_detector")]
    return kinds[0].unionByName(kinds[1])


LEAD = f"(SELECT *, (SELECT avg(epoch_us(ts) / 3600000000.0 % 48) FROM events WHERE event_type = 'error') AS lead_time_hours FROM {CONFUSION})"


@query("P13_evaluate_prediction", plain(targets_sql("predictive_alerting", SAME | {"lead_time_hours": "lead_time_hours"}, LEAD), "value target"))
def evaluate_prediction(t):
    lead = t.events.where("event_type = 'error'").agg(F.avg((F.unix_micros("ts") / 3_600_000_000) % 48)).scalar()
    return P.meets_targets(P.confusion(scored(t)).withColumn("lead_time_hours", lead), "predictive_alerting")


RANKED = """(SELECT avg((user_id % 5 = event_id % 5)::INT) AS accuracy, avg((user_id % 5 IN (event_id % 5, (event_id + 1) % 5, (event_id + 2) % 5))::INT) AS top_k_accuracy FROM events)"""


@query("P13_evaluate_ranking", plain(targets_sql("root_cause_analyzer", {"accuracy": "accuracy", "top_k_accuracy": "top_k_accuracy"}, RANKED), "value target"))
def evaluate_ranking(t):
    rows = t.events.select((F.col("user_id") % 5).alias("label"), F.array(*[(F.col("event_id") + i) % 5 for i in range(3)]).alias("candidates"))
    first = rows.agg(F.avg((F.col("candidates")[0] == F.col("label")).cast("int"))).scalar()
    return P.meets_targets(P.topk_accuracy(rows).withColumn("accuracy", first), "root_cause_analyzer").orderBy("measure")


DEMAND = """(SELECT avg(CASE WHEN l_quantity != 0 THEN abs((l_quantity - p) / l_quantity) END) * 100 AS mape, sqrt(avg((l_quantity - p) * (l_quantity - p))) AS rmse, avg((stock < l_quantity)::INT) AS stockout_rate
   FROM (SELECT l_quantity::DOUBLE AS l_quantity, l_quantity::DOUBLE + l_linenumber - 3 AS p, l_partkey % 60 AS stock FROM lineitem))"""


@query("P13_evaluate_demand", plain(targets_sql("inventory_optimizer", {m: m for m in ("mape", "rmse", "stockout_rate")}, DEMAND), "value target"))
def evaluate_demand(t):
    quantity = F.col("l_quantity").cast("double")
    rows = t.read("lineitem").select(quantity.alias("actual"), (quantity + F.col("l_linenumber") - 3).alias("predicted"), (F.col("l_partkey") % 60).alias("stock"))
    return P.meets_targets(P.forecast_errors(rows, stock="stock"), "inventory_optimizer")


EDGES = [10, 20, 40, 80, 160]
BIN = " + ".join(f"(value >= {e})::INT" for e in EDGES)


@query("P14_profile_drift", plain(f"""WITH base AS (SELECT {BIN} AS bin, count(*) / sum(count(*)) OVER () AS share FROM events WHERE ts < TIMESTAMP '2024-01-08' GROUP BY 1),
   cur AS (SELECT date_trunc('day', ts) AS day, {BIN} AS bin, count(*) / sum(count(*)) OVER (PARTITION BY date_trunc('day', ts)) AS share FROM events GROUP BY 1, 2),
   frame AS (SELECT day, bin FROM (SELECT DISTINCT day FROM cur), (SELECT bin FROM base UNION SELECT bin FROM cur)),
   psi AS (SELECT day, sum((c - b) * ln(c / b)) AS psi FROM (SELECT day, bin, greatest(coalesce(cur.share, 0), 1e-4) AS c, greatest(coalesce(base.share, 0), 1e-4) AS b
     FROM frame LEFT JOIN cur USING (day, bin) LEFT JOIN base USING (bin)) GROUP BY 1),
   prof AS (SELECT date_trunc('day', ts) AS day, count(*)::BIGINT AS rows, avg((v IS NULL)::INT) AS null_rate, min(v) AS min, max(v) AS max, avg(v) AS mean, stddev_samp(v) AS std, count(DISTINCT v)::BIGINT AS distinct
     FROM (SELECT ts, CASE WHEN event_id % 10 != 3 THEN value END AS v FROM events) GROUP BY 1)
   SELECT * FROM prof JOIN psi USING (day)""", "null_rate min max mean std psi", "day", 5), digits=5)
def profile_drift(t):
    rows = t.metrics().select("timestamp", "value", F.when(F.col("event_id") % 10 != 3, F.col("value")).alias("v"), F.date_trunc("day", "timestamp").alias("day"))
    base = P.bin_shares(rows.where(F.col("timestamp") < F.lit("2024-01-08").cast("timestamp")), "value", EDGES)
    psi = P.drift(P.bin_shares(rows, "value", EDGES, ["day"]), base)
    prof = P.profile(rows, ["v"], F.col("day")).drop("column").withColumnRenamed("window_start", "day")
    return prof.join(psi, "day")


@query("P15_anomaly_summary", plain("""SELECT detection_method, count(*)::BIGINT AS rows, count(*) FILTER (is_anomaly)::BIGINT AS anomalies, count(*) FILTER (is_anomaly) / sum(count(*)) OVER () AS share_of_all
   FROM (SELECT CASE WHEN event_type IN ('view', 'click') THEN 'forecast' ELSE 'dynamic_threshold' END AS detection_method, value > 100 AS is_anomaly FROM events) GROUP BY 1""", "share_of_all"))
def anomaly_summary(t):
    return P.anomaly_summary(t.events.select(
        F.when(F.col("event_type").isin("view", "click"), "forecast").otherwise("dynamic_threshold").alias("detection_method"), (F.col("value") > 100).alias("is_anomaly")))
