"""Thresholds, forecasts, anomalies and issues over the given tables."""

from pyspark.sql import functions as F

from tidewatch.operators import anomaly as A
from tidewatch.operators import commerce as K
from tidewatch.operators import prepare as P
from tidewatch.plans.catalog import plain, query
from tidewatch.plans.preparation import DESCRIBED, SERIES_CORR, series_corr
from tidewatch.plans.selectors import SVC

CUT = "(SELECT max(ts) - INTERVAL 7 DAY FROM events)"


def split(t):
    """Samples before the last seven days, and those of the last seven days."""
    m = t.metrics()
    cut = m.agg((F.max("timestamp") - F.expr("INTERVAL 7 DAYS")).alias("cut"))
    return m.where(F.col("timestamp") < cut.scalar()), m.where(F.col("timestamp") >= cut.scalar())


HIST = f"""(SELECT event_type, avg(value) AS m, stddev_samp(value) AS s, count(*) AS n FROM (
   SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE ts < {CUT}) WHERE r <= 1000 GROUP BY 1)"""
THRESHOLD = f"""(SELECT event_id, event_type AS metric_name, ts AS timestamp, value, m - 3 * s AS lower_threshold, m + 3 * s AS upper_threshold,
   coalesce(value < m - 3 * s OR value > m + 3 * s, false) AS is_anomaly,
   CASE WHEN value < m - 3 * s OR value > m + 3 * s THEN least(1, abs(value - m) / s / 3) ELSE 0 END AS anomaly_probability
   FROM events JOIN {HIST} USING (event_type) WHERE ts >= {CUT})"""


def thresholded(t):
    history, new = split(t)
    return A.dynamic_threshold(history, new, tie=["event_id"])


@query("A01_dynamic_threshold", plain(f"SELECT event_id, metric_name, timestamp, value, lower_threshold, upper_threshold, anomaly_probability FROM {THRESHOLD} WHERE is_anomaly", "value lower_threshold upper_threshold anomaly_probability", "timestamp"))
def dynamic_threshold(t):
    return thresholded(t).where("is_anomaly").select("event_id", "metric_name", "timestamp", "value", "lower_threshold", "upper_threshold", "anomaly_probability")


def hourly(t, by=("metric_name",), unit="hour"):
    return t.metrics().groupBy(*by, F.date_trunc(unit, "timestamp").alias("timestamp")).agg(F.sum("value").alias("value"))


def forecast_sql(source, by="metric_name", seasons=(("weekly", 14, "isodow(timestamp) - 1"), ("daily", 48, "hour(timestamp)"), ("yearly", 365, "month(timestamp)"))):
    """SQL for the parameter table; ``source`` has the series columns, timestamp and value."""
    ctes = [
        f"src AS (SELECT *, epoch_us(timestamp) / 86400000000.0 AS t FROM {source})",
        f"par AS (SELECT {by}, count(*) AS n, avg(t) AS mean_t, avg(value) AS mean_y, coalesce(regr_slope(value, t), 0) AS slope, max(timestamp) AS last_ts FROM src GROUP BY {by})",
        f"b0 AS (SELECT src.*, n, mean_t, mean_y, slope, last_ts, mean_y + slope * (t - mean_t) AS base FROM src JOIN par USING ({by}))",
    ]
    prev = "b0"
    for name, least, key in seasons:
        ctes.append(f"{name}_i AS (SELECT {by}, {key} AS k, sum(value) / sum(base) AS i FROM {prev} WHERE n >= {least} GROUP BY {by}, k HAVING sum(base) > 0)")
        ctes.append(f"b_{name} AS (SELECT p.* REPLACE (base * coalesce(i, 1) AS base) FROM {prev} p LEFT JOIN {name}_i x ON {' AND '.join(f'p.{c.strip()} = x.{c.strip()}' for c in by.split(','))} AND {key.replace('timestamp', 'p.timestamp')} = x.k)")
        prev = f"b_{name}"
    ctes.append(f"sig AS (SELECT {by}, coalesce(stddev_samp(value - base), 0) AS sigma FROM {prev} GROUP BY {by})")
    return ", ".join(ctes)


def yhat_sql(rows, by="metric_name", seasons=(("weekly", "isodow(f.timestamp) - 1"), ("daily", "hour(f.timestamp)"), ("yearly", "month(f.timestamp)"))):
    cols = [c.strip() for c in by.split(",")]
    joins = " ".join(
        f"LEFT JOIN {name}_i {name} ON {' AND '.join(f'f.{c} = {name}.{c}' for c in cols)} AND {key} = {name}.k" for name, key in seasons)
    factor = " * ".join(f"coalesce({name}.i, 1)" for name, _ in seasons)
    return f"""(SELECT *, yhat - 1.96 * sigma AS yhat_lower, yhat + 1.96 * sigma AS yhat_upper FROM (SELECT f.*, sigma, (mean_y + slope * (epoch_us(f.timestamp) / 86400000000.0 - mean_t)) * {factor} AS yhat
      FROM {rows} f JOIN par USING ({by}) JOIN sig USING ({by}) {joins}))"""


HOURLY = "(SELECT event_type AS metric_name, date_trunc('hour', ts) AS timestamp, sum(value) AS value FROM events GROUP BY 1, 2)"


@query("A02_fit_forecast", plain(f"WITH {forecast_sql(HOURLY)} SELECT metric_name, n::BIGINT AS n, mean_y, slope, sigma, w.i AS monday, d.i AS noon FROM par JOIN sig USING (metric_name) LEFT JOIN weekly_i w USING (metric_name) LEFT JOIN daily_i d USING (metric_name) WHERE w.k = 0 AND d.k = 12", "mean_y slope sigma monday noon"))
def fit_forecast(t):
    return A.fit_forecast(hourly(t)).select("metric_name", "n", "mean_y", "slope", "sigma", F.col("weekly")[0].alias("monday"), F.col("daily")[12].alias("noon"))


FUTURE = "(SELECT metric_name, unnest(generate_series(last_ts + INTERVAL 1 HOUR, last_ts + INTERVAL 24 HOUR, INTERVAL 1 HOUR)) AS timestamp FROM par)"


@query("A03_predict_forecast", plain(f"WITH {forecast_sql(HOURLY)} SELECT metric_name, timestamp, yhat, yhat_lower, yhat_upper FROM {yhat_sql(FUTURE)}", "yhat yhat_lower yhat_upper", "timestamp"))
def predict_forecast(t):
    params = A.fit_forecast(hourly(t))
    return A.predict_forecast(params, A.future_grid(params, "1h", 24))


ANOMALY = f"""SELECT metric_name, timestamp, value, yhat, value < yhat_lower OR value > yhat_upper AS is_anomaly,
   CASE WHEN value < yhat_lower OR value > yhat_upper THEN least(1, 2 * abs(value - yhat) / (yhat_upper - yhat_lower)) ELSE 0 END AS anomaly_probability FROM {yhat_sql(HOURLY)}"""


@query("A04_forecast_anomaly", plain(f"WITH {forecast_sql(HOURLY)} {ANOMALY}", "value yhat anomaly_probability", "timestamp"))
def forecast_anomaly(t):
    series = hourly(t)
    return A.forecast_anomaly(series, A.fit_forecast(series)).drop("yhat_lower", "yhat_upper")


@query("A05_combine_methods", plain(f"""WITH {forecast_sql(HOURLY)}, f AS ({ANOMALY}),
   h AS (SELECT metric_name, avg(value) AS m, stddev_samp(value) AS s FROM {HOURLY} GROUP BY 1),
   d AS (SELECT metric_name, timestamp, value < m - 3 * s OR value > m + 3 * s AS ta, least(1, abs(value - m) / s / 3) AS tp FROM {HOURLY} JOIN h USING (metric_name))
   SELECT metric_name, timestamp, value, is_anomaly OR ta AS is_anomaly, CASE WHEN is_anomaly THEN anomaly_probability WHEN ta THEN tp ELSE 0 END AS anomaly_probability,
     CASE WHEN is_anomaly THEN 'forecast' WHEN ta THEN 'dynamic_threshold' ELSE 'none' END AS detection_method FROM f JOIN d USING (metric_name, timestamp)""", "value anomaly_probability", "timestamp"))
def combine_methods(t):
    series = hourly(t)
    by_forecast = A.forecast_anomaly(series, A.fit_forecast(series)).drop("yhat", "yhat_lower", "yhat_upper")
    return A.combine_methods(by_forecast, A.dynamic_threshold(series, series), ["metric_name", "timestamp"])


DECISION = "(value - 100) / 250"


@query("A08_normalise_score", plain(f"""SELECT event_id, CASE WHEN hi = lo THEN 0 ELSE 1 - (d - lo) / (hi - lo) END AS anomaly_score, 1 - (d + 0.5) / 2 AS fixed, (d < -0.35)::BIGINT AS label
   FROM (SELECT event_id, {DECISION} AS d, min({DECISION}) OVER () AS lo, max({DECISION}) OVER () AS hi FROM events)""", "anomaly_score fixed"))
def normalise_score(t):
    rows = t.events.select("event_id", F.expr(DECISION).alias("decision"))
    return A.normalise_score(rows).select("event_id", "anomaly_score", A.fixed_score(F.col("decision")).alias("fixed"), A.below_cut(F.col("decision"), -0.35).alias("label"))


@query("A09_contributing_features", plain(f"""WITH s AS (SELECT timestamp, ps, {', '.join(f"(coalesce({c}, avg({c}) OVER ()) - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in ('click', 'error', 'purchase', 'signup', 'view'))}
     FROM (SELECT date_trunc('hour', ts) AS timestamp, sum(value) AS ps, {', '.join(f"avg(value) FILTER (event_type = '{c}') AS {c}" for c in ('click', 'error', 'purchase', 'signup', 'view'))} FROM events GROUP BY 1)),
   w AS (SELECT * FROM s ORDER BY -ps, timestamp LIMIT 1)
   SELECT timestamp, metric, abs(v) AS importance FROM w UNPIVOT (v FOR metric IN (click, error, purchase, signup, view))""", "importance", "timestamp"))
def contributing_features(t):
    cols = ["click", "error", "purchase", "signup", "view"]
    rows = t.metrics().withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    wide = P.to_wide(rows, cols)
    scaled = P.apply_scaler(wide, cols, P.fit_scaler(wide, cols)).na.fill(0.0, cols)
    scaled = scaled.join(rows.groupBy("timestamp").agg((-F.sum("value")).alias("decision")), "timestamp")
    return A.contributing_features(scaled, cols)


@query("A10_multivariate_issue", plain(f"""SELECT 'multiple' AS service, 'multivariate_anomaly' AS metric_name, min(d) AS current_value, min(d) AS predicted_value, -1.0 AS lower_bound, 0.0 AS upper_bound,
   arg_min(ts, d) AS timestamp, least(1, abs(min(d)) * 2) AS confidence, 0.0 AS time_until_hours, 0.8 AS business_impact, 'critical' AS severity FROM (SELECT ts, event_id, -value / 500 AS d FROM events) HAVING min(d) < -0.5""",
   "current_value predicted_value lower_bound upper_bound confidence time_until_hours business_impact", "timestamp"))
def multivariate_issue(t):
    return A.multivariate_issue(t.events.select(F.col("ts").alias("timestamp"), (-F.col("value") / 500).alias("decision")))


PAIR = f"(SELECT {SVC} AS service, event_type AS metric_name, date_trunc('day', ts) AS timestamp, sum(value) AS value FROM events GROUP BY 1, 2, 3)"
PAIR_FUTURE = "(SELECT service, metric_name, unnest(generate_series(last_ts + INTERVAL 1 DAY, last_ts + INTERVAL 5 DAY, INTERVAL 1 DAY)) AS timestamp FROM par)"
WEEKLY = (("weekly", 14, "isodow(timestamp) - 1"),)
ISSUES = f"""(WITH {forecast_sql(PAIR, 'service, metric_name', WEEKLY)}, fc AS (SELECT * FROM {yhat_sql(PAIR_FUTURE, 'service, metric_name', (("weekly", "isodow(f.timestamp) - 1"),))}),
   now AS (SELECT service, metric_name, arg_max(value, timestamp) AS current_value, max(timestamp) AS now FROM {PAIR} GROUP BY 1, 2),
   b AS (SELECT service, metric_name, avg(value) - 0.6 * stddev_samp(value) AS lo, avg(value) + 0.6 * stddev_samp(value) AS hi FROM {PAIR} GROUP BY 1, 2),
   i AS (SELECT *, least(1, 2 * abs(yhat - (lo + hi) / 2) / (hi - lo)) AS confidence, (epoch(timestamp) - epoch(now)) / 3600 AS h, CASE WHEN metric_name = 'error' THEN 1.0 ELSE 0.5 END AS impact
     FROM fc JOIN now USING (service, metric_name) JOIN b USING (service, metric_name) WHERE timestamp > now AND (yhat < lo OR yhat > hi))
   SELECT service, metric_name, current_value, yhat AS predicted_value, lo AS lower_bound, hi AS upper_bound, timestamp, confidence, h AS time_until_hours, impact AS business_impact,
     CASE WHEN confidence * impact / (1 + h / 24) > 0.8 THEN 'critical' WHEN confidence * impact / (1 + h / 24) > 0.6 THEN 'high' WHEN confidence * impact / (1 + h / 24) > 0.4 THEN 'medium' ELSE 'low' END AS severity
   FROM i WHERE confidence >= 0.7)"""
ISSUE_NUMBERS = "current_value predicted_value lower_bound upper_bound confidence time_until_hours business_impact"


def issues(t, correlated=None):
    by = ["service", "metric_name"]
    series = hourly(t, by, "day")
    params = A.fit_forecast(series, by, {"weekly": 14})
    forecast = A.predict_forecast(params, A.future_grid(params, "1d", 5, by), by)
    bounds = series.groupBy(*by).agg((F.avg("value") - 0.6 * F.stddev_samp("value")).alias("lower_bound"), (F.avg("value") + 0.6 * F.stddev_samp("value")).alias("upper_bound"))
    impact = series.select(*by).distinct().where("metric_name = 'error'").withColumn("impact", F.lit(1.0))
    return A.predict_issues(forecast, series, bounds, impact, correlated, by)


@query("A11_predict_issues", plain(f"""SELECT i.*, c.metrics AS correlated FROM {ISSUES} i LEFT JOIN (SELECT a, string_agg(b, ',' ORDER BY r) AS metrics FROM (
   SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY round(abs(corr), 9) DESC, b) AS r FROM {SERIES_CORR} WHERE NOT isnan(corr)) WHERE r <= 5 GROUP BY 1) c ON c.a = service || '/' || metric_name""", ISSUE_NUMBERS, "timestamp"))
def predict_issues(t):
    rows = issues(t, P.top_correlated(series_corr(t)))
    return rows.withColumn("correlated", F.array_join(F.transform("correlated_metrics", lambda x: x["metric"]), ",")).drop("correlated_metrics")


@query("A12_issue_severity", """SELECT event_id, CASE WHEN s > 0.8 THEN 'critical' WHEN s > 0.6 THEN 'high' WHEN s > 0.4 THEN 'medium' ELSE 'low' END AS severity,
   CASE WHEN s > 0.8 THEN 0 WHEN s > 0.6 THEN 1 WHEN s > 0.4 THEN 2 ELSE 3 END::BIGINT AS rank FROM (SELECT event_id, least(1, value / 100) * 0.9 * (1.0 / (1.0 + (event_id % 48) / 24.0)) AS s FROM events)""")
def issue_severity(t):
    severity = A.issue_severity(F.least(F.lit(1.0), F.col("value") / 100), F.lit(0.9), F.col("event_id") % 48)
    return t.events.select("event_id", severity.alias("severity")).withColumn("rank", A.severity_rank(F.col("severity")))


@query("A13_generate_thresholds", plain(f"SELECT metric_name, mean, p95, (mean + 3 * std) * 1.2 + 5 AS threshold FROM {DESCRIBED}", "mean p95 threshold"))
def generate_thresholds(t):
    return A.generate_thresholds(P.describe_metric(t.metrics()), 1.2, 5.0).select("metric_name", "mean", "p95", "threshold")


@query("A14_generate_rules", f"""SELECT 'dynamic_thresholds' AS "group", upper(metric_name[1]) || metric_name[2:] || 'Dynamic' AS alert, metric_name || ' > ' || printf('%.6f', mean + 3 * std) AS expr, '5m' AS "for",
   'warning' AS severity, metric_name AS metric, printf('%.6f', mean + 3 * std) AS threshold_value FROM {DESCRIBED}""")
def generate_rules(t):
    rules = A.generate_rules(A.generate_thresholds(P.describe_metric(t.metrics())))
    return rules.select("group", "alert", "expr", "for", "severity", F.col("labels")["metric"].alias("metric"), F.col("annotations")["threshold_value"].alias("threshold_value"))


CONFIGS = [
    {"name": "view", "alert_name": "ViewsHigh", "query": "sum(rate(views_total[5m]))", "severity": "critical", "dashboard": "shop", "labels": {"team": "web"}},
    {"name": "error", "alert_name": "FewErrors", "query": "errors_total", "comparison": "<", "for": "10m", "annotations": {"runbook": "r1"}},
    {"name": "absent", "alert_name": "Never", "query": "x"},
]
NOTE = "'{{ $labels.instance }} has exceeded the dynamic threshold of ' || l || ' for ' || metric_name"


@query("A14_rules_from_configuration", f"""WITH limits AS (SELECT metric_name, printf('%.6f', mean + 3 * std) AS l FROM {DESCRIBED})
   SELECT 'dynamic_thresholds' AS "group", 'ViewsHigh' AS alert, 'sum(rate(views_total[5m])) > ' || l AS expr, '5m' AS "for", 'critical' AS severity, 'web' AS team, {NOTE} AS description, 'shop' AS dashboard, NULL AS runbook FROM limits WHERE metric_name = 'view'
   UNION ALL SELECT 'dynamic_thresholds', 'FewErrors', 'errors_total < ' || l, '10m', 'warning', NULL, {NOTE}, '', 'r1' FROM limits WHERE metric_name = 'error'""")
def rules_from_configuration(t):
    rules = A.rules_from_config(A.generate_thresholds(P.describe_metric(t.metrics())), CONFIGS)
    return rules.select("group", "alert", "expr", "for", *[F.col("labels")[k].alias(k) for k in ("severity", "team")], *[F.col("annotations")[k].alias(k) for k in ("description", "dashboard", "runbook")])


def calls(t):
    return t.events.select(
        F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string")).alias("service"), F.concat(F.lit("/"), F.col("event_type")).alias("endpoint"),
        F.col("ts").alias("timestamp"), F.col("value").alias("response_time"),
        F.when(F.col("event_type") == "error", F.when(F.col("event_id") % 2 == 0, 500).otherwise(404)).otherwise(200).alias("status_code"),
        "user_id", F.concat(F.lit("r"), (F.col("user_id") % 3).cast("string")).alias("region"))


@query("A15_service_features", plain(f"""SELECT {SVC} AS service, '/' || event_type AS endpoint, date_trunc('day', ts) AS window_start, count(*)::BIGINT AS throughput,
   count(*) FILTER (event_type = 'error')::BIGINT AS error_count, avg((event_type = 'error')::INT) AS error_rate, count(*) FILTER (event_type = 'error' AND event_id % 2 = 1)::BIGINT AS status_4xx,
   count(*) FILTER (event_type = 'error' AND event_id % 2 = 0)::BIGINT AS status_5xx, count(*) / 86400 AS requests_per_second, count(DISTINCT user_id)::BIGINT AS unique_users,
   quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.9) AS p90, quantile_cont(value, 0.99) AS p99, coalesce(count(*) FILTER (user_id % 3 = 1), 0)::BIGINT AS from_r1 FROM events GROUP BY 1, 2, 3""",
   "error_rate requests_per_second p50 p90 p99", "window_start"))
def service_features(t):
    rows = A.service_features(calls(t), "1d")
    return rows.withColumn("from_r1", F.coalesce(F.col("geographic_distribution")["r1"], F.lit(0))).drop("geographic_distribution")


@query("A17_business_features", plain("""SELECT date_trunc('day', ts) AS day, count(*) FILTER (event_type = 'purchase') / nullif(count(*) FILTER (event_type = 'view'), 0) AS conversion_rate,
   1 - count(*) FILTER (event_type = 'purchase') / nullif(count(*) FILTER (event_type = 'click'), 0) AS cart_abandonment_rate, avg(value) FILTER (event_type = 'purchase') AS average_order_value,
   count(*) FILTER (event_type = 'purchase') / nullif(count(*) FILTER (event_type IN ('signup', 'purchase')), 0) AS checkout_success_rate,
   count(*) FILTER (event_type = 'purchase') / nullif(count(*) FILTER (event_type IN ('purchase', 'error')), 0) AS payment_success_rate FROM events GROUP BY 1""",
   "conversion_rate cart_abandonment_rate average_order_value checkout_success_rate payment_success_rate", "day"))
def business_features(t):
    return K.business_features(t.events.select(F.date_trunc("day", "ts").alias("day"), "event_type", "value"), ["day"])
