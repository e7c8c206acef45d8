"""Thresholds, forecasts and the anomalies and issues read from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.durations import micros, seconds, step_start
from tidewatch.functions.labels import one_row_per_hit
from tidewatch.operators.prepare import METRIC_KEY, recent
from tidewatch.operators.quantiles import exact_quantiles

SENSITIVITY = 3.0
MIN_HISTORY = 30
MAX_HISTORY = 1000
BAND = 1.96
SEVERITY_RANK = {"critical": 0, "high": 1, "medium": 2, "low": 3}

# Points a series needs before a seasonality is fitted: weekly, daily, yearly.
HOURLY_SEASONS = {"weekly": 14, "daily": 48, "yearly": 365}
FIVE_MINUTE_SEASONS = {"weekly": 4032, "daily": 576, "yearly": 365 * 288}
DAILY_SEASONS = {"weekly": 1, "yearly": 365}

# Score limits of the four endpoint detectors and the features they look at.
DETECTORS = {
    "latency": (0.8, ["p50", "p90", "p99", "error_rate", "throughput"]),
    "error": (0.7, ["error_rate", "error_count", "status_4xx", "status_5xx"]),
    "traffic": (0.75, ["requests_per_second", "unique_users", "session_count"]),
    "business": (0.8, ["conversion_rate", "cart_abandonment_rate", "average_order_value", "checkout_success_rate", "payment_success_rate"]),
}


def history_stats(history: DataFrame, by: Sequence[str] = METRIC_KEY, keep: int = MAX_HISTORY, tie: Sequence[str] = ()) -> DataFrame:
    """Mean, sample deviation and size of the newest ``keep`` points per series."""
    return recent(history, keep, by, tie=tie).groupBy(*by).agg(
        F.avg("value").alias("hist_mean"), F.stddev_samp("value").alias("hist_std"), F.count("value").alias("hist_n")
    )


def dynamic_threshold(
    history: DataFrame, new: DataFrame, by: Sequence[str] = METRIC_KEY, sensitivity: float = SENSITIVITY,
    min_history: int = MIN_HISTORY, max_history: int = MAX_HISTORY, tie: Sequence[str] = (),
) -> DataFrame:
    """Flag new samples outside mean +- sensitivity deviations of their history; short histories flag nothing."""
    return flag_outside(new, history_stats(history, by, max_history, tie), by, sensitivity, min_history)


def flag_outside(
    new: DataFrame, stats: DataFrame, by: Sequence[str] = METRIC_KEY, sensitivity: float = SENSITIVITY, min_history: int = MIN_HISTORY,
) -> DataFrame:
    """``dynamic_threshold`` with statistics of the history that are already there."""
    return flagged(new.join(stats, list(by), "left"), sensitivity, min_history)


def flagged(rows: DataFrame, sensitivity: float = SENSITIVITY, min_history: int = MIN_HISTORY) -> DataFrame:
    """Verdicts on rows that carry their history's ``hist_mean``, ``hist_std`` and ``hist_n``, batch or stream."""
    usable = F.col("hist_n") >= min_history
    lower = F.when(usable, F.col("hist_mean") - sensitivity * F.col("hist_std"))
    upper = F.when(usable, F.col("hist_mean") + sensitivity * F.col("hist_std"))
    outside = F.coalesce((F.col("value") < lower) | (F.col("value") > upper), F.lit(False))
    distance = F.try_divide(F.abs(F.col("value") - F.col("hist_mean")), F.col("hist_std")) / sensitivity
    return rows.withColumns(
        {
            "lower_threshold": lower, "upper_threshold": upper, "is_anomaly": outside,
            "anomaly_probability": F.when(outside, F.least(F.lit(1.0), F.coalesce(distance, F.lit(1.0)))).otherwise(0.0),
        }
    ).drop("hist_mean", "hist_std", "hist_n")


def extend_history(history: DataFrame, new: DataFrame, by: Sequence[str] = METRIC_KEY, keep: int = MAX_HISTORY, tie: Sequence[str] = ()) -> DataFrame:
    """History plus the new samples, cut to the newest ``keep`` per series."""
    return recent(history.unionByName(new.select(*history.columns)), keep, by, tie=tie)


def _days(ts: Column) -> Column:
    return F.unix_micros(ts) / 86_400_000_000


def _trend() -> Column:
    return F.col("mean_y") + F.col("slope") * (_days(F.col("timestamp")) - F.col("mean_t"))


def _season_keys() -> dict[str, Column]:
    return {"weekly": F.weekday("timestamp"), "daily": F.hour("timestamp"), "yearly": F.month("timestamp")}


def fit_forecast(series: DataFrame, by: Sequence[str] = METRIC_KEY, seasons: Mapping[str, int] = HOURLY_SEASONS) -> DataFrame:
    """One parameter row per series: linear trend, multiplicative seasonal indices, residual deviation.

    ``series`` has the group columns, ``timestamp`` and ``value``. Two passes over it: the trend, then sums per
    calendar cell (at most 7 x 24 x 12 per series). Indices and the residual deviation follow from the cells.
    """
    by = list(by)
    known = series.where(F.col("value").isNotNull())
    t = _days(F.col("timestamp"))
    params = known.groupBy(*by).agg(
        F.count("value").alias("n"), F.avg(t).alias("mean_t"), F.avg("value").alias("mean_y"),
        F.coalesce(F.regr_slope("value", t), F.lit(0.0)).alias("slope"), F.max("timestamp").alias("last_ts"),
    )
    y, base = F.col("value"), _trend()
    keys = {season: _season_keys()[season] for season in seasons}
    trend = [c for c in params.columns if c not in by]
    cells = (
        known.join(params, by)
        .groupBy(*by, *trend, *[key.alias(f"_{season}") for season, key in keys.items()])
        .agg(
            F.count(y).alias("_n"), F.sum(y).alias("_y"), F.sum(base).alias("_b"), F.sum(y * y).alias("_yy"),
            F.sum(base * base).alias("_bb"), F.sum(y * base).alias("_yb"),
        )
        .repartition(*by)
        .withColumn("_index", F.lit(1.0))
    )
    for season, least in seasons.items():
        group = W.partitionBy(*by, f"_{season}")
        under = F.sum(F.col("_index") * F.col("_b")).over(group)
        index = F.when((F.col("n") >= least) & (under > 0), F.sum("_y").over(group) / under)
        cells = cells.withColumn(f"_i_{season}", index).withColumn("_index", F.col("_index") * F.coalesce(f"_i_{season}", F.lit(1.0)))
    i = F.col("_index")
    entry = lambda s: F.collect_set(F.when(F.col(f"_i_{s}").isNotNull(), F.struct(F.col(f"_{s}").alias("key"), F.col(f"_i_{s}").alias("value"))))
    fitted = cells.groupBy(*by, *trend).agg(
        *[F.map_from_entries(entry(s)).alias(s) for s in seasons],
        F.sum(F.col("_y") - i * F.col("_b")).alias("_r"),
        F.sum(F.col("_yy") - 2 * i * F.col("_yb") + i * i * F.col("_bb")).alias("_rr"),
    )
    variance = F.greatest((F.col("_rr") - F.col("_r") * F.col("_r") / F.col("n")) / (F.col("n") - 1), F.lit(0.0))
    return fitted.withColumn("sigma", F.when(F.col("n") > 1, F.sqrt(variance)).otherwise(0.0)).drop("_r", "_rr")


def predict_forecast(params: DataFrame, future: DataFrame, by: Sequence[str] = METRIC_KEY) -> DataFrame:
    """yhat, yhat_lower and yhat_upper at the given series and times."""
    rows = future.join(params, list(by))
    yhat = _trend()
    for season, key in _season_keys().items():
        if season in params.columns:
            yhat = yhat * F.coalesce(F.col(season)[key], F.lit(1.0))
    rows = rows.withColumn("yhat", yhat).withColumns(
        {"yhat_lower": F.col("yhat") - BAND * F.col("sigma"), "yhat_upper": F.col("yhat") + BAND * F.col("sigma")}
    )
    return rows.drop(*[c for c in params.columns if c not in by and c not in future.columns])


def future_grid(params: DataFrame, step: str, periods: int, by: Sequence[str] = METRIC_KEY) -> DataFrame:
    """The next ``periods`` steps after the last sample of every series."""
    ticks = F.sequence(F.lit(1), F.lit(periods))
    rows = params.select(*by, F.unix_micros("last_ts").alias("_t"), F.explode(ticks).alias("_i"))
    return rows.select(*by, F.timestamp_micros(F.col("_t") + F.col("_i") * micros(step)).alias("timestamp"))


def forecast_anomaly(samples: DataFrame, params: DataFrame, by: Sequence[str] = METRIC_KEY) -> DataFrame:
    """Samples against their forecast band; probability grows with the distance from yhat."""
    rows = predict_forecast(params, samples, by)
    outside = (F.col("value") < F.col("yhat_lower")) | (F.col("value") > F.col("yhat_upper"))
    reach = F.try_divide(2 * F.abs(F.col("value") - F.col("yhat")), F.col("yhat_upper") - F.col("yhat_lower"))
    return rows.withColumns(
        {"is_anomaly": outside, "anomaly_probability": F.when(outside, F.least(F.lit(1.0), F.coalesce(reach, F.lit(1.0)))).otherwise(0.0)}
    )


def combine_methods(by_forecast: DataFrame, by_threshold: DataFrame, on: Sequence[str], forest_scored: bool = False) -> DataFrame:
    """The forecast decides first; the threshold only fills rows not yet anomalous; the method is named."""
    f = by_forecast.withColumnsRenamed({"is_anomaly": "_fa", "anomaly_probability": "_fp"})
    d = by_threshold.select(*on, F.col("is_anomaly").alias("_ta"), F.col("anomaly_probability").alias("_tp"))
    rows = f.join(d, list(on), "left")
    forecast, threshold = F.coalesce("_fa", F.lit(False)), F.coalesce("_ta", F.lit(False))
    return rows.withColumns(
        {
            "is_anomaly": forecast | threshold,
            "anomaly_probability": F.when(forecast, F.col("_fp")).when(threshold, F.col("_tp")).otherwise(0.0),
            "detection_method": F.when(forecast, "forecast").when(threshold, "dynamic_threshold").otherwise(
                "isolation_forest" if forest_scored else "none"
            ),
        }
    ).drop("_fa", "_fp", "_ta", "_tp")


def normalise_score(df: DataFrame, decision: str = "decision", out: str = "anomaly_score") -> DataFrame:
    """1 for the most anomalous decision value of the batch, 0 for the least; 0 throughout if all are equal."""
    ends = df.agg(F.struct(F.min(decision).alias("lo"), F.max(decision).alias("hi")).alias("e"))
    rows = df.withColumn("_e", ends.scalar())
    span = F.col("_e.hi") - F.col("_e.lo")
    score = F.when(span == 0, 0.0).otherwise(1 - (F.col(decision) - F.col("_e.lo")) / span)
    return rows.withColumn(out, score).drop("_e")


def fixed_score(decision: Column) -> Column:
    """A decision value of about -0.5 .. 0.5 as a score, larger is more anomalous."""
    return 1 - (decision + 0.5) / 2


def below_cut(decision: Column, cut: float = -0.5) -> Column:
    return (decision < cut).cast("int")


def contributing_features(scaled: DataFrame, columns: Sequence[str], decision: str = "decision", at: str = "timestamp", k: int = 5) -> DataFrame:
    """At the most anomalous time: the k features with the largest absolute scaled value."""
    worst = scaled.agg(F.min_by(F.struct(at, *columns), F.struct(decision, at)).alias("w")).select("w.*")
    entries = F.array(*[F.struct(F.lit(c).alias("metric"), F.abs(c).alias("importance")) for c in columns])
    long = worst.select(at, F.inline(entries)).where(F.col("importance").isNotNull())
    return long.orderBy(F.col("importance").desc(), "metric").limit(k)


def multivariate_issue(scored: DataFrame, decision: str = "decision", at: str = "timestamp", cut: float = -0.5) -> DataFrame:
    """One critical issue if the lowest decision value is below the cut, else no row."""
    low = scored.agg(F.min(decision).alias("low"), F.min_by(at, F.struct(decision, at)).alias("timestamp"))
    return low.where(F.col("low") < cut).select(
        F.lit("multiple").alias("service"), F.lit("multivariate_anomaly").alias("metric_name"),
        F.col("low").alias("current_value"), F.col("low").alias("predicted_value"),
        F.lit(-1.0).alias("lower_bound"), F.lit(0.0).alias("upper_bound"), "timestamp",
        F.least(F.lit(1.0), F.abs("low") * 2).alias("confidence"), F.lit(0.0).alias("time_until_hours"),
        F.lit(0.8).alias("business_impact"), F.lit("critical").alias("severity"),
    )


def issue_severity(confidence: Column, impact: Column, hours: Column) -> Column:
    s = confidence * impact * (F.lit(1.0) / (1.0 + hours / 24.0))
    return F.when(s > 0.8, "critical").when(s > 0.6, "high").when(s > 0.4, "medium").otherwise("low")


def severity_rank(severity: Column) -> Column:
    rank = F.lit(4)
    for name, value in SEVERITY_RANK.items():
        rank = F.when(severity == name, value).otherwise(rank)
    return rank


def predict_issues(
    forecast: DataFrame, latest: DataFrame, bounds: DataFrame | None = None, impact: DataFrame | None = None,
    correlated: DataFrame | None = None, by: Sequence[str] = ("service", "metric_name"), min_confidence: float = 0.7,
) -> DataFrame:
    """Forecast points outside their bounds, as issues, most severe and nearest first.

    ``bounds`` (lower_bound, upper_bound per series) comes from history; without it the forecast's own band is used,
    which is the strict reading. ``correlated`` holds (a, b, corr) with ``a`` as ``service/metric_name``.
    """
    by = list(by)
    now = latest.groupBy(*by).agg(
        F.max_by("value", "timestamp").alias("current_value"), F.max("timestamp").alias("_now")
    )
    rows = forecast.join(now, by).where(F.col("timestamp") > F.col("_now"))
    if bounds is None:
        rows = rows.withColumnsRenamed({"yhat_lower": "lower_bound", "yhat_upper": "upper_bound"})
    else:
        rows = rows.join(bounds.select(*by, "lower_bound", "upper_bound"), by)
    outside = (F.col("yhat") < F.col("lower_bound")) | (F.col("yhat") > F.col("upper_bound"))
    middle = (F.col("lower_bound") + F.col("upper_bound")) / 2
    confidence = F.least(
        F.lit(1.0), F.coalesce(F.try_divide(2 * F.abs(F.col("yhat") - middle), F.col("upper_bound") - F.col("lower_bound")), F.lit(1.0))
    )
    rows = rows.where(outside).withColumn("confidence", confidence).where(F.col("confidence") >= min_confidence)
    if impact is not None:
        rows = rows.join(impact.select(*by, F.col("impact").alias("_impact")), by, "left")
    else:
        rows = rows.withColumn("_impact", F.lit(None).cast("double"))
    hours = (F.unix_micros("timestamp") - F.unix_micros("_now")) / 3_600_000_000
    rows = rows.withColumns({"time_until_hours": hours, "business_impact": F.coalesce("_impact", F.lit(0.5))})
    rows = rows.withColumn("severity", issue_severity(F.col("confidence"), F.col("business_impact"), F.col("time_until_hours")))
    columns = [
        *by, "current_value", F.col("yhat").alias("predicted_value"), "lower_bound", "upper_bound", "timestamp",
        "confidence", "time_until_hours", "business_impact", "severity",
    ]
    if correlated is not None:
        related = correlated.groupBy(F.col("a").alias("_series")).agg(
            F.array_sort(F.collect_list(F.struct("rank", F.col("b").alias("metric"), F.col("corr").alias("correlation")))).alias("correlated_metrics")
        )
        rows = rows.withColumn("_series", F.concat_ws("/", *by)).join(related, "_series", "left")
        columns.append("correlated_metrics")
    return rows.select(*columns).orderBy(severity_rank(F.col("severity")), "time_until_hours", *by)


def generate_thresholds(described: DataFrame, multiplier: float = 1.0, base: float = 0.0, sensitivity: float = SENSITIVITY) -> DataFrame:
    """A limit per metric: the estimate mean + sensitivity deviations, times a multiplier, plus a base."""
    estimate = F.col("mean") + sensitivity * F.col("std")
    return described.withColumn("threshold", estimate * multiplier + base)


def generate_rules(thresholds: DataFrame, comparison: str = ">", hold: str = "5m", severity: str = "warning") -> DataFrame:
    """Rule rows from metric limits: alert, expression text, hold, severity, labels and annotations."""
    name = F.concat(F.initcap(F.col("metric_name")), F.lit("Dynamic"))
    limit = F.format_string("%.6f", F.col("threshold"))
    return thresholds.where(F.col("threshold").isNotNull()).select(
        F.lit("dynamic_thresholds").alias("group"), name.alias("alert"),
        F.concat_ws(" ", F.col("metric_name"), F.lit(comparison), limit).alias("expr"), F.lit(hold).alias("for"),
        F.lit(severity).alias("severity"),
        F.create_map(F.lit("severity"), F.lit(severity), F.lit("type"), F.lit("dynamic_threshold"), F.lit("metric"), F.col("metric_name")).alias("labels"),
        F.create_map(
            F.lit("summary"), F.concat(name, F.lit(" - Dynamic threshold exceeded")),
            F.lit("threshold_value"), limit,
        ).alias("annotations"),
    )


def rules_from_config(thresholds: DataFrame, configs: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Rule rows for configured metrics with a limit: own alert name, query, comparison, hold, severity, dashboard, labels
    and annotations. A configuration (name, alert_name, query, ...) is an expression on the metric's row: no join."""
    limit = F.format_string("%.6f", F.col("threshold"))
    text = lambda pairs: F.map_from_arrays(F.array(*[F.lit(k) for k in pairs]), F.array(*[v if isinstance(v, Column) else F.lit(str(v)) for v in pairs.values()]))
    hits = []
    for c in configs:
        labels = {"severity": c.get("severity", "warning"), "type": "dynamic_threshold", "metric": c["name"], **c.get("labels", {})}
        notes = {
            "summary": f"{c['alert_name']} - Dynamic threshold exceeded",
            "description": F.concat(F.lit("{{ $labels.instance }} has exceeded the dynamic threshold of "), limit, F.lit(f" for {c['name']}")),
            "threshold_value": limit, "dashboard": c.get("dashboard", ""), **c.get("annotations", {}),
        }
        rule = F.struct(
            F.lit("dynamic_thresholds").alias("group"), F.lit(c["alert_name"]).alias("alert"), F.concat_ws(" ", F.lit(c["query"]), F.lit(c.get("comparison", ">")), limit).alias("expr"),
            F.lit(c.get("for", "5m")).alias("for"), text(labels).alias("labels"), text(notes).alias("annotations"),
        )
        hits.append(F.when((F.col("metric_name") == c["name"]) & F.col("threshold").isNotNull(), rule))
    return one_row_per_hit(thresholds.select("metric_name", "threshold"), hits).drop("metric_name", "threshold")


def rules_document(rules: DataFrame) -> DataFrame:
    """One document of groups; it holds as many rules as there are configured metrics."""
    fields = [c for c in rules.columns if c != "group"]
    groups = rules.groupBy("group").agg(F.sort_array(F.collect_list(F.to_json(F.struct(*fields)))).alias("_r"))
    text = F.concat(F.lit('{"name":"'), F.col("group"), F.lit('","rules":['), F.array_join("_r", ","), F.lit("]}"))
    return groups.agg(F.concat(F.lit('{"groups":['), F.array_join(F.sort_array(F.collect_list(text)), ","), F.lit("]}")).alias("document"))


def service_features(calls: DataFrame, width: str = "1h", by: Sequence[str] = ("service", "endpoint")) -> DataFrame:
    """Latency quantiles, errors, throughput and users per service, endpoint and window.

    Needs service, endpoint, timestamp, response_time, status_code and user_id; ``session_id``, ``region``,
    ``cpu`` and ``memory`` are used when present.
    """
    rows = calls.withColumn("window_start", F.timestamp_micros(step_start(F.col("timestamp"), micros(width))))
    keys = [*by, "window_start"]
    status = F.col("status_code")
    failed, client, server = status >= 400, (status >= 400) & (status < 500), status >= 500
    span = seconds(width)
    aggregates = [
        F.count(F.lit(1)).alias("throughput"), F.count(F.when(failed, 1)).alias("error_count"),
        F.avg(failed.cast("double")).alias("error_rate"), F.count(F.when(client, 1)).alias("status_4xx"),
        F.count(F.when(server, 1)).alias("status_5xx"), (F.count(F.lit(1)) / span).alias("requests_per_second"),
        F.count_distinct("user_id").alias("unique_users"),
    ]
    if "session_id" in calls.columns:
        aggregates.append(F.count_distinct("session_id").alias("session_count"))
    aggregates += [F.avg(c).alias(f"{c}_usage") for c in ("cpu", "memory") if c in calls.columns]
    out = rows.groupBy(*keys).agg(*aggregates)
    quantiles = exact_quantiles(rows, keys, "response_time", {"p50": 0.5, "p90": 0.9, "p99": 0.99}).drop("n")
    out = out.join(quantiles, keys)
    if "region" in calls.columns:
        places = rows.groupBy(*keys, "region").agg(F.count(F.lit(1)).alias("_c")).groupBy(*keys).agg(
            F.map_from_entries(F.collect_list(F.struct("region", "_c"))).alias("geographic_distribution")
        )
        out = out.join(places, keys, "left")
    return out
