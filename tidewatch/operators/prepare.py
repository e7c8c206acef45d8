"""Preparation and statistics of metric samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.labels import calendar
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.operators.sequence import cumulative_over_value, suggest_chunk, with_last_known

METRIC_KEY = ("metric_name",)

# Minimum quality per model, and which measures are upper limits.
TARGETS = {
    "anomaly_detector": {"precision": 0.80, "recall": 0.70, "f1": 0.75},
    "root_cause_analyzer": {"accuracy": 0.70, "top_k_accuracy": 0.85},
    "predictive_alerting": {"precision": 0.75, "recall": 0.80, "lead_time_hours": 24.0},
    "fraud_detector": {"precision": 0.90, "recall": 0.80, "f1": 0.85, "auc": 0.92},
    "inventory_optimizer": {"mape": 15.0, "rmse": 10.0, "stockout_rate": 0.05},
    "intrusion_detector": {"precision": 0.95, "recall": 0.85, "f1": 0.90, "false_positive_rate": 0.01},
}
UPPER_LIMITS = {"mape", "rmse", "stockout_rate", "false_positive_rate"}


def dedup_samples(
    samples: DataFrame, tie: Sequence[str], by: Sequence[str] = METRIC_KEY, ts: str = "timestamp"
) -> DataFrame:
    """First row per series and time in tie order. Copies are combined before the shuffle."""
    rest = [c for c in samples.columns if c not in (*by, ts)]
    kept = samples.groupBy(*by, ts).agg(F.min_by(F.struct(*rest), F.struct(*tie)).alias("_row"))
    return kept.select(*by, ts, "_row.*")


def interpolate_time(
    samples: DataFrame, by: Sequence[str] = METRIC_KEY, ts: str = "timestamp", value: str = "value", chunk: str | None = None
) -> DataFrame:
    """Missing values linear in time between their neighbours; the last value closes a trailing gap; a leading gap is dropped."""
    known_at = F.when(F.col(value).isNotNull(), F.unix_micros(ts))
    rows = samples.withColumn("_at", known_at)
    chunk = chunk or suggest_chunk(rows, by, ts)
    rows = with_last_known(rows, by, {"_v0": value, "_t0": "_at"}, ts, chunk=chunk)
    rows = with_last_known(rows, by, {"_v1": value, "_t1": "_at"}, ts, chunk=chunk, ahead=True)
    share = (F.unix_micros(ts) - F.col("_t0")) / (F.col("_t1") - F.col("_t0"))
    filled = (
        F.when(F.col(value).isNotNull(), F.col(value))
        # Between two samples of its own time there is nothing to go along.
        .when(F.col("_v1").isNull() | (F.col("_t0") == F.col("_t1")), F.col("_v0"))
        .when(F.col("_v0").isNotNull(), F.col("_v0") + (F.col("_v1") - F.col("_v0")) * share)
    )
    return rows.withColumn(value, filled).drop("_at", "_v0", "_t0", "_v1", "_t1").where(F.col(value).isNotNull())


def trim_extremes(samples: DataFrame, by: Sequence[str] = METRIC_KEY, value: str = "value", reach: float = 10.0) -> DataFrame:
    """Keep what lies within ``reach`` times the 1 %..99 % span around that span, per series."""
    span = exact_quantiles(samples, by, value, {"_low": 0.01, "_high": 0.99}).drop("n")
    margin = (F.col("_high") - F.col("_low")) * reach
    kept = samples.join(span, list(by)).where(F.col(value).between(F.col("_low") - margin, F.col("_high") + margin))
    return kept.drop("_low", "_high")


def to_wide(samples: DataFrame, columns: Sequence[str], at: str = "timestamp", name: str = "metric_name", value: str = "value") -> DataFrame:
    """One row per time, one column per named metric (mean of its samples)."""
    return samples.groupBy(at).pivot(name, list(columns)).agg(F.avg(value))


def ffill(samples: DataFrame, by: Sequence[str] = METRIC_KEY, ts: str = "timestamp", value: str = "value", chunk: str | None = None) -> DataFrame:
    """Carry the last value forward in each series."""
    return with_last_known(samples, by, {"_last": value}, ts, chunk=chunk).withColumn(value, F.col("_last")).drop("_last")


def ffill_wide(wide: DataFrame, columns: Sequence[str], at: str = "timestamp", chunk: str | None = None) -> DataFrame:
    """Carry forward in every column of a wide matrix."""
    rows = with_last_known(wide.withColumn("_all", F.lit(0)), ["_all"], {f"_f_{c}": c for c in columns}, at, chunk=chunk)
    return rows.select(*[c for c in wide.columns if c not in columns], *[F.col(f"_f_{c}").alias(c) for c in columns])


def impute_mean(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Remaining nulls become their column's mean."""
    means = wide.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("m"))
    rows = wide.withColumn("_m", means.scalar())
    return rows.withColumns({c: F.coalesce(F.col(c), F.col("_m")[c]) for c in columns}).drop("_m")


def fit_scaler(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per column: column, mean, std. A constant column divides by one."""
    stats = wide.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.avg(c).alias("mean"), F.coalesce(F.stddev_pop(c), F.lit(0.0)).alias("std"))
                for c in columns
            ]
        ).alias("s")
    )
    return stats.select(F.inline("s")).withColumn("std", F.when(F.col("std") == 0, 1.0).otherwise(F.col("std")))


def apply_scaler(wide: DataFrame, columns: Sequence[str], scaler: DataFrame) -> DataFrame:
    """Scale with stored parameters (one row per column, so bounded by the number of features)."""
    packed = scaler.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("mean", "std")))).alias("p"))
    rows = wide.withColumn("_p", packed.scalar())
    return rows.withColumns(
        {c: (F.col(c) - F.col("_p")[c]["mean"]) / F.col("_p")[c]["std"] for c in columns}
    ).drop("_p")


def standardise_series(samples: DataFrame, by: Sequence[str] = METRIC_KEY, value: str = "value") -> DataFrame:
    """Long form of the scaler: one mean and deviation per series."""
    stats = samples.groupBy(*by).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    scale = F.when(F.col("_s") == 0, 1.0).otherwise(F.col("_s"))
    return samples.join(stats, list(by)).withColumn("scaled", (F.col(value) - F.col("_m")) / scale).drop("_m", "_s")


def _gram(columns: Sequence[str]):
    import numpy as np
    import pandas as pd

    def partial(batches):
        k = len(columns)
        sums = {name: np.zeros((k, k)) for name in ("n", "x", "y", "xx", "yy", "xy")}
        for batch in batches:
            x = batch[list(columns)].to_numpy(dtype="float64")
            here = ~np.isnan(x)
            m = here.astype("float64")
            v = np.where(here, x, 0.0)
            sums["n"] += m.T @ m
            sums["x"] += v.T @ m
            sums["y"] += m.T @ v
            sums["xx"] += (v * v).T @ m
            sums["yy"] += m.T @ (v * v)
            sums["xy"] += v.T @ v
        i, j = np.triu_indices(k, 1)
        yield pd.DataFrame({"i": i, "j": j, **{name: s[i, j] for name, s in sums.items()}})

    return partial


def corr_matrix(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every two columns over the rows where both are present: a, b, corr (both orders).

    Rows are never paired with rows: product sums of the scaled columns are built per partition and added up. A column
    without spread has no correlation.
    """
    columns = list(columns)
    scaled = apply_scaler(wide.select(*columns), columns, fit_scaler(wide, columns))
    parts = scaled.mapInPandas(_gram(columns), "i int, j int, n double, x double, y double, xx double, yy double, xy double")
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    top = F.col("n") * F.col("xy") - F.col("x") * F.col("y")
    under = (F.col("n") * F.col("xx") - F.col("x") * F.col("x")) * (F.col("n") * F.col("yy") - F.col("y") * F.col("y"))
    names = F.array(*[F.lit(c) for c in columns])
    upper = total.select(
        names[F.col("i")].alias("a"), names[F.col("j")].alias("b"),
        F.when((F.col("n") > 1) & (under > 0), top / F.sqrt(under)).alias("corr"),
    )
    upper = upper.where(F.col("corr").isNotNull() & ~F.isnan("corr"))
    return upper.select(F.inline(F.array(F.struct("a", "b", "corr"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "corr"))))


def top_correlated(corr: DataFrame, k: int = 5) -> DataFrame:
    """The k others with the largest absolute correlation, per series; equal to nine digits counts as a tie, by name."""
    order = W.partitionBy("a").orderBy(F.round(F.abs("corr"), 9).desc(), "b")
    ranked = corr.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("a", "b", F.abs("corr").alias("corr"), "rank")


def describe_metric(samples: DataFrame, by: Sequence[str] = METRIC_KEY, value: str = "value", now: Column | None = None) -> DataFrame:
    """Mean, median, sample deviation, extremes, p90, p95, p99 and count per metric, with the time features of ``now``."""
    stats = samples.groupBy(*by).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
        F.max(value).alias("max"), F.count(value).alias("count"),
    )
    q = exact_quantiles(samples, by, value, {"median": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}).drop("n")
    out = stats.join(q, list(by))
    if now is not None:
        out = out.withColumns({n: c for n, c in calendar(now).items() if n != "month"})
    return out


def quantiles_exclusive(samples: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """p50, p95 and p99 at position p(n + 1)."""
    return exact_quantiles(samples, by, value, {"p50": 0.5, "p95": 0.95, "p99": 0.99}, method="exclusive")


def recent(samples: DataFrame, n: int = 1000, by: Sequence[str] = METRIC_KEY, ts: str = "timestamp", tie: Sequence[str] = ()) -> DataFrame:
    """The newest n rows per series; the limit is applied on both sides of the shuffle."""
    order = W.partitionBy(*by).orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in tie])
    return samples.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1, false positive rate and accuracy of 0/1 predictions, in one row."""
    hit = lambda y, p: F.count(F.when((F.col(label) == y) & (F.col(prediction) == p), 1))
    c = scored.agg(hit(1, 1).alias("tp"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), hit(0, 0).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(
        F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"), F.try_divide(fp, fp + tn).alias("false_positive_rate"),
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
    )


def auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve by rank sums, ties counted half: one row."""
    tallies = scored.groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("_neg"),
    )
    ranked = cumulative_over_value(tallies, "_s", {"_neg_upto": "_neg"})
    wins = F.sum(F.col("_pos").cast("double") * (F.col("_neg_upto") - F.col("_neg") / 2))
    return ranked.agg(F.try_divide(wins, F.sum("_pos").cast("double") * F.sum("_neg")).alias("auc"))


def forecast_errors(scored: DataFrame, actual: str = "actual", predicted: str = "predicted", stock: str | None = None) -> DataFrame:
    """MAPE in percent (zero actuals left out), RMSE, and the share of rows whose stock is below the actual."""
    a, p = F.col(actual), F.col(predicted)
    out = [
        (F.avg(F.when(a != 0, F.abs((a - p) / a))) * 100).alias("mape"),
        F.sqrt(F.avg((a - p) * (a - p))).alias("rmse"),
    ]
    if stock:
        out.append(F.avg(F.when(F.col(stock) < a, 1.0).otherwise(0.0)).alias("stockout_rate"))
    return scored.agg(*out)


def topk_accuracy(ranked: DataFrame, label: str = "label", candidates: str = "candidates") -> DataFrame:
    """Share of rows whose true class is among the ranked candidates."""
    return ranked.agg(F.avg(F.array_contains(F.col(candidates), F.col(label)).cast("double")).alias("top_k_accuracy"))


def meets_targets(measures: DataFrame, model: str, targets: Mapping[str, Mapping[str, float]] = TARGETS) -> DataFrame:
    """One row per measure with its target and whether it is met."""
    known = [m for m in targets[model] if m in measures.columns]
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"), F.lit(targets[model][m]).alias("target"),
                ((F.col(m) <= targets[model][m]) if m in UPPER_LIMITS else (F.col(m) >= targets[model][m])).alias("met"),
            )
            for m in known
        ]
    )
    return measures.select(F.inline(rows))


def profile(df: DataFrame, columns: Sequence[str], window: Column | None = None) -> DataFrame:
    """Statistics per column (and time window): rows, null rate, min, max, mean, deviation, distinct values."""
    by = [window.alias("window_start")] if window is not None else []
    long = df.select(
        *by, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]))
    )
    keys = [*(["window_start"] if by else []), "column"]
    return long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.col("x").isNull().cast("double")).alias("null_rate"),
        F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.count_distinct("x").alias("distinct"),
    )


def bin_shares(df: DataFrame, column: str, edges: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Share of values per fixed bin (bin i holds edge[i-1] <= x < edge[i])."""
    index = sum((F.when(F.col(column) >= e, 1).otherwise(0) for e in edges), F.lit(0))
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, index.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    whole = W.partitionBy(*by)
    return counts.withColumn("share", F.col("_n") / F.sum("_n").over(whole)).drop("_n")


def drift(current: DataFrame, baseline: DataFrame, floor: float = 1e-4) -> DataFrame:
    """Population stability index of two bin-share tables, per shared group columns."""
    by = [c for c in current.columns if c in baseline.columns and c not in ("bin", "share")]
    groups = [c for c in current.columns if c not in ("bin", "share")]
    extra = [c for c in groups if c not in by]
    # Bins empty on one side still count, so both are laid over the full set of bins.
    bins = baseline.select("bin").union(current.select("bin")).distinct().agg(F.collect_set("bin").alias("b"))
    keys = current.select(*groups).distinct() if groups else current.agg(F.count(F.lit(1)).alias("_any")).drop("_any")
    frame = keys.withColumn("bin", F.explode(bins.scalar()))
    both = frame.join(current.withColumnRenamed("share", "_c"), [*groups, "bin"], "left").join(
        baseline.withColumnRenamed("share", "_b"), [*by, "bin"], "left"
    )
    c = F.greatest(F.coalesce("_c", F.lit(0.0)), F.lit(floor))
    b = F.greatest(F.coalesce("_b", F.lit(0.0)), F.lit(floor))
    return both.groupBy(*by, *extra).agg(F.sum((c - b) * F.log(c / b)).alias("psi"))


def constraint_violations(current: DataFrame, baseline: DataFrame, max_null_rise: float = 0.05) -> DataFrame:
    """Columns of a profile that leave the baseline's range or hold more nulls than it allows."""
    b = baseline.select("column", F.col("min").alias("_min"), F.col("max").alias("_max"), F.col("null_rate").alias("_nulls"))
    rows = current.join(b, "column")
    checks = F.array(
        F.when(F.col("min") < F.col("_min"), "below_min"), F.when(F.col("max") > F.col("_max"), "above_max"),
        F.when(F.col("null_rate") > F.col("_nulls") + max_null_rise, "null_rate"),
    )
    rows = rows.withColumn("violations", F.filter(checks, lambda x: x.isNotNull())).where(F.size("violations") > 0)
    return rows.drop("_min", "_max", "_nulls")


def anomaly_summary(scored: DataFrame) -> DataFrame:
    """Rows, anomalies and their share of all rows, by detection method."""
    by = scored.groupBy("detection_method").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("is_anomaly"), 1)).alias("anomalies")
    )
    return by.withColumn("share_of_all", F.col("anomalies") / F.sum("rows").over(W.partitionBy(F.lit(0))))
