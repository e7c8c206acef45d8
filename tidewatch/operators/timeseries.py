"""Time-series functions on labelled series, evaluated on a step grid.

Range functions first reduce the samples of a series to one row per step (an order-aware partial that can be merged),
so the series-wide windows see one row per step however many samples there are. Grid rows are filled only where a
window holds samples. Windows are open on the left: (eval - window, eval].
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.durations import micros, seconds, step_end

LOOKBACK = "5m"


def _rise(value: Column, before: Column) -> Column:
    """Counter increase between two neighbouring samples; a drop means a restart from zero."""
    return F.when(before.isNull(), 0.0).when(value < before, value).otherwise(value - before)


def _moved(value: Column, before: Column) -> Column:
    return (before.isNotNull() & (value != before)).cast("long")


def step_blocks(samples: DataFrame, by: Sequence[str], step: str, ts: str = "timestamp", value: str = "value", tasks: int | None = None) -> DataFrame:
    """One row per series and step: rise and changes inside the step, first and last sample, sum and extremes.

    Samples of one time stand in order of their value, so equal times give the same result on every run. ``tasks`` fixes
    over how many the samples are dealt, which adaptive execution otherwise brings down to the number of cores.
    """
    rows = samples.select(*by, F.col(ts).alias("_ts"), F.col(value).alias("_v"), step_end(F.col(ts), micros(step)).alias("_end"))
    rows = rows.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if tasks:
        rows = rows.repartition(tasks, *by, "_end")
    inside = W.partitionBy(*by, "_end").orderBy("_ts", "_v")
    rows = rows.withColumn("_b", F.lag("_v").over(inside))
    return rows.groupBy(*by, "_end").agg(
        F.sum(_rise(F.col("_v"), F.col("_b"))).alias("_rise"),
        F.sum(_moved(F.col("_v"), F.col("_b"))).alias("_moves"),
        F.count(F.lit(1)).alias("_n"),
        F.min_by("_v", F.struct("_ts", "_v")).alias("_head"),
        F.max_by("_v", F.struct("_ts", "_v")).alias("_last"),
        F.sum("_v").alias("_sum"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.max("_ts").alias("_last_ts"),
    )


def coarser_blocks(blocks: DataFrame, by: Sequence[str], step: str) -> DataFrame:
    """Blocks of a longer step from shorter ones: what lies between two blocks of a step counts inside it."""
    rows = blocks.withColumn("_fine", F.col("_end")).withColumn("_end", (F.ceil(F.col("_end") / F.lit(micros(step))) * F.lit(micros(step))).cast("long"))
    rows = rows.withColumn("_b", F.lag("_last").over(W.partitionBy(*by, "_end").orderBy("_fine")))
    return rows.groupBy(*by, "_end").agg(
        F.sum(F.col("_rise") + _rise(F.col("_head"), F.col("_b"))).alias("_rise"),
        F.sum(F.col("_moves") + _moved(F.col("_head"), F.col("_b"))).alias("_moves"),
        F.sum("_n").alias("_n"), F.min_by("_head", "_fine").alias("_head"), F.max_by("_last", "_fine").alias("_last"),
        F.sum("_sum").alias("_sum"), F.min("_min").alias("_min"), F.max("_max").alias("_max"), F.max("_last_ts").alias("_last_ts"),
    )


def entered(blocks: DataFrame, by: Sequence[str]) -> DataFrame:
    """Blocks with the rise and change on entering each, from the last sample before it."""
    blocks = blocks.withColumn("_b", F.lag("_last").over(W.partitionBy(*by).orderBy("_end")))
    return blocks.withColumns(
        {"_rise_in": _rise(F.col("_head"), F.col("_b")), "_moves_in": _moved(F.col("_head"), F.col("_b"))}
    ).drop("_b", "_head")


def step_partials(samples: DataFrame, by: Sequence[str], step: str, ts: str = "timestamp", value: str = "value", tasks: int | None = None) -> DataFrame:
    """``step_blocks`` with the rise and change on entering each step: what range functions start from."""
    return entered(step_blocks(samples, by, step, ts, value, tasks), by)


def on_grid(parts: DataFrame, by: Sequence[str], window: str, step: str) -> DataFrame:
    """Repeat nothing, fill gaps: every step end whose window holds samples becomes a row; filler rows hold nulls."""
    size, width = micros(step), micros(window)
    if width % size:
        raise ValueError("the window must be a multiple of the step")
    series = W.partitionBy(*by).orderBy("_end")
    until = F.least(F.coalesce(F.lead("_end").over(series) - size, F.col("_end") + width), F.col("_end") + width - size)
    payload = [c for c in parts.columns if c not in (*by, "_end")]
    grid = parts.withColumn("_until", until).withColumn("_eval", F.explode(F.sequence("_end", "_until", F.lit(size))))
    return grid.select(*by, "_eval", *[F.when(F.col("_eval") == F.col("_end"), F.col(c)).alias(c) for c in payload])


def _frame(by: Sequence[str], window: str, step: str):
    return W.partitionBy(*by).orderBy("_eval").rangeBetween(-(micros(window) - micros(step)), 0)


def _evaluated(df: DataFrame, by: Sequence[str], value: Column) -> DataFrame:
    return df.select(*by, F.timestamp_micros("_eval").alias("eval_ts"), value.alias("value"))


def increase(
    samples: DataFrame, by: Sequence[str], window: str, step: str, ts: str = "timestamp", value: str = "value"
) -> DataFrame:
    """Reset-corrected counter increase between the first and last sample of each window (at least two samples)."""
    return increase_of(step_partials(samples, by, step, ts, value), by, window, step)


def increase_of(parts: DataFrame, by: Sequence[str], window: str, step: str) -> DataFrame:
    """``increase`` from step partials that are already there."""
    frame = _frame(by, window, step)
    grid = on_grid(parts, by, window, step)
    total = F.sum(F.col("_rise") + F.col("_rise_in")).over(frame) - F.first("_rise_in", ignorenulls=True).over(frame)
    grid = grid.withColumns({"_value": total, "_count": F.sum("_n").over(frame)})
    return _evaluated(grid.where(F.col("_count") >= 2), by, F.col("_value"))


def rate(samples: DataFrame, by: Sequence[str], window: str, step: str, ts: str = "timestamp", value: str = "value") -> DataFrame:
    """Per-second increase over the window."""
    return increase(samples, by, window, step, ts, value).withColumn("value", F.col("value") / seconds(window))


def changes(samples: DataFrame, by: Sequence[str], window: str, step: str, ts: str = "timestamp", value: str = "value") -> DataFrame:
    """How often the value changed between neighbouring samples of the window."""
    frame = _frame(by, window, step)
    grid = on_grid(step_partials(samples, by, step, ts, value), by, window, step)
    total = F.sum(F.col("_moves") + F.col("_moves_in")).over(frame) - F.first("_moves_in", ignorenulls=True).over(frame)
    return _evaluated(grid, by, total.cast("double"))


def instant(
    samples: DataFrame, by: Sequence[str], step: str, lookback: str = LOOKBACK, ts: str = "timestamp", value: str = "value"
) -> DataFrame:
    """Last sample of each series at every step, no older than the lookback."""
    rows = samples.select(*by, F.col(ts).alias("_ts"), F.col(value).alias("_v"), step_end(F.col(ts), micros(step)).alias("_end"))
    parts = rows.groupBy(*by, "_end").agg(F.max_by("_v", F.struct("_ts", "_v")).alias("_last"))
    grid = on_grid(parts, by, lookback, step)
    return _evaluated(grid, by, F.last("_last", ignorenulls=True).over(_frame(by, lookback, step)))


def instant_of(parts: DataFrame, by: Sequence[str], step: str, lookback: str = LOOKBACK) -> DataFrame:
    """``instant`` from step partials that are already there."""
    grid = on_grid(parts.select(*by, "_end", "_last"), by, lookback, step)
    return _evaluated(grid, by, F.last("_last", ignorenulls=True).over(_frame(by, lookback, step)))


def aggregate_by(vector: DataFrame, by: Sequence[str], how: str = "sum") -> DataFrame:
    """Aggregate over series at each evaluation time."""
    fn = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}[how]
    return vector.groupBy(*by, "eval_ts").agg(fn("value").alias("value"))


def sum_by(vector: DataFrame, *by: str) -> DataFrame:
    return aggregate_by(vector, by, "sum")


def avg_by(vector: DataFrame, *by: str) -> DataFrame:
    return aggregate_by(vector, by, "avg")


BINARY = {
    "+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b,
    "/": lambda a, b: F.try_divide(a, b),
}
COMPARE = {
    ">": lambda a, b: a > b, "<": lambda a, b: a < b, ">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b,
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
}


def vector_binop(left: DataFrame, right: DataFrame, op: str, on: Sequence[str]) -> DataFrame:
    """One-to-one match on equal labels and time; a comparison keeps the left sample, arithmetic combines both."""
    pair = left.select(*on, "eval_ts", "value").join(
        right.select(*on, "eval_ts", F.col("value").alias("_right")), [*on, "eval_ts"]
    )
    if op in COMPARE:
        return pair.where(COMPARE[op](F.col("value"), F.col("_right"))).drop("_right")
    return pair.withColumn("value", BINARY[op](F.col("value"), F.col("_right"))).drop("_right")


def vector_eq(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return vector_binop(left, right, "==", on)


def threshold_filter(vector: DataFrame, op: str, limit: float) -> DataFrame:
    return vector.where(COMPARE[op](F.col("value"), F.lit(limit)))


def ratio(vector: DataFrame, by: Sequence[str], part: Column, op: str = "/") -> DataFrame:
    """Sum of the matching series over the sum of all series, per labels and time, in one aggregation."""
    out = vector.groupBy(*by, "eval_ts").agg(
        F.sum(F.when(part, F.col("value"))).alias("_part"), F.sum("value").alias("_all")
    )
    return out.where(F.col("_part").isNotNull()).select(*by, "eval_ts", F.try_divide("_part", "_all").alias("value"))


def histogram_quantile(
    buckets: DataFrame, q: float, by: Sequence[str], le: str = "le", value: str = "value", eval_ts: str = "eval_ts"
) -> DataFrame:
    """Quantile of cumulative buckets: linear inside the bucket, last finite bound for the open one."""
    keys = [*by, eval_ts]
    summed = buckets.groupBy(*keys, le).agg(F.sum(value).alias("_cum"))
    order = W.partitionBy(*keys).orderBy(le)
    whole = W.partitionBy(*keys)
    rows = summed.withColumns(
        {
            "_below": F.coalesce(F.lag("_cum").over(order), F.lit(0.0)),
            "_from": F.lag(le).over(order),
            "_total": F.max("_cum").over(whole),
        }
    )
    rank = F.lit(float(q)) * F.col("_total")
    width = F.col(le) - F.coalesce(F.col("_from"), F.lit(0.0))
    inside = F.coalesce(F.col("_from"), F.lit(0.0)) + width * (rank - F.col("_below")) / (F.col("_cum") - F.col("_below"))
    estimate = (
        F.when(F.col(le) == float("inf"), F.col("_from"))
        .when(F.col("_from").isNull() & (F.col(le) <= 0), F.col(le))
        .otherwise(inside)
    )
    hit = rows.where((F.col("_total") > 0) & (F.col("_cum") >= rank))
    return hit.groupBy(*keys).agg(F.min_by(estimate, F.col(le)).alias("value"))


def mean_from_sum_count(
    sums: DataFrame, counts: DataFrame, by: Sequence[str], series: Sequence[str], window: str, step: str
) -> DataFrame:
    """Mean of a summary: summed rate of its sum over summed rate of its count."""
    top = sum_by(rate(sums, series, window, step), *by)
    bottom = sum_by(rate(counts, series, window, step), *by)
    return vector_binop(top, bottom, "/", by)


def predict_linear(vector: DataFrame, by: Sequence[str], window: str, horizon: str | float) -> DataFrame:
    """Least-squares line over the trailing window of a step-aligned series, read ``horizon`` after each time."""
    t = F.unix_micros("eval_ts")
    frame = W.partitionBy(*by).orderBy("_t").rangeBetween(-(micros(window) - 1), 0)
    at = F.col("_t") / 1_000_000
    rows = vector.withColumn("_t", t).withColumns(
        {
            "_slope": F.regr_slope("value", at).over(frame), "_mean": F.avg("value").over(frame),
            "_mid": F.avg(at).over(frame), "_n": F.count("value").over(frame),
        }
    )
    # Read from the centre of the points: an intercept at the epoch would lose digits.
    ahead = F.col("_mean") + F.col("_slope") * (at + seconds(horizon) - F.col("_mid"))
    return rows.where(F.col("_n") >= 2).select(*by, "eval_ts", ahead.alias("value"))


def offset(vector: DataFrame, by: Sequence[str], back: str) -> DataFrame:
    """The vector as it was ``back`` earlier, stamped with the time it is looked at."""
    return vector.select(*by, F.timestamp_micros(F.unix_micros("eval_ts") + micros(back)).alias("eval_ts"), "value")


def topk(vector: DataFrame, k: int, tie: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The k largest samples at each evaluation time (and per extra label)."""
    order = W.partitionBy(*by, "eval_ts").orderBy(F.col("value").desc(), *tie)
    return vector.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")


def reduce_series(vector: DataFrame, by: Sequence[str], ts: str = "eval_ts", value: str = "value") -> DataFrame:
    """Panel reducers per series: last non-null, mean, max and sum."""
    known = F.when(F.col(value).isNotNull(), F.col(ts))
    return vector.groupBy(*by).agg(
        F.max_by(value, known).alias("last_not_null"), F.avg(value).alias("mean"),
        F.max(value).alias("max"), F.sum(value).alias("sum"),
    )


def dedup_replicas(samples: DataFrame, by: Sequence[str], replica: str = "replica", ts: str = "timestamp") -> DataFrame:
    """One sample per series and time: the lowest replica name wins. Combines before the shuffle."""
    rest = [c for c in samples.columns if c not in (*by, ts, replica)]
    kept = samples.groupBy(*by, ts).agg(F.min_by(F.struct(*rest), replica).alias("_row"))
    return kept.select(*by, ts, "_row.*")


def downsample(samples: DataFrame, by: Sequence[str], block: str, ts: str = "timestamp", value: str = "value") -> DataFrame:
    """One row per series and block with mergeable partials; counters keep what a rate over tiers needs."""
    return step_partials(samples, by, block, ts, value).select(
        *by, F.timestamp_micros("_end").alias("block_end"), F.col("_n").alias("count"),
        F.col("_sum").alias("sum"), F.col("_min").alias("min"), F.col("_max").alias("max"),
        F.col("_last").alias("last"), F.col("_last_ts").alias("last_ts"), (F.col("_rise") + F.col("_rise_in")).alias("rise"),
    )


def coarsen(blocks: DataFrame, by: Sequence[str], block: str) -> DataFrame:
    """A coarser tier from a finer one; averages are never averaged."""
    return blocks.groupBy(*by, step_end(F.col("block_end"), micros(block)).alias("_end")).agg(
        F.sum("count").alias("count"), F.sum("sum").alias("sum"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.max_by("last", "last_ts").alias("last"), F.max("last_ts").alias("last_ts"), F.sum("rise").alias("rise"),
    ).withColumn("block_end", F.timestamp_micros("_end")).drop("_end")


def slo_availability(
    requests: DataFrame, series: Sequence[str], by: Sequence[str], failed: Column, window: str = "1h", step: str = "1m"
) -> DataFrame:
    """100 x (1 - failed/total) of request counters; ``series`` are the columns that tell the counters apart."""
    return availability_of(rate(requests, series, window, step), by, failed)


def availability_of(rates: DataFrame, by: Sequence[str], failed: Column) -> DataFrame:
    """100 x (1 - failed/total) of rates that are already there."""
    out = rates.groupBy(*by, "eval_ts").agg(F.sum(F.when(failed, F.col("value")).otherwise(0.0)).alias("_bad"), F.sum("value").alias("_all"))
    return out.select(*by, "eval_ts", (100 * (1 - F.try_divide("_bad", "_all"))).alias("value"))


def error_budget(
    requests: DataFrame, series: Sequence[str], by: Sequence[str], failed: Column, window: str = "30d",
    step: str = "1h", allowed: float = 0.001,
) -> DataFrame:
    """Remaining error budget in percent; negative once it is overspent."""
    out = increase(requests, series, window, step).groupBy(*by, "eval_ts").agg(
        F.sum(F.when(failed, F.col("value")).otherwise(0.0)).alias("_bad"), F.sum("value").alias("_all")
    )
    return out.select(*by, "eval_ts", (100 * (1 - F.try_divide(F.col("_bad"), F.col("_all") * allowed))).alias("value"))


def utilisation(usage: DataFrame, limit: DataFrame, by: Sequence[str]) -> DataFrame:
    """Summed usage over summed limit per label set and time."""
    return vector_binop(sum_by(usage, *by), sum_by(limit, *by), "/", by)
