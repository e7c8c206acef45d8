"""Order-dependent helpers for series of any length.

A window over a whole series puts that series into one task. Each helper here cuts a series into time chunks, works
inside the chunks, summarises every chunk in one row, and carries what crosses a boundary over those summaries only.
``chunk`` is the longest stretch of one series that one task sees; left out, the rows are counted and the widest stretch
is taken in which no series holds more than a task should.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.durations import micros, step_start
from tidewatch.session import materialise

def suggest_chunk(
    df: DataFrame, keys: Sequence[str], ts: str = "timestamp", rows_per_task: int = 5_000_000,
    candidates: Sequence[str] = ("1d", "6h", "1h", "10m", "1m", "10s", "1s"),
) -> str:
    """The widest chunk in which no series has more than ``rows_per_task`` rows; one counting job over the table.

    Only where the widest does not fit is the table counted once more, by the finest, and all others are sums of that.
    """
    at = step_start(F.col(ts), micros(candidates[0])).alias("_at")
    fits = lambda counts: (counts.agg(F.max("_n").alias("n")).first()["n"] or 0) <= rows_per_task
    if fits(df.groupBy(*keys, at).agg(F.count(F.lit(1)).alias("_n"))):
        return candidates[0]
    finest = df.groupBy(*keys, step_start(F.col(ts), micros(candidates[-1])).alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    finest = materialise(finest, "chunk-counts")
    for chunk in candidates[1:-1]:
        wider = F.col("_at") - F.pmod("_at", F.lit(micros(chunk)))
        if fits(finest.groupBy(*keys, wider.alias("_at")).agg(F.sum("_n").alias("_n"))):
            return chunk
    return candidates[-1]


def _chunked(df: DataFrame, ts: str, chunk: str) -> DataFrame:
    return df.withColumn("_chunk", step_start(F.col(ts), micros(chunk)))


def _order(ts: str, tie: Sequence[str]) -> list[Column]:
    return [F.col(ts), *[F.col(c) for c in tie]]


def with_previous(
    df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], ts: str = "timestamp",
    tie: Sequence[str] = (), chunk: str | None = None,
) -> DataFrame:
    """Add, for each new name, the named column's value in the row before within the series."""
    chunk = chunk or suggest_chunk(df, keys, ts)
    rows = _chunked(df, ts, chunk)
    inside = W.partitionBy(*keys, "_chunk").orderBy(*_order(ts, tie))
    packed = F.struct(*[F.col(old).alias(new) for new, old in columns.items()])
    rows = rows.withColumn("_prev", F.lag(packed).over(inside))
    tails = _chunked(df, ts, chunk).groupBy(*keys, "_chunk").agg(F.max_by(packed, F.struct(*_order(ts, tie))).alias("_tail"))
    carried = tails.select(
        *keys, "_chunk", F.lag("_tail").over(W.partitionBy(*keys).orderBy("_chunk")).alias("_carry")
    )
    rows = rows.join(carried, [*keys, "_chunk"], "left")
    before = F.coalesce(F.col("_prev"), F.col("_carry"))
    return rows.withColumns({new: before[new] for new in columns}).drop("_prev", "_carry", "_chunk")


def with_last_known(
    df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], ts: str = "timestamp",
    tie: Sequence[str] = (), chunk: str | None = None, ahead: bool = False,
) -> DataFrame:
    """Add, for each new name, the last non-null value at or before the row (or the next one, with ``ahead``)."""
    chunk = chunk or suggest_chunk(df, keys, ts)
    rows = _chunked(df, ts, chunk)
    order = _order(ts, tie)
    inside = W.partitionBy(*keys, "_chunk").orderBy(*order)
    if ahead:
        # Ahead is back in the reversed order, rows of one time included: a frame up to the end of its partition is
        # worked out anew for every row.
        rows = rows.withColumn("_place", F.row_number().over(inside))
        inside = W.partitionBy(*keys, "_chunk").orderBy(F.desc("_place"))
    inside = inside.rowsBetween(W.unboundedPreceding, 0)
    chunks = F.col("_chunk").desc() if ahead else F.col("_chunk").asc()
    across = W.partitionBy(*keys).orderBy(chunks).rowsBetween(W.unboundedPreceding, -1)
    edge = F.min_by if ahead else F.max_by
    # The order key is null where the value is null, so such rows never win.
    tails = rows.groupBy(*keys, "_chunk").agg(
        *[
            edge(F.col(old), F.when(F.col(old).isNotNull(), F.struct(*order))).alias(f"_tail_{new}")
            for new, old in columns.items()
        ]
    )
    carried = tails.select(
        *keys, "_chunk", *[F.last(f"_tail_{new}", ignorenulls=True).over(across).alias(f"_carry_{new}") for new in columns]
    )
    rows = rows.withColumns({f"_in_{new}": F.last(old, ignorenulls=True).over(inside) for new, old in columns.items()})
    rows = rows.join(carried, [*keys, "_chunk"], "left")
    rows = rows.withColumns({new: F.coalesce(f"_in_{new}", f"_carry_{new}") for new in columns})
    return rows.drop("_chunk", "_place", *[f"_in_{n}" for n in columns], *[f"_carry_{n}" for n in columns])


def running_total(
    df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], ts: str = "timestamp",
    tie: Sequence[str] = (), chunk: str | None = None,
) -> DataFrame:
    """Add, for each new name, the running sum of the named column up to and including the row."""
    chunk = chunk or suggest_chunk(df, keys, ts)
    rows = _chunked(df, ts, chunk)
    inside = W.partitionBy(*keys, "_chunk").orderBy(*_order(ts, tie)).rowsBetween(W.unboundedPreceding, 0)
    across = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, "_chunk").agg(*[F.sum(old).alias(f"_sum_{new}") for new, old in columns.items()])
    carried = sums.select(*keys, "_chunk", *[F.sum(f"_sum_{new}").over(across).alias(f"_carry_{new}") for new in columns])
    rows = rows.withColumns({f"_in_{new}": F.sum(old).over(inside) for new, old in columns.items()})
    rows = rows.join(carried, [*keys, "_chunk"], "left")
    rows = rows.withColumns({new: F.col(f"_in_{new}") + F.coalesce(F.col(f"_carry_{new}"), F.lit(0)) for new in columns})
    return rows.drop("_chunk", *[f"_in_{n}" for n in columns], *[f"_carry_{n}" for n in columns])


def sessions(
    df: DataFrame, keys: Sequence[str], gap: str, sums: Mapping[str, Column], ts: str = "timestamp", chunk: str | None = None
) -> DataFrame:
    """Sessions per key: runs of rows less than ``gap`` apart, with start, end and the given sums.

    Runs are first built inside a chunk; what remains per key is at most a few runs per chunk, which are then merged.
    """
    chunk = chunk or suggest_chunk(df, keys, ts)
    limit = micros(gap)
    rows = _chunked(df, ts, chunk).withColumn("_us", F.unix_micros(ts))
    inside = W.partitionBy(*keys, "_chunk").orderBy("_us")
    starts = (F.col("_us") - F.lag("_us").over(inside) >= limit).cast("int")
    rows = rows.withColumn("_new", F.coalesce(starts, F.lit(1)))
    rows = rows.withColumn("_run", F.sum("_new").over(inside.rangeBetween(W.unboundedPreceding, 0)))
    runs = rows.groupBy(*keys, "_chunk", "_run").agg(
        F.min("_us").alias("_from"), F.max("_us").alias("_to"), *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    series = W.partitionBy(*keys).orderBy("_from")
    runs = runs.withColumn("_first", F.coalesce((F.col("_from") - F.lag("_to").over(series) >= limit).cast("int"), F.lit(1)))
    runs = runs.withColumn("_session", F.sum("_first").over(series.rowsBetween(W.unboundedPreceding, 0)))
    return (
        runs.groupBy(*keys, "_session")
        .agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"), *[F.sum(n).alias(n) for n in sums])
        .select(
            *keys,
            F.timestamp_micros("_from").alias("session_start"),
            F.timestamp_micros("_to").alias("session_end"),
            ((F.col("_to") - F.col("_from")) / 1_000_000).alias("duration_s"),
            *sums,
        )
    )


def cumulative_over_value(df: DataFrame, value: str, columns: Mapping[str, str], rows_per_task: int = 1_000_000) -> DataFrame:
    """Running sums over the whole frame in order of a numeric column (which must hold each value once).

    Rows are spread over ranges of the value, cut by a sketch into as many as keep about ``rows_per_task`` in each, so no
    task orders the whole frame however large it is.
    """
    df = materialise(df, "by-value")
    bins = max(16, ceil(df.count() / rows_per_task))
    cuts = df.select(F.percentile_approx(value, [i / bins for i in range(1, bins)], bins * 20).alias("_cuts"))
    rows = df.withColumn("_cuts", cuts.scalar()).withColumn(
        "_bin", F.size(F.filter("_cuts", lambda c: c < F.col(value)))
    ).drop("_cuts")
    inside = W.partitionBy("_bin").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    sums = rows.groupBy("_bin").agg(*[F.sum(old).alias(f"_sum_{new}") for new, old in columns.items()])
    # One row per bin is left here: a single-partition window over the bins.
    across = W.partitionBy(F.lit(0)).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    carried = sums.select("_bin", *[F.sum(f"_sum_{new}").over(across).alias(f"_carry_{new}") for new in columns])
    rows = rows.withColumns({f"_in_{new}": F.sum(old).over(inside) for new, old in columns.items()}).join(carried, "_bin")
    rows = rows.withColumns({new: F.col(f"_in_{new}") + F.coalesce(F.col(f"_carry_{new}"), F.lit(0)) for new in columns})
    return rows.drop("_bin", *[f"_in_{n}" for n in columns], *[f"_carry_{n}" for n in columns])
