"""Keyed streaming state: user history, duplicate suppression, rate limit, breaker and notification groups."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from math import inf

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewatch.functions.durations import duration_seconds, micros, seconds, step_start
from tidewatch.operators.alerting import GROUP_WAIT, rate_limit
from tidewatch.operators.fraud import user_history
from tidewatch.streaming.ordered import AT, InOrder, emptied, filled, in_order


def history_stream(transactions: DataFrame) -> DataFrame:
    """Running user history over the non-fraudulent transactions (``is_fraud`` false), population deviation.

    Plain streaming aggregation: partial sums before the shuffle, so a very busy user is no hot spot.
    """
    rows = transactions.where(~F.coalesce(F.col("is_fraud"), F.lit(False)))
    return user_history(rows, population_std=True)


class CycleProcessor(InOrder):
    """Per key: count events, trip at the threshold, swallow until the timeout has passed (see operators.cycles)."""

    def __init__(self, threshold: int, timeout_us: int, ident: tuple[str, str], forget_us: int | None = None):
        super().__init__([(AT, "bigint"), ident], [ident[0]], ["key"])
        self.threshold, self.timeout, self.ident, self.forget = threshold, timeout_us, ident[0], forget_us

    def open(self) -> None:
        self.state = self.handle.getValueState("cycle", "until bigint, count int, last bigint")

    def advance(self, key, rows, watermark):
        until, count, last = self.state.get() if self.state.exists() else (-1, 0, -1)
        outcome = []
        for us in rows[AT].tolist():
            last = us
            if until != -1 and us < until:
                outcome.append(2)
                continue
            until, count = -1, count + 1
            if count >= self.threshold:
                until, count = us + self.timeout, 0
                outcome.append(1)
            else:
                outcome.append(0)
        over = until == -1 or until <= watermark
        # A breaker's count has no end of its own; what it was counting is dropped only if told so.
        if over and (count == 0 or self.forget is not None and last + self.forget <= watermark):
            self.state.clear()
        else:
            self.state.update((until, count, last))
        if outcome:
            yield self.named(key, {self.ident: rows[self.ident], "outcome": outcome})

    def wake(self) -> float:
        if not self.state.exists():
            return inf
        until, count, last = self.state.get()
        return until if until != -1 else last + self.forget if self.forget is not None else inf


def cycle_stream(
    events: DataFrame, key: str, ident: str, threshold: int, timeout: str, ts: str = "timestamp", forget: str | None = None, watermark: str = "1 minute",
) -> DataFrame:
    """Stream of key, ident and outcome (0 counted, 1 trips or is accepted, 2 swallowed), in order of time and ident.

    A key's state goes, by event time, once its timeout has passed and nothing is being counted; ``forget`` names how
    long without events a running count is kept.
    """
    rows = events.select(F.col(key).cast("string").alias("key"), ts, F.unix_micros(ts).alias(AT), *filled(events, [ident]))
    kind = dict(events.dtypes)[ident]
    processor = CycleProcessor(threshold, micros(timeout), (ident, kind), micros(forget) if forget else None)
    out = in_order(rows, ["key"], ts, watermark, processor, f"key string, {ident} {kind}, outcome int")
    return out.select("key", *emptied(out, [ident]), "outcome")


def suppress_stream(alerts: DataFrame, ident: str, window: str = "300s", key: str = "dedupe_key", watermark: str = "1 minute") -> DataFrame:
    """Accepted alerts: none of the same key was accepted less than ``window`` before."""
    return cycle_stream(alerts, key, ident, 1, window, watermark=watermark).where(F.col("outcome") == 1).drop("outcome")


def circuit_stream(failures: DataFrame, context: str, ident: str, threshold: int, reset: str, forget: str | None = None, watermark: str = "1 minute") -> DataFrame:
    names = F.create_map(F.lit(0), F.lit("counted"), F.lit(1), F.lit("opened"), F.lit(2), F.lit("refused"))
    return cycle_stream(failures, context, ident, threshold, reset, forget=forget, watermark=watermark).withColumn("breaker", names[F.col("outcome")]).drop("outcome")


def rate_limit_batch(path: str, tie: Sequence[str], limit: int, window: str = "60s") -> Callable[[DataFrame, int], None]:
    """At most ``limit`` accepted alerts per fixed window over all batches.

    Each batch is cut to ``limit`` rows per window before anything else, and only the days it touches are read of what
    was accepted before. Accepted rows of a batch replace their own folder when it is repeated.
    """
    day = micros("1d")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        slot = step_start(F.col("timestamp"), micros(window))
        few = rate_limit(batch, tie, limit, window).withColumn("_slot", slot)
        order = [F.col("timestamp"), *[F.col(c) for c in tie]]
        from pyspark.sql import Window as W

        few = few.withColumn("_rank", F.row_number().over(W.partitionBy("_slot").orderBy(*order)))
        few = few.withColumn("_day", step_start(F.col("timestamp"), day))
        kept = few = few.persist()
        ends = few.agg(F.min("_day").alias("lo"), F.max("_day").alias("hi")).first()
        if batch_id > 0 and ends["lo"] is not None:
            stored = spark.read.option("basePath", path).schema("_slot bigint, batch bigint, _day bigint").parquet(path)
            # Both columns are folders: other days and later batches are not opened.
            stored = stored.where((F.col("batch") < batch_id) & F.col("_day").between(ends["lo"], ends["hi"]))
            taken = stored.groupBy("_slot").agg(F.count(F.lit(1)).alias("_taken"))
            few = few.join(taken, "_slot", "left").where(F.col("_rank") + F.coalesce("_taken", F.lit(0)) <= limit).drop("_taken")
        few.drop("_rank").write.mode("overwrite").partitionBy("_day").parquet(f"{path}/batch={batch_id}")
        kept.unpersist()

    return run


def rate_limit_stream(alerts: DataFrame, path: str, checkpoint: str, tie: Sequence[str], limit: int, window: str = "60s") -> DataStreamWriter:
    return alerts.writeStream.foreachBatch(rate_limit_batch(path, tie, limit, window)).option("checkpointLocation", checkpoint)


class GroupProcessor(StatefulProcessor):
    """Per group: wait after the first alert, then send at every interval that brought alerts, or when a repeat is due.

    Each alert is counted under the tick that sends it; timers exist only for such ticks and for the next repeat.
    """

    def __init__(self, interval_s: float, repeat_s: float):
        self.interval_ms = int(interval_s * 1000)
        self.repeat_ms = -(-int(repeat_s * 1000) // self.interval_ms) * self.interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("group", "first bigint, sent bigint")
        self.ticks = handle.getMapState("ticks", "tick bigint", "alerts bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, sent = self.state.get() if self.state.exists() else (None, -1)
        # Only how many alerts came when is held, however many there are.
        alerts, wait = Counter(), None
        for pdf in rows:
            alerts.update(pdf["at_ms"].tolist())
            wait = min(int(pdf["wait_ms"].min()), wait if wait is not None else 1 << 62)
        if first is None:
            first = min(alerts) + wait
        self.state.update((int(first), int(sent)))
        ticks = Counter()
        for at, count in alerts.items():
            # An alert whose tick was already sent goes with the next one.
            tick = first + max(0, -(-(at - first) // self.interval_ms)) * self.interval_ms
            ticks[max(tick, first if sent < 0 else sent + self.interval_ms)] += count
        for at, count in ticks.items():
            known = self.ticks.getValue((int(at),))[0] if self.ticks.containsKey((int(at),)) else 0
            self.ticks.updateValue((int(at),), (int(known + count),))
            self.handle.registerTimer(int(at))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = int(expiredTimerInfo.getExpiryTimeInMs())
        first, sent = self.state.get()
        count = 0
        if self.ticks.containsKey((at,)):
            count = int(self.ticks.getValue((at,))[0])
            self.ticks.removeKey((at,))
        elif sent < 0 or at - sent < self.repeat_ms:
            return
        self.state.update((int(first), at))
        self.handle.registerTimer(at + self.repeat_ms)
        yield pd.DataFrame({"group": [key[0]], "sent_ms": [at], "new_alerts": [count]})

    def close(self) -> None:
        pass


def group_stream(routed: DataFrame, by: Sequence[str], interval: str = "5m", repeat: str = "4h", watermark: str = "1 minute") -> DataFrame:
    """Notifications of every group as event time passes: group, sent_ms, new_alerts."""
    wait = F.coalesce(duration_seconds(F.col("group_wait")), F.lit(seconds(GROUP_WAIT))) * 1000
    rows = routed.withWatermark("timestamp", watermark).select(
        F.concat_ws("|", "receiver", *by).alias("group"), "timestamp", F.unix_millis("timestamp").alias("at_ms"), wait.cast("long").alias("wait_ms")
    )
    return rows.groupBy("group").transformWithStateInPandas(
        GroupProcessor(seconds(interval), seconds(repeat)), "group string, sent_ms bigint, new_alerts bigint", "Append", "EventTime"
    )
