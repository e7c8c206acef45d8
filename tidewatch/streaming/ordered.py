"""Keyed state in order of event time: rows wait until the watermark has passed them.

What comes out of such a stream does not depend on how its input was cut into batches, nor on the order inside the
watermark. A key holds its waiting rows, its own small state, and one timer for the next time something is due; once
nothing waits and nothing runs, it holds nothing. Rows behind the watermark never get here; ``telemetry.split_late``
keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import inf

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewatch.functions.durations import micros, seconds

AT = "at_us"
#: Rows that wait in one entry of the state, at most.
TOGETHER = 1 << 15


def _entries(rows: pd.DataFrame) -> list[tuple[bytes]]:
    """The rows as entries of a list in state: many to one, as the state's cost is mostly per entry."""
    out = []
    for start in range(0, len(rows), TOGETHER):
        table = pa.Table.from_pandas(rows.iloc[start : start + TOGETHER], preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        out.append((sink.getvalue().to_pybytes(),))
    return out


def _rows(entries: Iterator[tuple[bytes]], names: Sequence[str]) -> pd.DataFrame:
    parts = [pa.ipc.open_stream(e[0]).read_pandas() for e in entries]
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame([], columns=names)


class InOrder(StatefulProcessor):
    """Calls ``advance`` with a key's rows the watermark has passed, sorted, and with the watermark itself.

    ``fields`` are names and types of the rows' columns (the first is their time in microseconds), ``order`` breaks ties.
    """

    def __init__(self, fields: Sequence[tuple[str, str]], order: Sequence[str] = (), keys: Sequence[str] = ()):
        self.fields, self.order, self.keys = list(fields), [AT, *order], list(keys)
        self.names = [n for n, _ in self.fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.due = handle.getValueState("due", "ms bigint")
        self.open()

    def open(self) -> None:
        """Declare what ``advance`` keeps."""

    def advance(self, key: tuple, rows: pd.DataFrame, watermark: int) -> Iterator[pd.DataFrame]:
        raise NotImplementedError

    def wake(self) -> float:
        """When ``advance`` is to be called even without rows, in microseconds."""
        return inf

    def named(self, key: tuple, rows: dict) -> pd.DataFrame:
        """An output frame with the key's columns first."""
        size = len(next(iter(rows.values())))
        return pd.DataFrame({**{k: [v] * size for k, v in zip(self.keys, key, strict=True)}, **rows})

    def _set(self, at: float) -> None:
        known = self.due.get()[0] if self.due.exists() else None
        if at == inf or (known is not None and known * 1000 <= at):
            return
        if known is not None:
            self.handle.deleteTimer(int(known))
        ms = int(-(-at // 1000))
        self.due.update((ms,))
        self.handle.registerTimer(ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = inf
        for pdf in rows:
            self.waiting.appendList(_entries(pdf[self.names]))
            first = min(first, int(pdf[AT].min()))
        self._set(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        held = _rows(self.waiting.get() if self.waiting.exists() else (), self.names)
        rows, rest = held[held[AT] <= watermark], held[held[AT] > watermark]
        if len(rows):
            self.waiting.put(_entries(rest)) if len(rest) else self.waiting.clear()
        self.due.clear()
        rows = rows.astype({AT: "int64"}).sort_values(self.order, kind="stable", ignore_index=True)
        yield from self.advance(tuple(key), rows, watermark)
        self._set(max(min(int(rest[AT].min()) if len(rest) else inf, self.wake()), watermark + 1000))

    def close(self) -> None:
        pass


def in_order(rows: DataFrame, keys: Sequence[str], ts: str, watermark: str, processor: InOrder, output: str) -> DataFrame:
    """The processor over ``rows`` (keys, ``ts``, ``at_us`` and what its fields name), as an append-mode stream."""
    return rows.withWatermark(ts, watermark).groupBy(*keys).transformWithStateInPandas(processor, output, "Append", "EventTime")


#: Whole numbers stand in for null on the way through pandas, which has none for them.
_NULLS = {"bigint": -(1 << 63), "int": -(1 << 31), "smallint": -(1 << 15), "tinyint": -(1 << 7)}


def filled(df: DataFrame, names: Sequence[str]) -> list[Column]:
    types = dict(df.dtypes)
    return [F.coalesce(F.col(n), F.lit(_NULLS[types[n]]).cast(types[n])).alias(n) if types[n] in _NULLS else F.col(n) for n in names]


def emptied(df: DataFrame, names: Sequence[str]) -> list[Column]:
    types = dict(df.dtypes)
    return [F.nullif(F.col(n), F.lit(_NULLS[types[n]]).cast(types[n])).alias(n) if types[n] in _NULLS else F.col(n) for n in names]


def _kinds(df: DataFrame, names: Sequence[str]) -> list[tuple[str, str]]:
    types = dict(df.dtypes)
    return [(n, types[n]) for n in names]


def _ddl(fields: Sequence[tuple[str, str]]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in fields)


# --- alert state --------------------------------------------------------------------------------------------------


class AlertProcessor(InOrder):
    """One run of a condition at a time: since when it holds and when it last held."""

    def __init__(self, keys: Sequence[str], hold: int, step: int):
        super().__init__([(AT, "bigint"), ("value", "double")], keys=keys)
        self.hold, self.step = hold, step

    def open(self) -> None:
        self.run = self.handle.getValueState("run", "since bigint, last bigint")

    def advance(self, key, rows, watermark):
        since, last = self.run.get() if self.run.exists() else (None, None)
        out = []
        for at, value in zip(rows[AT].tolist(), rows["value"].tolist(), strict=True):
            if last is not None and at - last > self.step:
                out.append((last + self.step, None, since, "resolved"))
                since = None
            since = at if since is None else since
            last = at
            out.append((at, value, since, "firing" if at - since >= self.hold else "pending"))
        if last is not None and last + self.step <= watermark:
            out.append((last + self.step, None, since, "resolved"))
            self.run.clear()
        elif last is not None:
            self.run.update((since, last))
        if out:
            at, value, start, state = zip(*out, strict=True)
            yield self.named(key, {AT: at, "value": pd.Series(value, dtype="float64"), "since_us": start, "state": state})

    def wake(self) -> float:
        return self.run.get()[1] + self.step if self.run.exists() else inf


def alert_state_stream(condition: DataFrame, by: Sequence[str], hold: str, step: str, watermark: str = "10 minutes") -> DataFrame:
    """``rules.alert_state`` over a stream of the times a condition holds, and a ``resolved`` row (without a value) at the
    first step it no longer does. A label set that went idle keeps nothing."""
    rows = condition.select(*by, "eval_ts", F.unix_micros("eval_ts").alias(AT), F.col("value").cast("double").alias("value"))
    shape = _ddl([*_kinds(condition, by), (AT, "bigint"), ("value", "double"), ("since_us", "bigint"), ("state", "string")])
    out = in_order(rows, by, "eval_ts", watermark, AlertProcessor(by, micros(hold), micros(step)), shape)
    return out.select(*by, F.timestamp_micros(AT).alias("eval_ts"), "value", F.timestamp_micros("since_us").alias("active_since"), "state")


# --- history of a metric ------------------------------------------------------------------------------------------


class HistoryProcessor(InOrder):
    """The newest ``keep`` values of a series; every sample meets mean and deviation of those before it."""

    def __init__(self, keys: Sequence[str], fields: Sequence[tuple[str, str]], tie: Sequence[str], keep: int, forget: int | None):
        super().__init__(fields, tie, keys)
        self.keep, self.forget = keep, forget

    def open(self) -> None:
        self.newest = self.handle.getValueState("newest", "points binary, last bigint")

    def advance(self, key, rows, watermark):
        raw, last = self.newest.get() if self.newest.exists() else (b"", None)
        past = np.frombuffer(raw, np.float64)
        value = rows["value"].to_numpy(float)
        known = ~np.isnan(value)
        x = np.concatenate([past, value[known]])
        if len(value):
            last = int(rows[AT].iloc[-1])
            middle = x.mean() if len(x) else 0.0  # sums of what is left are small
            sums, squares = (np.concatenate(([0.0], np.cumsum((x - middle) ** p))) for p in (1, 2))
            end = len(past) + np.cumsum(known) - known
            start = np.maximum(end - self.keep, 0)
            n = end - start
            s1, s2 = sums[end] - sums[start], squares[end] - squares[start]
            with np.errstate(invalid="ignore", divide="ignore"):
                mean = np.where(n > 0, middle + s1 / n, np.nan)
                deviation = np.where(n > 1, np.sqrt(np.maximum(s2 - s1 * s1 / n, 0) / (n - 1)), np.nan)
            rest = {c: rows[c] for c in self.names}
            yield self.named(key, {**rest, "hist_mean": mean, "hist_std": deviation, "hist_n": n})
        if last is None or self.forget is not None and last + self.forget <= watermark:
            self.newest.clear()
        elif len(value):
            self.newest.update((x[-self.keep :].tobytes(), last))

    def wake(self) -> float:
        return self.newest.get()[1] + self.forget if self.forget is not None and self.newest.exists() else inf


def history_stream(
    samples: DataFrame, by: Sequence[str], ident: Sequence[str], keep: int = 1000, ts: str = "timestamp", watermark: str = "10 minutes", forget: str | None = None,
) -> DataFrame:
    """Every sample (``by``, ``ident``, ``ts``, ``value``) with ``hist_mean``, ``hist_std`` and ``hist_n`` of the newest
    ``keep`` samples of its series before it, in order of time and ``ident``: what ``anomaly.flagged`` judges.

    ``forget`` names how long, by event time, a series without samples keeps its history."""
    rows = samples.select(*by, ts, F.unix_micros(ts).alias(AT), *filled(samples, ident), F.col("value").cast("double").alias("value"))
    fields = [(AT, "bigint"), *_kinds(samples, ident), ("value", "double")]
    processor = HistoryProcessor(by, fields, ident, keep, micros(forget) if forget else None)
    shape = _ddl([*_kinds(samples, by), *fields, ("hist_mean", "double"), ("hist_std", "double"), ("hist_n", "bigint")])
    out = in_order(rows, by, ts, watermark, processor, shape)
    numbers = [F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("value", "hist_mean", "hist_std")]
    return out.select(F.timestamp_micros(AT).alias(ts), *by, *emptied(out, ident), *numbers, "hist_n")


# --- sliding windows from panes -----------------------------------------------------------------------------------


class PaneProcessor(InOrder):
    """One partial per step ("pane") of the last window: samples, rise, the first sample's own rise, last value.

    A pane is made when the watermark has passed its end; a window is the difference of two running sums over panes, so
    every sample is added once however many windows hold it. The rise into a window's first sample does not count.
    """

    def __init__(self, keys: Sequence[str], tie: Sequence[tuple[str, str]], window: int, step: int):
        super().__init__([(AT, "bigint"), *tie, ("value", "double")], [n for n, _ in tie], keys)
        self.span, self.step = window // step, step

    def open(self) -> None:
        self.panes = self.handle.getValueState("panes", "pane array<bigint>, n array<bigint>, rise array<double>, into array<double>, total array<double>, last double, sent bigint")
        self.unmade = self.handle.getListState("unmade", ", ".join(f"`{n}` {t}" for n, t in self.fields))

    def advance(self, key, rows, watermark):
        # The last closed pane ends at or before the watermark; rows of the open one wait on.
        closed = watermark // self.step
        held = pd.DataFrame(list(self.unmade.get()) if self.unmade.exists() else [], columns=self.names)
        rows = pd.concat([held, rows], ignore_index=True) if len(held) else rows
        rows = rows[~rows["value"].isna().to_numpy(bool)].sort_values(self.order, kind="stable", ignore_index=True)
        place = -(-rows[AT].to_numpy(np.int64) // self.step)
        ready = place <= closed
        rest = rows[~ready]
        if len(rest):
            self.unmade.put(list(zip(*[rest[n].tolist() for n in self.names], strict=True)))
        elif len(held):
            self.unmade.clear()
        pane, n, rise, into, total, last, sent = (list(x) if isinstance(x, (list, tuple)) else x for x in self.panes.get()) if self.panes.exists() else ([], [], [], [], [], None, None)
        value, place = rows["value"].to_numpy(float)[ready], place[ready]
        if len(value):
            before = np.concatenate(([value[0] if last is None else last], value[:-1]))
            rises = np.where(value < before, value, value - before)
            if last is None:
                rises[0] = 0.0
            starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            pane += place[starts].tolist()
            n += np.diff(np.append(starts, len(place))).tolist()
            rise += np.add.reduceat(rises, starts).tolist()
            into += rises[starts].tolist()
            total += np.add.reduceat(value, starts).tolist()
            last = float(value[-1])
        if not pane:
            return
        panes = np.array(pane)
        first = max(int(panes[0]), (sent or -(1 << 62)) + 1)
        times = np.arange(first, min(closed, int(panes[-1]) + self.span - 1) + 1)
        begin, end = np.searchsorted(panes, times - self.span, "right"), np.searchsorted(panes, times, "right")
        some = end > begin
        if some.any():
            times, begin, end = times[some], begin[some], end[some]
            sums = [np.concatenate(([0], np.cumsum(x))) for x in (n, rise, total)]
            count, up, value_sum = (s[end] - s[begin] for s in sums)
            yield self.named(key, {AT: times * self.step, "n": count.astype(np.int64), "increase": up - np.array(into)[begin], "total": value_sum})
        keep = panes > closed - self.span + 1
        if keep.any() or len(rest):
            cut = lambda x: [v for v, k in zip(x, keep.tolist(), strict=True) if k]
            self.panes.update(([*map(int, cut(pane))], cut(n), cut(rise), cut(into), cut(total), last, int(closed)))
        else:
            self.panes.clear()  # no window holds a sample from before the next one

    def wake(self) -> float:
        first = inf
        if self.unmade.exists():
            first = min(-(-r[0] // self.step) * self.step for r in self.unmade.get())
        if self.panes.exists():
            pane, sent = self.panes.get()[0], self.panes.get()[6]
            first = min(first, (sent + 1) * self.step) if len(pane) else first
        return first


def sliding_stream(samples: DataFrame, by: Sequence[str], window: str, step: str, tie: Sequence[str] = (), ts: str = "timestamp", watermark: str = "10 minutes") -> DataFrame:
    """At every ``step``, over the last ``window`` of each series that holds samples: ``n``, ``increase`` (reset-corrected,
    as ``timeseries.increase``) and ``total``. ``window`` is a multiple of ``step``."""
    if micros(window) % micros(step):
        raise ValueError("the window must be a multiple of the step")
    rows = samples.select(*by, ts, F.unix_micros(ts).alias(AT), *filled(samples, tie), F.col("value").cast("double").alias("value"))
    shape = _ddl([*_kinds(samples, by), (AT, "bigint"), ("n", "bigint"), ("increase", "double"), ("total", "double")])
    out = in_order(rows, by, ts, watermark, PaneProcessor(by, _kinds(samples, tie), micros(window), micros(step)), shape)
    return out.select(*by, F.timestamp_micros(AT).alias("eval_ts"), "n", "increase", "total")


def rate_stream(samples: DataFrame, by: Sequence[str], window: str, step: str, tie: Sequence[str] = (), ts: str = "timestamp", watermark: str = "10 minutes") -> DataFrame:
    """``timeseries.rate`` over a stream."""
    rows = sliding_stream(samples, by, window, step, tie, ts, watermark).where("n >= 2")
    return rows.select(*by, "eval_ts", (F.col("increase") / seconds(window)).alias("value"))


# --- admission ----------------------------------------------------------------------------------------------------


class AdmissionProcessor(InOrder):
    """A queue's budget in the running slot, and the keys accepted within the window."""

    def __init__(self, keys: Sequence[str], ident: tuple[str, str], limit: int, slot: int, window: int):
        super().__init__([(AT, "bigint"), ident, ("key", "string")], [ident[0]], keys)
        self.ident, self.limit, self.slot, self.window = ident[0], limit, slot, window

    def open(self) -> None:
        self.budget = self.handle.getValueState("budget", "slot bigint, taken int")
        self.accepted = self.handle.getMapState("accepted", "key string", "at bigint")

    def advance(self, key, rows, watermark):
        slot, taken = self.budget.get() if self.budget.exists() else (None, 0)
        held = {k[0]: v[0] for k, v in self.accepted.iterator()} if self.accepted.exists() else {}
        out = []
        for at, ident, name in zip(rows[AT].tolist(), rows[self.ident].tolist(), rows["key"].tolist(), strict=True):
            if at // self.slot != slot:
                slot, taken = at // self.slot, 0
            if taken < self.limit and at - held.get(name, at - self.window) >= self.window:
                held[name], taken = at, taken + 1
                self.accepted.updateValue((name,), (at,))
                out.append((ident, at))
        # Nothing older than the watermark comes any more: what has left the window by then can go.
        for name, at in held.items():
            if watermark - at >= self.window:
                self.accepted.removeKey((name,))
        if slot is None or (slot + 1) * self.slot <= watermark:
            self.budget.clear()
        else:
            self.budget.update((slot, taken))
        if out:
            ident, at = zip(*out, strict=True)
            yield self.named(key, {self.ident: ident, AT: at})

    def wake(self) -> float:
        ends = [v[0] + self.window for v in self.accepted.values()] if self.accepted.exists() else []
        if self.budget.exists():
            ends.append((self.budget.get()[0] + 1) * self.slot)
        return min(ends, default=inf)


def admission_stream(
    alerts: DataFrame, ident: str, by: Sequence[str], limit: int, slot: str = "60s", window: str = "300s", key: str = "dedupe_key", ts: str = "timestamp", watermark: str = "1 minute",
) -> DataFrame:
    """``alerting.admit`` over a stream: ``by``, ``ident`` and time of the accepted alerts. A queue's state is its budget
    and at most ``limit`` keys per slot of the window; both go as event time passes."""
    rows = alerts.select(*by, ts, F.unix_micros(ts).alias(AT), *filled(alerts, [ident]), F.coalesce(F.col(key), F.lit("")).alias("key"))
    kind = _kinds(alerts, [ident])[0]
    out = in_order(rows, by, ts, watermark, AdmissionProcessor(by, kind, limit, micros(slot), micros(window)), _ddl([*_kinds(alerts, by), kind, (AT, "bigint")]))
    return out.select(*by, *emptied(out, [ident]), F.timestamp_micros(AT).alias(ts))
