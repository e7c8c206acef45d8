"""Reading a range over tiers: raw samples, 5-minute and 1-hour blocks, each kept for its own time.

Every stretch of the range is read from one tier. Of the tiers that still hold it and whose blocks fit the step, the
coarsest one is read; blocks are built some time after their samples, until then a finer tier serves. Where none fits,
because only coarser blocks are left, these give their values at their own ends. Stretches meet at ends of all blocks
and steps, so no block is cut, and what a counter rose across a seam is worked out once, from the last sample before it
and the first one behind it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from math import lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.durations import micros
from tidewatch.operators import timeseries as ts

# How long each tier is kept, and how old samples are when their blocks are built.
KEPT = {"raw": "30d", "5m": "90d", "1h": "365d"}
BUILT = {"5m": "40h", "1h": "10d"}


def stretches(now: int, step: str, kept: Mapping[str, str] = KEPT, built: Mapping[str, str] = BUILT) -> list[tuple[str, int, int]]:
    """(tier, from, to] in microseconds, oldest first, without gaps up to the end of the step that holds ``now``."""
    size, names = micros(step), sorted(kept, key=lambda n: 0 if n == "raw" else micros(n))
    grid = lcm(size, *[micros(n) for n in names if n != "raw"])
    up = lambda t: -(-t // grid) * grid
    since = {n: up(now - micros(kept[n])) for n in names}
    until = {n: up(now) if n == "raw" else now // grid * grid - up(micros(built.get(n, "0s"))) for n in names}
    edges = sorted({*since.values(), *until.values()} - {t for t in until.values() if t > up(now)})
    out: list[tuple[str, int, int]] = []
    for first, last in zip(edges[:-1], edges[1:], strict=True):
        there = [n for n in names if since[n] <= first and last <= until[n]]
        fits = [n for n in there if n == "raw" or size % micros(n) == 0]
        if not there and out:
            raise ValueError("a tier is built only after the finer one is gone: no tier holds the time between")
        if not there:
            continue
        tier = fits[-1] if fits else there[0]
        if out and out[-1][0] == tier and out[-1][2] == first:
            out[-1] = (tier, out[-1][1], last)
        else:
            out.append((tier, first, last))
    return out


def read_blocks(
    raw: DataFrame, tiers: Mapping[str, DataFrame], by: Sequence[str], step: str, now: dt.datetime,
    kept: Mapping[str, str] = KEPT, built: Mapping[str, str] = BUILT, time: str = "timestamp", value: str = "value",
) -> DataFrame:
    """Blocks of one ``step`` for all that any tier holds: ``timeseries.entered`` and the range functions go on from here.

    ``tiers`` are tables of ``timeseries.step_blocks`` (or ``coarser_blocks``) by block length; each is filtered to the
    stretches it serves, by the time it is laid out by."""
    # Session times are UTC.
    us = round(now.replace(tzinfo=now.tzinfo or dt.timezone.utc).timestamp() * 1_000_000)
    out = None
    for tier, first, last in stretches(us, step, kept, built):
        if tier == "raw":
            inside = (F.col(time) > F.timestamp_micros(F.lit(first))) & (F.col(time) <= F.timestamp_micros(F.lit(last)))
            part = ts.step_blocks(raw.where(inside), by, step, time, value)
        else:
            part = ts.coarser_blocks(tiers[tier].where((F.col("_end") > first) & (F.col("_end") <= last)), by, step)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else ts.step_blocks(raw.limit(0), by, step, time, value)
