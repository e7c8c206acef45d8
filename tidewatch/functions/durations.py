"""Duration texts (``15s``, ``5m``, ``24h``, ``30d``) as microseconds, and step arithmetic on timestamps."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_SECONDS = {"ms": 0.001, "s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800, "y": 31536000}


def seconds(text: str | int | float) -> float:
    if isinstance(text, (int, float)):
        return float(text)
    parts = re.findall(r"(\d+(?:\.\d+)?)(ms|s|m|h|d|w|y)", text)
    if not parts or "".join(n + u for n, u in parts) != text:
        raise ValueError(f"not a duration: {text!r}")
    return sum(float(n) * UNIT_SECONDS[u] for n, u in parts)


def micros(text: str | int | float) -> int:
    return round(seconds(text) * 1_000_000)


def duration_seconds(col: Column) -> Column:
    """Seconds of a one-unit duration text column, null when it does not parse."""
    number = F.regexp_extract(col, r"^(\d+(?:\.\d+)?)(ms|s|m|h|d|w|y)$", 1)
    unit = F.regexp_extract(col, r"^(\d+(?:\.\d+)?)(ms|s|m|h|d|w|y)$", 2)
    scale = F.create_map(*[F.lit(x) for pair in UNIT_SECONDS.items() for x in (pair[0], float(pair[1]))])
    return F.when(number != "", number.cast("double") * scale[unit])


def step_end(ts: Column, step: int) -> Column:
    """End of the step holding ``ts`` in epoch microseconds; steps are open on the left: (end - step, end]."""
    return (F.ceil(F.unix_micros(ts) / F.lit(step)) * F.lit(step)).cast("long")


def step_start(ts: Column, step: int) -> Column:
    us = F.unix_micros(ts)
    return us - F.pmod(us, F.lit(step))
