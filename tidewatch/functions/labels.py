"""Column expressions on label maps, log lines and value bands."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_RANK = {"DEBUG": 0, "INFO": 1, "WARN": 2, "ERROR": 3}

# Bands of the service and commerce panels (lower bound, colour).
BANDS = {
    "error_rate": [(0.0, "green"), (0.01, "yellow"), (0.05, "red")],
    "latency": [(0.0, "green"), (0.5, "yellow"), (1.0, "red")],
    "usage": [(0.0, "green"), (0.7, "yellow"), (0.85, "red")],
    "slo": [(0.0, "red"), (95.0, "yellow"), (99.0, "green")],
    "budget": [(0.0, "red"), (30.0, "yellow"), (70.0, "green")],
    "conversion": [(0.0, "red"), (1.0, "yellow"), (2.0, "green")],
}


def anchored(pattern: str) -> str:
    return f"^(?:{pattern})$"


def matches(col: Column, op: str, pattern: str) -> Column:
    """Label matcher; a missing label counts as empty text and regexes match the whole value."""
    value = F.coalesce(col, F.lit(""))
    if op == "=":
        return value == pattern
    if op == "!=":
        return value != pattern
    if op == "=~":
        return value.rlike(anchored(pattern))
    if op == "!~":
        return ~value.rlike(anchored(pattern))
    raise ValueError(f"unknown label operator {op!r}")


def joined(sources: Sequence[Column], separator: str = ";") -> Column:
    return F.concat_ws(separator, *[F.coalesce(c, F.lit("")) for c in sources])


def java_replacement(text: str) -> str:
    """``${1}`` and ``$1`` both name a group; Java knows the second form for numbers."""
    return re.sub(r"\$\{(\d+)\}", r"$\1", text)


def overlay(base: Column, extra: Column) -> Column:
    """Union of two maps in which ``extra`` wins; no duplicate-key error."""
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(extra, k)), extra)


def labelmap(labels: Column, pattern: str, keep_source: bool = False) -> Column:
    """Rename label keys that match to their first group; the last of equal new names wins."""
    hit = F.map_entries(F.map_filter(labels, lambda k, _: k.rlike(anchored(pattern))))
    renamed = F.transform(
        hit, lambda e: F.struct(F.regexp_replace(e["key"], anchored(pattern), "$1").alias("key"), e["value"].alias("value"))
    )
    last_only = F.filter(
        renamed,
        lambda e, i: ~F.exists(F.slice(renamed, i + 2, F.greatest(F.size(renamed), F.lit(1))), lambda x: x["key"] == e["key"]),
    )
    base = labels if keep_source else F.map_filter(labels, lambda k, _: ~k.rlike(anchored(pattern)))
    return overlay(base, F.map_from_entries(last_only))


def attribute_insert(attributes: Column, key: str, value: Column) -> Column:
    """Set a key only if it is absent."""
    return F.when(F.map_contains_key(attributes, key), attributes).otherwise(
        F.map_concat(attributes, F.create_map(F.lit(key), value))
    )


def attribute_upsert(attributes: Column, key: str, value: Column) -> Column:
    """Set a key, replacing what is there; a null value leaves the map alone."""
    return F.when(value.isNull(), attributes).otherwise(overlay(attributes, F.create_map(F.lit(key), value)))


def any_match(col: Column, patterns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [col.rlike(anchored(p)) for p in patterns])


def level_rank(level: Column) -> Column:
    expr = F.lit(LOG_RANK["INFO"])
    for name, rank in LOG_RANK.items():
        expr = F.when(level == name, rank).otherwise(expr)
    return expr


def trace_id_of(message: Column) -> Column:
    found = F.regexp_extract(message, r"traceID=(\w+)", 1)
    return F.when(found != "", found)


def traceparent(header: Column) -> Column:
    """``version-trace-span-flags`` as a struct, null when malformed."""
    parts = F.split(header, "-")
    well_formed = header.rlike(r"^[0-9a-f]{2}-[0-9a-f]{32}-[0-9a-f]{16}-[0-9a-f]{2}$")
    return F.when(
        well_formed,
        F.struct(
            parts[0].alias("version"), parts[1].alias("trace_id"), parts[2].alias("span_id"), parts[3].alias("flags")
        ),
    )


def band(value: Column, steps: Sequence[tuple[float, str]]) -> Column:
    """Name of the last step whose bound is <= value; below the first bound the first name holds."""
    expr = F.lit(steps[0][1])
    for bound, name in steps:
        expr = F.when(value >= bound, name).otherwise(expr)
    return F.when(value.isNotNull(), expr)


def calendar(ts: Column) -> dict[str, Column]:
    """Hour, weekday (Monday = 0), weekend flag, month."""
    weekday = F.weekday(ts)
    return {
        "hour_of_day": F.hour(ts),
        "day_of_week": weekday,
        "is_weekend": F.when(weekday >= 5, 1).otherwise(0),
        "month": F.month(ts),
    }


def render(template: Column | str, context: dict[str, Column]) -> Column:
    """Fill ``{name}`` placeholders; names without a value in the context stay as they are.

    A template known when the plan is made becomes one concatenation. A template column is cut at its placeholders
    once, so in both forms a filled-in value is never scanned for placeholders again.
    """
    if isinstance(template, str):
        parts = [p for p in re.split(r"(\{\w+\})", template) if p]
        return F.concat(
            *[
                F.coalesce(context[p[1:-1]].cast("string"), F.lit(p)) if p[0] == "{" and p[1:-1] in context else F.lit(p)
                for p in parts
            ]
        )
    values = F.create_map(*[x for k, v in context.items() for x in (F.lit(k), v.cast("string"))])
    tokens = F.regexp_extract_all(template, F.lit(r"(\{\w+\}|\{|[^{]+)"), 1)
    filled = F.transform(
        tokens,
        lambda t: F.when(
            t.rlike(r"^\{\w+\}$"), F.coalesce(F.element_at(values, F.substring(t, F.lit(2), F.length(t) - 2)), t)
        ).otherwise(t),
    )
    return F.array_join(filled, "")


def one_row_per_hit(df: DataFrame, candidates: Sequence[Column]) -> DataFrame:
    """A row per non-null candidate struct, its fields as columns.

    Exploding all candidates and dropping the nulls stays inside generated code; filtering the array first would not.
    """
    rows = df.withColumn("_hit", F.explode(F.array(*candidates))).where(F.col("_hit").isNotNull())
    return rows.select(*df.columns, "_hit.*")


#: Keys whose values are secret, alone or behind a prefix that ends in ``_`` or ``-``.
SECRET_KEYS = "password|passwd|pwd|secret|token|api[_-]?key|authorization"


def mask_secrets(text: Column) -> Column:
    """Hide values of secret-bearing keys; everything else, the user name included, stays.

    A quoted value goes up to its closing quote, single or double; an authorisation scheme of any name goes with its
    token; ``client_secret`` and ``db-password`` count as their last word does.
    """
    key = rf"""(?i)(["']?(?<![A-Za-z0-9])(?:[A-Za-z0-9]+[_-])*(?:{SECRET_KEYS})["']?\s*[=:]\s*"""
    double = F.regexp_replace(text, key + r'")(?:[^"\\]|\\.)*"', '$1***"')
    single = F.regexp_replace(double, key + r"')(?:[^'\\]|\\.)*'", "$1***'")
    scheme = r"""(?i)(["']?(?<![A-Za-z0-9])(?:[A-Za-z0-9]+[_-])*authorization["']?\s*[=:]\s*)(?![*"'])[A-Za-z][A-Za-z0-9+.-]*[ \t]+[^\s"',;}]+"""
    header = F.regexp_replace(single, scheme, "$1***")
    # What is left is bare, or quoted without an end.
    return F.regexp_replace(header, key + r"""["']?)(?!\*\*\*)[^\s"',;}]+""", "$1***")
