"""The table of named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def nudge(digits: int) -> float:
    """A thousandth of the last kept digit: exact halves then round alike whatever order they were summed in."""
    return 10.0 ** (-digits - 3)


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Result in plain comparable types: BIGINT, rounded DOUBLE, text timestamps."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            col = F.round(col.cast("double") + F.lit(nudge(digits)), digits) + F.lit(0.0)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            col = col.cast("long")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, TIME_TEXT)
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        out.append(col.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, digits: int = 6):
    """Register ``fn(tables) -> DataFrame`` under a name, with the SQL that must give the same rows."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query name used twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(Tables(spark, sf_dir)), digits)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def plain(body: str, num: str = "", ts: str = "", digits: int = 6) -> str:
    """Wrap oracle SQL so that its doubles are rounded and its timestamps are text, as ``tidy`` does."""
    swaps = [f"round(({c})::DOUBLE + {nudge(digits)}::DOUBLE, {digits}) + 0.0 AS {c}" for c in num.split()]
    swaps += [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in ts.split()]
    return f"SELECT * REPLACE ({', '.join(swaps)}) FROM ({body})" if swaps else body
