"""Row types of the data model and the column checks in front of every operator."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRIC = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
SERVICE_METRIC = T.StructType([*METRIC.fields, T.StructField("service", T.StringType())])
LABELLED_SAMPLE = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("name", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("value", T.DoubleType()),
    ]
)
LOG_RECORD = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("level", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("trace_id", T.StringType()),
        T.StructField("span_id", T.StringType()),
    ]
)
SPAN = T.StructType(
    [
        T.StructField("trace_id", T.StringType()),
        T.StructField("span_id", T.StringType()),
        T.StructField("parent_span_id", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("start", T.TimestampType()),
        T.StructField("duration_ms", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)
TRANSACTION_KEYS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
    ]
)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The frame itself, or an error that lists every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def require_rows(df: DataFrame, what: str = "training data") -> DataFrame:
    """Fitting on nothing is an error; this is the one place that looks at the data early."""
    if df.isEmpty():
        raise ValueError(f"empty {what}")
    return df


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The listed columns the frame has, in the listed order."""
    return [c for c in columns if c in df.columns]


def known(col: Column) -> Column:
    """NaN and NULL both mean missing."""
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)
