"""File sources and sinks: metric and feature CSV, payload bodies, load-test JSON, archive, index, reports, retention."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.durations import seconds
from tidewatch.operators.loadtest import scenario_of
from tidewatch.schema import METRIC

RECORDS_PER_FILE = 10_000
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# How long each kind of data is kept.
RETENTION = {
    "raw": "30d", "5m": "90d", "1h": "365d", "topic_metrics": "7d", "topic_traces": "3d", "topic_logs": "7d",
    "audit": "365d", "audit_log": "90d", "edge_cache": "7d",
}


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """First line of every ``*.csv`` below a folder: file, header. Lines are reduced before the shuffle."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.col("value"),
        F.monotonically_increasing_id().alias("_line"),
    )
    first = lines.where(F.col("_block") == 0).groupBy("file").agg(F.min_by("value", "_line").alias("header"))
    return first


def _layouts(spark: SparkSession, path: str, required: Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """Column lists and the files that have them; the driver holds file names only, as any file listing does."""
    rows = csv_headers(spark, path).groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    out = []
    for row in rows:
        columns = [c.strip().strip('"') for c in row["header"].split(",")]
        if all(c in columns for c in required):
            out.append((columns, row["files"]))
    return sorted(out)


def read_metric_csv(spark: SparkSession, path: str, required: Sequence[str] = ("timestamp", "metric_name", "value")) -> DataFrame:
    """All CSV files of a folder that have the required columns, in whatever order; others are skipped."""
    layouts = _layouts(spark, path, required)
    if not layouts:
        raise ValueError(f"no file below {path} has the columns {list(required)}")
    types = {f.name: f.dataType for f in METRIC.fields}
    parts = []
    for columns, files in layouts:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        rows = spark.read.csv(files, schema=schema, header=True)
        parts.append(rows.select(*[F.col(c).try_cast(types.get(c, T.StringType())).alias(c) for c in required]))
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_feature_csv(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """All CSV files of a folder, numeric columns only, with the column order to keep for scoring."""
    parts = []
    for _, files in _layouts(spark, path, ()):
        rows = spark.read.csv(files, header=True, inferSchema=True)
        numeric = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.NumericType)]
        parts.append(rows.select(*[F.col(c).cast("double").alias(c) for c in numeric]))
    if not parts:
        raise ValueError(f"no CSV file below {path}")
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out, out.columns


SAMPLE = "struct<timestamp:string,metric_name:string,name:string,value:double>"


def parse_metric_payload(df: DataFrame, column: str) -> DataFrame:
    """Samples from request bodies: a list, ``{"metrics": [...]}``, a columnar object, or CSV text with a header.

    Samples that lack a time, a name or a value are left out; ``invalid_payloads`` finds bodies without any sample.
    """
    body = F.ltrim(F.col(column))
    is_list, is_object = body.startswith("["), body.startswith("{")
    listed = F.from_json(F.when(is_list, body), f"array<{SAMPLE}>")
    wrapped = F.from_json(F.when(is_object, body), f"struct<metrics:array<{SAMPLE}>>")["metrics"]
    columnar = F.from_json(F.when(is_object, body), "struct<timestamp:array<string>,metric_name:array<string>,name:array<string>,value:array<double>>")
    names = F.coalesce(columnar["metric_name"], columnar["name"])
    zipped = F.transform(
        F.sequence(F.lit(1), F.size(columnar["value"])),
        lambda i: F.struct(
            F.try_element_at(columnar["timestamp"], i).alias("timestamp"), F.try_element_at(names, i).alias("metric_name"),
            F.lit(None).cast("string").alias("name"), F.try_element_at(columnar["value"], i).alias("value"),
        ),
    )
    zipped = F.when(columnar["value"].isNotNull() & (F.size(columnar["value"]) > 0), zipped)
    lines = F.split(F.when(~is_list & ~is_object, F.trim(body)), "\r?\n")
    cells = lambda line: F.transform(
        F.regexp_extract_all(line, F.lit(r'(?:^|,)(\s*"(?:[^"]|"")*"\s*|[^,]*)'), F.lit(1)),
        lambda c: F.when(F.trim(c).startswith('"'), F.replace(F.regexp_replace(F.trim(c), '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(F.trim(c)),
    )
    header = cells(lines[0])
    at = lambda found, name: F.try_element_at(found, F.nullif(F.array_position(header, name), F.lit(0)).cast("int"))
    from_csv = F.transform(
        F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))),
        lambda line: F.struct(
            at(cells(line), "timestamp").alias("timestamp"), at(cells(line), "metric_name").alias("metric_name"),
            F.lit(None).cast("string").alias("name"), at(cells(line), "value").try_cast("double").alias("value"),
        ),
    )
    samples = F.coalesce(listed, wrapped, zipped, from_csv)
    rows = df.withColumn("_s", F.explode(samples)).select(
        *[c for c in df.columns if c != column], F.col("_s.timestamp").try_cast("timestamp").alias("timestamp"),
        F.coalesce("_s.metric_name", "_s.name").alias("metric_name"), F.col("_s.value").alias("value"),
    )
    return rows.where(F.col("timestamp").isNotNull() & F.col("metric_name").isNotNull() & F.col("value").isNotNull())


def invalid_payloads(df: DataFrame, column: str, key: str) -> DataFrame:
    """Bodies no sample can be read from."""
    return df.join(parse_metric_payload(df, column).select(key).distinct(), key, "left_anti")


RESULT_SCHEMA = "timestamp bigint, metrics map<string,struct<values:map<string,double>>>"


def read_loadtest_json(spark: SparkSession, path: str) -> DataFrame:
    """Summary documents ``k6-*.json`` (files, or folders of files): scenario (from that name), time, and statistics per metric."""
    rows = spark.read.schema(RESULT_SCHEMA).option("multiLine", True).json(f"{path}/k6-*.json")
    name = F.regexp_extract(F.col("_metadata.file_path"), r"/(k6-[^/]*\.json)", 1)
    stats = F.transform_values(
        "metrics",
        lambda _, v: F.struct(
            *[F.coalesce(v["values"][k], F.lit(0.0)).alias(n) for n, k in (
                ("avg", "avg"), ("min", "min"), ("med", "med"), ("p90", "p(90)"), ("p95", "p(95)"), ("p99", "p(99)"), ("max", "max"),
                ("rate", "rate"), ("count", "count"),
            )]
        ),
    )
    out = rows.select(scenario_of(name).alias("scenario"), F.timestamp_millis("timestamp").alias("timestamp"), stats.alias("metrics"))
    return out.where(F.col("scenario").isNotNull())


def read_loadtest_points(spark: SparkSession, path: str) -> DataFrame:
    """Point-stream files (one JSON point per line): scenario, metric, time, value."""
    schema = "type string, metric string, data struct<time:timestamp,value:double>"
    rows = spark.read.schema(schema).option("pathGlobFilter", "k6-*.json").json(path)
    rows = rows.select(scenario_of(F.col("_metadata.file_name")).alias("scenario"), "type", "metric", "data.time", "data.value")
    return rows.where((F.col("type") == "Point") & F.col("scenario").isNotNull()).drop("type")


def archive_columns(ts: Column) -> dict[str, Column]:
    """UTC partition columns from the record's own time."""
    return {
        "year": F.date_format(ts, "yyyy"), "month": F.date_format(ts, "MM"), "day": F.date_format(ts, "dd"), "hour": F.date_format(ts, "HH"),
    }


def write_archive(df: DataFrame, path: str, ts: str = "timestamp", mode: str = "append") -> None:
    """JSON files by year, month, day and hour, at most 10 000 records each. Rows meet their partition before writing."""
    rows = df.withColumns(archive_columns(F.col(ts)))
    keys = ["year", "month", "day", "hour"]
    # The rebalance hint lets large hours be split and small ones be put together.
    rows.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).options(
        maxRecordsPerFile=RECORDS_PER_FILE, timestampFormat=ISO_MICROS
    ).json(path)


def read_archive(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_daily_index(logs: DataFrame, path: str, by: Sequence[str] = ("service",), mode: str = "append") -> None:
    """Logs laid out per service (and environment) and day."""
    keys = [*by, "dt"]
    logs.withColumn("dt", F.date_format("timestamp", "yyyy.MM.dd")).hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(path)


def index_name(service: Column, ts: Column) -> Column:
    return F.concat(F.lit("logs-"), service, F.lit("-"), F.date_format(ts, "yyyy.MM.dd"))


def format_predictions(df: DataFrame, accept: str = "application/json") -> DataFrame:
    """Scored rows as one text per row: JSON with ISO times, or CSV."""
    iso = df.withColumns({f.name: F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss") for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)})
    if accept == "text/csv":
        return iso.select(F.to_csv(F.struct(*[F.col(c) for c in iso.columns])).alias("record"))
    return iso.select(F.to_json(F.struct(*[F.col(c) for c in iso.columns])).alias("record"))


def write_predictions(df: DataFrame, path: str, accept: str = "application/json", mode: str = "append") -> None:
    if accept == "text/csv":
        df.write.mode(mode).option("header", True).csv(path)
    else:
        format_predictions(df, accept).write.mode(mode).text(path)


def write_chargeback_report(report: DataFrame, path: str, period: str = "month", mode: str = "overwrite") -> None:
    """CSV reports by period; writing a period again replaces that period only."""
    report.withColumn("period", F.col(period).cast("string")).write.mode(mode).option("header", True).option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("period").csv(path)


def retention(df: DataFrame, tier: str, now: Column, ts: str = "timestamp") -> DataFrame:
    """Rows still inside the tier's period."""
    span = int(seconds(RETENTION[tier]))
    return df.where(F.col(ts) >= now - F.expr(f"INTERVAL {span} SECONDS"))


def expired_days(path_days: DataFrame, tier: str, now: Column, day: str = "day") -> DataFrame:
    """Archive days that lie wholly outside the tier's period and may be dropped."""
    span = int(seconds(RETENTION[tier]))
    return path_days.where(F.date_add(day, 1).cast("timestamp") <= now - F.expr(f"INTERVAL {span} SECONDS"))
