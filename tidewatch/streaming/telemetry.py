"""Telemetry streams in, archive, upserts, predictions and recorded signals out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewatch.functions.durations import micros, step_start
from tidewatch.operators import rules as R
from tidewatch.schema import LOG_RECORD, SERVICE_METRIC, SPAN
from tidewatch.sources.files import ISO_MICROS, RECORDS_PER_FILE, archive_columns

WATERMARK = "10 minutes"
SCORING_INTERVAL = "60 seconds"
ROLL_INTERVAL = "5 minutes"

# Topic and record type per kind of telemetry.
TOPICS = {
    "metrics": ("telemetry-metrics", SERVICE_METRIC),
    "traces": ("telemetry-traces", SPAN),
    "logs": ("telemetry-logs", LOG_RECORD),
}
CORRUPT = "_corrupt_record"


def _has_kafka(spark: SparkSession) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider", False,
            spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader(),
        )
        return True
    except Exception:
        return False


def parse_records(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON text to typed columns; a line that does not parse keeps its text in ``_corrupt_record``."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return lines.select(F.from_json(F.col(column).cast("string"), full, options).alias("r")).select("r.*")


def telemetry_stream(
    spark: SparkSession, kind: str, servers: str | None = None, folder: str | None = None,
    schema: T.StructType | None = None, max_offsets: int = 1_000_000, max_files: int = 1000,
) -> DataFrame:
    """One telemetry topic as a typed stream, from a broker or from a folder of JSON lines; same code path behind it."""
    topic, default = TOPICS[kind]
    if servers:
        if not _has_kafka(spark):
            raise RuntimeError("the Kafka source package is not on the class path")
        lines = spark.readStream.format("kafka").options(
            **{"kafka.bootstrap.servers": servers, "subscribe": topic, "maxOffsetsPerTrigger": max_offsets, "startingOffsets": "earliest"}
        ).load()
    elif folder:
        lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(folder)
    else:
        raise ValueError("name either the servers or a folder")
    return parse_records(lines, schema or default)


def good_and_bad(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    return records.where(F.col(CORRUPT).isNull()).drop(CORRUPT), records.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def archive_stream(records: DataFrame, path: str, checkpoint: str, ts: str = "timestamp") -> DataStreamWriter:
    """JSON files by the record's own hour, at most 10 000 records each, a new round every five minutes."""
    rows = records.withColumns(archive_columns(F.col(ts)))
    return rows.writeStream.format("json").options(
        path=path, checkpointLocation=checkpoint, maxRecordsPerFile=RECORDS_PER_FILE, timestampFormat=ISO_MICROS
    ).partitionBy("year", "month", "day", "hour").trigger(processingTime=ROLL_INTERVAL)


def rolling_archive(path: str, hours_path: str, delay: str = WATERMARK, ts: str = "timestamp") -> Callable[[DataFrame, int], None]:
    """A batch writer for the archive that also keeps book of its hours, so that readers know which are whole.

    Files lie by the record's hour, then by batch, and roll at 10 000 records; the trigger rolls them by time. Beside them
    each batch writes one row per hour it touched (``records``, and ``late``: those whose hour was closed when they came)
    and its ``mark``, the newest time of all batches so far less ``delay``: every hour that ends at the mark or before is
    closed. A late record still goes to its own hour, which counts it. Records without a time are kept in the archive's
    default folder and belong to no hour. A repeated batch replaces its own files and rows; nothing is read but the mark of
    the batch before.
    """
    behind = F.expr(f"INTERVAL {delay}")
    keys = ["year", "month", "day", "hour"]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = None
        if batch_id > 0:
            before = spark.read.schema("mark timestamp").parquet(f"{hours_path}/marks/batch={batch_id - 1}").first()["mark"]
        rows = batch.persist()
        placed = rows.withColumns({**archive_columns(F.col(ts)), "batch": F.lit(batch_id)})
        placed.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys, "batch").options(
            maxRecordsPerFile=RECORDS_PER_FILE, timestampFormat=ISO_MICROS, partitionOverwriteMode="dynamic"
        ).json(path)
        start = F.date_trunc("hour", ts)
        closed = F.coalesce(start + F.expr("INTERVAL 1 HOUR") <= F.lit(before).cast("timestamp"), F.lit(False))
        book = rows.where(F.col(ts).isNotNull()).groupBy(start.alias("start"))
        book = book.agg(F.count(F.lit(1)).alias("records"), F.count_if(closed).alias("late"))
        book.write.mode("overwrite").parquet(f"{hours_path}/hours/batch={batch_id}")
        mark = rows.agg(F.greatest(F.max(ts) - behind, F.lit(before).cast("timestamp")).alias("mark"))
        mark.write.mode("overwrite").parquet(f"{hours_path}/marks/batch={batch_id}")
        rows.unpersist()

    return run


def archive_hours(spark: SparkSession, hours_path: str) -> DataFrame:
    """Per hour of a rolling archive: its ``records``, how many came ``late``, and whether it is ``complete``.

    A record may still come after that; its hour then counts one more late record.
    """
    hours = spark.read.schema("start timestamp, records long, late long").parquet(f"{hours_path}/hours")
    marks = spark.read.schema("mark timestamp").parquet(f"{hours_path}/marks").agg(F.max("mark").alias("mark"))
    total = hours.groupBy("start").agg(F.sum("records").alias("records"), F.sum("late").alias("late"))
    mark = marks.first()["mark"]
    complete = F.coalesce(F.col("start") + F.expr("INTERVAL 1 HOUR") <= F.lit(mark).cast("timestamp"), F.lit(False))
    return total.withColumn("complete", complete)


def rolling_archive_stream(records: DataFrame, path: str, hours_path: str, checkpoint: str, delay: str = WATERMARK, ts: str = "timestamp") -> DataStreamWriter:
    """The archive as a stream with its book of hours, a new round every five minutes."""
    write = rolling_archive(path, hours_path, delay, ts)
    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime=ROLL_INTERVAL)


# --- upserts: every batch adds its newest row per key under its own number; readers take the newest of all ---------


def upsert_batch(path: str, bad_path: str, key: str, ts: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that may run twice for one batch: it replaces its own folder. Malformed rows go aside, none is lost."""

    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = good_and_bad(batch) if CORRUPT in batch.columns else (batch, None)
        rest = [c for c in good.columns if c != key]
        # Maps have no order; their JSON text does, so of equal times one row wins on every run.
        tie = [F.to_json(c) if isinstance(good.schema[c].dataType, T.MapType) else F.col(c) for c in rest if c != ts]
        newest = good.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(ts, *tie)).alias("_r"))
        newest.select(key, "_r.*").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if bad is not None:
            bad.write.mode("overwrite").json(f"{bad_path}/batch={batch_id}")

    return write


def upsert_stream(records: DataFrame, path: str, bad_path: str, checkpoint: str, key: str, ts: str = "timestamp") -> DataStreamWriter:
    return records.writeStream.foreachBatch(upsert_batch(path, bad_path, key, ts)).option("checkpointLocation", checkpoint)


def current_rows(spark: SparkSession, path: str, key: str, ts: str = "timestamp") -> DataFrame:
    """The newest row per key over all batches."""
    rows = spark.read.option("basePath", path).parquet(path)
    rest = [c for c in rows.columns if c not in (key, "batch")]
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(ts, "batch")).alias("_r"))
    return newest.select(key, "_r.*")


def compact(spark: SparkSession, path: str, target: str, key: str, ts: str = "timestamp") -> DataFrame:
    """Write the current rows as batch 0 of a new folder; readers move over, the old folder can then go."""
    current_rows(spark, path, key, ts).write.mode("overwrite").parquet(f"{target}/batch=0")
    return current_rows(spark, target, key, ts)


def update_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A batch writer for update mode: only the rows that changed, under the batch's number; a repeated batch replaces its own."""
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def latest_rows(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Each key's row from the newest batch that changed it."""
    rows = spark.read.option("basePath", path).parquet(path)
    rest = [c for c in rows.columns if c not in (key, "batch")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(key, "_r.*")


def periodic_scoring(scored: DataFrame, path: str, checkpoint: str, every: str = SCORING_INTERVAL) -> DataStreamWriter:
    """Write the predictions of a scored stream (as from ``ordered.history_stream``) in every interval, each once."""
    return scored.writeStream.format("json").options(path=path, checkpointLocation=checkpoint, timestampFormat=ISO_MICROS).trigger(processingTime=every)


def split_late(on_time: Callable[[DataFrame, int], None], side_path: str, marks_path: str, delay: str = WATERMARK, ts: str = "timestamp") -> Callable[[DataFrame, int], None]:
    """A batch writer that hands ``on_time`` the rows the watermark has not passed and puts the others in a side table.

    The watermark of a batch is the newest time of all batches before it less ``delay``; it is kept beside the side
    table, a row per batch, and a batch reads only the one before. Rows without a time go to the side table. A repeated
    batch replaces what it wrote, so every row of the stream is in one of the two, once.
    """
    behind = F.expr(f"INTERVAL {delay}")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = None
        if batch_id > 0:
            mark = spark.read.schema("mark timestamp").parquet(f"{marks_path}/batch={batch_id - 1}").first()["mark"]
        rows = batch.persist()
        passed = F.coalesce(F.col(ts) < F.lit(mark) - behind, F.col(ts).isNull()) if mark is not None else F.col(ts).isNull()
        on_time(rows.where(~passed), batch_id)
        rows.where(passed).write.mode("overwrite").parquet(f"{side_path}/batch={batch_id}")
        newest = rows.agg(F.greatest(F.max(ts), F.lit(mark).cast("timestamp")).alias("mark"))
        newest.write.mode("overwrite").parquet(f"{marks_path}/batch={batch_id}")
        rows.unpersist()

    return run


def touched_stretches(rows: DataFrame, part: str, size: int, reach: int) -> list[tuple[int, int]]:
    """First and last of each run of stretches whose results the rows can change, ``reach`` microseconds ahead: one row
    per stretch that holds rows comes to the driver."""
    starts = sorted(r[part] for r in rows.select(part).distinct().collect() if r[part] is not None)
    runs: list[tuple[int, int]] = []
    for start in starts:
        end = start + -(-reach // size) * size
        if runs and start <= runs[-1][1] + size:
            runs[-1] = (runs[-1][0], max(runs[-1][1], end))
        else:
            runs.append((start, end))
    return runs


def _within(column: str, runs: Sequence[tuple[int, int]], before: int = 0) -> Column:
    hit = F.lit(False)
    for first, last in runs:
        hit |= F.col(column).between(first - before, last)
    return hit


def recording_batch(samples_path: str, out_path: str, window: str, step: str, part: str = "1h") -> Callable[[DataFrame, int], None]:
    """Keep the recorded signals up to date: store the batch, then evaluate again the times its samples can change.

    Samples and results are laid out by stretches of time (``part``). A batch evaluates the stretches its samples reach,
    and reads those and a window before them: a late sample costs its own window, not all the time since.
    """
    size = micros(part)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("timestamp", "name", "labels", "value").withColumn("_part", step_start(F.col("timestamp"), size))
        path = f"{samples_path}/batch={batch_id}"
        rows.write.mode("overwrite").partitionBy("_part").parquet(path)
        runs = touched_stretches(rows, "_part", size, micros(window) + micros(step))
        if not runs:
            return
        stored = spark.read.option("basePath", samples_path).parquet(samples_path)
        near = stored.where(_within("_part", runs, micros(window) + size))
        result = R.recording_rules(R.Signals(near.drop("_part", "batch"), step), window)
        result = result.withColumn("_part", step_start(F.col("eval_ts"), size)).where(_within("_part", runs))
        result.hint("rebalance", "_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(out_path)

    return run


def windowed_counts(records: DataFrame, by: Sequence[str], width: str, slide: str | None = None, ts: str = "timestamp", watermark: str = WATERMARK) -> DataFrame:
    """Tumbling or sliding counts and sums; rows later than the watermark are not counted."""
    span = F.window(ts, width, slide) if slide else F.window(ts, width)
    return records.withWatermark(ts, watermark).groupBy(span, *by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def session_counts(records: DataFrame, by: Sequence[str], gap: str = "30 minutes", ts: str = "timestamp", watermark: str = WATERMARK) -> DataFrame:
    return records.withWatermark(ts, watermark).groupBy(F.session_window(ts, gap), *by).agg(F.count(F.lit(1)).alias("n"))


def run_to_end(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything there is, then stop: for back-fills and tests."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
