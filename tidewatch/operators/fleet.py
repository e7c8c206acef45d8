"""Edge fleet: roll-out selection, phase gates, sync data and package checks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.durations import duration_seconds
from tidewatch.functions.hashing import cohort
from tidewatch.operators.ordered import in_order

PHASES = "array<struct<id:string,percentage:double,duration:string,require_approval:boolean,approved:boolean,metrics:array<string>,thresholds:map<string,double>>>"
ROLLOUT_SCHEMA = f"id string, version string, status string, target_groups array<string>, current_phase int, phases {PHASES}, package_hash string"

# Phase thresholds.
THRESHOLDS = {"error_rate": 0.01, "latency": 500.0, "cpu": 80.0, "memory": 80.0}
EVERYONE = "all"


def active_rollout(devices: DataFrame, rollouts: DataFrame) -> DataFrame:
    """Each device with the first (lowest id) roll-out in progress that targets its group or everyone.

    The choice is made per group on the small side; devices then join on their group only.
    """
    rows = rollouts.where(F.col("status") == "in-progress")
    columns = [c for c in rollouts.columns if c not in ("target_groups", "status")]
    plan = F.struct(*columns)
    per_group = rows.select(F.explode("target_groups").alias("device_group"), plan.alias("_p")).groupBy("device_group").agg(
        F.min_by("_p", "_p.id").alias("_own")
    )
    everyone = per_group.where(F.col("device_group") == EVERYONE).agg(F.first("_own").alias("o"))
    out = devices.join(per_group.where(F.col("device_group") != EVERYONE), "device_group", "left").withColumn("_any", everyone.scalar())
    better = F.when(F.col("_own").isNull() | (F.col("_any.id") < F.col("_own.id")), F.col("_any")).otherwise(F.col("_own"))
    best = F.when(F.col("_any").isNull(), F.col("_own")).otherwise(better)
    return out.withColumn("rollout", best).where(F.col("rollout").isNotNull()).drop("_own", "_any")


def eligible_devices(targeted: DataFrame, strict: bool = False) -> DataFrame:
    """Devices that should take their roll-out now: other version, valid and approved phase, cohort within percentage.

    The cohort runs from 0 to 99 and is compared with <=; ``strict`` compares with <.
    """
    index = F.col("rollout.current_phase")
    phase = F.when((index >= 0) & (index < F.size("rollout.phases")), F.col("rollout.phases")[F.greatest(index, F.lit(0))])
    rows = targeted.withColumns({"_phase": phase, "cohort": cohort(F.col("device_id"))}).where(F.col("_phase").isNotNull())
    share = F.col("_phase.percentage")
    reached = (F.col("cohort") < share) if strict else (F.col("cohort") <= share)
    approved = ~F.coalesce(F.col("_phase.require_approval"), F.lit(False)) | F.coalesce(F.col("_phase.approved"), F.lit(False))
    rows = rows.where((F.col("current_version") != F.col("rollout.version")) & approved & reached)
    return rows.withColumn("phase_id", F.col("_phase.id")).drop("_phase")


def phase_gate(phases: DataFrame, measurements: DataFrame) -> DataFrame:
    """Whether a phase (rollout_id, phase_id, start, duration, thresholds) may advance.

    Every listed metric must have been measured within the phase's duration and never have exceeded its threshold.
    Measurements are (rollout_id, metric, timestamp, value).
    """
    limits = phases.select(
        "rollout_id", "phase_id", "start", duration_seconds(F.col("duration")).alias("_len"), F.explode("thresholds").alias("metric", "_max")
    )
    rows = limits.join(measurements, ["rollout_id", "metric"], "left")
    age = (F.unix_micros("timestamp") - F.unix_micros("start")) / 1_000_000
    inside = (age >= 0) & (age <= F.col("_len"))
    per_metric = rows.groupBy("rollout_id", "phase_id", "metric").agg(
        F.count(F.when(inside, 1)).alias("_seen"), F.count(F.when(inside & (F.col("value") > F.col("_max")), 1)).alias("_over")
    )
    ok = (F.col("_seen") > 0) & (F.col("_over") == 0)
    return per_metric.groupBy("rollout_id", "phase_id").agg(
        F.bool_and(ok).alias("may_advance"), F.array_sort(F.collect_list(F.when(~ok, F.col("metric")))).alias("failing")
    )


def gate_with_check(phases: DataFrame, measurements: DataFrame, healthy: Column) -> DataFrame:
    """The phase gate with a caller's own condition on a measurement in place of the thresholds."""
    rows = phases.select("rollout_id", "phase_id").join(measurements, "rollout_id", "left")
    return rows.groupBy("rollout_id", "phase_id").agg(F.coalesce(F.bool_and(healthy), F.lit(False)).alias("may_advance"))


def rollout_status(updates: DataFrame) -> DataFrame:
    """Per roll-out: devices by their last status, last message and time. Updates: rollout_id, device_id, status, message, timestamp."""
    last = updates.groupBy("rollout_id", "device_id").agg(
        F.max_by(F.struct("status", "message"), F.struct("timestamp", "status", "message")).alias("_s"), F.max("timestamp").alias("_t")
    )
    count = lambda s: F.count(F.when(F.col("_s.status") == s, 1))
    return last.groupBy("rollout_id").agg(
        F.count(F.lit(1)).alias("devices"), count("success").alias("succeeded"), count("failed").alias("failed"),
        F.max_by("_s.message", F.struct("_t", "device_id")).alias("last_message"), F.max("_t").alias("last_time"),
    )


def merge_changes(pending: DataFrame, handled: DataFrame) -> DataFrame:
    """Changes to upload: the last write per device and key, overlaid by handler changes stored under type/key.

    ``pending``: device_id, key, data, timestamp. ``handled``: the same with data_type.
    """
    own = pending.select("device_id", "key", "data", "timestamp", F.lit(0).alias("_rank"))
    theirs = handled.select("device_id", F.concat_ws("/", "data_type", "key").alias("key"), "data", "timestamp", F.lit(1).alias("_rank"))
    last = own.unionByName(theirs).groupBy("device_id", "key").agg(
        F.max_by("data", F.struct("_rank", "timestamp", "data")).alias("data"), F.max("timestamp").alias("timestamp")
    )
    path = F.concat(F.lit("devices/"), F.col("device_id"), F.lit("/data/"), F.col("key"))
    return last.withColumn("path", path)


def incremental_updates(manifests: DataFrame, last_sync: DataFrame) -> DataFrame:
    """Manifest entries strictly newer than the device's last sync; a device that never synced takes all.

    ``manifests``: device_id, updates array<struct<key, timestamp, data_type>>.
    """
    entries = manifests.select("device_id", F.inline("updates"))
    rows = entries.join(last_sync.select("device_id", "last_sync"), "device_id", "left")
    return rows.where(F.col("last_sync").isNull() | (F.col("timestamp") > F.col("last_sync"))).drop("last_sync")


def advance_watermark(last_sync: DataFrame, taken: DataFrame) -> DataFrame:
    """New last-sync time per device after its updates were taken."""
    newest = taken.groupBy("device_id").agg(F.max("timestamp").alias("_new"))
    rows = last_sync.join(newest, "device_id", "full_outer")
    return rows.select("device_id", F.greatest("last_sync", "_new").alias("last_sync"))


def resolve_conflicts(local: DataFrame, remote: DataFrame, policy: Mapping[str, str] | str = "newest", custom: Column | None = None) -> DataFrame:
    """One value per (device_id, key). Policies: newest, local, remote (one for all or per data_type), or a column.

    A custom column sees ``local_value``, ``remote_value``, ``local_ts`` and ``remote_ts``.
    """
    keys = ["device_id", "key"]
    a = local.select(*keys, "data_type", F.col("value").alias("local_value"), F.col("timestamp").alias("local_ts"))
    b = remote.select(*keys, F.col("data_type").alias("_type"), F.col("value").alias("remote_value"), F.col("timestamp").alias("remote_ts"))
    rows = a.join(b, keys, "full_outer").withColumn("data_type", F.coalesce("data_type", "_type")).drop("_type")
    picks = {
        "newest": F.when(F.col("local_ts") >= F.col("remote_ts"), F.col("local_value")).otherwise(F.col("remote_value")),
        "local": F.col("local_value"), "remote": F.col("remote_value"),
    }
    if custom is not None:
        both = custom
    elif isinstance(policy, str):
        both = picks[policy]
    else:
        both = picks[policy.get("default", "newest")]
        for data_type, name in policy.items():
            if data_type != "default":
                both = F.when(F.col("data_type") == data_type, picks[name]).otherwise(both)
    value = F.when(F.col("remote_ts").isNull(), F.col("local_value")).when(F.col("local_ts").isNull(), F.col("remote_value")).otherwise(both)
    return rows.select(*keys, "data_type", value.alias("value"), (F.col("local_ts").isNotNull() & F.col("remote_ts").isNotNull()).alias("conflict"))


def read_through(wanted: DataFrame, pending: DataFrame, store: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    """The value of each key from pending changes, else the store, else the file cache, and where it came from."""
    rows = wanted.select(key)
    for name, source in (("pending", pending), ("store", store), ("cache", cache)):
        rows = rows.join(source.select(key, F.col("value").alias(f"_{name}")), key, "left")
    origin = F.when(F.col("_pending").isNotNull(), "pending").when(F.col("_store").isNotNull(), "store").when(F.col("_cache").isNotNull(), "cache")
    return rows.select(key, F.coalesce("_pending", "_store", "_cache").alias("value"), origin.alias("origin"))


def sync_status(devices: DataFrame, pending: DataFrame, syncs: DataFrame) -> DataFrame:
    """Last sync, online flag and number of pending keys per device."""
    waiting = pending.groupBy("device_id").agg(F.count_distinct("key").alias("pending_changes"))
    last = syncs.groupBy("device_id").agg(F.max("timestamp").alias("last_sync"), F.max_by("online", "timestamp").alias("online"))
    rows = devices.select("device_id").join(last, "device_id", "left").join(waiting, "device_id", "left")
    return rows.select("device_id", "last_sync", F.coalesce("online", F.lit(False)).alias("online"), F.coalesce("pending_changes", F.lit(0)).alias("pending_changes"))


def write_packages(lines: DataFrame, path: str, order: str, lines_per_file: int = 4000) -> None:
    """Text files of ``line`` per ``package`` in an order; a package is as many bounded files as it takes, by ranges of the order."""
    spread = lines.repartitionByRange("package", order).sortWithinPartitions("package", order)
    spread.select("package", "line").write.partitionBy("package").option("maxRecordsPerFile", lines_per_file).text(path)


def read_packages(spark: SparkSession, path: str, chunk: int = 8192) -> DataFrame:
    """Package files below a folder, in chunks: package (file name, or the folder's partition value), the place of the
    chunk in its package (part and counter of the file's name, its path, number within the file), content as bytes."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.coalesce(F.nullif(F.regexp_extract("path", r"/package=([^/]+)/[^/]+$", 1), F.lit("")), F.regexp_extract("path", r"([^/]+)$", 1))
    number = lambda pattern: F.regexp_extract("path", pattern, 1).try_cast("int")
    file = [number(r"/part-(\d+)-[^/]*$").alias("part"), number(r"\.c(\d+)[^/]*$").alias("counter"), F.col("path")]
    starts = F.sequence(F.lit(0), F.floor(F.greatest(F.length("content") - 1, F.lit(0)) / chunk).cast("int"))
    rows = rows.select(name.alias("package"), F.struct(*file).alias("file"), "content", F.explode(starts).alias("number"))
    return rows.select("package", F.struct("file", "number").alias("place"), F.substring("content", F.col("number") * chunk + 1, F.lit(chunk)).alias("content"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    package, digest, done = None, None, []
    for batch in batches:
        for name, content in zip(batch.column("package").to_pylist(), batch.column("content")):
            if digest is None or name != package:
                if digest is not None:
                    done.append((package, digest.hexdigest()))
                package, digest = name, hashlib.sha256()
            digest.update(content.as_buffer() or b"")
    if digest is not None:
        done.append((package, digest.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([d for _, d in done], pa.string())], names=["package", "hash"])


def package_hashes(parts: DataFrame, order: str) -> DataFrame:
    """SHA-256 of each ``package``'s ``content`` in an order of its parts. A digest is sequential by nature: a package's
    parts stream through one task, which holds the digest's state and one batch, never the package."""
    return in_order(parts.select("package", order, "content"), ["package"], [order]).mapInArrow(_digests, "package string, hash string")


def verify_packages(packages: DataFrame, content: str = "content", expected: str = "package_hash") -> DataFrame:
    """SHA-256 of the content against the expected hex text."""
    return verify_hashes(packages.withColumn("actual_hash", F.sha2(F.col(content), 256)), expected)


def verify_hashes(packages: DataFrame, expected: str = "package_hash") -> DataFrame:
    """``actual_hash`` against the expected hex text."""
    return packages.withColumn("accepted", F.lower(expected) == F.col("actual_hash"))


def last_good_version(deployments: DataFrame, by: str = "environment") -> DataFrame:
    """The second newest succeeded deployment per environment; fewer than two means nothing to go back to."""
    order = W.partitionBy(by).orderBy(F.col("timestamp").desc(), F.col("version").desc())
    good = deployments.where(F.col("result") == "succeeded").withColumn("_place", F.row_number().over(order))
    return good.where(F.col("_place") <= 2).where(F.col("_place") == 2).drop("_place")
