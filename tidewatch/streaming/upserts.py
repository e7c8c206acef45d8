"""A table of the newest row per key, written by a stream and read while it is written.

Rows lie in buckets of their key's hash. A batch adds one file set to each bucket it touches; a bucket with more than
``most_files`` sets is merged into one, the others are left alone. Which sets make up the table is told by a manifest, a
row per bucket; a batch writes a new one and publishes it by renaming its folder, so a reader sees the table before or
after a batch and never has to move. A batch that has been published is passed over when it is run again; one that broke
off before is written anew. Sets a manifest no longer names can be deleted once no reader uses it (``vacuum``).

The rename must be atomic, as it is on HDFS and local disks; the writer is one stream.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

MANIFEST = "bucket int, sets array<string>"


class UpsertTable:
    def __init__(self, spark: SparkSession, path: str, key: str, ts: str = "timestamp", buckets: int = 64, most_files: int = 8):
        self.spark, self.path, self.key, self.ts = spark, path.rstrip("/"), key, ts
        self.buckets, self.most_files = buckets, most_files

    # --- manifests ---

    def _fs(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder, fs = self._fs(f"{self.path}/manifest")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n.removeprefix("v")) for n in names if n.startswith("v") and n[1:].isdigit())

    def _sets(self, version: int | None) -> dict[int, list[str]]:
        """At most a row per bucket."""
        if version is None:
            return {}
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/v{version}").collect()
        return {r["bucket"]: list(r["sets"]) for r in rows}

    def _publish(self, version: int, sets: dict[int, list[str]]) -> None:
        made = f"{self.path}/manifest/_making"
        self.spark.createDataFrame(list(sets.items()), MANIFEST).coalesce(1).write.mode("overwrite").parquet(made)
        source, fs = self._fs(made)
        target, _ = self._fs(f"{self.path}/manifest/v{version}")
        if not fs.rename(source, target):
            raise RuntimeError(f"could not publish {target}")

    # --- rows ---

    def _newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in (self.key, "_bucket")]
        # Maps have no order; their JSON text does, so of equal times one row wins on every run.
        tie = [F.to_json(c) if isinstance(rows.schema[c].dataType, T.MapType) else F.col(c) for c in rest if c != self.ts]
        return rows.groupBy("_bucket", self.key).agg(F.max_by(F.struct(*rest), F.struct(self.ts, *tie)).alias("_r")).select("_bucket", self.key, "_r.*")

    def _read(self, sets: dict[int, list[str]], schema: T.StructType) -> DataFrame:
        """The rows of these buckets; a set is the folder of one bucket in one write."""
        writes: dict[str, list[int]] = {}
        for bucket, names in sets.items():
            for name in names:
                writes.setdefault(name, []).append(bucket)
        parts = [
            self.spark.read.schema(schema).option("basePath", f"{self.path}/data/{name}").parquet(*[f"{self.path}/data/{name}/_bucket={b}" for b in buckets])
            for name, buckets in sorted(writes.items())
        ]
        return reduce(DataFrame.unionByName, parts)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Add a batch: of each key the newest row stays; rows of one key and time are ordered by their other columns."""
        known = self.versions()
        if batch_id in known:
            return
        sets = self._sets(max((v for v in known if v < batch_id), default=None))
        rows = batch.withColumn("_bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))
        name = f"b{batch_id}"
        self._newest(rows).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/data/{name}")
        folder, fs = self._fs(f"{self.path}/data/{name}")
        touched = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(folder) if "=" in s.getPath().getName()]
        for bucket in touched:
            sets.setdefault(bucket, []).append(name)
        full = {b: s for b, s in sets.items() if len(s) > self.most_files}
        if full:
            merged = self._newest(self._read(full, rows.schema))
            merged.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/data/m{batch_id}")
            sets |= {b: [f"m{batch_id}"] for b in full}
        if sets:
            self._write_schema(rows.schema)
            self._publish(batch_id, sets)

    def _write_schema(self, schema: T.StructType) -> None:
        self.spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/schema")

    def read(self, version: int | None = None) -> DataFrame:
        """The newest row of every key, now or as of a version."""
        schema = self.spark.read.parquet(f"{self.path}/schema").schema
        known = self.versions()
        sets = self._sets(version if version is not None else known[-1])
        return self._newest(self._read(sets, schema)).drop("_bucket")

    def stream(self, rows: DataFrame, checkpoint: str) -> DataStreamWriter:
        return rows.writeStream.foreachBatch(self.write).option("checkpointLocation", checkpoint)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete what only versions older than the newest ``keep`` name; the names of the deleted writes."""
        known = self.versions()
        used = {s for v in known[-keep:] for names in self._sets(v).values() for s in names}
        folder, fs = self._fs(f"{self.path}/data")
        # Writes behind the newest version are not published yet.
        old = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in used and int(s.getPath().getName()[1:]) <= known[-1]]
        for v in known[:-keep]:
            fs.delete(self._fs(f"{self.path}/manifest/v{v}")[0], True)
        for path in old:
            fs.delete(path, True)
        return sorted(p.getName() for p in old)
