"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = 8, app: str = "tidewatch") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .getOrCreate()
    )


_LOCAL_SCRATCH: dict[str, str] = {}
_SHIPPED: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own, which goes when the program ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="tidewatch-scratch-")
        atexit.register(shutil.rmtree, _LOCAL_SCRATCH[app], ignore_errors=True)
    return _LOCAL_SCRATCH[app]


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark).rstrip('/')}/tidewatch-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below this application's folder in the scratch root."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application wrote to the scratch root; call it once all results have been read."""
    _delete(spark, _own_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Where the tables that ``materialise`` returned lie, and the lists that record new ones.
_WRITTEN: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_RECORDERS: list[list[str]] = []
_FILES: list[int] = []


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once and read back: cuts lineage with files that survive a lost executor."""
    path = scratch_path(df.sparkSession, name)
    (df.coalesce(_FILES[-1]) if _FILES else df).write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    for paths in _RECORDERS:
        paths.append(path)
    return out


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over all cores: a small file is one partition, however much work each of its rows is."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


@contextmanager
def few_files(spark: SparkSession, per_core: int = 4) -> Iterator[int]:
    """Inside the block ``materialise`` writes at most so many files per core: a chain of small tables over hundreds of
    partitions is otherwise mostly the making of files, each with its folder, permissions and commit."""
    _FILES.append(max(1, per_core * spark.sparkContext.defaultParallelism))
    try:
        yield _FILES[-1]
    finally:
        _FILES.pop()


@contextmanager
def recorded_scratch() -> Iterator[list[str]]:
    """The paths ``materialise`` writes to inside the block."""
    paths: list[str] = []
    _RECORDERS.append(paths)
    try:
        yield paths
    finally:
        _RECORDERS.remove(paths)


def discard(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Delete written tables (or paths of such) that nothing will read again."""
    for table in tables:
        path = table if isinstance(table, str) else _WRITTEN.pop(table, None)
        if path and path.startswith(_own_folder(spark)):
            _delete(spark, path)


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Needless where they have it already: from ``--py-files``, from an installed package or from ``PYTHONPATH``.
    """
    app, package = spark.sparkContext.applicationId, os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if app in _SHIPPED or root in known or not os.path.isdir(package) or os.path.basename(root) in ("site-packages", "dist-packages"):
        return
    _SHIPPED.add(app)
    if spark.sparkContext.master.startswith("local["):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
        return
    # Executors fetch the archive from the driver, also later ones: it stays as long as the program runs.
    folder = tempfile.mkdtemp(prefix="tidewatch-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "tidewatch-package"), "zip", root, "tidewatch"))
