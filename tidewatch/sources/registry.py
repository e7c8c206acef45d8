"""Model registry: fitted models below one folder, and a table of their versions."""

from __future__ import annotations

import json
from collections.abc import Mapping

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.forest import ForestModel

REGISTRY_SCHEMA = "name string, version string, path string, kind string, saved_at timestamp, metadata string"


def _register(spark: SparkSession, root: str, name: str, version: str, path: str, kind: str, metadata: Mapping) -> None:
    row = spark.range(1).select(
        F.lit(name).alias("name"), F.lit(version).alias("version"), F.lit(path).alias("path"), F.lit(kind).alias("kind"),
        F.current_timestamp().alias("saved_at"), F.lit(json.dumps(dict(metadata))).alias("metadata"),
    )
    row.write.mode("append").parquet(f"{root}/registry")


def save_model(spark: SparkSession, model, root: str, name: str, version: str, metadata: Mapping | None = None) -> str:
    """Write a Spark ML model or an isolation forest; the registry row is written last, so it only names whole models."""
    path = f"{root}/{name}/{version}"
    if isinstance(model, ForestModel):
        rows = [
            (i, model.feature[i].tolist(), model.threshold[i].tolist(), model.left[i].tolist(), model.right[i].tolist(), model.path[i].tolist())
            for i in range(len(model.feature))
        ]
        schema = "tree int, feature array<bigint>, threshold array<double>, left array<bigint>, right array<bigint>, path array<double>"
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(path)
        details = {"columns": list(model.columns), "sample": model.sample, "depth": model.depth, "offset": model.offset}
        _register(spark, root, name, version, path, "isolation_forest", {**(metadata or {}), "forest": details})
    else:
        model.write().overwrite().save(path)
        _register(spark, root, name, version, path, "spark_ml", metadata or {})
    return path


def registry(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).parquet(f"{root}/registry")


def latest_versions(rows: DataFrame) -> DataFrame:
    """The last version of each model in text order, its newest save if it was saved more than once."""
    return rows.groupBy("name").agg(
        F.max("version").alias("version"), F.max_by("path", F.struct("version", "saved_at")).alias("path"),
        F.count_distinct("version").alias("versions"),
    )


def load_model(spark: SparkSession, root: str, name: str, version: str = "latest"):
    """The model and its metadata; a model without a registry row does not exist."""
    rows = registry(spark, root).where(F.col("name") == name)
    if version != "latest":
        rows = rows.where(F.col("version") == version)
    found = rows.orderBy(F.col("version").desc(), F.col("saved_at").desc()).limit(1).collect()
    if not found:
        raise ValueError(f"no model {name!r} with version {version!r}")
    row = found[0]
    metadata = json.loads(row["metadata"])
    if row["kind"] == "spark_ml":
        return PipelineModel.load(row["path"]), metadata
    nodes = spark.read.parquet(row["path"]).orderBy("tree").toPandas()
    arrays = {c: np.array(nodes[c].tolist()) for c in ("feature", "threshold", "left", "right", "path")}
    details = metadata.pop("forest")
    model = ForestModel(tuple(details["columns"]), details["sample"], depth=details["depth"], offset=details["offset"], **arrays)
    return model, metadata
