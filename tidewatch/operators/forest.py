"""Isolation forest: trees over small uniform samples, scored where the data lies.

Fitting looks at ``trees x sample`` rows at most, whatever the table holds: a uniform pool is drawn by hash first and
every tree draws its own sample from that pool. The model is a few hundred kilobytes of node arrays.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.schema import require_rows

NODE_SCHEMA = (
    "tree int, rows int, depth int, feature array<int>, threshold array<double>, left array<int>, right array<int>, "
    "path array<double>"
)
EULER_GAMMA = 0.5772156649015329


def average_path(n):
    """Mean path length of an unsuccessful search in a binary search tree of n points."""
    n = np.asarray(n, dtype="float64")
    safe = np.maximum(n, 2.0)
    length = 2.0 * (np.log(safe - 1.0) + EULER_GAMMA) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, length, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class ForestModel:
    """Node arrays of all trees, one padded row per tree."""

    columns: tuple[str, ...]
    sample: int
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    depth: int
    offset: float = -0.5

    def raw_score(self, x: np.ndarray) -> np.ndarray:
        """Negated anomaly score in (-1, 0); lower is more anomalous."""
        at = np.arange(len(x))
        total = np.zeros(len(x))
        for tree in range(len(self.feature)):
            node = np.zeros(len(x), dtype="int64")
            for _ in range(self.depth):
                feature = self.feature[tree, node]
                inner = feature >= 0
                goes_left = x[at, np.maximum(feature, 0)] < self.threshold[tree, node]
                node = np.where(inner, np.where(goes_left, self.left[tree, node], self.right[tree, node]), node)
            total += self.path[tree, node]
        return -np.power(2.0, -(total / len(self.feature)) / float(average_path(self.sample)))


def _grow(columns: Sequence[str], seed: int, max_features: float):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf.sort_values("_pick")[list(columns)].to_numpy(dtype="float64")
        rng = np.random.default_rng([seed, tree])
        usable = np.sort(rng.permutation(x.shape[1])[: max(1, round(max_features * x.shape[1]))])
        limit = int(np.ceil(np.log2(max(len(x), 2))))
        feature, threshold, left, right, path = [], [], [], [], []
        waiting = [(np.arange(len(x)), 0, -1, False)]
        deepest = 0
        while waiting:
            rows, depth, parent, is_right = waiting.pop()
            here = len(feature)
            if parent >= 0:
                (right if is_right else left)[parent] = here
            deepest = max(deepest, depth)
            sub = x[rows]
            splittable = [f for f in usable if len(rows) > 1 and sub[:, f].min() < sub[:, f].max()]
            feature.append(-1), threshold.append(0.0), left.append(here), right.append(here)
            path.append(depth + float(average_path(len(rows))))
            if depth >= limit or not splittable:
                continue
            f = int(rng.choice(splittable))
            low, high = sub[:, f].min(), sub[:, f].max()
            cut = float(rng.uniform(low, high))
            cut = cut if cut > low else float(np.nextafter(low, high))
            feature[here], threshold[here] = f, cut
            goes_left = sub[:, f] < cut
            waiting.append((rows[~goes_left], depth + 1, here, True))
            waiting.append((rows[goes_left], depth + 1, here, False))
        return pd.DataFrame(
            [{"tree": tree, "rows": len(x), "depth": deepest, "feature": feature, "threshold": threshold,
              "left": left, "right": right, "path": path}]
        )

    return build


def fit_nodes(
    df: DataFrame, columns: Sequence[str], key: str, trees: int = 100, sample: int = 256, seed: int = 42,
    max_features: float = 1.0,
) -> DataFrame:
    """One row per tree with its node arrays. ``key`` identifies a row and drives the sampling.

    The forest's own sampling: every tree sees ``sample`` rows of a uniform pool of about ``trees * sample`` rows.
    """
    # A row is in the pool if its hash lies below the share wanted: no order over the table, about trees x sample rows.
    share = min(1.0, trees * sample / max(df.count(), 1))
    pool = df.select(key, *columns).where(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    drawn = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    drawn = drawn.withColumn("_pick", F.xxhash64(F.col(key), F.col("tree"), F.lit(seed)))
    mine = W.partitionBy("tree").orderBy("_pick", key)
    drawn = drawn.withColumn("_rank", F.row_number().over(mine)).where(F.col("_rank") <= sample).drop("_rank", key)
    return drawn.groupBy("tree").applyInPandas(_grow(columns, seed, max_features), NODE_SCHEMA)


def load_model(nodes: DataFrame, columns: Sequence[str], offset: float = -0.5) -> ForestModel:
    """Node table to arrays: bounded by trees x (2 x sample - 1) nodes."""
    rows = nodes.orderBy("tree").toPandas()
    width = max(len(f) for f in rows["feature"])

    def padded(name, fill, kind):
        out = np.full((len(rows), width), fill, dtype=kind)
        for i, values in enumerate(rows[name]):
            out[i, : len(values)] = values
        return out

    return ForestModel(
        tuple(columns), int(rows["rows"].max()), padded("feature", -1, "int64"), padded("threshold", 0.0, "float64"),
        padded("left", 0, "int64"), padded("right", 0, "int64"), padded("path", 0.0, "float64"),
        int(rows["depth"].max()), offset,
    )


def fit(
    df: DataFrame, columns: Sequence[str], key: str, trees: int = 100, sample: int = 256, contamination: float = 0.01,
    seed: int = 42, max_features: float = 1.0,
) -> ForestModel:
    """Trees plus the offset that puts ``contamination`` of the training rows below zero."""
    require_rows(df.select(key))
    model = load_model(fit_nodes(df, columns, key, trees, sample, seed, max_features), columns)
    raw = score(df.select(key, *columns), model).select(F.col("decision").alias("d"))
    cut = exact_quantiles(raw, [], "d", {"cut": contamination}).first()["cut"]
    return ForestModel(**{**model.__dict__, "offset": model.offset + cut})


def score(df: DataFrame, model: ForestModel, out: str = "decision") -> DataFrame:
    """Add the decision value (below zero = anomalous) and the label (-1 / 1); missing features count as 0."""

    @F.pandas_udf("double")
    def decide(*features: pd.Series) -> pd.Series:
        x = np.column_stack([np.nan_to_num(f.to_numpy(dtype="float64"), nan=0.0) for f in features])
        return pd.Series(model.raw_score(x) - model.offset)

    scored = df.withColumn(out, decide(*[F.col(c).cast("double") for c in model.columns]))
    return scored.withColumn("label", F.when(F.col(out) < 0, -1).otherwise(1))


def score_endpoints(features: DataFrame, models: dict[str, ForestModel], detectors: dict[str, tuple[float, list[str]]]) -> DataFrame:
    """Every detector's batch-normalised score and whether it passes its limit, one row per feature row and detector."""
    from tidewatch.operators.anomaly import normalise_score

    keys = [c for c in ("service", "endpoint", "window_start") if c in features.columns]
    out = None
    for name, model in models.items():
        rows = normalise_score(score(features, model)).select(
            *keys, F.lit(name).alias("detector"), "anomaly_score", (F.col("anomaly_score") > detectors[name][0]).alias("is_anomaly")
        )
        out = rows if out is None else out.unionByName(rows)
    return out
