"""Noise points of a density clustering, exact and without comparing all points with each other.

Points fall into cells whose diagonal is ``eps``. All points of a cell that holds ``min_points`` are core points, so they
need no comparison at all. What is left are cells with fewer points; only their points are compared, and only with cells
that can reach them, found by blocks over the most spread dimensions. A cell without enough points has few of them, so one
cell that holds most of the table costs no more than a pass over it. Points that fill far more than four dimensions
thinly have many cells within reach of each other; project such points first.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialise

BLOCK_DIMENSIONS = 4


def _sum(columns) -> Column:
    return reduce(lambda a, b: a + b, columns)


def density_noise(df: DataFrame, key: str, dims: Sequence[str], eps: float = 0.5, min_points: int = 5, salt: int = 16) -> DataFrame:
    """The noise points of ``df``: neither core nor within ``eps`` (inclusive) of a core point. A point counts itself."""
    return df.join(noise_keys(df, key, dims, eps, min_points, salt), key, "left_semi")


def noise_keys(df: DataFrame, key: str, dims: Sequence[str], eps: float = 0.5, min_points: int = 5, salt: int = 16) -> DataFrame:
    """The keys of the noise points."""
    d = len(dims)
    side = eps / math.sqrt(d)
    # A whisker below the exact side keeps two points of one cell within eps in floating point too.
    side *= 1 - 1e-9
    points = df.select(F.col(key).alias("_id"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(dims)])
    cell = F.array(*[F.floor(F.col(f"_x{i}") / side) for i in range(d)])
    # The points are read once; every step below starts from the written copy.
    points = materialise(points.withColumn("_cell", cell), "density-points")
    sizes = points.groupBy("_cell").agg(F.count(F.lit(1)).alias("_size"))
    sparse_cells = sizes.where(F.col("_size") < min_points).select("_cell")

    # Cells that may hold neighbours of a sparse cell: blocks over the most spread dimensions find them by an equi-join.
    k = min(d, BLOCK_DIMENSIONS)
    reach = math.ceil(eps / side)
    spread = points.agg(*[F.approx_count_distinct(F.floor(F.col("_cell")[i] / reach)).alias(f"s{i}") for i in range(d)]).first()
    widest = sorted(range(d), key=lambda i: (-spread[f"s{i}"], i))[:k]
    block = lambda c: [F.floor(c[i] / reach) for i in widest]
    blocks = [f"_b{i}" for i in range(k)]
    around = F.array(*[F.array(*[F.lit(o) for o in offset]) for offset in itertools.product((-1, 0, 1), repeat=k)])
    near = sparse_cells.select(F.col("_cell").alias("_sparse"), F.explode(around).alias("_o"))
    near = near.select("_sparse", *[(b + F.col("_o")[i]).cast("long").alias(n) for i, (b, n) in enumerate(zip(block(F.col("_sparse")), blocks))])
    placed = sizes.select("_cell", "_size", *[b.cast("long").alias(n) for b, n in zip(block(F.col("_cell")), blocks)])
    gap = _sum(
        [F.pow(F.greatest(F.abs(F.col("_sparse")[i] - F.col("_cell")[i]) - 1, F.lit(0)).cast("double"), F.lit(2.0)) for i in range(d)]
    )
    links = near.join(placed, blocks).where(gap * side * side <= eps * eps).select("_sparse", "_cell", "_size")

    # Compare the few points of sparse cells with the points of the linked cells. A full cell may hold a third of the
    # table, so its points are dealt over ``salt`` parts and the few points are repeated once per part.
    few = points.join(sparse_cells, "_cell", "left_semi").select(
        F.col("_id").alias("_p"), F.col("_cell").alias("_sparse"), *[F.col(f"_x{i}").alias(f"_p{i}") for i in range(d)]
    )
    few = few.join(links, "_sparse").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    other = points.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salt)).cast("int"))
    distance = _sum([F.pow(F.col(f"_p{i}") - F.col(f"_x{i}"), F.lit(2.0)) for i in range(d)])
    close = few.join(other, ["_cell", "_salt"]).where(distance <= eps * eps)
    close = close.select("_p", F.col("_id").alias("_q"), (F.col("_size") >= min_points).alias("_full"))
    counted = close.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.max("_full").alias("_beside_full"))
    lonely = counted.where((F.col("_n") < min_points) & ~F.col("_beside_full")).select("_p")
    sparse_core = counted.where(F.col("_n") >= min_points).select(F.col("_p").alias("_q"))
    bordering = close.where(~F.col("_full")).join(sparse_core, "_q", "left_semi").select("_p").distinct()
    return lonely.join(bordering, "_p", "left_anti").select(F.col("_p").alias(key))
