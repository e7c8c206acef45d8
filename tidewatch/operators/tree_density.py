"""Noise points of a density clustering over vectors of many dimensions, exact, by a tree of boxes.

``density.py`` lays a grid, which serves up to about four dimensions. Here the points are cut along the dimension in which
they spread most, again and again, until a leaf holds at most ``leaf`` different vectors. Every leaf counts the neighbours
among its own points; a point that finds ``min_points`` there is a core point and needs nothing more, so crowds are settled
inside their leaves. Only the others visit: the thin points of a tile (a node of some thousand points) meet the points of
each tile whose box is within ``eps`` of theirs, leaf by leaf, each leaf with those visitors its own box does not exclude
and that are not known as core points yet. Equal vectors are one point with a weight.

No group grows with the data: a leaf and a tile are bounded, and the tree is a table of boxes, one level a round, joined
by its node. On vectors that point evenly in all directions boxes exclude little and a thin point meets most leaves; that
is as many comparisons as all pairs, dealt evenly over the tasks. Tiles are written once, each as one packed row, and tasks
read them in pairs: nothing is shuffled or written per meeting, so the disk in use grows with the points.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import discard, materialise, ship, spread

#: Children of a node: the points are cut at so many less one quantiles, and in the middle of their range.
FAN = 8
#: Points of a tile, at most, unless a leaf is larger; of many points, tiles are up to so many bytes of components.
TILE = 8192
TILE_BYTES = 1 << 24
#: Visitors compared with a leaf at a time.
BLOCK = 1024
FOUND = "pid long, n long, near array<long>"
_SCHEMA = pa.schema([("pid", pa.int64()), ("n", pa.int64()), ("near", pa.list_(pa.int64()))])
_PACKED = pa.schema([("tile", pa.string()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())), ("rows", pa.binary())])
PACKED = "tile string, lo array<double>, hi array<double>, rows binary"


def vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Key and vector of the rows whose vector is whole: not null, not empty, no null, NaN or infinite component."""
    x = F.col(vector).cast("array<double>")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    return df.select(F.col(key).alias("_key"), x.alias("_x")).where((F.size("_x") > 0) & whole)


def _boxes(points: DataFrame, dims: int) -> DataFrame:
    """Number of points and the box around them, per node."""
    lows = [F.min(F.col("x")[i]).alias(f"l{i}") for i in range(dims)]
    highs = [F.max(F.col("x")[i]).alias(f"h{i}") for i in range(dims)]
    found = points.groupBy("node").agg(F.count(F.lit(1)).alias("size"), *lows, *highs)
    return found.select(
        "node", "size", F.array(*[f"l{i}" for i in range(dims)]).alias("lo"), F.array(*[f"h{i}" for i in range(dims)]).alias("hi")
    )


def _cuts(points: DataFrame, boxes: DataFrame, leaf: int) -> DataFrame:
    """Where the nodes above ``leaf`` points are cut: the widest dimension, at quantiles and in the middle.

    The middle parts the lowest from the highest value whatever the quantiles are, so every cut gets further.
    """
    widths = F.zip_with("hi", "lo", lambda h, l: h - l)
    wide = boxes.where(F.col("size") > leaf).select("node", F.array_position(widths, F.array_max(widths)).cast("int").alias("dim"), "lo", "hi")
    low, high = F.element_at("lo", F.col("dim")), F.element_at("hi", F.col("dim"))
    middle = low + (high - low) / 2
    wide = wide.select("node", "dim", F.when(middle < high, middle).otherwise(low).alias("middle"))
    shares = [F.lit((i + 1) / (FAN - 1)) for i in range(FAN - 2)]
    at = points.join(wide, "node").groupBy("node").agg(
        F.any_value("dim").alias("dim"), F.any_value("middle").alias("middle"),
        F.percentile_approx(F.element_at("x", F.col("dim")), F.array(*shares), 1000).alias("at"),
    )
    return at.select("node", "dim", F.array_distinct(F.concat("at", F.array("middle"))).alias("at"))


def tree(points: DataFrame, dims: int, leaf: int) -> tuple[DataFrame, list[DataFrame]]:
    """The points with their leaf (``node``), and per level the boxes of its nodes with their parents."""
    level = materialise(points.withColumn("node", F.lit("0")), "tree-points")
    placed, levels, written = [], [], [level]
    while True:
        boxes = _boxes(level, dims).withColumns({"parent": F.regexp_replace("node", r"\.?\d+$", ""), "is_leaf": F.col("size") <= leaf})
        boxes = materialise(boxes, "tree-boxes")
        levels.append(boxes)
        leaves = boxes.where("is_leaf").select("node")
        placed.append(level.join(leaves, "node", "left_semi").select(*level.columns))
        if boxes.where("NOT is_leaf").isEmpty():
            break
        cuts = materialise(_cuts(level, boxes, leaf), "tree-cuts")
        child = F.size(F.filter("at", lambda c: F.element_at("x", F.col("dim")) > c))
        below = level.join(cuts, "node").withColumn("node", F.concat_ws(".", "node", child.cast("string")))
        level = materialise(below.select(*level.columns), "tree-points")
        written.append(level)
    out = materialise(reduce(DataFrame.unionByName, placed), "tree-leaves")
    discard(points.sparkSession, *written)
    return out, levels


def _tiles(levels: list[DataFrame], most: int) -> DataFrame:
    """Each leaf (``node``) with its tile: the highest node on its path of at most ``most`` points."""
    own = F.when(F.col("size") <= most, F.col("node"))
    above = levels[0].select("node", "is_leaf", own.alias("tile"))
    leaves = [above.where("is_leaf")]
    for boxes in levels[1:]:
        up = above.where("NOT is_leaf").select(F.col("node").alias("parent"), F.col("tile").alias("above"))
        above = materialise(boxes.join(up, "parent").select("node", "is_leaf", F.coalesce("above", own).alias("tile")), "tree-tiles")
        leaves.append(above.where("is_leaf"))
    return reduce(DataFrame.unionByName, leaves).select("node", "tile")


def _gap(dims: int) -> Column:
    """Squared distance of two boxes, term by term: compiled, where functions over arrays are not."""
    outside = [F.greatest(F.col("lo")[i] - F.col("to")[i], F.col("from")[i] - F.col("hi")[i], F.lit(0.0)) for i in range(dims)]
    return reduce(lambda total, d: total + d, [d * d for d in outside])


def _reach(eps: float) -> float:
    """The square of ``eps`` and a whisker: boxes only exclude, distances decide."""
    return eps * eps * (1 + 1e-9)


def _arrived(at: DataFrame, keep: list[str], levels: list[DataFrame], dims: int, eps: float, end: Column) -> DataFrame:
    """Boxes (``from``, ``to``) with every node they can reach, level by level down to the nodes that ``end`` marks."""
    at, arrived = at.withColumn("parent", F.lit("")), []
    for boxes in levels:
        below = at.join(boxes.select("parent", "node", "lo", "hi", end.alias("_end")), "parent").where(_gap(dims) <= _reach(eps))
        below = materialise(below.select(*keep, "from", "to", "node", "_end"), "tree-visits")
        arrived.append(below.where("_end").select(*keep, "node"))
        at = below.where("NOT _end").select(*keep, "from", "to", F.col("node").alias("parent"))
    return reduce(DataFrame.unionByName, arrived)


def visits(points: DataFrame, levels: list[DataFrame], dims: int, eps: float) -> DataFrame:
    """Each point (``pid``, ``x``, ``node``: its own leaf) with every other leaf whose box it can reach, as ``leaf``."""
    at = points.select("pid", F.col("node").alias("home"), F.col("x").alias("from"), F.col("x").alias("to"), "x")
    came = _arrived(at, ["pid", "x", "home"], levels, dims, eps, F.col("is_leaf"))
    return came.where("node != home").select("pid", "x", F.col("node").alias("leaf"))


def meetings(thin: DataFrame, levels: list[DataFrame], dims: int, eps: float, most: int) -> DataFrame:
    """Each ``tile`` of visitors (as ``visitor``) with every tile of at most ``most`` points that their box can reach."""
    boxes = _boxes(thin.select(F.col("tile").alias("node"), "x"), dims)
    at = boxes.select(F.col("node").alias("visitor"), F.col("lo").alias("from"), F.col("hi").alias("to"))
    return _arrived(at, ["visitor"], levels, dims, eps, F.col("size") <= most).withColumnRenamed("node", "tile")


def _matrix(table: pa.Table) -> np.ndarray:
    x = table.column("x").combine_chunks()
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _close(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` are within ``eps``. Products decide but for a whisker around ``eps``, where differences do."""
    middle = b.mean(axis=0)
    a0, b0 = a - middle, b - middle
    aa, bb = (a0 * a0).sum(axis=1), (b0 * b0).sum(axis=1)
    squares = aa[:, None] + bb[None, :] - 2 * (a0 @ b0.T)
    slack = 1e-12 * a.shape[1] * (aa[:, None] + bb[None, :] + eps * eps)
    near = squares <= eps * eps
    i, j = np.nonzero(np.abs(squares - eps * eps) <= slack)
    for s in range(0, len(i), 4096):
        p, q = i[s : s + 4096], j[s : s + 4096]
        near[p, q] = ((a[p] - b[q]) ** 2).sum(axis=1) <= eps * eps
    return near


def _found(visitors: pa.Table, owners: pa.Table, eps: float, min_points: int) -> pa.Table:
    """Weight of each visitor's neighbours among the owners, and who they are as long as they are too few for a core."""
    if not visitors.num_rows or not owners.num_rows:
        return _SCHEMA.empty_table()
    near = _close(_matrix(visitors), _matrix(owners), eps)
    weights, ids = owners.column("w").to_numpy(), owners.column("pid").to_numpy()
    n = near @ weights
    some = np.nonzero(n > 0)[0]
    who = [ids[near[i]] if n[i] < min_points else [] for i in some]
    pids = visitors.column("pid").to_numpy()[some]
    return pa.Table.from_arrays([pa.array(pids), pa.array(n[some].astype("int64")), pa.array(who, pa.list_(pa.int64()))], schema=_SCHEMA)


def _pack(table: pa.Table) -> pa.Table:
    """A tile's points as one row, leaf after leaf, with the box around them."""
    x, sink = _matrix(table), pa.BufferOutputStream()
    rows = table.drop_columns(["tile"]).sort_by("node").combine_chunks()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    box = [pa.array([ends.tolist()], pa.list_(pa.float64())) for ends in (x.min(axis=0), x.max(axis=0))]
    return pa.Table.from_arrays([table.column("tile").slice(0, 1), *box, pa.array([sink.getvalue().to_pybytes()], pa.binary())], schema=_PACKED)


def packed(points: DataFrame, *columns: str) -> DataFrame:
    """One row per ``tile``, dealt over all cores: its box and its points with ``columns``."""
    tiles = points.select("tile", *columns).groupBy("tile").applyInArrow(_pack, PACKED)
    return materialise(spread(tiles), "tree-packed")


def _unpacked(rows: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(rows.as_buffer()).read_all()


class _Visitors:
    """The thin points of one tile, and what they have found in the tiles met so far."""

    def __init__(self, tile: str, rows: pa.Scalar, min_points: int):
        table = _unpacked(rows)
        self.tile, self.least = tile, min_points
        self.pid, self.home, self.x = table.column("pid").to_numpy(), table.column("node"), _matrix(table)
        self.own = table.column("n").to_numpy()
        self.n = np.zeros(len(self.pid), "int64")
        self.near: dict[int, list[int]] = {}

    def meet(self, tile: str, rows: pa.Scalar, eps: float) -> None:
        """The points of a tile, leaf by leaf, each with those visitors of other leaves that its box does not exclude.

        A visitor known as core needs nothing more: it leaves, and who its neighbours are does not matter.
        """
        at = np.nonzero(self.own + self.n < self.least)[0]
        if not len(at):
            return
        owners, x = _unpacked(rows), self.x[at]
        box, weights, ids, nodes = _matrix(owners), owners.column("w").to_numpy(), owners.column("pid").to_numpy(), owners.column("node")
        ends = pc.value_counts(nodes).field("counts").to_numpy().cumsum()
        for start, end in zip([0, *ends[:-1]], ends, strict=True):
            leaf = box[start:end]
            reach = ((x - np.clip(x, leaf.min(axis=0), leaf.max(axis=0))) ** 2).sum(axis=1) <= _reach(eps)
            reach &= self.own[at] + self.n[at] < self.least
            if tile == self.tile:
                reach &= pc.not_equal(self.home, nodes[int(start)]).to_numpy()[at]
            come = np.nonzero(reach)[0]
            for s in range(0, len(come), BLOCK):
                part = come[s : s + BLOCK]
                near = _close(x[part], leaf, eps)
                found, who = near @ weights[start:end], at[part]
                self.n[who] += found
                for i in np.nonzero((found > 0) & (self.own[who] + self.n[who] < self.least))[0]:
                    self.near.setdefault(int(who[i]), []).extend(ids[start:end][near[i]].tolist())

    def found(self) -> pa.RecordBatch:
        some = np.nonzero(self.n > 0)[0]
        who = [self.near.get(int(i), []) if self.own[i] + self.n[i] < self.least else [] for i in some]
        return pa.RecordBatch.from_arrays([pa.array(self.pid[some]), pa.array(self.n[some]), pa.array(who, pa.list_(pa.int64()))], schema=_SCHEMA)


def met(thin: DataFrame, placed: DataFrame, dims: int, eps: float, min_points: int) -> DataFrame:
    """What the thin points (``n``: the weight found in their own leaf) find in the other leaves (``FOUND``), once per task.

    A task reads some tiles of thin points and some of all points; every two that reach each other meet there.
    """
    visitors = packed(thin, "pid", "x", "node", "n").select(
        F.col("tile").alias("visitor"), F.col("lo").alias("from"), F.col("hi").alias("to"), F.col("rows").alias("visitors")
    )
    pairs = visitors.join(packed(placed, "pid", "x", "w", "node").hint("shuffle_replicate_nl"), _gap(dims) <= _reach(eps))

    def meet(batches):
        come = None
        for batch in batches:
            for visitor, rows, tile, owners in zip(*[batch.column(c) for c in ("visitor", "visitors", "tile", "rows")], strict=True):
                if come is None or come.tile != visitor.as_py():
                    if come is not None:
                        yield come.found()
                    come = _Visitors(visitor.as_py(), rows, min_points)
                come.meet(tile.as_py(), owners, eps)
        if come is not None:
            yield come.found()

    return pairs.select("visitor", "visitors", "tile", "rows").mapInArrow(meet, FOUND)


def noise_keys(df: DataFrame, key: str, vector: str, eps: float, min_points: int = 5, leaf: int = 1024) -> DataFrame:
    """Keys of the rows whose vector is noise: fewer than ``min_points`` rows within ``eps`` (inclusive, itself among them),
    and none of those with as many.

    Rows whose vector is null, empty or holds a null, NaN or infinite component take no part: they are neither noise nor
    neighbours. Repeated rows count as often as they stand there. Vectors of different lengths raise an error.
    """
    if eps <= 0 or min_points < 1 or leaf < 1:
        raise ValueError("eps, min_points and leaf must be positive")
    ship(df.sparkSession)
    rows = materialise(vectors(df, key, vector), "tree-rows")
    points = rows.groupBy(F.col("_x").alias("x")).agg(F.count(F.lit(1)).alias("w"))
    points = materialise(points.withColumn("pid", F.monotonically_increasing_id()), "tree-distinct")
    ends = points.agg(F.min(F.size("x")).alias("lo"), F.max(F.size("x")).alias("hi")).first()
    if ends["lo"] is None:
        return rows.select(F.col("_key").alias(key))
    if ends["lo"] != ends["hi"]:
        raise ValueError(f"vectors of {ends['lo']} and of {ends['hi']} components")

    dims = ends["lo"]
    placed, levels = tree(points, dims, leaf)
    spark = df.sparkSession
    own = placed.groupBy("node").applyInArrow(lambda t: _found(t, t, eps, min_points), FOUND)
    own = materialise(own, "tree-own")
    leaves, most = placed, max(leaf, TILE, min(points.count() // 16, TILE_BYTES // (8 * dims)))
    placed = materialise(leaves.join(_tiles(levels, most), "node"), "tree-placed")
    discard(spark, leaves)
    thin = materialise(placed.join(own.where(F.col("n") < min_points).select("pid", "n"), "pid"), "tree-thin")
    found = materialise(own.unionByName(met(thin, placed, dims, eps, min_points)), "tree-found")
    discard(spark, placed, thin, own)

    total = materialise(found.groupBy("pid").agg((F.sum("n") >= min_points).alias("core")), "tree-core")
    thin = total.where("NOT core").select("pid")
    seen = found.join(thin, "pid", "left_semi").select("pid", F.explode("near").alias("q"))
    beside = seen.join(total.where("core").select(F.col("pid").alias("q")), "q", "left_semi").select("pid")
    noise = points.join(thin.join(beside, "pid", "left_anti"), "pid", "left_semi").select(F.col("x").alias("_x"))
    return rows.join(noise, "_x", "left_semi").select(F.col("_key").alias(key))
