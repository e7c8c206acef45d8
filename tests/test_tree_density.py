"""Density noise over vectors of many dimensions against all pairs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import tree_density as D

SCHEMA = "id long, v array<double>, x double, node string"


def brute(x, eps, least):
    near = ((x[:, None] - x[None]) ** 2).sum(2) <= eps * eps
    core = near.sum(1) >= least
    return {i for i in range(len(x)) if not core[i] and not (near[i] & core).any()}


def frame(spark, x):
    """Columns of the operator's own names stand in the way."""
    return spark.createDataFrame([(i, list(map(float, v)), 1.0, "a") for i, v in enumerate(x)], SCHEMA)


def points(kind):
    rng = np.random.default_rng(7)
    if kind == "crowds":  # tight and loose crowds, thin points between, copies of one vector
        x = [rng.normal(size=(90, 20)) * 0.05, rng.normal(size=(60, 20)) * 0.16 + 1, rng.normal(size=(70, 20)), np.ones((40, 20)) * 3, np.ones((3, 20)) * -4]
        return np.concatenate(x), 0.9
    if kind == "ties":  # few values in every dimension, distances that equal eps
        return rng.integers(0, 2, (200, 6)) * 1.0, 1.0
    if kind == "even":
        x = rng.normal(size=(250, 16))
        return x / np.linalg.norm(x, axis=1)[:, None], 0.75
    return np.concatenate([rng.normal(size=(120, 1)) * 1e-3, rng.normal(size=(80, 1)) * 50]), 0.5


@pytest.mark.parametrize("kind, leaf", [("crowds", 16), ("ties", 16), ("even", 32), ("line", 16)])
def test_noise_equals_all_pairs(spark, kind, leaf):
    x, eps = points(kind)
    want = brute(x, eps, 5)
    got = [r["id"] for r in D.noise_keys(frame(spark, x), "id", "v", eps, 5, leaf).collect()]
    assert sorted(got) == sorted(want)
    if kind != "ties":
        assert want


def test_leaves_are_bounded_and_hold_every_point_once(spark):
    x, _ = points("crowds")
    rows = frame(spark, np.unique(x, axis=0)).select(F.col("id").alias("pid"), F.col("v").alias("x"), F.lit(1).alias("w"))
    placed, levels = D.tree(rows, 20, 16)
    sizes = {r["node"]: r["count"] for r in placed.groupBy("node").count().collect()}
    assert max(sizes.values()) <= 16 and sum(sizes.values()) == rows.count() == placed.select("pid").distinct().count()
    leaves = {r["node"]: r["size"] for boxes in levels for r in boxes.where("is_leaf").collect()}
    assert leaves == sizes and len(levels) > 1


def test_points_visit_leaves_within_reach_only(spark):
    """Points go down the tree only to boxes within their reach."""
    rows = spark.createDataFrame([(i, [float(i // 10) * 10, float(i % 10) * 0.01]) for i in range(60)], "pid long, x array<double>")
    placed, levels = D.tree(rows.withColumn("w", F.lit(1)), 2, 10)
    homes = {r["pid"]: r["node"] for r in placed.collect()}
    for r in D.visits(placed, levels, 2, 1.0).collect():
        assert r["leaf"] != homes[r["pid"]]
        assert any(homes[q] == r["leaf"] for q in range(60) if q // 10 == r["pid"] // 10)


@pytest.mark.parametrize("kind, leaf, tile", [("crowds", 8, 40), ("even", 8, 64)])
def test_tiles_meet_and_noise_stays(spark, monkeypatch, kind, leaf, tile):
    """Tiles of several leaves."""
    monkeypatch.setattr(D, "TILE", tile)
    x, eps = points(kind)
    got = [r["id"] for r in D.noise_keys(frame(spark, x), "id", "v", eps, 5, leaf).collect()]
    assert sorted(got) == sorted(brute(x, eps, 5))


def test_a_point_is_sent_once_per_tile_and_not_per_leaf(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 24))
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x / np.linalg.norm(x, axis=1)[:, None])], "pid long, x array<double>, w long")
    placed, levels = D.tree(rows, 24, 8)
    tiles = D._tiles(levels, 100)
    sizes = {r["tile"]: r["n"] for r in placed.join(tiles, "node").groupBy("tile").agg(F.count("*").alias("n")).collect()}
    assert sum(sizes.values()) == 400 and max(sizes.values()) <= 100
    met = D.meetings(placed.join(tiles, "node"), levels, 24, 1.2, 100)
    assert met.count() == met.distinct().count() <= len(sizes) ** 2 < tiles.count() ** 2 / 4


def test_tiles_meet_without_a_shuffle(spark):
    """A point is written once, in its tile; a task reads tiles in pairs, so the disk in use does not grow with the pairs."""
    x, eps = points("even")
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "pid long, x array<double>, w long")
    leaves, levels = D.tree(rows, 16, 8)
    placed = leaves.join(D._tiles(levels, 40), "node")
    tiles = D.packed(placed, "pid", "x", "w", "node").collect()
    ids = [i for t in tiles for i in pa.ipc.open_stream(t["rows"]).read_all().column("pid").to_pylist()]
    assert sorted(ids) == list(range(250)) and len(tiles) > 4
    told = D.met(placed.withColumn("n", F.lit(1)), placed, 16, eps, 1000)
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    homes, got = {r["pid"]: r["node"] for r in leaves.collect()}, {}
    for r in told.collect():
        got.setdefault(r["pid"], []).extend(r["near"])
    near = ((x[:, None] - x[None]) ** 2).sum(2) <= eps * eps
    for i in range(250):
        assert sorted(got.get(i, [])) == [j for j in range(250) if near[i, j] and homes[i] != homes[j]]


def test_a_known_core_point_meets_no_more_tiles():
    def tile(name, x, **more):
        table = pa.table({"tile": [name] * len(x), "pid": list(range(len(x))), "x": x, "node": [name] * len(x)} | more)
        return D._pack(table).column("rows")[0]

    come = D._Visitors("a", tile("a", [[0.0], [9.0]], n=[4, 1]), 5)
    for other in ("b", "c"):
        come.meet(other, tile(other, [[0.1], [9.1], [50.0]], w=[1, 1, 1]), 1.0)
    assert come.found().to_pydict() == {"pid": [0, 1], "n": [1, 2], "near": [[], [1, 1]]}


def test_rows_that_take_no_part(spark):
    odd = [(1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 0.0]), (5, [float("inf"), 0.0]), (6, [0.0, 0.0]), (6, [0.0, 0.0]), (7, [-0.0, 0.0]), (None, [9.0, 9.0])]
    df = spark.createDataFrame(odd, "id long, v array<double>")
    assert [r["id"] for r in D.noise_keys(df, "id", "v", 1.0, 3).collect()] == [None]
    assert sorted((r["id"] or 0) for r in D.noise_keys(df, "id", "v", 1.0, 4).collect()) == [0, 6, 6, 7]
    assert D.noise_keys(df.where("id < 6"), "id", "v", 1.0).count() == 0
    assert D.noise_keys(df.limit(0), "id", "v", 1.0).columns == ["id"]
    with pytest.raises(ValueError):
        D.noise_keys(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id long, v array<double>"), "id", "v", 1.0)
