"""Hard negatives by anchor-clustered shared lists.

Anchors are clustered by direction. A cluster's centre and its widest angle bound what any member can score with a
candidate: no more than the two norms times the cosine of the angle between candidate and centre, less the cluster's own
angle. So a cluster sorts a block of candidates once by that bound, and each member walks the shared list until the
bound of the next candidate, times its own norm, is below the worst score it still needs; what it found is then
certified. The first walk finds the positives, the second the negatives between the two shares of each positive score.

Both walks are run first over a hash sample of one in ``seed_share`` candidates. The scores found there are lower limits
for the walk over all: a candidate is only sent to the clusters whose bound for it reaches a member's limit.

Candidates are dealt by hash into blocks of about ``block_rows``, anchors by cluster into bundles of about
``bundle_anchors`` (a larger cluster is split), and a bundle meets a block in one task. Centres are fitted on at most
``sample`` anchors drawn by hash; they decide how far lists are walked, never what is found.

Defined results: components are floor(256 * x); vectors that are null or hold a null or non-finite component, and rows
without a vec_id or label, take no part; vectors meet only vectors of their own length; a row never meets itself but
does meet other rows of the same vec_id, each a positive of its own; ties go to the smaller vec_id, then to the row met
first; an anchor without positives, or whose positives' scores leave no range, gives no rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.topk import whole
from tidewatch.session import discard, materialise

FIRST_STRETCH = 256
#: Angles come from floating point; bounds are raised by this share of both norms.
SLACK = 1e-6
PASSED_OVER = 1 << 62


def _units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(norms, directions); a zero vector's direction is zero."""
    x = x.astype(np.float64)
    norms = np.sqrt((x * x).sum(1))
    return norms, x / np.maximum(norms, 1e-300)[:, None]


def centres(directions: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spaced starts."""
    found = directions[np.linspace(0, len(directions) - 1, count).astype(int)]
    for _ in range(rounds):
        own = np.argmax(directions @ found.T, 1)
        sums = np.zeros_like(found)
        np.add.at(sums, own, directions)
        norms, made = _units(sums)
        found = np.where(norms[:, None] > 0, made, found)
    return found


def bounds(norms: np.ndarray, cosines: np.ndarray, angle: float) -> np.ndarray:
    """What candidates can score, at most, with a member of norm 1 whose angle to the centre is ``angle`` at most."""
    apart = np.maximum(0.0, np.arccos(np.clip(cosines, -1, 1)) - angle)
    return norms * (np.cos(apart) + SLACK)


class Best:
    """A member's k best candidates of its own label, none below ``floor``."""

    def __init__(self, rid: int, label, floor: int | None, k: int):
        self.rid, self.label, self.floor, self.k = rid, label, floor, k
        self.scores, self.ids = np.zeros(0), np.zeros(0, np.int64)

    def take(self, scores: np.ndarray, ids: np.ndarray, rids: np.ndarray, labels: np.ndarray) -> None:
        ok = (labels == self.label) & (rids != self.rid)
        if self.floor is not None:
            ok &= scores >= self.floor
        scores, ids = np.concatenate([self.scores, scores[ok]]), np.concatenate([self.ids, ids[ok]])
        top = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[top], ids[top]

    def need(self) -> float:
        least = -np.inf if self.floor is None else float(self.floor)
        return max(least, float(self.scores[-1])) if len(self.scores) == self.k else least


class Between:
    """For each of a member's positives, the k best candidates of other labels inside that positive's range."""

    def __init__(self, label, ranges: list[tuple[int, int]], k: int):
        self.label, self.ranges, self.k = label, ranges, k
        self.scores, self.ids = np.zeros(0), np.zeros(0, np.int64)
        self.low = min((lo for lo, hi in ranges if lo <= hi), default=PASSED_OVER)
        self.high = max((hi for lo, hi in ranges if lo <= hi), default=-PASSED_OVER)

    def found(self) -> list[slice]:
        """Of the kept scores, in order, each positive's stretch."""
        down = -self.scores
        out = []
        for lo, hi in self.ranges:
            start, stop = np.searchsorted(down, -hi, "left"), np.searchsorted(down, -lo, "right")
            out.append(slice(int(start), int(max(start, min(stop, start + self.k)))))
        return out

    def take(self, scores: np.ndarray, ids: np.ndarray, rids: np.ndarray, labels: np.ndarray) -> None:
        ok = (labels != self.label) & (scores >= self.low) & (scores <= self.high)
        scores, ids = np.concatenate([self.scores, scores[ok]]), np.concatenate([self.ids, ids[ok]])
        order = np.lexsort((ids, -scores))
        self.scores, self.ids = scores[order], ids[order]
        wanted = np.zeros(len(order), bool)
        for part in self.found():
            wanted[part] = True
        self.scores, self.ids = self.scores[wanted], self.ids[wanted]

    def need(self) -> float:
        least = np.inf
        for (lo, hi), part in zip(self.ranges, self.found(), strict=True):
            if lo <= hi:
                full = part.stop - part.start == self.k
                least = min(least, float(self.scores[part.stop - 1]) if full else float(lo))
        return least


def walk(x: np.ndarray, bound: np.ndarray, u: np.ndarray, members: list, ids: np.ndarray, rids: np.ndarray, labels: np.ndarray) -> int:
    """Members walk the candidates ``x`` from the highest bound down; how many scores it took."""
    order = np.argsort(-bound, kind="stable")
    norms = np.sqrt((u.astype(np.float64) ** 2).sum(1))
    active, at, step, taken = np.array([k for k, m in enumerate(members) if m.need() < np.inf], np.int64), 0, FIRST_STRETCH, 0
    while at < len(order) and len(active):
        limits = norms[active] * bound[order[at]] + 1e-3
        active = active[[limit >= members[k].need() for k, limit in zip(active.tolist(), limits.tolist(), strict=True)]]
        part = order[at : at + step]
        scores = x[part] @ u[active].T
        for column, k in enumerate(active.tolist()):
            members[k].take(scores[:, column], ids[part], rids[part], labels[part])
        taken += scores.size
        at, step = at + step, step * 2
    return taken


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0), np.int64)


def _exact(*matrices: np.ndarray):
    """Floating point where every inner product is below 2**53, Python's whole numbers beyond."""
    largest = max(1, matrices[0].shape[1])
    for m in matrices:
        largest *= float(np.abs(m.astype(float)).max(initial=0))
    return [m.astype(np.float64 if largest < 2**53 else object) for m in matrices]


def _whole(score) -> int:
    return max(-(2**63), min(2**63 - 1, int(score)))


class Clusters:
    """Centres by vector length, each with its widest member angle, its members' least limit and its bundles."""

    def __init__(self, found: dict[int, np.ndarray]):
        self.found = found
        self.angle: dict[tuple[int, int], float] = {}
        self.first: dict[tuple[int, int], tuple[int, int]] = {}

    def nearest(self, dims: int, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cluster, angle); vectors of a length no sampled anchor had are in cluster 0, as wide as can be."""
        if dims not in self.found:
            return np.zeros(len(directions), np.int64), np.full(len(directions), np.pi)
        cosines = directions @ self.found[dims].T
        own = np.argmax(cosines, 1)
        angle = np.arccos(np.clip(cosines[np.arange(len(own)), own], -1, 1))
        return own, np.where(np.abs(directions).sum(1) > 0, angle, 0.0)

    def bound(self, dims: int, cluster: int, norms: np.ndarray, directions: np.ndarray) -> np.ndarray:
        if dims not in self.found:
            return norms * (1 + SLACK)
        return bounds(norms, directions @ self.found[dims][cluster], self.angle[dims, cluster])


def _fit(anchors: DataFrame, sample: int, clusters: int) -> Clusters:
    """Centres of about the square root of the sampled anchors; ``sample`` vectors come to the driver."""
    drawn = anchors.orderBy(F.xxhash64("rid", F.lit(5))).limit(sample).select("dims", "q").toPandas()
    found = {}
    for dims, rows in drawn.groupby("dims"):
        directions = _units(_matrix(rows["q"]))[1] if dims else np.zeros((len(rows), 0))
        if dims:
            found[int(dims)] = centres(directions, max(1, min(clusters, isqrt(len(rows)))))
    return Clusters(found)


def _assign(anchors: DataFrame, fitted: Clusters, bundle_anchors: int) -> DataFrame:
    """``anchors`` with cluster and bundle, written; the clusters learn their angles and bundles."""

    def near(batches):
        for batch in batches:
            for dims, rows in batch.groupby("dims"):
                cluster, angle = fitted.nearest(int(dims), _units(_matrix(rows["q"]))[1])
                yield pd.DataFrame({"rid": rows["rid"], "cluster": cluster, "angle": angle})

    told = materialise(anchors.select("rid", "dims", "q").mapInPandas(near, "rid long, cluster long, angle double"), "negatives-clusters")
    sized = anchors.select("rid", "dims").join(told, "rid").groupBy("dims", "cluster").agg(F.max("angle").alias("angle"), F.count("*").alias("n"))
    # As many rows as there are centres.
    bundle, held, spans = 0, 0, []
    for row in sized.orderBy("dims", "cluster").collect():
        key = (row["dims"], row["cluster"])
        if held and (held + row["n"] > bundle_anchors or key[0] != spans[-1][0]):
            bundle, held = bundle + 1, 0
        parts = ceil(row["n"] / bundle_anchors)
        fitted.angle[key], fitted.first[key] = row["angle"] + 1e-7, (bundle, parts)
        spans.append((*key, bundle, parts))
        held += row["n"]
        if parts > 1:
            bundle, held = bundle + parts, 0
    if not spans:
        return materialise(anchors.withColumn("cluster", F.lit(0).cast("long")).withColumn("bundle", F.lit(0)), "negatives-anchors")
    spans_df = anchors.sparkSession.createDataFrame(spans, "dims int, cluster long, first int, parts int")
    # One row per centre.
    placed = anchors.join(told, "rid").join(F.broadcast(spans_df), ["dims", "cluster"])
    return materialise(placed.withColumn("bundle", F.col("first") + F.pmod(F.xxhash64("rid", F.lit(7)), F.col("parts")).cast("int")).drop("first", "parts", "angle"), "negatives-anchors")


def _limits(asked: DataFrame, least: Column) -> dict[tuple[int, int], float]:
    """Per cluster the least limit of any member, divided by the member's norm: one row per centre."""
    norm = F.sqrt(F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    per = F.when(norm > 0, least.cast("double") / norm).when(least.cast("double") > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    rows = asked.groupBy("dims", "cluster").agg(F.min(F.coalesce(per, F.lit(float("-inf")))).alias("low")).collect()
    return {(r["dims"], r["cluster"]): r["low"] for r in rows}


def _sent(rows: DataFrame, fitted: Clusters, limits: dict[tuple[int, int], float], blocks: int) -> DataFrame:
    """``rows`` once for every bundle that holds a cluster whose bound for the row reaches the cluster's limit."""

    def choose(batches):
        for batch in batches:
            for dims, part in batch.groupby("dims"):
                norms, directions = _units(_matrix(part["q"]))
                wanted: dict[int, np.ndarray] = {}
                for (d, cluster), low in limits.items():
                    if d == dims:
                        hit = fitted.bound(int(dims), cluster, norms, directions) * (1 + 1e-9) + 1e-3 >= low
                        first, parts = fitted.first[d, cluster]
                        for b in range(first, first + parts):
                            wanted[b] = wanted[b] | hit if b in wanted else hit
                if wanted:
                    names = np.array(list(wanted))
                    table = np.stack(list(wanted.values()), 1)
                    yield pd.DataFrame({"rid": part["rid"], "vec_id": part["vec_id"], "label": part["label"], "q": part["q"], "dims": part["dims"], "bundles": [names[t].tolist() for t in table]})

    kind = dict(rows.dtypes)["label"]
    chosen = rows.select("rid", "vec_id", "label", "q", "dims").mapInPandas(choose, f"rid long, vec_id long, label {kind}, q array<long>, dims int, bundles array<int>")
    block = F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    return chosen.select("rid", "vec_id", "label", "q", "dims", block, F.explode("bundles").alias("bundle"))


def _meet(rows: DataFrame, asked: DataFrame, fitted: Clusters, limits: dict, blocks: int, members: Callable, out: Callable, shape: str) -> DataFrame:
    """Every bundle of anchors walks every block of candidates sent to it."""
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")

    def run(x: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(x) and len(a):
            dims = int(x["dims"].iloc[0])
            vectors, mine = _exact(_matrix(x["q"]), _matrix(a["q"]))
            norms, directions = _units(vectors)
            ids, rids, labels = x["vec_id"].to_numpy(), x["rid"].to_numpy(), x["label"].to_numpy()
            for cluster, at in a.reset_index(drop=True).groupby("cluster").indices.items():
                rows_ = a.iloc[at]
                walkers = members(rows_)
                walk(vectors, fitted.bound(dims, int(cluster), norms, directions), mine[at], walkers, ids, rids, labels)
                for row, walker in zip(rows_.itertuples(), walkers, strict=True):
                    found += out(row, walker)
        return pd.DataFrame(found, columns=[c.split()[0] for c in shape.split(", ")])

    left = _sent(rows, fitted, limits, blocks).groupBy("bundle", "block")
    return left.cogroup(asked.select("*", every).groupBy("bundle", "block")).applyInPandas(run, shape)


def _top(found: DataFrame, by: list[str], score: str, ident: str, k: int) -> DataFrame:
    best = Window.partitionBy(*by).orderBy(F.desc(score), ident)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(
    embeddings: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    block_rows: int = 8192, bundle_anchors: int = 2048, clusters: int = 256, sample: int = 4096, seed_share: int = 16,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``embeddings`` (vec_id, embedding,
    label): for every row that ``anchors`` holds for and each of its best ``positives`` of the same label, the best
    ``negatives`` of other labels that score from ``low`` to ``high`` percent of the positive."""
    usable = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", whole(F.col("embedding")).alias("q"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    usable = usable.where("q IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL").withColumn("rid", F.monotonically_increasing_id()).withColumn("dims", F.size("q"))
    rows = materialise(usable, "negatives-vectors")
    blocks = max(1, ceil(rows.count() / block_rows))
    seeds = rows.where(F.pmod(F.xxhash64("rid", F.lit(3)), F.lit(seed_share)) == 0)
    fitted = _fit(rows.where("asks"), sample, clusters)
    asked = _assign(rows.where("asks").drop("asks"), fitted, bundle_anchors)
    has = lambda value: None if value is None or pd.isna(value) else int(value)

    def best_members(a: pd.DataFrame) -> list:
        return [Best(r.rid, r.label, has(r.floor), positives) for r in a.itertuples()]

    def best_out(row, walker: Best) -> list:
        return [(row.rid, int(i), _whole(s)) for s, i in zip(walker.scores, walker.ids, strict=True)]

    def best(of: DataFrame, told: DataFrame, count: int) -> DataFrame:
        found = _meet(of, told, fitted, _limits(told, F.col("floor")), count, best_members, best_out, "rid long, positive_id long, score long")
        return _top(found, ["rid"], "score", "positive_id", positives)

    seeded = best(seeds, asked.withColumn("floor", F.lit(None).cast("long")), max(1, blocks // seed_share))
    floors = materialise(seeded.where(F.col("rank") == positives).select("rid", F.col("score").alias("floor")), "negatives-floors")
    chosen = materialise(best(rows, asked.join(floors, "rid", "left"), blocks), "negatives-positives")
    listed = chosen.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("rank", "positive_id", "score"))).alias("chosen"))
    asked = materialise(asked.join(listed, "rid"), "negatives-asked")

    def between_members(a: pd.DataFrame) -> list:
        out = []
        for r in a.itertuples():
            floor = r.floors
            ranges = [(max(-(-low * p["score"] // 100), int(f)), high * p["score"] // 100) for p, f in zip(r.chosen, floor, strict=True)]
            out.append(Between(r.label, ranges, negatives))
        return out

    def between_out(row, walker: Between) -> list:
        out = []
        for p, part in zip(row.chosen, walker.found(), strict=True):
            out += [(row.rid, p["rank"], row.vec_id, p["positive_id"], p["score"], int(i), _whole(s)) for s, i in zip(walker.scores[part], walker.ids[part], strict=True)]
        return out

    def between(of: DataFrame, told: DataFrame, count: int) -> DataFrame:
        limit = F.array_min(F.zip_with("chosen", "floors", lambda p, f: F.greatest(F.ceil(p["score"].cast("decimal(38,0)") * low / 100).cast("double"), f.cast("double"))))
        shape = "rid long, place int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
        found = _meet(of, told, fitted, _limits(told, limit), count, between_members, between_out, shape)
        return _top(found, ["rid", "place"], "negative_score", "negative_id", negatives)

    unknown = F.transform("chosen", lambda p: F.lit(-PASSED_OVER).cast("long"))
    seeded = between(seeds, asked.withColumn("floors", unknown), max(1, blocks // seed_share))
    reached = seeded.where(F.col("rank") == negatives).groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("place", "negative_score"))).alias("reached"))
    reached = materialise(reached, "negatives-reached")
    told = asked.join(reached, "rid", "left").withColumn("floors", F.transform("chosen", lambda p: F.coalesce(F.col("reached")[p["rank"]], F.lit(-PASSED_OVER).cast("long")))).drop("reached")
    found = between(rows, told, blocks)
    discard(embeddings.sparkSession, floors)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
