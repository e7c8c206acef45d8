"""Exact top-k by inner product: the threshold algorithm over sorted per-dimension lists.

Rows are dealt by hash into blocks. A block keeps, per dimension, its vectors sorted by that component; a query walks
all lists at once from the end its component's sign favours. A vector met in any list is scored in full. After each
round the bound is the score of an imaginary vector holding the values last met in every list; nothing unseen can beat
it, so the walk ends when the k-th best score is above the bound. Rounds double their depth. Blocks' winners meet in a
ranking per query.

The query set meets all rows in pairs of blocks, about ``block_rows`` vectors by ``query_rows`` queries each.

Defined results: components are floor(256 * x) as whole numbers, at the ends of the 64-bit range if beyond it, and so
are scores; vectors that are null or hold a null or non-finite component, and rows without a vec_id, take no part;
vectors meet only vectors of their own length; a query never meets its own row but does meet other rows of the same
vec_id; ties go to the smaller vec_id; fewer candidates than k give fewer ranks; an empty table gives no rows.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import materialise

SCALE = 256


def whole(embedding: Column) -> Column:
    """floor(256 * x) of every component; null unless all are finite numbers."""
    usable = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(embedding, lambda x: F.floor(F.lit(SCALE) * x.cast("double"))))


class Lists:
    """A block's vectors, their rank in every dimension (0: largest) and every dimension's values in that order."""

    def __init__(self, vectors: np.ndarray):
        self.n, self.dims = vectors.shape
        order = np.argsort(-vectors.astype(np.float64) if vectors.dtype != object else -vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, order, 0)
        self.rank = np.empty((self.dims, self.n), np.uint32 if self.n > 0xFFFF else np.uint16)
        for d in range(self.dims):
            self.rank[d, order[:, d]] = np.arange(self.n, dtype=self.rank.dtype)
        self.vectors = vectors

    def top(self, query: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k best, ties by id; rows marked ``own`` are passed over."""
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        met = np.full(self.n, self.n - 1, np.int64)
        if len(up):
            met = np.minimum(met, self.rank[up].min(0))
        if len(down):
            met = np.minimum(met, self.n - 1 - self.rank[down].max(0).astype(np.int64))
        seen, scores = np.zeros(self.n, bool), np.empty(self.n, self.vectors.dtype)
        seen[own] = True
        rows = np.zeros(0, np.int64)
        depth = 4 * k
        while True:
            depth = min(depth, self.n)
            new = np.flatnonzero((met < depth) & ~seen) if depth < self.n else np.flatnonzero(~seen)
            seen[new] = True
            scores[new] = self.vectors[new] @ query
            rows = np.concatenate([rows, new])
            if len(rows) > k:
                cut = np.sort(scores[rows])[-k]
                rows = rows[scores[rows] >= cut]
                rows = rows[np.lexsort((ids[rows], -scores[rows]))][:k]
            if depth == self.n:
                break
            bound = self.sorted[depth - 1, up] @ query[up] + self.sorted[self.n - depth, down] @ query[down]
            if len(rows) == k and scores[rows].min() > bound:
                break
            depth *= 2
        rows = rows[np.lexsort((ids[rows], -scores[rows]))]
        return rows, scores[rows]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0), np.int64)


def _search(rows: pd.DataFrame, asked: pd.DataFrame, k: int) -> pd.DataFrame:
    out = []
    if len(rows) and len(asked):
        x, q = _matrix(rows["q"]), _matrix(asked["q"])
        # Sums below 2**53 are exact in floating point; beyond, Python's own whole numbers count.
        largest = max(1, x.shape[1]) * float(np.abs(x.astype(float)).max(initial=0)) * float(np.abs(q.astype(float)).max(initial=0))
        kind = np.float64 if largest < 2**53 else object
        lists, ids, rid = Lists(x.astype(kind)), rows["vec_id"].to_numpy(), rows["rid"].to_numpy()
        for query, name, own in zip(q.astype(kind), asked["vec_id"], asked["rid"], strict=True):
            found, scores = lists.top(query, ids, np.flatnonzero(rid == own), k)
            out += [(own, name, i, max(-(2**63), min(2**63 - 1, int(s)))) for i, s in zip(ids[found].tolist(), scores.tolist(), strict=True)]
    return pd.DataFrame(out, columns=["rid", "query_id", "vec_id", "score"])


def nearest(embeddings: DataFrame, asks: Column, k: int = 5, block_rows: int = 4096, query_rows: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row of ``embeddings`` (vec_id, embedding) that ``asks``."""
    usable = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding")).alias("q"), F.coalesce(asks, F.lit(False)).alias("asks"))
    usable = usable.where("q IS NOT NULL AND vec_id IS NOT NULL").withColumn("rid", F.monotonically_increasing_id()).withColumn("dims", F.size("q"))
    usable = materialise(usable, "topk-vectors")
    total = usable.agg(F.count("*").alias("n"), F.count_if("asks").alias("asked")).first()
    blocks, parts = max(1, ceil(total["n"] / block_rows)), max(1, ceil(total["asked"] / query_rows))
    deal = lambda n, seed: F.pmod(F.xxhash64("rid", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = usable.withColumn("block", deal(blocks, 1)).withColumn("part", every(parts)).groupBy("dims", "block", "part")
    asked = usable.where("asks").withColumn("part", deal(parts, 2)).withColumn("block", every(blocks)).groupBy("dims", "block", "part")

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return _search(a, b, k)

    found = rows.cogroup(asked).applyInPandas(search, "rid long, query_id long, vec_id long, score long")
    best = Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
