"""Near duplicates and exact top-k: brute force, SQL, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import near_dups, shingles, topk
from tidewatch.llm.components import components

SPACE = b" \t\n\x0b\x0c\r"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def shingled(text):
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in raw).translate(bytes(32 if c in SPACE else c for c in range(256))).split(b" ")
    words = [w for w in words if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute(docs):
    """{doc_id: (set size, component)} by all pairs."""
    sets = {i: shingled(t) for i, t in docs}
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if a < b:
                c = len(sets[a] & sets[b])
                if c and 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
                    x, y = sorted((find(a), find(b)))
                    up[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def variants(n=160, seed=2):
    """Groups of near copies around the threshold: a group of 60 whose members rarely link, pairs, chains and strangers."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [str(x) for x in rng.choice(vocabulary, 120)]
    docs = []
    for i in range(n):
        words = list(base) if i < 60 else [str(x) for x in rng.choice(vocabulary, 90)]
        if i < 60:
            for at in rng.integers(0, 120, int(rng.integers(0, 7))):
                words[at] = f"x{i}_{at}"
        elif i % 5 == 0 and i > 60:
            words = docs[-1][1].split()
            words[3] = f"c{i}"
        docs.append((1000 - i, " ".join(words)))
    return docs


def test_components_of_copies_equal_brute_force(spark):
    docs = [*variants(), (1, "A b C d E f"), (2, "a B c D e F"), (3, "a b"), (4, "A\tB"), (5, ""), (6, None), (7, " \n"), (8, "a")]
    want = brute(docs)
    got = rows(near_dups.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len({c for _, c in want.values()}) < len(docs) - 50  # the fixture does hold copies


def test_open_buckets_are_searched_to_the_end(spark, monkeypatch):
    """Without a second hub round, and with blocks of a few texts, the same components come out."""
    monkeypatch.setattr(near_dups, "BLOCK_TEXTS", 4)
    docs = variants(seed=9)
    got = rows(near_dups.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), hub_rounds=1))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(docs)


def test_near_duplicate_edges(spark, edge, nothing):
    got = rows(near_dups.near_duplicates(edge))
    assert len(got) == edge.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by[2] == [(by[1][0][0], 1, False)] * 2 and by[1][0][1:] == (1, True)
    assert by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)] and by[5] == [(0, 5, True)]
    assert {r[1:] for r in by[None]} == {(None, True)}
    assert near_dups.near_duplicates(nothing).count() == 0
    left = rows(near_dups.deduplicated(edge).select("doc_id", "text"))
    # The very long text repeats the first, so their shingles are the same.
    assert sorted(r["doc_id"] or 0 for r in left) == [0, 0, 1, 3, 4, 5, 6, 7, 9, 10, 11, 12]


@pytest.mark.parametrize("text", ["", "a", "a b c d e", "É é x\x00y  z\n\nQ", "w " * 40, "x" * 3_000_000 + " a b c d e f", ("long words here to cut " * 90_000) + "end"])
def test_shingle_sets_equal_loops(text):
    alone, beside = shingles.shingle_sets([text])[0], shingles.shingle_sets(["other words stand before this", text, "and after it too , yes"])[1]
    assert len(alone) == len(shingled(text)) and (alone == beside).all()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    x = np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64))
    a, b = x[:3000], x[1000:]
    s = shingles.MinHash(2000).signatures([a, b, a[:0], x[:70000]])
    assert abs((s[0] == s[1]).mean() - 0.5) < 0.05 and (s[2] == 0xFFFFFFFF).all()


def test_pruning_bounds():
    least = near_dups.least_matches()
    assert least == sorted(least) and least[-1] / 128 < 0.75
    same = np.arange(256, dtype=np.uint32).reshape(2, 128)
    assert near_dups.may_reach(same, same, least).tolist() == [0, 1]
    assert near_dups.may_reach(same, same + 1, least).tolist() == []


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (5, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in rows(components(links))}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def brute_top(data, k=5):
    whole = {}
    for n, (i, v) in enumerate(data):
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole[n] = (i, [int(np.floor(256.0 * x)) for x in v])
    out = []
    for n, (i, q) in whole.items():
        if i % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for m, (j, v) in whole.items() if m != n and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    data = [(int(i), rng.normal(size=8).round(1).tolist()) for i in range(700)]
    data += [(50, [0.0] * 8), (100, [1e6] * 8), (101, [-2.5e5] * 8), (None, [1.0] * 8), (102, None), (103, [None, 1.0]), (150, [float("nan"), 1.0]), (151, [float("inf")]), (200, [1.0, 2.0]), (201, [2.0, 1.0]), (250, []), (7, data[7][1])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("rank", F.lit(0)).withColumn("score", F.lit("x"))
    got = rows(topk.nearest(df, F.col("vec_id") % 50 == 0, block_rows=90, query_rows=6))
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute_top(data)
    assert topk.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_lists_stop_early_when_the_bound_allows():
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.integers(-5, 5, (5000, 4)), np.full((5, 4), 200)]).astype(np.float64)
    lists = topk.Lists(x)
    lists.vectors = Counting(x)
    found, scores = lists.top(np.ones(4), np.arange(len(x)), np.zeros(0, np.int64), 5)
    assert sorted(found.tolist()) == list(range(5000, 5005)) and set(scores) == {800.0} and lists.vectors.read < 500


class Counting:
    def __init__(self, x):
        self.x, self.read, self.dtype = x, 0, x.dtype

    def __getitem__(self, at):
        self.read += len(at)
        return self.x[at]
