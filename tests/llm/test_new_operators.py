"""Hard negatives, fill-in-the-middle and attention scores: brute force, SQL, round trips, edge cases."""

import collections
import hashlib
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import attention, fill_middle, hard_negatives, lm_scoring

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# --- hard negatives -------------------------------------------------------------------------------------------------


def brute_negatives(data):
    whole = []
    for n, (i, v, label) in enumerate(data):
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.append((n, i, [int(np.floor(256.0 * x)) for x in v], label))
    out = []
    for n, i, q, label in whole:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j, m, other) for m, j, v, other in whole if m != n and len(v) == len(q))
        for p, j, _, _ in [x for x in scored if x[3] == label][:5]:
            found = [x for x in scored if x[3] != label and 30 * -p <= 100 * -x[0] <= 90 * -p][:10]
            out += [(i, j, r + 1, x[1], -p, -x[0]) for r, x in enumerate(found)]
    return sorted(out)


def mined(df, **sizes):
    got = rows(hard_negatives.mine(df, F.col("vec_id") % 100 == 0, **sizes))
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in got)


def vectors(n=900, seed=3, groups=6):
    """Directions around a few centres, with ties, zero and opposite vectors, other lengths and unusable ones."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(groups, 6))
    data = [(int(i), (middle[i % groups] + rng.normal(size=6) * 0.4).round(1).tolist(), int(rng.integers(0, 4))) for i in range(n)]
    data += [(100, [0.0] * 6, 1), (200, [-9.0] * 6, 2), (300, data[7][1], data[7][2]), (7, data[7][1], data[7][2]), (901, [1e6] * 6, 3), (400, [1.0, 2.0], 0), (902, [2.0, 2.0], 0), (903, [1.0, 0.5], 1)]
    return [*data, (904, None, 1), (905, [None] * 6, 1), (906, [float("nan")] * 6, 1), (907, [float("inf")] * 6, 1), (None, [1.0] * 6, 1), (908, [1.0] * 6, None), (500, [], 1)]


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 70, "bundle_anchors": 3, "clusters": 4, "sample": 5, "seed_share": 2}])
def test_hard_negatives_equal_brute_force(spark, sizes):
    data = vectors()
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label long").withColumn("rank", F.lit("x")).withColumn("q", F.lit(1))
    want = brute_negatives(data)
    assert mined(df, **sizes) == want and len(want) > 100


def test_text_labels_one_label_and_an_empty_table(spark):
    data = [(i, v, f"l{label}" if label is not None else None) for i, v, label in vectors(300)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label string")
    assert mined(df) == brute_negatives(data)
    assert mined(df.withColumn("label", F.lit("same"))) == [] and mined(df.limit(0)) == []


def test_a_walk_ends_once_nothing_better_can_come():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(40_000, 8)) * 5, np.array([[100.0] * 8]) + rng.normal(size=(40, 8))]).round()
    norms, directions = hard_negatives._units(x)
    u = np.array([[50.0] * 8, [52.0] * 8]).round()
    centre = np.full(8, 8**-0.5)
    members = [hard_negatives.Best(-1, 1, None, 5) for _ in u]
    taken = hard_negatives.walk(x, hard_negatives.bounds(norms, directions @ centre, 0.01), u, members, np.arange(len(x)), np.arange(len(x)), np.ones(len(x), int))
    for m, q in zip(members, u, strict=True):
        assert m.ids.tolist() == np.lexsort((np.arange(len(x)), -(x @ q)))[:5].tolist()
    assert taken < len(x) / 10


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x, u = rng.normal(size=(500, 5)) * 9, rng.normal(size=(30, 5))
    norms, directions = hard_negatives._units(x)
    own, mine = hard_negatives._units(u)
    centre = hard_negatives._units(mine.mean(0, keepdims=True))[1][0]
    angle = float(np.arccos(np.clip(mine @ centre, -1, 1)).max())
    assert (x @ u.T <= hard_negatives.bounds(norms, directions @ centre, angle)[:, None] * own + 1e-9).all()


# --- fill in the middle ---------------------------------------------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = [int(hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = ["", " ", "\t\n  ", "a", " a", "a ", "  two  words \n", "é ü x  y", "<P> in here", "x<S", "ends <", "\U0001f600 \x00 z\x0b\x0cq", "<M>", "w" * 3000 + " " + "ß" * 999, "1 2 3 4 5 6 7 8 9 " * 40, "\x1c\x1f \x85", None]


def test_fill_in_the_middle_equals_a_loop_and_comes_back(spark):
    data = [(i if i % 23 else None, TEXTS[i % len(TEXTS)]) for i in range(600)] + [(9_999, "long words here " * 90_000 + " end ")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("form", F.lit(1)).withColumn("output", F.lit(2)).coalesce(2)
    made = fill_middle.transform(df).withColumn("again", fill_middle.restored(F.col("output"), F.col("form")))
    assert made.columns[:2] == ["doc_id", "text"]
    forms = collections.Counter()
    for r in rows(made):
        assert (r["n_units"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute_middle(r["doc_id"], r["text"])
        assert r["again"] == (r["text"] or "")
        forms[r["form"]] += 1
    assert forms["spm"] > forms["psm"] > 0 and fill_middle.transform(df.limit(0)).count() == 0


def test_fill_in_the_middle_edges(spark, edge):
    assert {(r["n_units"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rows(fill_middle.transform(edge))} == {brute_middle(r["doc_id"], r["text"]) for r in rows(edge)}
    assert all(r["form"] == "plain" for r in rows(fill_middle.transform(edge, percent=0)))


@pytest.mark.parametrize("byte", [8, 9, 13, 14, 31, 32, 33, 127, 128, 137, 141, 160, 255])
def test_white_space_is_told_from_every_other_byte(byte):
    x = np.full(8, byte, np.uint8).view(np.uint64)
    assert (int(fill_middle._spaces(x)[0]) != 0) == (byte in (9, 10, 11, 12, 13, 32))


def test_marks_rank_and_select():
    rng = np.random.default_rng(0)
    flags = rng.random(800) < 0.3
    marks = fill_middle.Marks((flags * np.uint8(0x80)).view(np.uint64))
    places = np.flatnonzero(flags)
    assert (marks.select(np.arange(1, len(places) + 1)) == places).all()
    assert (marks.rank(np.arange(801)) == np.concatenate(([0], np.cumsum(flags)))).all()


# --- attention scores -----------------------------------------------------------------------------------------------


def small_model(columns=40, span=attention.SPAN):
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 50, 61)
    counts[60] = 20
    vocabulary = attention.Vocabulary(counts, np.arange(61) % 2 == 0, columns, (4, 3))
    weights = {k: (x + rng.normal(size=x.shape) * 0.3).astype(np.float32) for k, x in attention.new_weights(vocabulary, 4).items()}
    pairs = rng.integers(0, 9, (vocabulary.columns + 2, vocabulary.columns)).astype(float)
    return attention.Model(vocabulary, weights, vocabulary.places(pairs))


def brute_log(model, ids):
    """A text position by position: attention over its window, the whole vocabulary summed up."""
    v, w = model.vocabulary, model.weights
    columns, out = [int(c) for c in v.column[ids]], []
    seen = [v.start, *columns[:-1]]
    for t in range(len(ids)):
        first = max(0, t // attention.SPAN * attention.SPAN - attention.SPAN)
        e = w["embed"].astype(float)
        q, inside = e[seen[t]] @ w["query"] / np.sqrt(4), range(first, t + 1)
        a = np.exp([q @ (e[seen[k]] @ w["key"]) + w["far"][t - k] for k in inside])
        h = e[seen[t]] + (a / a.sum()) @ np.array([e[seen[k]] @ w["value"] for k in inside])
        g = np.exp(h @ w["group"] + w["after"][seen[t]])
        share = (g / g.sum())[v.group] * np.exp(model.places[seen[t]].astype(float))
        assert abs(share.sum() - 1) < 1e-5
        out.append(np.log(share[columns[t]]) + v.inside[ids[t]])
    return sum(out)


def test_scores_equal_a_loop_over_positions():
    model = small_model()
    rng = np.random.default_rng(2)
    lengths = np.array([1, 7, 8, 9, 16, 17, 40, 3])
    texts = [np.append(rng.integers(0, 60, n - 1), 60) for n in lengths]
    got = lm_scoring._log10(model, np.concatenate(texts), lengths)
    assert np.allclose(got * np.log(10), [brute_log(model, t) for t in texts], rtol=1e-4)


def test_shares_of_the_vocabulary_sum_to_one():
    v = small_model().vocabulary
    for kind in (True, False):
        tail = [i for i in range(61) if v.inside[i] != 0 and (i % 2 == 0) == kind]
        assert not tail or abs(np.exp(v.inside[tail]).sum() - 1) < 1e-9


def test_gradients_equal_differences():
    model = small_model()
    v = model.vocabulary
    rng = np.random.default_rng(3)
    inputs, targets, _ = attention.windows_of(v.column[rng.integers(0, 61, 90)], np.array([50, 5, 35]), v)
    loss, grad = model.gradients(inputs, targets)
    for name, g in grad.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in g.shape)
            moved = []
            for d in (1e-2, -1e-2):
                w = {k: x.copy() for k, x in model.weights.items()}
                w[name][at] += d
                moved.append(attention.Model(v, w).gradients(inputs, targets)[0])
            assert abs((moved[0] - moved[1]) / 2e-2 - g[at]) < 2e-3, name
    better = attention.trained(v, model.weights, np.concatenate([inputs, targets], 1), 60, 0.02, 0.01)
    assert attention.Model(v, better).gradients(inputs, targets)[0] < loss
    assert all((x == y).all() for x, y in zip(attention.unpacked(attention.packed(better), better).values(), (better[k] for k in sorted(better)), strict=True))


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


@pytest.mark.parametrize("hot", [1 << 18, 3])
def test_base_scores_equal_a_loop(spark, edge, monkeypatch, hot):
    """With all words at every worker, and with nearly all of them joined."""
    monkeypatch.setattr(lm_scoring, "HOT_WORDS", hot)
    extra = spark.createDataFrame([(100 + i, f"common w{i % 7} rare{i} The THE é{i % 3} " + "x" * (i * 10)) for i in range(60)], "doc_id long, text string")
    docs = edge.select("doc_id", "text").unionByName(extra).withColumn("score", F.lit("s"))
    got = rows(lm_scoring.score(docs, lm_scoring.train(docs, VOCABULARY, least_steps=3)).withColumn("k", F.lit(1)))
    data = [(r["doc_id"], words(r["text"])) for r in rows(docs)]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    c = collections.Counter(w for i, ws in data if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((i or 0, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(float(sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)), 3)) for i, ws in data)
    assert sorted((r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 3)) for r in got) == want
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)
    same = {r["score"] for r in got if r["doc_id"] in (1, 2)}
    assert max(same) - min(same) < 1e-3


def test_pairs_across_are_counted_a_few_rows_at_a_time():
    """However many windows an Arrow batch holds, only some of its rows are unpacked at a time."""
    v = small_model().vocabulary
    rng = np.random.default_rng(4)
    lengths = np.full(4000, 80)
    inputs, targets, _ = attention.windows_of(v.column[rng.integers(0, 61, lengths.sum())], lengths, v)
    both = np.concatenate([inputs, targets], 1)
    parts = [both[at : at + 16].tobytes() for at in range(0, len(both), 16)]
    batch = pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], names=["rows"])
    tracemalloc.start()
    got = lm_scoring._counted_across([batch, batch.slice(0, 100)], v)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert batch.nbytes > both.nbytes and peak < both.nbytes
    rows = np.concatenate([both, both[:1600]])
    before, column = rows[:, attention.SPAN : attention.WINDOW].reshape(-1), rows[:, attention.WINDOW :].reshape(-1)
    want = collections.Counter((int(b), int(c)) for b, c in zip(before, column, strict=True) if c < v.continuing)
    assert {(r["before"], r["id"]): r["n"] for r in got.to_pylist()} == want


def test_folded_windows_are_the_same_windows():
    """What is written of a window is its own nine columns, whatever parts it falls in."""
    v = small_model().vocabulary
    rng = np.random.default_rng(6)
    lengths = rng.integers(1, 60, 90)
    inputs, targets, _ = attention.windows_of(v.column[rng.integers(0, 61, lengths.sum())], lengths, v)
    both = np.concatenate([inputs, targets], 1)
    for most in (1, 7, 10_000):
        parts = [p.tobytes() for p in attention.folded(inputs, targets, most)]
        assert (attention.unfolded(parts, v) == both).all()
        assert (attention.unfolded(parts[1:], v) == both[most:]).all()
    assert len(b"".join(parts)) < 0.4 * both.nbytes and attention.unfolded([], v).shape == (0, 24)


def test_attention_sees_every_training_text(spark, monkeypatch):
    """All windows of the texts that are not held out reach a trainer, in a corpus of thousands too."""
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a word "), F.col("id")).alias("text"))
    met = []
    real = lm_scoring._fit
    monkeypatch.setattr(lm_scoring, "_fit", lambda windows, *rest: met.append(windows.agg(F.sum("windows")).first()[0]) or real(windows, *rest))
    lm_scoring.train(docs, VOCABULARY, per_trainer=1 << 10, least_steps=2)
    # Every text here has fewer subwords than a window's half.
    assert met == [docs.where(~lm_scoring.held_out(F.col("doc_id"))).count()]


def test_nothing_to_learn_from(spark, nothing, edge):
    empty = lm_scoring.train(nothing, VOCABULARY, least_steps=2)
    assert lm_scoring.score(nothing, empty).count() == 0
    got = rows(lm_scoring.score(edge.select("doc_id", "text").where("doc_id IN (3, 12)"), empty))
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got} == {(1, 0, 0), (5, 0, 0)} and all(np.isfinite(r["score"]) for r in got)


def test_training_makes_held_out_texts_likelier(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    total = lambda steps: rows(lm_scoring.score(docs, lm_scoring.train(docs, VOCABULARY, least_steps=steps)).where("held_out").agg(F.sum("score").alias("s")))[0]["s"]
    assert total(150) > total(1)


def test_long_words_are_cut_whole():
    ids, sizes = lm_scoring.subwords(["a" * 1000, "", "é" * 65], VOCABULARY)
    pieces = {i: p for p, i in lm_scoring._encoding(VOCABULARY)[1].items()}
    text = b"".join(pieces[i] for i in ids[: sizes[0]])
    assert text == b" " + b"a" * 1000 and lm_scoring.beginnings(VOCABULARY)[ids[0]]
