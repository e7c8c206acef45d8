"""Quality by a linear-chain conditional random field over a text's lines.

Every line is good or bad; a line's features are its own and those of the lines beside it, and neighbouring labels are
tied by learned transitions. Training knows only documents, whose lines would never change sides, so it splices them: a
stretch of bad lines goes into a good one at a random line, or the other way round, until one kind is used up. Each
line keeps its document's label, and the field learns what a change looks like and how likely it is. A document's score
is the marginal probability of "good" over its lines (forward-backward), weighted by their length.

The field is fitted on a bounded sample: labelled documents of any length are cut into stretches of ``stretch`` lines,
and about ``sample`` stretches are drawn by hash, each with the same chance; scoring reads every text whole. Rows whose
crc32(doc_id as text) mod 3 is 1 are held out.

Defined results: a null or empty text is one empty line and gets that line's score; without labels of both kinds every
score is 0.5; repeated rows get equal scores and train once; an empty table gives no rows; labels without a document,
and null labels, are passed over; of several labels of one doc_id the smallest counts, and all texts of a doc_id train;
input columns named like an added one are replaced. doc_id, source and lang are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import lean, text_slices, without
from tidewatch.llm.lines import OWN, WIDTH, line_features, own_features, with_neighbours
from tidewatch.session import materialise

FOLDS, HELD_OUT = 3, 1


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


@dataclass(frozen=True)
class Field:
    """Good-against-bad weights of the features, and scores of the label pairs (bad, good) x (bad, good)."""

    weights: np.ndarray
    links: np.ndarray

    def marginals(self, features: np.ndarray, lines: np.ndarray) -> np.ndarray:
        return _forward_backward(_potentials(self.weights, features), self.links, lines)[0]


def _potentials(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    return features @ weights.astype(np.float32)


def _forward_backward(good: np.ndarray, links: np.ndarray, lines: np.ndarray, paired: bool = False):
    """P(good) per line; if ``paired`` also the log likelihoods and the expected label pairs.

    Texts run side by side, longest first, line by line. ``good`` is each line's score of "good", "bad" scores 0.
    """
    order = np.argsort(-lines, kind="stable")
    starts, longest = (np.cumsum(lines) - lines)[order], int(lines.max(initial=0))
    active = [int(np.searchsorted(-lines[order], -t, side="left")) for t in range(longest)]
    total = len(good)
    forward, backward = np.zeros((total, 2)), np.zeros((total, 2))
    local = np.stack([np.zeros(total), good], 1)
    for t in range(longest):
        now = starts[: active[t]] + t
        if t == 0:
            forward[now] = local[now]
        else:
            forward[now] = np.logaddexp(forward[now - 1, :1] + links[0], forward[now - 1, 1:] + links[1]) + local[now]
    for t in range(longest - 2, -1, -1):
        now = starts[: active[t + 1]] + t
        ahead = backward[now + 1] + local[now + 1]
        backward[now] = np.logaddexp(ahead[:, :1] + links[:, 0], ahead[:, 1:] + links[:, 1])
    both = forward + backward
    p = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -60, 60)))
    if not paired:
        return p, None, None
    z = np.logaddexp(both[:, 0], both[:, 1])
    pairs = np.zeros((2, 2))
    for t in range(1, longest):
        now = starts[: active[t]] + t
        joint = forward[now - 1, :, None] + links[None] + (backward[now] + local[now])[:, None, :]
        pairs += np.exp(joint - z[now][:, None, None]).sum(0)
    return p, z, pairs


def splice(stretches: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lines of each sequence, label of each line): stretches of opposite labels set into each other, each used once."""
    if not stretches:
        return np.zeros((0, WIDTH), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    draw = np.random.default_rng(seed)
    good, bad = draw.permutation(np.flatnonzero(labels == 1)), draw.permutation(np.flatnonzero(labels == 0))
    pairs = min(len(good), len(bad))
    rows, told = [], []
    for a, b in zip(good[:pairs], bad[:pairs], strict=True):
        outer, inner = (a, b) if draw.random() < 0.5 else (b, a)
        cut = int(draw.integers(0, len(stretches[outer]) + 1))
        rows += [stretches[outer][:cut], stretches[inner], stretches[outer][cut:]]
        told += [np.full(cut, labels[outer]), np.full(len(stretches[inner]), labels[inner]), np.full(len(stretches[outer]) - cut, labels[outer])]
    left = np.concatenate([good[pairs:], bad[pairs:]])
    rows += [stretches[k] for k in left]
    told += [np.full(len(stretches[k]), labels[k]) for k in left]
    lines = [len(stretches[a]) + len(stretches[b]) for a, b in zip(good[:pairs], bad[:pairs], strict=True)] + [len(stretches[k]) for k in left]
    counts = np.array(lines, np.int64)
    return with_neighbours(np.concatenate(rows), counts), counts, np.concatenate(told)


def fit(features: np.ndarray, lines: np.ndarray, labels: np.ndarray, steps: int = 300, rate: float = 0.1, shrink: float = 1e-3) -> Field:
    """Maximum likelihood of the lines' labels with Adam."""
    if len(np.unique(labels)) < 2:
        return Field(np.zeros(WIDTH), np.zeros((2, 2)))
    weights, links = np.zeros(features.shape[1]), np.zeros((2, 2))
    inner = np.ones(len(labels), bool)
    inner[np.cumsum(lines) - lines] = False
    at = np.flatnonzero(inner)
    seen = np.bincount(2 * labels[at - 1] + labels[at], minlength=4).reshape(2, 2).astype(float)
    state = np.zeros((2, features.shape[1] + 4))
    for k in range(1, steps + 1):
        p, _, pairs = _forward_backward(_potentials(weights, features), links, lines, paired=True)
        gradient = np.concatenate([features.T @ (labels - p) / len(labels) - shrink * weights, ((seen - pairs) / len(labels) - shrink * links).ravel()])
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.999 * state[1] + 0.001 * gradient**2
        move = rate * (state[0] / (1 - 0.9**k)) / (np.sqrt(state[1] / (1 - 0.999**k)) + 1e-8)
        weights, links = weights + move[:-4], links + move[-4:].reshape(2, 2)
    return Field(weights, links)


def train(docs: DataFrame, labels: DataFrame, sample: int = 4000, stretch: int = 300) -> Field:
    """Fits the field; about ``sample`` stretches of at most ``stretch`` lines come to the driver, as line features."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").cast("int").alias("__quality"))
    text = docs.select(F.col("doc_id").alias("__id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    ends = F.octet_length("__text") - F.octet_length(F.replace("__text", F.lit("\n"), F.lit("")))
    sizes = text.groupBy("__id").agg(F.max(F.floor(ends / stretch) + 1).alias("__parts"))
    sizes = materialise(known.join(sizes, "__id"), "labelled-stretches")
    # By a hash threshold, not by order: no partition sends more than its share.
    share = min(1.0, sample / max(sizes.agg(F.sum("__parts")).first()[0] or 1, 1))
    drawn = F.filter(F.sequence(F.lit(0), F.col("__parts") - 1), lambda k: F.pmod(F.xxhash64(F.lit(31), "__id", k), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    # About ``sample`` numbers in all.
    picked = sizes.select("__id", "__quality", drawn.alias("__drawn")).where(F.size("__drawn") > 0)
    chosen = text.join(F.broadcast(picked), "__id").select("__text", "__id", "__quality", "__drawn")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for some in text_slices(whole):
                x, _, lines = own_features(some.column(0).to_pylist())
                starts = np.cumsum(lines) - lines
                cuts = [(i, k) for i, drawn in enumerate(some.column(3).to_pylist()) for k in drawn if k * stretch < lines[i]]
                rows = [x[starts[i] + k * stretch : starts[i] + min((k + 1) * stretch, lines[i])].tobytes() for i, k in cuts]
                of = pa.array([i for i, _ in cuts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [some.column(1).take(of), some.column(2).take(of), pa.array([k for _, k in cuts], pa.int64()), pa.array(rows, pa.binary())],
                    names=["id", "quality", "at", "x"],
                )

    shape = T.StructType([T.StructField("id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL("quality int, at long, x binary").fields])
    rows = chosen.mapInArrow(run, shape).dropDuplicates().orderBy("id", "at", "x").collect()
    stretches = [np.frombuffer(r.x, np.float32).reshape(-1, len(OWN)) for r in rows]
    return fit(*splice(stretches, np.array([r.quality for r in rows], np.int64)))


def score(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    kept = without(docs, "score", "predicted")
    names = [*kept.columns, "score"]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole):
                x, size, lines = line_features(batch.column(0).to_pylist())
                p = field.marginals(x, lines)
                weight = np.maximum(size, 1)
                starts = np.cumsum(lines) - lines
                scores = np.clip(np.add.reduceat(p * weight, starts) / np.add.reduceat(weight, starts), 0, 1) if len(lines) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores, pa.float64())], names=names)

    shape = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).alias("__text")
    out = docs.select(text, *[F.col(f"`{c}`") for c in kept.columns]).mapInArrow(run, shape)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
