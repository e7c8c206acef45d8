"""Language identification by bit-sliced Bloom filters of letter n-grams.

One array of slots serves all languages: bit ``l`` of a slot belongs to language ``l``'s Bloom filter, so a lookup of an
n-gram's slots, joined by AND, returns the set of all languages that contain it as one bitmask. A text's n-grams are
counted per language (popcounts over the masks), each count is corrected for that filter's false positives, and the
largest corrected count decides.

Learning reads a bounded sample: about ``sample`` labelled texts, spread evenly over the languages by hash, of rows
whose crc32(doc_id as text) mod 3 is not 1. An n-gram belongs to a language if it makes up at least ``least`` of its
n-grams and is at least ``share`` as frequent there as in the language where it is most frequent. As shares add up to
one, a language has at most 1 / ``least`` of them, and the filter, sized by their number, is a few megabytes whatever
the corpus; every text is then read whole.

Defined results: ``und`` and score 0 if the text is null or has no letter, or if nothing could be learned; a text whose
n-grams no language knows gets the most common learned language and score 0; ties go to the more common language, then
to the smaller name; repeated rows get equal results; an empty table gives no rows; input columns named like an added
one are replaced. lang, source and doc_id are never inputs of a prediction.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import lean, text_slices, without
from tidewatch.llm.quality import held_out
from tidewatch.llm.shingles import mix
from tidewatch.session import materialise

ORDERS = (2, 3, 4)
PROBES = 2
UNKNOWN = "und"
_U = np.uint64
#: Per code point: 2 for a letter, 1 for a mark that goes with letters, 0 for all else.
_KIND = np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)], np.uint8)
_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram hashes, number of the text each is from, which texts have a letter).

    Letters are lower-cased and everything between words is one space; an n-gram may begin or end with that space but
    spans no second word.
    """
    lowered = [t.lower() for t in texts]
    code = np.frombuffer((" " + " \n ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, lowered), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), sizes + 3)[: len(code)]
    kind = _KIND[code]
    lettered = np.bincount(owner[kind == 2], minlength=len(texts)) > 0
    letter = kind > 0
    keep = letter | np.concatenate(([True], letter[:-1] | (owner[1:] != owner[:-1])))
    code, owner, letter = np.where(letter, code, 32)[keep].astype(np.uint64), owner[keep], letter[keep]
    hashes, owners = [], []
    for n in ORDERS:
        size = len(code) - n + 1
        if size <= 0:
            continue
        ok = owner[:size] == owner[n - 1 :]
        for k in range(1, n - 1):
            ok &= letter[k : k + size]
        ok &= letter[:size] | letter[n - 1 :] if n == 2 else True
        at = np.flatnonzero(ok)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h += (code[at + k] + _U(1)) * _PLACE[k]
        hashes.append(mix(h))
        owners.append(owner[at])
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate(owners) if owners else np.zeros(0, np.int64), lettered


@dataclass(frozen=True)
class Filters:
    """``slots``: languages' bits side by side, in as many 64-bit planes as needed; ``false_rate`` per language."""

    languages: tuple[str, ...]
    slots: np.ndarray
    false_rate: np.ndarray

    @staticmethod
    def build(languages: list[str], members: list[np.ndarray]) -> Filters:
        total = sum(map(len, members))
        size = 1 << max(16, int(np.ceil(np.log2(max(max(map(len, members), default=1) * 24, 1)))))
        kind = next((k for k, bits in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32)) if len(languages) <= bits), np.uint64)
        planes = np.zeros((max(1, -(-len(languages) // 64)), size if total else 1), kind)
        for l, found in enumerate(members):
            for at in _probes(found, planes.shape[1]):
                planes[l // 64, at] |= kind(1 << (l % 64))
        fill = [((planes[l // 64] >> kind(l % 64)) & kind(1)).mean() for l in range(len(languages))]
        return Filters(tuple(languages), planes, np.array(fill) ** PROBES)

    def counts(self, hashes: np.ndarray, owners: np.ndarray, texts: int) -> np.ndarray:
        """(texts, languages): n-grams a language contains, less those expected by chance."""
        n = np.bincount(owners, minlength=texts).astype(float)
        out = np.zeros((texts, len(self.languages)))
        probes = list(_probes(hashes, self.slots.shape[1]))
        for p, plane in enumerate(self.slots):
            mask = plane[probes[0]]
            for at in probes[1:]:
                mask &= plane[at]
            for l in range(64 * p, min(64 * p + 64, len(self.languages))):
                hit = ((mask >> plane.dtype.type(l % 64)) & plane.dtype.type(1)).astype(bool)
                rate = self.false_rate[l]
                out[:, l] = np.maximum((np.bincount(owners[hit], minlength=texts) - n * rate) / (1 - rate), 0) if rate < 1 else 0
        return out


def _probes(hashes: np.ndarray, size: int) -> Iterator[np.ndarray]:
    for k in range(PROBES):
        yield ((hashes >> _U(32 * k)) & _U(size - 1)).astype(np.int64)


def train(docs: DataFrame, sample: int = 8000, least: float = 2e-5, share: float = 0.05) -> Filters:
    """Learns the filters from ``docs`` (``doc_id``, ``text``, ``lang``)."""
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64(F.lit(5), "doc_id").alias("__h"))
    # One row per language.
    sizes = known.groupBy("lang").agg(F.count("*").alias("__n"))
    named = {r["lang"]: r["__n"] for r in sizes.collect()}
    if not named:
        return Filters.build([], [])
    languages = sorted(named, key=lambda k: (-named[k], k))
    number = F.element_at(F.create_map(*[F.lit(x) for k, name in enumerate(languages) for x in (name, k)]), F.col("lang"))
    rate = F.element_at(F.create_map(*[F.lit(x) for name in languages for x in (name, sample / len(languages) / named[name])]), F.col("lang"))
    picked = known.where(F.pmod(F.col("__h"), F.lit(1 << 30)) < rate * (1 << 30)).select(number.alias("l"), "text")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, 1):
                h, owner, _ = grams(batch.column(1).to_pylist())
                of = np.array(batch.column(0).to_pylist())[owner]
                for l in np.unique(of):
                    found, n = np.unique(h[of == l], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), l, np.int32)), pa.array(found.view(np.int64)), pa.array(n)], names=["l", "g", "n"])

    counted = materialise(picked.mapInArrow(run, "l int, g long, n long").groupBy("l", "g").agg(F.sum("n").alias("n")), "language-grams")
    # One row per language; a window would put all of a language's n-grams through one task.
    totals = {r["l"]: r["n"] for r in counted.groupBy("l").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return Filters.build(languages, [np.zeros(0, np.uint64) for _ in languages])
    part = F.col("n") / F.element_at(F.create_map(*[F.lit(x) for pair in totals.items() for x in pair]), F.col("l"))
    ranked = counted.withColumn("p", part).where(F.col("p") >= least)
    own = ranked.withColumn("top", F.max("p").over(Window.partitionBy("g"))).where(F.col("p") >= share * F.col("top"))
    # At most 1 / ``least`` n-grams of each language.
    rows = own.select("l", "g").toPandas()
    return Filters.build(languages, [rows["g"][rows["l"] == k].to_numpy(np.int64).view(np.uint64) for k in range(len(languages))])


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the winner's share of all languages' corrected counts)."""
    kept = without(docs, "lang_pred", "score")
    names = [*kept.columns, "lang_pred", "score"]
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # bounded by 1 / ``least`` and the number of languages

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for whole in batches:
            for batch in text_slices(whole, 0):
                texts = [t or "" for t in batch.column(0).to_pylist()]
                h, owner, lettered = grams(texts)
                count = known.counts(h, owner, len(texts))
                best = count.argmax(1) if known.languages else np.zeros(len(texts), int)
                sums = count.sum(1)
                score = np.divide(count.max(1, initial=0), sums, out=np.zeros(len(texts)), where=sums > 0)
                told = [known.languages[b] if ok and known.languages else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(told, pa.string()), pa.array(np.where(lettered, score, 0.0))], names=names)

    shape = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(docs["text"].cast("string").alias("__text"), *[F.col(f"`{c}`") for c in kept.columns]).mapInArrow(run, shape)
