"""Best-fit packing of documents into sequences by the sum-of-squares rule.

A document's tokens and one end token are cut into pieces of at most ``capacity``; a piece goes into the open sequence,
or a new one, that makes the sum of N(h) * N(h) smallest, N(h) being the number of open sequences filled to h. Full
sequences are closed. The rule keeps the open sequences' gaps varied, so that a fitting gap is at hand for later pieces.

Pieces are dealt by hash into groups of about ``group_rows``; a group (piece numbers and lengths only) is packed in one
task, longest pieces first. A group leaves a few sequences open, out of tens of thousands. Token ids never pass through
a group.

Defined results: a null or empty text is one piece holding only the end token; equal rows are packed each for itself;
an empty table gives no rows; input columns named like an added one are replaced. Only documents longer than a sequence
are cut. The tokenizer is a parameter and is read on the executors from a path all of them have.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import lean, without
from tidewatch.session import materialise

CAPACITY = 4096
END = 1
PIECE = ("piece_id", "piece", "start", "length", "ids", "ids_crc32")
PLACE = ("sequence_id", "offset")
#: Where a text may be cut without changing its tokens: at spaces and line ends, and behind a run of Latin letters that
#: an ASCII mark other than an apostrophe follows. Such parts recur, so each worker keeps the tokens of so many, in two
#: generations: parts of the older one that are met again move to the younger, the rest goes when the younger is full.
_PART = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[ \n.,!$%&*#;:?)\"])|[^ \n]+")
_KEPT = 150_000
#: A part of nothing but Latin letters is one word to the tokenizer; its model can be asked without the steps before it.
_LETTERS = re.compile(r"[a-zà-öø-ÿ]+").fullmatch
_TOKENS: dict[str, tuple[object, dict[str, bytes], dict[str, bytes]]] = {}


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    letter = {b: chr(b) if b in plain else chr(next(other)) for b in range(256)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(128, 256)}


_BYTES = _byte_letters()


def _word_by_word(tokenizer) -> bool:
    """Whether the model alone gives the tokenizer's ids for words of letters."""
    probe = ["word", "unheardof", "é", "straße", "ciónñandü", "a"]
    alone = [[t.id for t in tokenizer.model.tokenize(p.translate(_BYTES))] for p in probe]
    return alone == [tokenizer.encode(p, add_special_tokens=False).ids for p in probe]


def _encoder(path: str):
    """``encode(texts)``: each text's ids as little-endian 32-bit bytes."""
    from tokenizers import Tokenizer

    if path not in _TOKENS:
        _TOKENS[path] = (Tokenizer.from_file(path), {}, {})
    tokenizer = _TOKENS[path][0]
    word = tokenizer.model.tokenize if _word_by_word(tokenizer) else None

    def encode(texts: list[str]) -> Iterator[bytes]:
        parts = [_PART.findall(t.lower() if t.isascii() and "<|" not in t else t) for t in texts]
        _, known, old = _TOKENS[path]
        if len(known) > _KEPT:
            known, old = {}, known
            _TOKENS[path] = (tokenizer, known, old)
        rest = []
        for part in set().union(*parts).difference(known):
            if part in old:
                known[part] = old[part]
                continue
            low = part.lower()
            if word and _LETTERS(low):
                known[part] = array("I", [t.id for t in word(low if low.isascii() else low.translate(_BYTES))]).tobytes()
            else:
                rest.append(part)
        for part, found in zip(rest, tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            known[part] = array("I", found.ids).tobytes()
        for p in parts:
            yield b"".join(map(known.__getitem__, p))

    return encode


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = True) -> DataFrame:
    """One row per piece: the columns of ``docs`` but ``text``, and ``piece_id``, ``piece``, ``start``, ``length``,
    ``ids`` (unless told otherwise) and ``ids_crc32``. ``piece_id`` is unique once the result is written."""
    kept = without(docs, *PIECE, "text")
    names = kept.columns + [c for c in PIECE if with_ids or c != "ids"]
    tail = np.array([end], "<u4").tobytes()

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path)
        serial = TaskContext.get().partitionId() << 33
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                row, piece, start, parts = [], [], [], []
                for n, ids in enumerate(encode(batch.column(0).to_pylist())):
                    ids += tail
                    for k, cut in enumerate(range(0, len(ids), 4 * capacity)):
                        row.append(n)
                        piece.append(k)
                        start.append(k * capacity)
                        parts.append(ids[cut : cut + 4 * capacity])
                lengths = np.array([len(p) // 4 for p in parts], np.int64)
                added = [pa.array(np.arange(serial, serial + len(parts))), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(lengths)]
                serial += len(parts)
                if with_ids:
                    ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
                    added.append(pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(parts), "<i4")))
                added.append(pa.array([zlib.crc32(p) for p in parts], pa.int64()))
                same = [c.take(pa.array(row)) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays(same + added, names=names)

    shape = T.StructType(list(kept.schema.fields))
    for name, kind in zip(PIECE, (T.LongType(), T.IntegerType(), T.LongType(), T.LongType(), T.ArrayType(T.IntegerType()), T.LongType()), strict=True):
        if name in names:
            shape.add(name, kind)
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).alias("__text")
    return docs.select(text, *[F.col(f"`{c}`") for c in kept.columns]).mapInArrow(run, shape)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, in the order given; sequences are numbered from 0."""
    open_ = [[] for _ in range(capacity + 1)]
    counts = np.zeros(capacity + 1, np.int64)
    place, offset, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for k, s in enumerate(lengths.tolist()):
        # Change of the sum: a sequence at h goes to h + s; at the capacity it is closed and counts no more.
        change = counts[s:] - counts[: capacity + 1 - s]
        change[-1] = -counts[capacity - s]
        change[counts[: capacity + 1 - s] == 0] = np.iinfo(np.int64).max >> 2
        h = len(change) - 1 - int(np.argmin(change[::-1]))  # of equals the fullest
        best = 2 * change[h] + (2 if h + s < capacity else 1)
        if s < capacity and best > 2 * counts[s] + 1 or s == capacity or counts[h] == 0:
            h, number = 0, made
            made += 1
        else:
            number = open_[h].pop()
            counts[h] -= 1
        place[k], offset[k] = number, h
        if h + s < capacity:
            open_[h + s].append(number)
            counts[h + s] += 1
    return place, offset


def pack(cut: DataFrame, capacity: int = CAPACITY, group_rows: int = 200_000) -> DataFrame:
    """All rows of ``cut`` (``piece_id`` unique, ``length``, any others) with ``sequence_id`` and ``offset``.

    A piece that fills a sequence gets one of its own without being dealt to a group.
    """
    cut = materialise(without(cut, *PLACE), "pack-pieces")
    part = cut.where(F.col("length") < capacity).select("piece_id", F.col("length").cast("int").alias("length"))
    groups = max(1, ceil(part.count() / group_rows))
    group = F.pmod(F.xxhash64("piece_id"), F.lit(groups)).cast("long").alias("group")

    def run(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values(["length", "piece_id"], ascending=[False, True])
        place, offset = sum_of_squares(x["length"].to_numpy(), capacity)
        return pd.DataFrame({"piece_id": x["piece_id"].to_numpy(), "sequence_id": (int(key[0]) << 32) + place, "offset": offset})

    packed = part.withColumn("group", group).groupBy("group").applyInPandas(run, "piece_id long, sequence_id long, offset long")
    packed = materialise(packed, "pack-places")
    # Sequences of their own are numbered below zero.
    alone = F.col("length") >= capacity
    placed = cut.join(packed, "piece_id", "left")
    return placed.withColumn("sequence_id", F.when(alone, -1 - F.col("piece_id")).otherwise(F.col("sequence_id"))).withColumn("offset", F.coalesce("offset", F.lit(0)))


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed token sequences themselves."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(inside, lambda x: x["ids"])).alias("ids"))
