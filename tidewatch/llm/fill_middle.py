"""Fill-in-the-middle transformation: a text is cut at two word units and its middle moved to the end.

A unit is a word with the white space before it; white space at the end of a text is a unit of its own. Units are found
eight bytes at a time: a slice's UTF-8 is viewed as 64-bit words, and whole-word arithmetic marks the top bit of every
byte that ends a unit (a byte that is no white space before one that is, or the last of its text). ``bitwise_count`` of
the marks, summed up, tells how many units end before any byte; a unit's end is found by searching the sums for its word
and then choosing the bit inside the word, again by arithmetic on all bytes at once. Code points are counted the same
way: they begin at every byte that does not continue another.

Every document's draws come from the SHA-256 of the seed and its doc_id: where to cut, whether to transform, and which
order the parts take. A text that already holds one of the marks, or is empty, stays as it is.

Defined results: a null text is empty; a null doc_id draws as the text "null"; rows that share a doc_id draw alike, each
on its own text; white space alone is one unit; a text of any length is cut whole; an empty table gives no rows; input
columns named like an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import lean, text_slices, without

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ADDED = ("n_units", "form", "prefix_chars", "middle_chars", "output")

_U = np.uint64
_ONES = _U(0x0101010101010101)
_TOP = _ONES << _U(7)
_LOW = ~_TOP


def _each(byte: int) -> np.uint64:
    return _ONES * _U(byte)


def _spaces(x: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is a blank or one of the controls 9 to 13."""
    low = x & _LOW
    control = (low + _each(0x80 - 9)) & ~(low + _each(0x80 - 14))
    blank = ~((low ^ _each(0x20)) + _LOW)
    return (control | blank) & ~x & _TOP


def _unit_ends(x: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The top bit of every byte that ends a unit; ``last`` are the places of the texts' last bytes."""
    space = _spaces(x)
    following = (space >> _U(8)) | (np.append(space[1:], _U(0)) << _U(56))
    ends = following & (space ^ _TOP)
    ends.view(np.uint8)[last] = 0x80
    return ends


class Marks:
    """Marked bytes of a buffer: how many stand before a place, and where the n-th stands."""

    def __init__(self, marks: np.ndarray):
        self.marks = np.append(marks, _U(0))
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)))

    def rank(self, place: np.ndarray) -> np.ndarray:
        word, inside = place >> 3, (place & 7).astype(_U)
        return self.before[word] + np.bitwise_count(self.marks[word] & ((_U(1) << (inside * _U(8))) - _U(1)))

    def select(self, n: np.ndarray) -> np.ndarray:
        """Places of the n-th marked bytes, counted from 1."""
        word = np.searchsorted(self.before, n, side="left") - 1
        left = (n - self.before[word]).astype(_U)
        # Byte b of the product holds how many of the bytes 0 to b are marked.
        sums = (self.marks[word] >> _U(7)) * _ONES
        reached = ((sums | _TOP) - left * _ONES) & _TOP
        return 8 * word + 8 - np.bitwise_count(reached).astype(np.int64)


def _bytes_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without nulls, offsets from 0, bytes filled up to whole 64-bit words."""
    kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
    _, ends, data = text.buffers()
    offsets = np.frombuffer(ends, kind)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    size = int(offsets[-1] - offsets[0])
    raw = np.zeros(-(-size // 8) * 8, np.uint8)
    if size:
        raw[:size] = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def cut(raw: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray):
    """(units, cut, cut, code points of prefix, of middle) of every text; a cut's number is taken modulo units + 1."""
    words = raw.view(_U)
    starts, stops = offsets[:-1], offsets[1:]
    ends = Marks(_unit_ends(words, stops[stops > starts] - 1))
    points = Marks(_TOP ^ (words & ~(words << _U(1)) & _TOP))
    base = ends.rank(starts)
    n = ends.rank(stops) - base
    a, b = first % (n + 1), second % (n + 1)
    place = lambda units: np.where(units > 0, ends.select(np.maximum(base + units, 1)) + 1, starts) if len(raw) else starts
    one, two = place(np.minimum(a, b)), place(np.maximum(a, b))
    at = [points.rank(p) for p in (starts, one, two)]
    return n, one, two, at[1] - at[0], at[2] - at[1]


def transform(docs: DataFrame, seed: int = 42, percent: int = 50, suffix_first: int = 80) -> DataFrame:
    """The columns of ``docs`` (``doc_id``, ``text``) with ``n_units``, ``form`` (plain, psm or spm), ``prefix_chars``,
    ``middle_chars`` (null if plain) and ``output``: ``percent`` of the texts are transformed, ``suffix_first`` percent
    of these with the suffix before the prefix."""
    kept = without(docs, *ADDED)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(docs["doc_id"].cast("string"), F.lit("null"))), 256)
    draws = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.conv(F.substring(drawn, 8 * k + 1, F.lit(8)), 16, 10).cast("long"))
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    stays = (text == "") | text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    named = docs.select(text.alias("__text"), draws.alias("__h"), *[F.col(f"`{c}`") for c in kept.columns], stays.alias("__stays"))
    form = F.when(F.col("__stays") | (F.col("__h")[2] % 100 >= percent), "plain").when(F.col("__h")[3] % 100 < suffix_first, "spm").otherwise("psm")
    source = named.select("__text", F.col("__h")[0].alias("__first"), F.col("__h")[1].alias("__second"), form.alias("__form"), *[F.col(f"`{c}`") for c in kept.columns])
    names = [*kept.columns, *ADDED]
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole):
                raw, offsets = _bytes_of(batch.column(0))
                first, second = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
                n, one, two, prefix, middle = cut(raw, offsets, first, second)
                data, forms, out = raw.tobytes(), batch.column(3).to_pylist(), []
                for form_, s, a, b, e in zip(forms, offsets[:-1].tolist(), one.tolist(), two.tolist(), offsets[1:].tolist(), strict=True):
                    if form_ == "plain":
                        out.append(data[s:e])
                    elif form_ == "psm":
                        out.append(b"".join((marks[0], data[s:a], marks[1], data[b:e], marks[2], data[a:b])))
                    else:
                        out.append(b"".join((marks[1], data[b:e], marks[0], data[s:a], marks[2], data[a:b])))
                plain = np.array([f == "plain" for f in forms], bool)
                added = [pa.array(n.astype(np.int64)), batch.column(3), pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain), pa.array(out, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*batch.columns[4:], *added], names=names)

    kinds = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())
    shape = T.StructType([*kept.schema.fields, *[T.StructField(c, k) for c, k in zip(ADDED, kinds, strict=True)]])
    return source.mapInArrow(run, shape)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from: a transformed text holds each mark exactly once."""
    parts = F.split(output, "<[PSM]>", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(parts[2], parts[3], parts[1]))
