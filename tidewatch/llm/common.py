"""What the training-data operators share: reading the given tables, safe column handling, word counts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import ship

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns an operator is about to add; Spark compares names without case, so this does too."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def text_of(df: DataFrame, column: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def hex_number(text: Column, digits: int = 8) -> Column:
    """The first hexadecimal digits of a text's MD5 as a number: a seeded hash that any SQL engine can repeat."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def release() -> None:
    """Hand memory that is free back to the system; Python workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that leaves no freed memory behind when its task ends."""

    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def text_slices(batch, column: int = 0, most: int = 1 << 20):
    """An Arrow batch in slices of about ``most`` characters of a text column, so that long texts do not pile up."""
    at, held = 0, 0
    for k, n in enumerate(pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_pylist()):
        if held and held + n > most:
            yield batch.slice(at, k - at)
            at, held = k, 0
        held += n
    if at < batch.num_rows:
        yield batch.slice(at)
