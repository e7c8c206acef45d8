"""Deterministic hashes that other systems compute the same way."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FNV_OFFSET = 2166136261
FNV_PRIME = 16777619
UINT32 = 2**32


def fnv1a32(text: Column) -> Column:
    """32-bit FNV-1a over the UTF-8 bytes, as a non-negative BIGINT."""
    digits = F.hex(F.encode(text, "UTF-8"))
    octets = F.transform(
        F.filter(F.split(F.regexp_replace(digits, "(..)", "$1,"), ","), lambda h: h != ""),
        lambda h: F.conv(h, 16, 10).cast("long"),
    )
    return F.aggregate(octets, F.lit(FNV_OFFSET), lambda h, b: F.pmod(h.bitwiseXOR(b) * FNV_PRIME, F.lit(UINT32)))


def cohort(key: Column, buckets: int = 100) -> Column:
    """Stable bucket 0 .. buckets-1 of a key."""
    return F.pmod(fnv1a32(key), F.lit(buckets))


def hash_fraction(key: Column) -> Column:
    """Stable value in [0, 1) of a key."""
    return fnv1a32(key) / F.lit(float(UINT32))
