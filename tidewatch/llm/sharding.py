"""Sharding by a two-pass external shuffle.

Pass one scatters records uniformly, by a seeded hash, into buckets that fit a task's memory; the exchange's files are
the external buckets. Pass two takes each bucket into memory, puts it in Fisher-Yates order (Spark's ``shuffle``) and
writes it to the shared folder. The buckets one after another are a uniform permutation of all records; shards are
equal stretches of it, so their row counts are at most one apart.

Defined results: a null text has no bytes; equal rows are dealt separately; an empty table gives no rows; input columns
named like an added one are replaced. A bucket's order depends on the seed and on which rows it holds, not on the order
in which they arrive. Rows are salted with their place in the scan, so that even a doc_id that fills a third of the
table spreads; reruns agree if the input is a table of files, which is what a lost executor's tasks read again.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import text_of, without
from tidewatch.session import materialise

ADDED = ("size", "shard", "slot")
#: More buckets than this would make their table of counts large; a larger input takes larger buckets.
MOST_BUCKETS = 1 << 20


def record_size(docs: DataFrame):
    """UTF-8 bytes of the text plus 16 for the rest of a record."""
    return (F.octet_length(text_of(docs)) + 16).cast("long")


def shuffled_buckets(docs: DataFrame, seed: int = 23, bucket_bytes: int = 8 << 20) -> tuple[DataFrame, int, int]:
    """The written table (``__bucket``, ``__pos``, columns of docs and ``size``), its rows and the number of buckets."""
    sized = without(docs, "size").withColumn("size", record_size(docs))
    total, rows = sized.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    buckets = max(1, min(MOST_BUCKETS, math.ceil(total / bucket_bytes)))
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.monotonically_increasing_id())
    scattered = (
        sized.select(key.alias("__key"), F.struct(*[F.col(f"`{c}`") for c in sized.columns]).alias("__row"))
        .withColumn("__bucket", F.pmod(F.col("__key"), F.lit(buckets)).cast("int"))
        .repartitionById(buckets, F.col("__bucket"))
    )
    # The order of arrival must not matter: sort by the key, then draw.
    by_key = lambda a, b: F.when(a["__key"] < b["__key"], -1).when(a["__key"] > b["__key"], 1).otherwise(0)
    bucket = scattered.groupBy("__bucket").agg(F.array_sort(F.collect_list(F.struct("__key", "__row")), by_key).alias("__all"))
    drawn = bucket.select("__bucket", F.posexplode(F.shuffle("__all", seed)).alias("__pos", "__one")).select("__bucket", "__pos", "__one.__row.*")
    return materialise(drawn, "shard-buckets"), rows, buckets


def shards(docs: DataFrame, count: int = 40, seed: int = 23, bucket_bytes: int = 8 << 20) -> DataFrame:
    """All rows of ``docs`` with ``size``, ``shard`` (0 to count - 1) and ``slot`` (their place in the shard, gapless from 0)."""
    table, rows, buckets = shuffled_buckets(without(docs, *ADDED), seed, bucket_bytes)
    # One row per bucket, MOST_BUCKETS at most: 16 MB.
    starts = table.groupBy("__bucket").agg(F.count("*").alias("__n"))
    starts = starts.select("__bucket", (F.sum("__n").over(Window.orderBy("__bucket")) - F.col("__n")).alias("__start"))
    place = F.col("__start") + F.col("__pos")
    placed = table.join(F.broadcast(starts), "__bucket").withColumn("__place", place)
    total = max(rows, 1)
    shard = F.expr(f"(__place * {count}L) div {total}L")
    placed = placed.withColumn("shard", shard.cast("int"))
    slot = F.col("__place") - F.expr(f"(cast(shard as bigint) * {total}L + {count - 1}L) div {count}L")
    return placed.withColumn("slot", slot).drop("__bucket", "__pos", "__start", "__place")


def write_shards(dealt: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order; the files of a shard follow one another by their first slot."""
    dealt.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
