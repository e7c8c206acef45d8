"""Mixing sources to target weights by systematic sampling.

A source's target is a number of words. Every document of a source expects ``target / source size`` copies; documents
stand in one line per source, the expected copies are summed along it, one random offset is added, and a document is
emitted once for each whole number its stretch of the sum crosses. A document therefore gets the floor or the ceiling
of its expected copies. The line runs by size class, so each class is sampled at the same rate and the words taken
come within about one document of the target.

The sum along a source is taken in two levels, so a source with a third of all rows is no single task: the line is cut
by (size class, hash slice) into slices of about ``slice_rows`` rows, slices are counted and their counts summed, and
only inside a slice are rows ranked.

Defined results: a null text has size 0; rows without words are taken with the same rate (0 words); a null source is a
source of its own, last in order; equal rows are interchangeable; an empty table gives an empty mix. Input columns
named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import hex_number, text_of, without, word_count
from tidewatch.session import materialise

ADDED = ("source_size", "target", "copies", "taken")
INNER = ("__span", "__head", "__hash", "__n", "__slices", "__slice", "__before", "__rate", "__offset", "__rank")


def with_sizes(docs: DataFrame) -> DataFrame:
    """Adds ``size``: the number of words of the text."""
    return without(docs, "size").withColumn("size", word_count(text_of(docs)))


def source_targets(sizes: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (5, 2, 1), ceiling: float = 2.0) -> DataFrame:
    """(source, source_size) to (source, source_size, target): words to take from each source.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of all words; a target stops
    at ``ceiling`` times its source and the excess goes to the others by weight. That fixed point is a water level:
    ``target = least(cap, level * weight)``, found in one pass over the sources by rising cap per weight.
    The two windows hold one row per source, never documents.
    """
    line = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("__ratio", "__place")
    everything = Window.partitionBy()
    ranked = (
        sizes.withColumn("__place", F.row_number().over(line))
        .withColumn("__weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("__place") - 1) % len(weights) + 1).cast("int")))
        .withColumn("__cap", F.lit(float(ceiling)) * F.col("source_size"))
        .withColumn("__ratio", F.col("__cap") / F.col("__weight"))
        .withColumn("__budget", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("__capped", F.sum("__cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__cap"))
        .withColumn("__open", F.sum("__weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("__level", (F.col("__budget") - F.col("__capped")) / F.col("__open"))
    )
    level = F.min(F.when(F.col("__level") <= F.col("__ratio"), F.struct("__ratio", "__place", "__level"))).over(everything)["__level"]
    target = F.least(F.col("__cap"), F.coalesce(level * F.col("__weight"), F.col("__cap")))
    return ranked.select("source", "source_size", target.alias("target"))


def _offset(seed: int) -> Column:
    """The source's random offset in [0, 1)."""
    name = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    return hex_number(F.concat(F.lit(f"{seed}|"), name)) / F.lit(float(2**32))


def mix(
    docs: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (5, 2, 1), ceiling: float = 2.0, seed: int = 17, slice_rows: int = 100_000,
) -> DataFrame:
    """All rows of ``docs`` (``doc_id``, ``source``, ``size``, any others) with ``source_size``, ``target``, ``copies``, ``taken``.

    ``copies`` is how often the mix holds the row, at most ``ceil(ceiling)``; ``taken = copies * size``. Which rows get
    the extra copy depends on ``doc_id``, ``size`` and ``seed`` alone, so reruns agree.
    """
    binary = F.bin(F.col("size"))
    keyed = without(docs, *ADDED, *INNER).withColumns({
        "__span": F.length(binary), "__head": F.substring(binary, 1, 3),
        "__hash": hex_number(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("n")))),
    })
    keyed = materialise(keyed, "mix-keyed")
    cell = ["source", "__span", "__head"]
    cells = materialise(keyed.groupBy(*cell).agg(F.count("*").alias("__n"), F.sum("size").alias("__words")), "mix-cells")
    targets = source_targets(cells.groupBy("source").agg(F.sum("__words").alias("source_size")), share, weights, ceiling)
    plan = materialise(
        _null_safe(cells.withColumn("__slices", F.ceil(F.col("__n") / slice_rows)), targets, ["source"])
        .withColumn("__rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("__offset", _offset(seed)).drop("__n", "__words"),
        "mix-plan",
    )
    sliced = _null_safe(keyed, plan, cell).withColumn("__slice", F.floor(F.col("__hash") * F.col("__slices") / F.lit(2**32)))
    piece = [*cell, "__slice"]
    along = Window.partitionBy("source").orderBy("__span", "__head", "__slice")
    counts = sliced.groupBy(*piece).agg(F.count("*").alias("__n"))
    starts = materialise(counts.withColumn("__before", F.sum("__n").over(along) - F.col("__n")).drop("__n"), "mix-starts")
    inside = Window.partitionBy(*piece).orderBy("__hash", F.col("doc_id").asc_nulls_last(), "size")
    ranked = _null_safe(sliced.withColumn("__rank", F.row_number().over(inside)), starts, piece).withColumn("__rank", F.col("__rank") + F.col("__before"))
    reached = lambda rank: F.floor(F.col("__rate") * rank + F.col("__offset"))
    copies = reached(F.col("__rank")) - reached(F.col("__rank") - 1)
    mixed = ranked.withColumn("copies", copies.cast("int")).withColumn("taken", F.col("copies") * F.col("size"))
    return without(mixed, *INNER)


def emit(mixed: DataFrame) -> DataFrame:
    """One row per copy; rows with no copy go."""
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mixed.where(F.col("copies") > 0).withColumn("__copy", copies).drop("__copy")


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys meet; the right side's key columns go."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") if k in keys else F.col(k) for k in right.columns])
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(renamed, on).drop(*[f"__r_{k}" for k in keys])
