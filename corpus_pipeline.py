"""From documents to packed training sequences: the stages in order, each written and read again."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import host_rules, mixing, near_dups, packing, quality
from tidewatch.llm.common import table
from tidewatch.llm.plans import tokenizer_path
from tidewatch.session import discard, few_files, materialise, recorded_scratch, ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: What the stage before has in the scratch folder.
_LEFT: list[str] = []


def _stage(fn: Stage) -> Stage:
    """A stage's operators leave written tables that its result reads. Once the next stage is called on a result that has
    been written and read again, they go; a result that still reads them keeps them."""

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        read = docs.inputFiles()
        if not any(path in file for path in _LEFT for file in read):
            discard(spark, *_LEFT)
            _LEFT.clear()
        with recorded_scratch() as paths, few_files(spark) as files:
            out = fn(spark, docs, sf_dir)
        _LEFT.extend(paths)
        return out.coalesce(files)

    return run_stage


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the line field calls good."""
    field = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, field).where("predicted = 1").select(*docs.columns)


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their own rules and whose host does."""
    return host_rules.apply_rules(docs).where("kept").select(*docs.columns)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of smallest doc_id; equal rows once."""
    return near_dups.deduplicated(docs)


@_stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks, up to twice."""
    return mixing.emit(mixing.mix(mixing.with_sizes(docs))).select(*docs.columns)


@_stage
def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token pieces with their places in sequences of 4096 tokens."""
    return packing.pack(packing.pieces(docs, tokenizer_path()))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("sequence_packing", sequence_packing),
]
#: Line marginals and token ids cannot be expressed in SQL; tests/llm holds every stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
