"""Registered queries of the training-data operators; each derives its contract's columns from its operator's result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import fill_middle, hard_negatives, host_rules, language, licenses, lm_scoring, mixing, near_dups, packing, quality, sharding, sql, style_tree, topk
from tidewatch.llm.common import table, text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def tokenizer_path() -> str:
    """The contract's vocabulary, from the package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_sum_of_squares")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), with_ids=False)
    return packing.pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op3_line_field")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, field)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op4_external_shuffle")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shards(table(spark, sf_dir, "documents"), count=40)
    return dealt.select(
        "doc_id", "size", F.crc32(text_of(dealt)).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_host_rules", sql.HOST_RULES)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.apply_rules(table(spark, sf_dir, "documents"), keep=["doc_id", "source"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op6_source_mix", sql.MIX)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.with_sizes(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


@query("op7_threshold_topk", sql.TOP_K)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op8_language_filters")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = language.identify(docs.select("doc_id", "text"), language.train(docs.select("doc_id", "text", "lang")))
    return told.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op9_style_tree")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


@query("op10_minhash_bayes", sql.NEAR_DUPS)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op11_shared_lists", sql.HARD_NEGATIVES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", told), F.col("vec_id") % 100 == 0)


@query("op12_fill_middle", sql.FILL_MIDDLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    again = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"),
    )


@query("op13_attention_score")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = lm_scoring.train(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return lm_scoring.score(docs, learned).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
