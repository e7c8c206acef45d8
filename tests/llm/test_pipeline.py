"""The pipeline's stages against what their operators must leave, and the queries' shapes."""

import __spark_entry__ as entry
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from test_pairs import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tiny, tmp_path_factory):
    docs, out = spark.read.parquet(f"{tiny}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, tiny).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return spark.read.parquet(f"{tiny}/documents.parquet"), out


def ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def test_stages(stages):
    first, (scored, ruled, single, mixed, packed) = stages
    assert [s.columns for s in (scored, ruled, single, mixed)] == [COLUMNS] * 4
    assert set(ids(ruled)) < set(ids(scored)) < set(ids(first))
    want = brute([(r.doc_id, r.text) for r in ruled.select("doc_id", "text").collect()])
    assert sorted(ids(single)) == sorted({c for _, c in want.values()})
    copies = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(copies) <= set(ids(single)) and set(copies.values()) <= {1, 2}
    assert packed.where("piece = 0").count() == mixed.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 4096


def test_queries_are_registered(spark, tiny):
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert len(names) == 14 and set(entry.oracle_sql()) <= set(entry.queries())


def test_pipeline_of_no_documents(spark, nothing, tiny):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tiny)
    assert docs.count() == 0


def test_stages_take_clashing_columns_and_repeated_rows(spark, edge, tiny):
    """Every row of the edge cases twice, beside documents the classifier can learn from."""
    whole = spark.read.parquet(f"{tiny}/documents.parquet").where("doc_id > 20").withColumn("doc_id", F.col("doc_id").cast("long"))
    docs = edge.unionByName(edge).unionByName(whole, allowMissingColumns=True)
    names, kept = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tiny)
        if name != "sequence_packing":
            assert docs.columns == names
        if name == "near_duplicates":
            kept = docs.where("doc_id IS NOT NULL").groupBy("doc_id", "text").count().where("count > 1").count()
    assert kept == 0 and docs.count() > 0
