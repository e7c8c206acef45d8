import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = T.StructType().add("doc_id", T.LongType()).add("text", T.StringType()).add("lang", T.StringType()).add("source", T.StringType()).add("n_chars", T.LongType())
#: Columns that clash with what the operators add, with a column no operator knows, and with a map, which cannot be sorted.
CLASHES = "score predicted size shard slot kept labels n_words component_id sequence_id offset piece target taken lang_pred detections ids text_length".split()

PROSE = "the quick brown fox jumps over the lazy dog while seventeen patient gardeners water long rows of early beans and talk about rain "


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and blank texts, a very long one, equal rows, ties, clashing columns."""
    rows = [
        (1, PROSE * 3, "en", "a", 10), (2, PROSE * 3, "en", "a", 10), (2, PROSE * 3, "en", "a", 10), (3, None, "en", "b", None),
        (4, "", None, None, 0), (5, " \n\t ", "de", "b", 3), (6, "word", "de", "b", 4), (None, PROSE * 3, None, None, None),
        (None, None, None, None, None), (7, "Grüße ÉCOLE straße l’été \U0001f600 \x00 x", "fr", "c", 1), (8, PROSE * 4000, "en", "c", 1),
        (9, "\n".join(["same line again"] * 400), "en", "a", 1), (10, "12 34 !!! ### $$$", "es", "a", 1),
        (11, "Released under the MIT License.\nUNDER THE MIT LICENSE", "en", "a", 1), (12, "one two three four", "en", "a", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *[F.lit(-1).alias(c) for c in CLASHES], F.create_map(F.lit("k"), F.lit(1)).alias("extra"))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
