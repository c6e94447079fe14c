import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for what they add.
        T.StructField("kept", T.StringType()),
        T.StructField("items", T.StringType()),
        T.StructField("n_words", T.StringType()),
        T.StructField("weight", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns that clash."""

    def make(*rows):
        full = [(*r, *([None] * (4 - len(r)))) for r in rows]
        return spark.createDataFrame([(i, t, g, s, len(t or ""), "k", "i", "w", "x") for i, t, g, s in full], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and very long texts, ties and repeated rows."""
    words = " ".join(f"w{k}" for k in range(60))
    return make_docs(
        (1, None),
        (2, ""),
        (3, "  \n\t "),
        (4, "one two"),
        (5, "One TWO"),
        (6, words),
        (6, words),
        (7, words + " extra"),
        (None, words),
        (8, "x" * 300_000),
        (9, "word " * 40_000),
        (10, "line a b c d e f g h i j\nline two of it\n\nend\n" * 3),
    )


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def tables(spark, small):
    return lambda name: spark.read.parquet(f"{small}/{name}.parquet")
