import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture()
def docs(spark):
    """Documents from (doc_id, text[, lang, source]) rows, prepared session."""
    from tidemark.llm.common import prepare

    prepare(spark)

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture()
def odd(docs):
    """Nulls in every column, empty and blank texts, ties, repeated rows, a
    very long text, and extra columns whose names clash with internals."""
    from pyspark.sql import functions as F

    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "one two"), (5, "one two"), (5, "other words here"),
            (None, "a b c d e f g h"), (None, None), (6, "é ü " * 30_000), (7, "x", None, None), (8, "Σ ﬁ İ ǆ <|endoftext|> don't!! 'S", "de", None)]
    df = docs(rows)
    for name in ("node", "root", "size", "part", "place", "h", "row_key", "score", "stats", "held_out", "spans", "item", "blk", "own_row_key", "copies"):
        df = df.withColumn(name, F.lit(7))
    return df
