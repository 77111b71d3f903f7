import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def documents(spark):
    """Make a documents table of (doc_id, text[, lang[, source]]) tuples."""
    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)
    return make
