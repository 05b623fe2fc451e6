import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
])


@pytest.fixture
def make_docs(spark):
    """documents of (doc_id, text) pairs; extra columns have names that operators use inside."""

    def make(pairs):
        rows = [(i, t, None, None, None if t is None else len(t)) for i, t in pairs]
        df = spark.createDataFrame(rows, DOCS)
        return df.selectExpr("*", "'x' AS key", "1 AS part", "2 AS rank", "'y' AS label", "0.5D AS _p")

    return make
