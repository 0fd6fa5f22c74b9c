import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("text", T.StringType())]
)


@pytest.fixture
def documents(spark):
    """(doc_id, text) pairs as a documents table."""

    def make(*pairs, **extra):
        return spark.createDataFrame([(i, "src0", t) for i, t in pairs], SCHEMA)

    return make
