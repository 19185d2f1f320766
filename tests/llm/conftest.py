import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def documents(spark):
    """``documents`` of given texts, with extra columns under names that operators use."""
    schema = T.StructType(
        [T.StructField(n, T.LongType()) for n in ("doc_id", "n_words")]
        + [T.StructField(n, T.StringType()) for n in ("text", "row", "spans", "score")]
    )

    def make(rows, parts=3):
        return spark.createDataFrame([(i, 5, t, "r", "s", "x") for i, t in rows], schema).repartition(parts)

    return make
