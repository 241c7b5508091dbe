import pytest
from pyspark.sql import functions as F

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows."""
    def make(rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def clashing(spark):
    """The same rows with extra columns whose names operators might use themselves."""
    def add(df):
        for c in ("node", "key", "size", "row", "take", "part", "rank", "score", "n", "bytes", "version", "numbers", "words"):
            df = df.withColumn(c, F.lit("x"))
        return df

    return add

