import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, or from (doc_id, text) or (doc_id, text, source)."""

    def build(rows, parts=3):
        full = []
        for i, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (i, r)
            text, source = r[1], r[2] if len(r) > 2 else "a"
            full.append((r[0], text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return build


@pytest.fixture(scope="session")
def all_docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
