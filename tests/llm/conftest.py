from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture()
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) tuples."""
    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def corpus(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
