"""A corpus pipeline: documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir), calls one operator of
``ordermill.llm`` and returns a DataFrame, which is written as Parquet and
reread as the next one's docs. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ordermill.llm.common import DOCUMENT_COLUMNS, keep_rows, materialise, row_key, table
from ordermill.llm.decontaminate import clean_rows
from ordermill.llm.langid import accepted_rows, train
from ordermill.llm.mixing import mix_rows
from ordermill.llm.simhash import simhash_components
from ordermill.llm.token_output import token_output


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language identifier rejects go. Its trigram tables
    are fitted on a bounded sample of the documents' own labels."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    return accepted_rows(docs, train(docs, "lang"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the smallest doc_id stays; of rows
    that share it, the one with the smallest hash of id and text, once."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    key = row_key("doc_id", "text")
    found = simhash_components(docs, key=key)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first")
    kept = found.groupBy("component_id").agg(first).select("first.doc_id", "first.row_key")
    return keep_rows(docs, kept, ("doc_id", "text"), once=True)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a benchmark item contaminates go."""
    return clean_rows(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights, once per epoch that takes them."""
    return mix_rows(docs.select(*DOCUMENT_COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and what reads back from them."""
    return token_output(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokens", tokens),
]

# Language identification and tokens have no SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
