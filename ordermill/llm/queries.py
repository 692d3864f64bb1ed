"""The corpus operators as registered queries: each runs its operator with
production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .chat import digests, format_chats, turn_events
from .common import table
from .decontaminate import contaminated
from .exact_dedup import exact_dedup
from .langid import document_evidence, identify, page_evidence, train
from .licenses import scan_licenses
from .mixing import select_mix
from .pii import find_pii
from .simhash import hex_fingerprint, simhash_components
from .spelling import spelling_variants
from .token_output import token_output
from .vafile import cluster_vectors
from .vamana import nearest_neighbours
from .warc import round_trip


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (sources as hosts) and pages (declared language, address and
    host) in one table; page p has doc_id -1 - p. The trigram tables are
    fitted on a bounded sample of the documents' labels."""
    docs = table(spark, sf_dir, "documents")
    rows = document_evidence(docs).unionByName(page_evidence(table(spark, sf_dir, "pages")))
    return identify(rows, train(docs, "lang")).drop("row_key")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    trap = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", trap), (-1, 1, "assistant", trap)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(format_chats(turn_events(turns.unionByName(extra))))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_fingerprint().alias("fingerprint"), "component_id")


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).drop("url")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_mix(table(spark, sf_dir, "documents")).drop("row_key")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language_id": op2_language_id,
    "op3_chat_format": op3_chat_format,
    "op4_simhash": op4_simhash,
    "op5_token_output": op5_token_output,
    "op6_warc": op6_warc,
    "op7_mixing": op7_mixing,
    "op8_pii": op8_pii,
    "op9_decontaminate": op9_decontaminate,
    "op10_licenses": op10_licenses,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}
