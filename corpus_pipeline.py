"""Pipeline over `documents`: quality rules, near-duplicates, repeated passages, secrets, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import drop_tables, own_tables, unused, written
from gleanery.llm.jaccard_join import near_duplicates_dropped
from gleanery.llm.packing import pack_documents
from gleanery.llm.quality import quality
from gleanery.llm.secrets import redact_secrets
from gleanery.llm.suffix_dedup import repeats_removed
from gleanery.sources.files import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the perplexity bands keep. A verdict holds for all rows of its id, language and
    text; rows with a null id are judged with the others, by language and text."""
    key = unused(docs, "_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string")))
    figures = quality(keyed.select(F.col(key).alias("doc_id"), "lang", "text"))
    gone = written(figures.filter("not kept").select(F.col("doc_id").alias(key)).distinct(), "rejected")
    return keyed.join(gone, key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of 5-word shingles are similar by 0.8 or more."""
    return near_duplicates_dropped(docs, shingle=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of any 200-byte string that occurs twice."""
    return repeats_removed(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in windows of 4096 tokens."""
    return pack_documents(docs, memo_words=150_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("secret scans", secret_scan),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's output is written as Parquet in the shared folder and read again, and then the
    tables that the stage wrote on its way are dropped."""
    docs = table(spark, f"{sf_dir}/documents.parquet")
    with own_tables():
        tables = 0
        for k, (_, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if k < len(STAGES) - 1:
                docs = written(docs, "stage")
                tables = drop_tables(spark, tables) - 1
    return docs


#: Perplexity, suffix arrays and tokenisation are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
