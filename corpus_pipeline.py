"""A training corpus from raw documents: five stages, each stored before the next one reads it.

Every stage takes all rows that the one before kept. All but the last return
the columns of `documents`; where a stage changes a text, `n_chars` follows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm.decontaminate import decontaminate
from zoneflow.llm.packing import pack_documents
from zoneflow.llm.pii import sanitise
from zoneflow.llm.similarity import one_per_group
from zoneflow.llm.text import table
from zoneflow.llm.toxicity import drop_toxic
from zoneflow.session import write_table


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional language models do not hold for toxic."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % of five-word shingles, the one with the smallest id."""
    return one_per_group(docs, width=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their benchmark passages; mostly benchmark text goes whole."""
    return _recounted(decontaminate(docs, table(spark, sf_dir, "benchmark"), width=10))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and revealing terms generalised."""
    return _recounted(sanitise(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 1024."""
    return pack_documents(docs, capacity=1024)


STAGES = [("toxicity", toxicity), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", benchmark_passages),
          ("pii", personal_data), ("packing", packing)]

# The language models and the tokenizer have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
