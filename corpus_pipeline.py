"""From raw documents to token files: five operators, one after the other.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the next stage
gets what was written of it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tuneloom.llm import curriculum, decontaminate, neardup, rules, tokens
from tuneloom.llm.queries import byte_bpe, table
from tuneloom.llm.tables import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules or are depleted go; frequent lines of a
    source go from the others."""
    return rules.apply_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays."""
    return neardup.keep_one(docs)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontaminate.remove_affected(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, range-sorted by the curriculum."""
    return curriculum.training_order(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order in which the stage before wrote its rows, the
    curriculum's; returns doc_id, start, n_tokens and ids_crc32 as read from them.
    Rows that don't come from files are in ascending order of doc_id."""
    files = tokens.token_files(docs, byte_bpe(), order=tokens.written_order(docs))
    read = tokens.read_tokens(files)
    return read.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_overlap", benchmark_overlap),
    ("mixing", mixing),
    ("token_ids", token_ids),
]

#: No SQL: fingerprints and token ids are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
