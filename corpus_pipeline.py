"""A training-data pipeline out of the operators in ``kinscore.llm``.

``STAGES`` are applied in order to ``documents``; each result is written as Parquet to the
shared checkpoint folder and read again, so every stage starts from a file and a lost executor
costs one stage at most. Every stage works on all rows of its predecessor; all but the last
return the columns of ``documents``. Nulls, empty and long texts, ties, repeated rows, empty tables
and extra columns have the results that the operators' modules state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinscore.llm.common import scratch_path, table
from kinscore.llm.quality_rules import accepted
from kinscore.llm.sentencepiece_codec import encoded
from kinscore.llm.simhash_dedup import first_of_group
from kinscore.llm.source_mixing import mix_sources
from kinscore.llm.substring_dedup import without_repeats


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that the rules reject."""
    return accepted(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return first_of_group(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that a document repeats from one with a smaller id are cut out of its text."""
    return without_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row for every time a document is taken."""
    return mix_sources(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the text as the ids give it back."""
    return encoded(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_dedup", simhash_stage),
    ("substring_dedup", substring_stage),
    ("source_mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

#: SimHash, the mixing draw and SentencePiece have no DuckDB equivalent; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
