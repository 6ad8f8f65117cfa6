"""The training-data pipeline: quality rules, one document per group of near
duplicates, removal of repeated passages, mixing of sources, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and reread as the next
one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landfall.llm import byte_bpe, jaccard_join, mixing, quality_rules, suffix_dedup
from landfall.llm.common import Scratch
from landfall.llm.queries import bpe_files


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is high enough; the others go."""
    return quality_rules.keep_good(spark, docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents."""
    return jaccard_join.one_of_each_group(spark, docs)


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 200-byte strings that start anywhere else too."""
    return suffix_dedup.remove_repeats(spark, docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as often as their source's target takes them."""
    return mixing.mix_documents(spark, docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each mixed document."""
    return byte_bpe.digests(docs, *bpe_files())


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("suffix-array dedup", repeated_passage_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE encoding and decoding", token_stage),
]

# Suffix arrays and byte-level BPE cannot be written in SQL; tests/llm holds
# run() against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark, "pipeline") as scratch:
        for name, stage in STAGES:
            docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"), result=name == STAGES[-1][0])
        return docs
