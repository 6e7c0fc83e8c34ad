"""The corpus pipeline: quality rules, exact dedup, near-dedup, mixing to
target weights, tokenisation.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet and gives it, read again, to the next stage. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm.exact_dedup import drop_exact_copies
from tidemark.llm.mixing import materialise_mix
from tidemark.llm.near_dedup import drop_near_copies
from tidemark.llm.quality import keep_good
from tidemark.llm.queries import QUERIES, tokenizer_path
from tidemark.llm.sentencepiece_codec import token_digests
from tidemark.llm.sql import SQL
from tidemark.session import ensure_checkpoint_root, scratch_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' posterior keeps."""
    return keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id."""
    return drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as the mix takes it, whole passes first."""
    return materialise_mix(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of every document of the mix."""
    return token_digests(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]

# EM, min-max hashing and the tokenizer have no SQL form; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ensure_checkpoint_root(spark)
    for name, stage in STAGES[:-1]:
        out = scratch_folder(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)


LLM_QUERIES = {**QUERIES, "pipeline": run}
LLM_SQL = dict(SQL)
