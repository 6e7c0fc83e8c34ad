"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_root

_MOVING = re.compile(r"(?m)^[\s:+|*()\d-]*(?:Exchange|Sort|Coalesce|Sample|\w*Limit|TakeOrdered|\w+Join|Union)")
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; NULL becomes empty. Pure ASCII text takes the fast
    built-in; only other text needs the character table."""
    t = text_or_empty(text)
    return (F.when(F.length(t) == F.octet_length(t), F.lower(t))
            .otherwise(F.translate(t, string.ascii_uppercase, string.ascii_lowercase)))


def word_count(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder once and read it from
    there: the lineage ends, so a lost executor never repeats the work before."""
    ensure_checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stable_rows(docs: DataFrame) -> DataFrame:
    """``docs`` if each scan of it gives the same rows in the same order: a table
    scan or a checkpoint, and what works row by row on them. Anything with a
    shuffle, a limit or a sample in its plan is checkpointed, as its rows could
    come in another order the next time."""
    plan = docs._jdf.queryExecution().executedPlan().toString()
    return checkpointed(docs) if _MOVING.search(plan) else docs


def row_number(docs: DataFrame) -> Column:
    """A number per row that is the same in every scan of ``docs``, a table scan
    or a checkpoint. Left alone, Spark splits files by the cores it has at that
    moment, so a lost executor would number the next scan's rows differently.
    The split is therefore fixed for the session, unless it is set already."""
    conf = docs.sparkSession.conf
    if conf.get("spark.sql.files.minPartitionNum", None) is None:
        conf.set("spark.sql.files.minPartitionNum",
                 str(docs.sparkSession.sparkContext.defaultParallelism))
    return F.monotonically_increasing_id()


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
