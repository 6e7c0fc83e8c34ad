"""Data-quality checks: filtered rows, row count, duplicate key groups,
and the interval check of a history table.

All are lazy DataFrames; the caller's action runs them. The duplicate check
is a hash aggregate with a map-side partial count, so a key holding a third
of all rows is reduced to one partial row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PARTITION_COLUMN
from ..functions.keys import as_list, column, resolve

Condition = str | Column | None


def _where(df: DataFrame, condition: Condition) -> DataFrame:
    if condition is None or (isinstance(condition, str) and condition.strip() in ("", "1=1")):
        return df
    return df.where(condition)


def filtered_rows(df: DataFrame, condition: Condition = None) -> DataFrame:
    """Rows of ``df`` that satisfy ``condition`` (SQL text or Column)."""
    return _where(df, condition)


def row_count(df: DataFrame, condition: Condition = None, alias: str = "cnt") -> DataFrame:
    """One row, one bigint column: the number of rows satisfying ``condition``."""
    return _where(df, condition).agg(F.count(F.lit(1)).alias(alias))


def duplicate_groups(df: DataFrame, keys: str | Iterable[str], condition: Condition = None,
                     alias: str = "cnt") -> DataFrame:
    """Key groups holding more than one row (NULL keys group together),
    with their row count. The filter runs before the grouping."""
    names = [resolve(df, k) for k in as_list(keys)]
    return (_where(df, condition)
            .groupBy(*[column(n) for n in names])
            .agg(F.count(F.lit(1)).alias(alias))
            .where(F.col(alias) > 1))


def count_check(spark: SparkSession, table: str, condition: Condition = None) -> DataFrame:
    """``filtered_rows`` over a catalog table (or view) by name."""
    return filtered_rows(spark.table(table), condition)


def count_value(spark: SparkSession, table: str, condition: Condition = None) -> DataFrame:
    """``row_count`` over a catalog table (or view) by name."""
    return row_count(spark.table(table), condition)


def duplicate_check(spark: SparkSession, table: str, keys: str | Iterable[str],
                    condition: Condition = None) -> DataFrame:
    """``duplicate_groups`` over a catalog table (or view) by name."""
    return duplicate_groups(spark.table(table), keys, condition)


def inverted_intervals(history: DataFrame, begin: str = "bgn_dt",
                       end: str = PARTITION_COLUMN) -> DataFrame:
    """Rows that were closed before they began (a key changed twice on one
    day). They are kept in the table; this check makes them visible."""
    return history.where(column(end) < column(begin))
