"""The full outer join on a match key that both the snapshot diff and the
SCD loads are built on.

Each side is packed into one struct column, so column names never clash and
the joined row carries both versions of a key. The left side is expected to
be keyed already (``_mk*`` columns, no NULL key part: the dedupe guarantees
both). Right-side rows with a NULL key part can never match; they bypass the
join and are unioned back with an empty left side, instead of all hashing
into one shuffle partition. The split is made on the raw key columns so the
NULL branch is a scan with a pushed-down ``IS NULL``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType
from pyspark.sql.window import Window

from ..functions.keys import (all_present, any_null, match_key_names, resolve,
                              with_match_key)
from ..functions.sqltext import ident, named_struct, type_sql

ROWS_PER_KEY = "_tm_rows_per_key"


def pack(df: DataFrame, columns: Sequence[str], types: Mapping[str, DataType], alias: str,
         extra: Sequence[tuple[str, str]] = ()) -> Column:
    """``struct(columns..., extra...)``: each column found by name
    (case-insensitively) and cast to ``types[c]`` when its type differs, NULL
    when ``df`` lacks it; ``extra`` are (name, SQL expression) pairs. Built
    as one SQL expression (see ``functions.sqltext``)."""
    have = {f.name.lower(): f for f in df.schema.fields}
    fields = []
    for c in columns:
        f = have.get(c.lower())
        if f is None:
            fields.append((c, f"CAST(NULL AS {type_sql(types[c])})"))
        elif f.dataType == types[c]:
            fields.append((c, ident(f.name)))
        else:
            fields.append((c, f"CAST({ident(f.name)} AS {type_sql(types[c])})"))
    return F.expr(named_struct([*fields, *extra])).alias(alias)


def full_outer_on_key(left: DataFrame, left_name: str, right: DataFrame, right_name: str,
                      keys: Sequence[str], normalize: bool,
                      right_struct: Callable[[DataFrame], Column],
                      rows_per_key: Observation | None = None) -> DataFrame:
    """``left`` (keyed, packed as ``left_name``) full outer join ``right`` on
    the match key; ``right_struct(df)`` packs a right row as ``right_name``.
    Output columns: the match key, ``left_name``, ``right_name``; an absent
    side is a NULL struct. A ``right`` that stores its match key is joined on the
    stored columns, so a table bucketed on them isn't shuffled. ``rows_per_key`` observes the most right rows that one
    key has (``ROWS_PER_KEY``), in the partitioning that the join needs anyway."""
    mk = match_key_names(len(keys))
    rkeys = [resolve(right, k) for k in keys]

    def side(df: DataFrame) -> DataFrame:
        stored = set(mk) <= set(df.columns)
        keyed = df if stored else with_match_key(df, rkeys, normalize)
        return keyed.select(*[F.col(m) for m in mk], right_struct(keyed).alias(right_name))

    present = side(right.where(all_present(rkeys)))
    if rows_per_key is not None:
        counted = present.withColumn(ROWS_PER_KEY, F.count(F.lit(1)).over(Window.partitionBy(*mk)))
        present = (counted.observe(rows_per_key, F.max(ROWS_PER_KEY).alias(ROWS_PER_KEY))
                   .drop(ROWS_PER_KEY))
    matched = left.select(*[F.col(m) for m in mk], F.col(left_name)).join(
        present, on=mk, how="full_outer")
    lonely = side(right.where(any_null(rkeys)))
    return matched.unionByName(lonely.select(
        *[F.col(m) for m in mk],
        F.lit(None).cast(left.schema[left_name].dataType).alias(left_name),
        F.col(right_name)))
