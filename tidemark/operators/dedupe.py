"""One row per natural key.

``row_number() over (partition by <match key> order by <tie-break>) = 1``.
Catalyst turns the rank filter into a WindowGroupLimit that also runs
*before* the shuffle, so a hot key holding a third of all rows leaves each
map task as a single row. The window's hash partitioning on the match key
is kept in the output, so a following join on the same match key does not
shuffle this side again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import (MATCH_KEYS, as_list, column, match_key_names, orderable,
                              reject_names, resolve, with_match_key)

_RANK = "_tm_rank"


def default_order(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Deterministic tie-break: every non-key, orderable column ascending
    (NULLs first), then the raw key columns (``'a'`` and ``'A '`` share a
    match key, so their spelling decides between otherwise equal rows)."""
    key_names = [resolve(df, k) for k in keys]
    key_set = set(key_names)
    fields = {f.name: f.dataType for f in df.schema.fields}
    rest = [f for f in fields if f not in key_set and f not in MATCH_KEYS]
    return [column(c).asc_nulls_first() for c in rest + key_names if orderable(fields[c])]


def _order_columns(df: DataFrame, order_by) -> list[Column]:
    cols = []
    for o in ([order_by] if isinstance(order_by, (str, Column)) else order_by):
        cols.append(column(resolve(df, o)).asc_nulls_first() if isinstance(o, str) else o)
    return cols


def dedupe(df: DataFrame, keys: str | Iterable[str],
           order_by: str | Column | Iterable[str | Column] | None = None,
           normalize: bool = True, keep_match_key: bool = False) -> DataFrame:
    """Keep the first row of each key group under ``order_by``.

    ``normalize``: string key parts match on ``trim(upper(part))`` (the same
    key the snapshot diff joins on). ``order_by`` defaults to all non-key
    columns ascending, which makes the survivor deterministic but sorts every
    map task by the whole row; name the columns that decide where there are some.
    """
    keys = as_list(keys)
    reject_names(df, MATCH_KEYS, "have internal names")
    order = _order_columns(df, order_by) if order_by is not None else default_order(df, keys)
    mk = match_key_names(len(keys))
    keyed = with_match_key(df, keys, normalize)
    w = Window.partitionBy(*[F.col(k) for k in mk]).orderBy(*order) if order \
        else Window.partitionBy(*[F.col(k) for k in mk]).orderBy(*[F.col(k) for k in mk])
    out = keyed.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1).drop(_RANK)
    return out if keep_match_key else out.drop(*mk)
