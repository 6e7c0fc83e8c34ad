"""Slowly changing dimensions, type 0, 1 and 2 (current-flag style).

Each function takes the source extract and the target table as DataFrames
and returns the target's **next full state** (a pure, lazy DataFrame). The
job layer decides how to publish it (append only the new rows for type 0,
replace the table for 1 and 2, always from a staged copy).

Matching is on the key columns; ``normalize=True`` matches string parts on
``trim(upper(part))`` as the snapshot diff does. Values compare NULL-safely.
Source rows with a NULL key part never match anything and are left out
(``split_rejected`` returns them). The source is deduplicated per key by
default (``order_by`` breaks ties) so one key never yields two current rows.

Plans: type 0 is a left-anti join (Spark may broadcast the target's keys
when AQE measures them under the broadcast threshold - a checked size); type
1 and 2 are one full outer join on the key, one shuffle per side, followed by
one projection (type 1) or one Generate (type 2: a changed key yields the
new version and the expired one from the same joined row).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.keys import (as_list, column, match_key_names,
                              resolve, with_match_key)
from ..functions.sqltext import ident, null_safe_differs, string_lit, type_sql
from .dedupe import dedupe
from .keyed_join import full_outer_on_key, pack
from .snapshot_diff import Stamps, split_rejected

CHANGE = "_change"
NEW, CHANGED, KEPT, EXPIRED, HISTORY = "N", "U", "K", "X", "H"
_NEW, _OLD = "_tm_new", "_tm_old"


def _source(source: DataFrame, keys: Sequence[str], normalize: bool, dedupe_source: bool,
            order_by) -> DataFrame:
    valid, _ = split_rejected(source, keys)
    if dedupe_source:
        return dedupe(valid, keys, order_by=order_by, normalize=normalize, keep_match_key=True)
    return with_match_key(valid, keys, normalize)


def keyed_source(source: DataFrame, keys: str | Iterable[str], normalize: bool = False,
                 order_by=None) -> DataFrame:
    """One row per key of ``source``, none with a NULL key part, with match keys."""
    return _source(source, as_list(keys), normalize, True, order_by)


def _compare(target_data: Sequence[str], keys: Sequence[str], source: DataFrame,
             compare) -> list[str]:
    if compare is not None:
        return [c for c in as_list(compare)]
    key_set = {k.lower() for k in keys}
    src = {c.lower() for c in source.columns}
    return [c for c in target_data if c.lower() not in key_set and c.lower() in src]


class ColumnMismatch(ValueError):
    """Source and target of a load have different columns."""


def _evolved(source: DataFrame, target: DataFrame, data: Sequence[str], evolve: bool) -> DataFrame:
    """``target`` with the columns that only the source has (NULL). Source and
    target must have the same columns unless ``evolve`` is given; then columns
    that only the target has keep their stored values on changed rows."""
    src, tgt = {c.lower() for c in source.columns}, {c.lower() for c in data}
    more = [f for f in source.schema.fields if f.name.lower() not in tgt]
    gone = [c for c in data if c.lower() not in src]
    if (more or gone) and not evolve:
        raise ColumnMismatch(f"only in the source: {[f.name for f in more]}, only in the target: "
                             f"{gone}; pass evolve=True to keep them all")
    return target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in more}) if more else target


def _join(source: DataFrame, target: DataFrame, keys: Sequence[str], data: Sequence[str],
          types: dict, normalize: bool, dedupe_source: bool, order_by) -> DataFrame:
    mk = match_key_names(len(keys))
    src = _source(source, keys, normalize, dedupe_source, order_by)
    left = src.select(*[F.col(m) for m in mk], pack(src, data, types, _NEW))
    return full_outer_on_key(left, _NEW, target, _OLD, keys, normalize,
                             lambda df: pack(df, data, types, _OLD))


def new_keys(source: DataFrame, target: DataFrame, keys: str | Iterable[str], *,
             normalize: bool = False, dedupe_source: bool = True, order_by=None,
             evolve: bool = False) -> DataFrame:
    """Source rows whose key the target lacks, in the target's columns."""
    keys = as_list(keys)
    target = _evolved(source, target, target.columns, evolve)
    mk = match_key_names(len(keys))
    src = _source(source, keys, normalize, dedupe_source, order_by)
    tgt = with_match_key(target, [resolve(target, k) for k in keys], normalize)
    types = {f.name: f.dataType for f in target.schema.fields}
    # distinct target keys: repeated keys are reduced map-side before the shuffle
    fresh = src.join(tgt.select(*[F.col(m) for m in mk]).distinct(), on=mk, how="left_anti")
    return fresh.select(pack(fresh, target.columns, types, _NEW)).select(f"{_NEW}.*")


def scd0(source: DataFrame, target: DataFrame, keys: str | Iterable[str], *,
         normalize: bool = False, dedupe_source: bool = True, order_by=None,
         evolve: bool = False, tag: bool = False) -> DataFrame:
    """Type 0: the target plus the source rows of keys it lacks. Existing
    rows never change and are never removed."""
    target = _evolved(source, target, target.columns, evolve)
    fresh = new_keys(source, target, keys, normalize=normalize,
                     dedupe_source=dedupe_source, order_by=order_by, evolve=evolve)
    if tag:
        return (target.withColumn(CHANGE, F.lit(KEPT))
                .unionByName(fresh.withColumn(CHANGE, F.lit(NEW))))
    return target.unionByName(fresh)


def scd1(source: DataFrame, target: DataFrame, keys: str | Iterable[str], *,
         compare: Iterable[str] | None = None, normalize: bool = False,
         dedupe_source: bool = True, order_by=None, evolve: bool = False,
         tag: bool = False) -> DataFrame:
    """Type 1: new keys are added, a row whose compare columns differ
    (NULL-safely) is replaced whole by the source row, every other target
    row keeps its values. No history."""
    keys = as_list(keys)
    target = _evolved(source, target, target.columns, evolve)
    data = list(target.columns)
    types = {f.name: f.dataType for f in target.schema.fields}
    cmp = _compare(data, keys, source, compare)
    j = _join(source, target, keys, data, types, normalize, dedupe_source, order_by)
    j = j.withColumn(CHANGE, F.expr(_state_sql(cmp)))
    take_new = f"{ident(CHANGE)} IN ({string_lit(NEW)}, {string_lit(CHANGED)})"
    src = {c.lower() for c in source.columns}
    out = j.selectExpr(*[f"CASE WHEN {take_new} THEN {ident(_NEW, c)} ELSE {ident(_OLD, c)} END "
                         f"AS {ident(c)}" if c.lower() in src else f"{ident(_OLD, c)} AS {ident(c)}"
                         for c in data], ident(CHANGE))
    return out if tag else out.drop(CHANGE)


def _state_sql(cmp: Sequence[str]) -> str:
    """N when the target lacks the key, U when a compare column differs
    (NULL-safely) from a present source row, else K."""
    changed = null_safe_differs([(ident(_NEW, c), ident(_OLD, c)) for c in cmp])
    return (f"CASE WHEN {ident(_OLD)} IS NULL THEN {string_lit(NEW)} "
            f"WHEN {ident(_NEW)} IS NOT NULL AND ({changed}) THEN {string_lit(CHANGED)} "
            f"ELSE {string_lit(KEPT)} END")


def scd2_frame(target: DataFrame) -> DataFrame:
    """A type-2 target with ``flag`` and ``expiry_date`` present (a full load
    written without ``expiry_date`` gets it as NULL)."""
    names = {c.lower() for c in target.columns}
    if C.SCD2_EXPIRY not in names:
        target = target.withColumn(C.SCD2_EXPIRY, F.lit(None).cast("date"))
    if C.SCD2_FLAG not in names:
        target = target.withColumn(C.SCD2_FLAG, F.lit(C.LATEST))
    return target


def scd2(source: DataFrame, target: DataFrame, keys: str | Iterable[str], stamps: Stamps | str,
         *, compare: Iterable[str] | None = None, normalize: bool = False,
         dedupe_source: bool = True, order_by=None, evolve: bool = False,
         tag: bool = False) -> DataFrame:
    """Type 2 with a current flag: a new key gets a ``flag = 1`` row; a key
    whose latest version differs gets a new ``flag = 1`` row and the old one
    becomes ``flag = 0`` with ``expiry_date = as_of``. Only ``flag = 1``
    rows are compared; older versions and target-only keys are kept as they
    are (there is no delete branch)."""
    keys = as_list(keys)
    stamps = stamps if isinstance(stamps, Stamps) else Stamps(stamps, stamps)
    target = scd2_frame(target)
    flag_col, exp_col = resolve(target, C.SCD2_FLAG), resolve(target, C.SCD2_EXPIRY)
    target = _evolved(source, target, [c for c in target.columns if c not in (flag_col, exp_col)],
                      evolve)
    data = [c for c in target.columns if c not in (flag_col, exp_col)]
    types = {f.name: f.dataType for f in target.schema.fields}
    cmp = _compare(data, keys, source, compare)
    latest = column(flag_col) == F.lit(C.LATEST)
    current, history = target.where(latest), target.where(~latest | column(flag_col).isNull())
    packed = data + [exp_col]      # the source has no expiry: NULL on the new side
    j = _join(source, current.select(*[column(c) for c in packed]), keys, packed, types,
              normalize, dedupe_source, order_by)
    j = j.withColumn(CHANGE, F.expr(_state_sql(cmp)))
    s = ident(CHANGE)
    ftype, etype = type_sql(types[flag_col]), type_sql(types[exp_col])
    # a changed key is exploded into its new version and the expired one
    U, X = string_lit(CHANGED), string_lit(EXPIRED)
    j = j.withColumn(CHANGE, F.expr(
        f"explode(CASE WHEN {s} = {U} THEN array({U}, {X}) ELSE array({s}) END)"))
    take_new = f"{s} IN ({string_lit(NEW)}, {U})"
    src = {c.lower() for c in source.columns}
    nxt = j.selectExpr(
        *[f"CASE WHEN {take_new} THEN {ident(_NEW, c)} ELSE {ident(_OLD, c)} END AS {ident(c)}"
          if c.lower() in src else f"{ident(_OLD, c)} AS {ident(c)}" for c in data],
        f"CAST(CASE WHEN {s} = {X} THEN {C.EXPIRED} ELSE {C.LATEST} END AS {ftype}) "
        f"AS {ident(flag_col)}",
        f"CAST(CASE WHEN {s} = {X} THEN {stamps.as_of_sql()} WHEN {s} = {string_lit(KEPT)} "
        f"THEN {ident(_OLD, exp_col)} END AS {etype}) AS {ident(exp_col)}", s)
    hist = history.select(*[column(c) for c in data], column(flag_col), column(exp_col),
                          F.lit(HISTORY).alias(CHANGE))
    out = hist.unionByName(nxt)
    return out if tag else out.drop(CHANGE)
