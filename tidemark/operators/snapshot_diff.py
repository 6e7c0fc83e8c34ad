"""Snapshot-diff CDC: compare a full extract ("prep") with the current rows of
an effective-dated table and derive change flags and the next table state.

Table layout: the prep columns, then ``audit_flag, bgn_dt, end_dt,
audit_inserted_ts``. Current rows have ``end_dt = 9999-12-31``; a closed row
has ``end_dt = as_of - 1``.

Flags: ``I`` key absent from current, ``U`` key present with a different
fingerprint, ``Z`` same fingerprint, ``D`` current key absent from prep.

Plans
-----
The single-purpose operators (``classify``, ``deleted``, ``close_history``)
are one join each (left, left-anti, left-anti with a null-safe fingerprint
key). ``next_state`` and ``diff_flags`` answer everything with **one full
outer join** of the deduplicated prep and the current rows on the match key:
one shuffle per side (the prep side reuses the dedupe window's partitioning),
then a single Generate of change letters emits the one or two rows each key produces.
No join result is computed twice and nothing is broadcast, so the plan scales
with the data; both sides hold at most one row per key after dedupe, so key
skew in the raw extract is absorbed by the dedupe's map-side group limit.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as C
from ..functions.keys import (MATCH_KEYS, all_present, any_null, as_list, column, conform,
                              differs, match_key_names, reject_names, resolve,
                              with_match_key)
from ..functions.sqltext import (as_date, date_lit, ident, named_struct,
                                 null_safe_differs, string_lit, timestamp_lit)
from .dedupe import dedupe
from .keyed_join import full_outer_on_key, pack

CHANGE = "_change"        # staged-only column: which branch produced the row
AUDIT_TYPES = ("string", "date", "date", "timestamp")   # of C.AUDIT_COLUMNS
CLOSED_BY_UPDATE = "C"    # a closed row whose key got a new version
_NEW, _OLD, _FLAG = "_tm_new", "_tm_old", "flag"


# --------------------------------------------------------------------------
# run parameters


@dataclass(frozen=True)
class Stamps:
    """Time inputs of one run: the business date and the load timestamp."""

    as_of: _dt.date | str
    load_ts: _dt.datetime | str

    def as_of_col(self) -> Column:
        return F.lit(as_date(self.as_of).isoformat()).cast("date")

    def closed_col(self) -> Column:
        return F.date_sub(self.as_of_col(), 1)

    def load_ts_col(self) -> Column:
        ts = self.load_ts
        text = ts.isoformat(sep=" ") if isinstance(ts, _dt.datetime) else str(ts)
        return F.lit(text).cast("timestamp")

    # the same values as SQL literals (validated)
    def as_of_sql(self) -> str:
        return date_lit(self.as_of)

    def closed_sql(self) -> str:
        return date_lit(as_date(self.as_of) - _dt.timedelta(days=1))

    def load_ts_sql(self) -> str:
        return timestamp_lit(self.load_ts)


def open_end_col() -> Column:
    return F.lit(C.OPEN_END.isoformat()).cast("date")


# --------------------------------------------------------------------------
# input preparation


def _data_columns(df: DataFrame) -> list[str]:
    """Everything but the audit and the internal match-key columns."""
    inside = {a.lower() for a in C.AUDIT_COLUMNS} | set(MATCH_KEYS)
    return [c for c in df.columns if c.lower() not in inside]


def snapshot_columns(prep: DataFrame) -> list[str]:
    """Data columns of a snapshot. Only an incoming ``audit_inserted_ts`` is
    dropped; any other audit name in an extract is an error, since the
    extract's own values would be lost."""
    reject_names(prep, set(C.AUDIT_COLUMNS) - {"audit_inserted_ts"}, "are audit columns of the target")
    return _data_columns(prep)


class MissingColumns(ValueError):
    """The extract lacks columns that the stored rows have."""


def split_rejected(df: DataFrame, keys: str | Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every key part present, rows with a NULL key part).

    A NULL key can never be matched, so such rows are set apart instead of
    being inserted again on every run."""
    names = [resolve(df, k) for k in as_list(keys)]
    return df.where(all_present(names)), df.where(any_null(names))


def prepare_snapshot(prep: DataFrame, keys: str | Iterable[str], order_by=None,
                     normalize: bool = True) -> DataFrame:
    """Valid-key, one-row-per-match-key snapshot with the match key kept."""
    keys = as_list(keys)
    reject_names(prep, MATCH_KEYS, "have internal names")
    prep = prep.select(*[column(c) for c in snapshot_columns(prep)])
    valid, _ = split_rejected(prep, keys)
    return dedupe(valid, keys, order_by=order_by, normalize=normalize, keep_match_key=True)


def _keyed(df: DataFrame, keys: Sequence[str], normalize: bool) -> DataFrame:
    mk = match_key_names(len(keys))
    if all(m in df.columns for m in mk):
        return df
    return with_match_key(df, keys, normalize)


def _compare_columns(prep: DataFrame, keys: Sequence[str], compare,
                     fingerprint: str | None) -> list[str]:
    if compare is not None:
        return [resolve(prep, c) for c in as_list(compare)]
    if fingerprint and fingerprint.lower() in {c.lower() for c in prep.columns}:
        return [resolve(prep, fingerprint)]
    key_set = {resolve(prep, k) for k in keys}
    return [c for c in snapshot_columns(prep) if c not in key_set]


# --------------------------------------------------------------------------
# single-purpose operators


def classify(prep: DataFrame, current: DataFrame, keys: str | Iterable[str], *,
             compare: Iterable[str] | None = None, fingerprint: str | None = C.FINGERPRINT_COLUMN,
             normalize: bool = True) -> DataFrame:
    """Prep rows plus ``flag``: I (key not current), U (fingerprint differs,
    NULL-safely) or Z (same). Expects one prep row per key (see ``dedupe``)."""
    keys = as_list(keys)
    mk = match_key_names(len(keys))
    cmp = _compare_columns(prep, keys, compare, fingerprint)
    reject_names(prep, [_FLAG], "would hide the flag")
    data = snapshot_columns(prep)
    p = _keyed(prep, keys, normalize)
    cur = _keyed(current, keys, normalize)
    right = cur.select(*[F.col(m) for m in mk],
                       *[column(resolve(cur, c)).alias(f"_tm_c{i}") for i, c in enumerate(cmp)],
                       F.lit(True).alias("_tm_in_cur"))
    j = p.join(right, on=mk, how="left")
    flag = (F.when(F.col("_tm_in_cur").isNull(), F.lit(C.INSERTED))
            .when(differs([column(c) for c in cmp],
                          [F.col(f"_tm_c{i}") for i in range(len(cmp))]), F.lit(C.UPDATED))
            .otherwise(F.lit(C.UNCHANGED)))
    return j.select(*[column(c) for c in data], flag.alias(_FLAG))


def deleted(prep: DataFrame, current: DataFrame, keys: str | Iterable[str], *,
            normalize: bool = True) -> DataFrame:
    """Current rows whose key is absent from prep, audit columns dropped,
    ``flag = 'D'``. A left-anti join (Catalyst does not derive one from an
    outer join plus IS NULL, so it is written as one)."""
    keys = as_list(keys)
    mk = match_key_names(len(keys))
    # distinct keys: a key repeated in an undeduplicated snapshot is reduced
    # map-side (partial aggregate) before it is shuffled
    p = _keyed(prep, keys, normalize).select(*[F.col(m) for m in mk]).distinct()
    reject_names(current, [_FLAG], "would hide the flag")
    keep = _data_columns(current)
    # current rows with a NULL key part never match: they skip the join
    # instead of hashing into one partition
    ok, nulls = split_rejected(current, keys)
    gone = _keyed(ok, keys, normalize).join(p, on=mk, how="left_anti").unionByName(
        _keyed(nulls, keys, normalize))
    return gone.select(*[column(c) for c in keep], F.lit(C.DELETED).alias(_FLAG))


def close_history(prep: DataFrame, current: DataFrame, keys: str | Iterable[str],
                  stamps: Stamps, *, compare: Iterable[str] | None = None,
                  fingerprint: str | None = C.FINGERPRINT_COLUMN,
                  normalize: bool = True) -> DataFrame:
    """Current rows whose key is updated or deleted, all columns kept, with
    ``end_dt = as_of - 1``: one left join on the match key alone, which reuses
    the dedupe's partitioning, then the rows whose key is absent or whose
    fingerprint differs NULL-safely. Expects one prep row per key."""
    keys = as_list(keys)
    mk = match_key_names(len(keys))
    cmp = _compare_columns(prep, keys, compare, fingerprint)
    p = _keyed(prep, keys, normalize).select(
        *[F.col(m) for m in mk], F.lit(True).alias("_tm_in_prep"),
        *[column(c).alias(f"_tm_pc{i}") for i, c in enumerate(cmp)])
    ok, nulls = split_rejected(current, keys)        # NULL keys skip the join
    cur = _keyed(ok, keys, normalize)
    changed = differs([column(resolve(cur, c)) for c in cmp],
                      [F.col(f"_tm_pc{i}") for i in range(len(cmp))])
    cols = [c for c in current.columns if c not in MATCH_KEYS]
    out = (cur.join(p, on=mk, how="left").where(F.col("_tm_in_prep").isNull() | changed)
           .select(*[column(c) for c in cols]).unionByName(nulls.select(*[column(c) for c in cols])))
    return out.select(*[column(c) if c != C.PARTITION_COLUMN
                        else stamps.closed_col().alias(C.PARTITION_COLUMN) for c in cols])


def stamp_new(df: DataFrame, stamps: Stamps, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as new current versions: data columns + audit_flag 'I',
    bgn_dt as_of, end_dt 9999-12-31, audit_inserted_ts load_ts."""
    cols = list(columns) if columns is not None else snapshot_columns(df)
    return df.select(*[column(c) for c in cols],
                     F.lit(C.INSERTED).alias("audit_flag"),
                     stamps.as_of_col().alias("bgn_dt"),
                     open_end_col().alias("end_dt"),
                     stamps.load_ts_col().alias("audit_inserted_ts"))


def initial_load(prep: DataFrame, stamps: Stamps) -> DataFrame:
    """First load: every (deduplicated) prep row becomes a current row."""
    return stamp_new(prep, stamps)


def new_versions(classified: DataFrame, stamps: Stamps) -> DataFrame:
    """Rows flagged I or U, stamped as new current versions (audit_flag is
    'I' for both)."""
    data = [c for c in snapshot_columns(classified) if c != _FLAG]
    return stamp_new(classified.where(F.col(_FLAG).isin(C.INSERTED, C.UPDATED)), stamps, data)


# --------------------------------------------------------------------------
# the fused plan: one full outer join


def _aligned_join(prep: DataFrame, current: DataFrame, keys: Sequence[str], compare,
                  fingerprint, normalize: bool, evolve: bool,
                  rows_per_key: Observation | None = None) -> tuple[DataFrame, list[str]]:
    """Full outer join of prep and current on the match key, each side packed
    in one struct in prep's columns and types; adds ``flag``. Columns that only
    the stored rows have are an error, or with ``evolve`` follow prep's columns
    (new versions have NULL there, stored rows keep their values)."""
    mk = match_key_names(len(keys))
    data = snapshot_columns(prep)
    known = {c.lower() for c in data}
    gone = [c for c in _data_columns(current) if c.lower() not in known]
    if gone and not evolve:
        raise MissingColumns(f"the extract lacks the stored columns {gone}; "
                             "pass evolve=True to keep them and go on")
    data = data + gone
    cmp = _compare_columns(prep, keys, compare, fingerprint)
    p = _keyed(prep, keys, normalize)
    ptypes = ({f.name: f.dataType for f in current.schema.fields if f.name in gone}
              | {f.name: f.dataType for f in prep.schema.fields})
    left = p.select(*[F.col(m) for m in mk], pack(p, data, ptypes, _NEW))

    def old_struct(df: DataFrame) -> Column:
        names = {c.lower(): c for c in df.columns}
        audit = [(a, f"CAST({ident(names[a.lower()]) if a.lower() in names else 'NULL'} AS {t})")
                 for a, t in zip(C.AUDIT_COLUMNS, AUDIT_TYPES)]
        return pack(df, data, ptypes, _OLD, audit)

    j = full_outer_on_key(left, _NEW, current, _OLD, keys, normalize, old_struct, rows_per_key)
    n, o = ident(_NEW), ident(_OLD)
    changed = null_safe_differs([(ident(_NEW, c), ident(_OLD, c)) for c in cmp])
    flag = (f"CASE WHEN {o} IS NULL THEN {string_lit(C.INSERTED)} "
            f"WHEN {n} IS NULL THEN {string_lit(C.DELETED)} "
            f"WHEN {changed} THEN {string_lit(C.UPDATED)} ELSE {string_lit(C.UNCHANGED)} END")
    return j.withColumn(_FLAG, F.expr(flag)), data


def diff_flags(prep: DataFrame, current: DataFrame, keys: str | Iterable[str], *,
               compare: Iterable[str] | None = None,
               fingerprint: str | None = C.FINGERPRINT_COLUMN,
               normalize: bool = True) -> DataFrame:
    """Every key with its flag: prep rows flagged I/U/Z plus current rows
    flagged D (their data columns), from one full outer join."""
    keys = as_list(keys)
    reject_names(prep, [_FLAG], "would hide the flag")
    j, data = _aligned_join(prep, current, keys, compare, fingerprint, normalize, True)
    f = F.col(_FLAG)
    side = lambda c: F.when(f == C.DELETED, F.col(_OLD)[c]).otherwise(F.col(_NEW)[c])
    return j.select(*[side(c).alias(c) for c in data], f)


def next_state(prep: DataFrame, current: DataFrame, keys: str | Iterable[str],
               stamps: Stamps, *, compare: Iterable[str] | None = None,
               fingerprint: str | None = C.FINGERPRINT_COLUMN, normalize: bool = True,
               evolve: bool = False, tag: bool = False,
               rows_per_key: Observation | None = None) -> DataFrame:
    """The rows a run writes: new current versions (I, U), unchanged current
    rows with their own stamps (Z) and closed rows (U, D) with
    ``end_dt = as_of - 1``. ``tag`` adds the ``_change`` column
    (I, U, Z for open rows; C, D for closed rows).

    Expects one prep row per key (``prepare_snapshot``) and observes in
    ``rows_per_key`` the most current rows of one key. ``evolve``: go on when
    the extract lacks stored columns (see ``_aligned_join``).

    An updated key is exploded into two change letters, any other into one;
    the letter then picks each column's side, so wide rows are built once and
    inside generated code."""
    keys = as_list(keys)
    j, data = _aligned_join(prep, current, keys, compare, fingerprint, normalize, evolve,
                            rows_per_key)
    f, change = ident(_FLAG), ident(CHANGE)
    I, U, Z = (string_lit(x) for x in (C.INSERTED, C.UPDATED, C.UNCHANGED))
    j = j.withColumn(CHANGE, F.expr(
        f"explode(CASE WHEN {f} = {U} THEN array({U}, {string_lit(CLOSED_BY_UPDATE)}) "
        f"ELSE array({f}) END)"))
    is_new = f"{change} IN ({I}, {U})"

    def pick(name: str, new: str, old: str) -> str:
        return f"CASE WHEN {is_new} THEN {new} ELSE {old} END AS {ident(name)}"

    flag, bgn, end, ts = C.AUDIT_COLUMNS
    old_end = f"CASE WHEN {change} = {Z} THEN {ident(_OLD, end)} ELSE {stamps.closed_sql()} END"
    out = j.selectExpr(*[pick(c, ident(_NEW, c), ident(_OLD, c)) for c in data],
                       pick(flag, I, ident(_OLD, flag)), pick(bgn, stamps.as_of_sql(), ident(_OLD, bgn)),
                       pick(end, date_lit(C.OPEN_END), old_end),
                       pick(ts, stamps.load_ts_sql(), ident(_OLD, ts)), change)
    return out if tag else out.drop(CHANGE)


def rebuild_current(prep: DataFrame, current: DataFrame, keys: str | Iterable[str],
                    stamps: Stamps, **kw) -> DataFrame:
    """The next current partition: unchanged current rows + new versions."""
    out = next_state(prep, current, keys, stamps, tag=True, **kw)
    return out.where(F.col(CHANGE).isin(C.INSERTED, C.UPDATED, C.UNCHANGED)).drop(CHANGE)


def full_table(target: DataFrame, prep: DataFrame, keys: str | Iterable[str], stamps: Stamps,
               *, order_by=None, **kw) -> DataFrame:
    """The whole next table in memory: existing history + ``next_state``.
    An empty current partition makes every prep row an insert (initial
    load) while history is kept."""
    keys = as_list(keys)
    is_open = column(resolve(target, C.PARTITION_COLUMN)).eqNullSafe(open_end_col())
    current, history = target.where(is_open), target.where(~is_open)
    snap = prepare_snapshot(prep, keys, order_by=order_by, normalize=kw.get("normalize", True))
    nxt = next_state(snap, current, keys, stamps, **kw)
    return conform(history, nxt).unionByName(nxt)
