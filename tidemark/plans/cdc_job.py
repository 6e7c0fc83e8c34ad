"""The snapshot-diff CDC job over ``<root>/<table>/{prep,tgt,temp,currbackup,rejected}``.

One run:

1. Read the snapshot; set rows with a NULL key part apart (written to
   ``rejected/``); stop with the target untouched if no valid row is left.
2. Copy the current partition to ``currbackup/`` and diff against that copy
   (one consistent snapshot; the target is read once). Only the folders of
   the two partitions a run touches are listed, never the whole history.
3. No current rows (new table, or history only): initial load. Otherwise the
   single-join ``next_state`` plus the rows already present in the partition
   ``end_dt = as_of - 1`` (a same-day re-run must not lose them).
4. Stage (in this table's folder under ``spark.checkpoint.dir`` when the
   session names one, else ``<table>/temp/``), verify, publish the touched partitions
   (``plans.publish``), then register / repair the catalog table when a name
   is given. ``runs/`` holds the table's lease and records how far a run came
   (``plans.run_log``).

Jobs (actions) per run: rejected write, emptiness probe, backup write (it
also counts the current rows), staged write, read-back count, publish of the
closed partition (when there are closed rows), publish of the open partition.
The diff itself (dedupe + join) runs exactly once, inside the staged write, which
also observes whether stored current rows share a key. Records and lease are
written by the driver without a job.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.keys import (MATCH_KEYS, as_list, column, conform, match_key_names, reject_names,
                              resolve, with_match_key)
from ..functions.sqltext import as_date
from ..operators import keyed_join
from ..operators import snapshot_diff as sd
from ..session import stage_folder
from ..sources.files import read_partition, read_snapshot
from . import run_log
from .publish import (TablePaths, backup as write_backup, publish_partitions, register_table,
                      verify_staged, write_observed)

CARRIED = "H"          # a row already in the closed partition, carried over
CHANGES = (C.INSERTED, C.UPDATED, C.UNCHANGED, sd.CLOSED_BY_UPDATE, C.DELETED, CARRIED)


def resolve_stamps(spark: SparkSession, as_of=None, load_ts=None) -> sd.Stamps:
    """Fix the run's date and timestamp once (session time zone)."""
    if as_of is None or load_ts is None:
        row = spark.range(1).select(F.current_date().alias("d"),
                                    F.date_format(F.current_timestamp(),
                                                  "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).first()
        as_of = as_of if as_of is not None else row["d"]
        load_ts = load_ts if load_ts is not None else row["t"]
    return sd.Stamps(as_of, load_ts)


def closed_date(stamps: sd.Stamps) -> _dt.date:
    return as_date(stamps.as_of) - _dt.timedelta(days=1)


def read_extract(spark: SparkSession, paths: TablePaths, prep: DataFrame | None,
                 keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The extract's rows with all key parts, and those without."""
    raw = read_snapshot(spark, paths.prep) if prep is None else prep
    reject_names(raw, MATCH_KEYS, "have internal names")
    return sd.split_rejected(raw.select(*[column(c) for c in sd.snapshot_columns(raw)]), keys)


def run_cdc(spark: SparkSession, table: str, keys: str | Iterable[str], root: str, *,
            database: str | None = None, as_of=None, load_ts=None, order_by=None,
            compare: Iterable[str] | None = None,
            fingerprint: str | None = C.FINGERPRINT_COLUMN, normalize: bool = True,
            backup: bool = True, prep: DataFrame | None = None, evolve: bool = False,
            rows_per_file: int = 5_000_000, lease_ttl: float = run_log.TTL) -> dict:
    """Run one CDC load of ``table``; returns counts per change and status.

    ``prep`` overrides the snapshot folder (a DataFrame from any source).
    ``evolve`` goes on when the extract lacks stored columns: new versions have
    NULL there, stored rows keep their values. ``rows_per_file`` sizes the
    files of the closed partition.

    A run that stopped while it published is completed first, from its verified
    staged copy, so running the job again after any failure is safe. While another
    run of the table holds its lease, ``run_log.Overlap`` is raised before anything
    is written; the lease of a lost driver runs out ``lease_ttl`` seconds after it
    was last renewed.
    """
    run_id = run_log.new_run_id()
    paths = TablePaths(root, table)
    with run_log.Lease(spark, paths.runs, run_id, lease_ttl) as lease:
        return _run(spark, paths, as_list(keys), run_id, lease, database=database, as_of=as_of,
                    load_ts=load_ts, order_by=order_by, compare=compare, fingerprint=fingerprint,
                    normalize=normalize, backup=backup, prep=prep, evolve=evolve,
                    rows_per_file=rows_per_file)


def _run(spark: SparkSession, paths: TablePaths, keys: list[str], run_id: str,
         lease: run_log.Lease, *, database, as_of, load_ts, order_by, compare, fingerprint,
         normalize, backup, prep, evolve, rows_per_file) -> dict:
    table = paths.table
    result: dict = {"table": table}
    last = run_log.last_state(spark, paths.runs)
    if last and last["state"] in (run_log.VERIFIED, run_log.PUBLISHING):
        _publish(spark, paths, last, database, lease)
        result["completed"] = last["run_id"]
    slot = 1 - last["slot"] if last else 0
    stamps = resolve_stamps(spark, as_of, load_ts)
    valid, rejected = read_extract(spark, paths, prep, keys)
    result["as_of"] = str(stamps.as_of)

    rejected_count = write_observed(rejected, f"{paths.rejected}/run={run_id}",
                                    name=f"{table}_rejected")["_total"]
    result["rejected"] = rejected_count
    if valid.isEmpty():
        result["status"] = "empty_prep"
        return result

    snap = sd.prepare_snapshot(valid, keys, order_by=order_by, normalize=normalize)
    # only the two partitions a run touches are listed and read
    current = read_partition(spark, paths.target, C.OPEN_END.isoformat())
    closed_day = closed_date(stamps)
    if current is not None:
        if backup:
            # the backup write counts the rows it copies: no extra probe job.
            # Two folders in turn: the previous copy stays until this run is done
            copy = f"{paths.backup}/{slot}"
            copied = write_backup(current, copy, name=f"{table}_backup")
            current = spark.read.parquet(copy) if copied else None
        elif current.isEmpty():
            current = None

    if current is None:
        if last and last["open"]:
            raise LostPartition(f"{paths.target} has no current rows, but run {last['run_id']} "
                                f"left {last['open']}; restore them from {paths.backup} or "
                                f"{last['stage']} before the next load")
        per_key = None
        staged = sd.initial_load(snap, stamps).withColumn(sd.CHANGE, F.lit(C.INSERTED))
        result["status"] = "initial_load"
    else:
        per_key = Observation(f"{table}_rows_per_key")
        staged = sd.next_state(snap, current, keys, stamps, compare=compare, evolve=evolve,
                               fingerprint=fingerprint, normalize=normalize, tag=True,
                               rows_per_key=per_key)
        existing = read_partition(spark, paths.target, closed_day.isoformat())
        if existing is not None:
            staged = staged.unionByName(conform(existing, staged, {sd.CHANGE: F.lit(CARRIED)}))
        result["status"] = "incremental"

    # the staged table cuts the lineage. Two folders in turn, like the backup;
    # the run record names the one that holds a verified state
    stage = f"{stage_root(spark, table, paths)}/{slot}"
    result["staged"] = stage
    observed = write_observed(staged, stage, sd.CHANGE, CHANGES,
                              partition_by=[C.PARTITION_COLUMN], name=f"{table}_stage")
    if per_key is not None and (per_key.get[keyed_join.ROWS_PER_KEY] or 0) > 1:
        report_shared_keys(current, keys, normalize)
    open_rows = sum(observed[c] for c in (C.INSERTED, C.UPDATED, C.UNCHANGED))
    closed_rows = observed[sd.CLOSED_BY_UPDATE] + observed[C.DELETED] + observed[CARRIED]
    if open_rows == 0:
        raise RuntimeError("no current rows would remain; target left untouched")
    facts = {"run_id": run_id, "token": lease.token, "slot": slot, "stage": stage, "observed": observed,
             "open": open_rows, "closed": closed_rows, "closed_day": closed_day.isoformat(),
             "columns": [c for c in staged.columns if c != sd.CHANGE],
             "rows_per_file": rows_per_file}
    lease.check()
    run_log.write_state(spark, paths.runs, run_id, run_log.STAGED,
                        facts | {"open": last["open"] if last else 0})
    verify_staged(spark, stage, sd.CHANGE, observed)
    run_log.write_state(spark, paths.runs, run_id, run_log.VERIFIED, facts)
    _publish(spark, paths, facts, database, lease, verified=True)

    result.update({
        "I": observed[C.INSERTED], "U": observed[C.UPDATED], "Z": observed[C.UNCHANGED],
        "D": observed[C.DELETED], "closed": observed[sd.CLOSED_BY_UPDATE] + observed[C.DELETED],
        "carried": observed[CARRIED], "current": open_rows,
    })
    return result


class LostPartition(RuntimeError):
    """The record says the table has current rows, but their partition is gone."""


class DuplicateCurrentKeys(RuntimeError):
    """Stored current rows share a match key."""


def report_shared_keys(current: DataFrame, keys: list[str], normalize: bool) -> None:
    """Current rows share a match key (``a`` and ``A ``, say, from a table loaded
    with raw keys): each would get its own new version. Name some and stop."""
    valid, _ = sd.split_rejected(current, keys)
    mk = match_key_names(len(keys))
    twice = (with_match_key(valid, [resolve(valid, k) for k in keys], normalize)
             .groupBy(*mk).count().where("count > 1").select(*mk).head(3))
    raise DuplicateCurrentKeys(f"several current rows for the match keys "
                               f"{[tuple(r) for r in twice]}; close all but one of each first")


def stage_root(spark: SparkSession, table: str, paths: TablePaths) -> str:
    """Staging folders of ``table``: under ``spark.checkpoint.dir`` when the
    cluster names one (the same in every session), else ``<table>/temp``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return stage_folder(spark, table, paths.target) if named else paths.stage


def _publish(spark: SparkSession, paths: TablePaths, run: dict, database: str | None,
             lease: run_log.Lease, verified: bool = False) -> None:
    """Publish a verified staged copy and record it. The closed partition goes
    first (a stop in between leaves extra history, never lost history) and is
    re-split by its observed size: its few rows come from every task of the
    diff and would otherwise land as one small file per task. Both writes
    replace whole partitions, so doing them again changes nothing."""
    if not verified:
        verify_staged(spark, run["stage"], sd.CHANGE, run["observed"])
    facts = {k: v for k, v in run.items() if k != "state"} | {"token": lease.token}
    lease.check()
    run_log.write_state(spark, paths.runs, run["run_id"], run_log.PUBLISHING, facts)
    touched = [C.OPEN_END.isoformat()]
    if run["closed"]:
        publish_partitions(spark, run["stage"], paths.target, drop=[sd.CHANGE],
                           columns=run["columns"], only=run["closed_day"],
                           files=max(1, -(-run["closed"] // run["rows_per_file"])))
        touched.append(run["closed_day"])
        lease.check()
    publish_partitions(spark, run["stage"], paths.target, drop=[sd.CHANGE],
                       columns=run["columns"], only=C.OPEN_END.isoformat())
    if database:
        register_table(spark, f"{database}.{paths.table}", paths.target, touched)
    run_log.write_state(spark, paths.runs, run["run_id"], run_log.DONE, facts)


def republish(spark: SparkSession, table: str, root: str, database: str | None = None) -> None:
    """Complete the table's last run, which reached ``verified``: publish its
    staged copy again after counting it once more. Recovery is always forward;
    rolling back would also have to remove a closed partition the run created."""
    paths = TablePaths(root, table)
    with run_log.Lease(spark, paths.runs, run_log.new_run_id()) as lease:
        last = run_log.last_state(spark, paths.runs)
        if last is None or last["state"] == run_log.STAGED:
            raise RuntimeError(f"no verified run of {table} to publish; run the load again")
        _publish(spark, paths, last, database, lease)
