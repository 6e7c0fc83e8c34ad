"""The snapshot-diff CDC job with one atomic step that readers can see.

Every run writes its rows once, into partitions of its own, ``run=<number>``, of
the base table ``<table>__versions``: the whole next open partition, and the rows
the run closed (rows that earlier runs of the day closed stay where they are, so
nothing is carried over and history is append-only). Readers use the view
``<table>``, which shows the history of all runs up to a number and the open
partition of that run:

    run <= P AND (end_dt < DATE'9999-12-31' OR run = P)

The rows are verified where they lie; no second copy is written. Registering the
new partitions changes nothing for readers, as the view does not reach them. One
``ALTER VIEW`` then moves P: every query sees the whole old or the whole new state,
columns included. A query already planned goes on reading the previous open
partition, which stays until ``keep`` newer versions exist; it is the backup as
well, and ``rollback`` points the view at it again.

With ``buckets`` the open rows of a run are a catalog table of their own,
``<table>__open_<number>``, bucketed on the stored match key into as many parts as
the next load's join has, one file each. That join reads them in place: only the
extract is shuffled. The view then takes its open rows from that table. Loads with
and without buckets, or with another number of them, may follow each other.

Lease and record are those of ``plans.run_log``. A run that stopped after its rows
were verified is completed by the next: both remaining steps can be done again.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.keys import MATCH_KEYS, as_list, match_key_names, quote, with_match_key
from ..functions.sqltext import string_lit
from ..operators import keyed_join
from ..operators import snapshot_diff as sd
from ..sources.files import (delete_folder, list_names, partition_dir, partition_filter, path_exists,
                             read_current)
from . import run_log
from .cdc_job import (CHANGES, LostPartition, closed_date, read_extract, report_shared_keys,
                      resolve_stamps)
from .publish import TablePaths, verify_staged, write_observed

RUN = "run"
MATCH_KEY = "tidemark.match_key"


def base_name(database: str, table: str) -> str:
    return f"{database}.{table}__versions"


def open_name(database: str, table: str, number: int | str) -> str:
    return f"{database}.{table}__open_{number}"


def _folder(paths: TablePaths, number: int) -> str:
    return f"{paths.versions}/{RUN}={number}"


def match_key_property(keys: Sequence[str], normalize: bool) -> str:
    """How a stored match key was made; kept in the table's ``MATCH_KEY`` property."""
    return json.dumps([[k.lower() for k in keys], normalize])


def version_rows(spark: SparkSession, paths: TablePaths, database: str, number: int,
                 match_key: str | None = None) -> DataFrame | None:
    """The open rows of a version, with the match key they are bucketed on if it was
    made as ``match_key`` says; None if they are gone."""
    name = open_name(database, paths.table, number)
    if not spark.catalog.tableExists(name):
        rows = read_current(spark, _folder(paths, number))
    elif path_exists(spark, partition_dir(_folder(paths, number), C.OPEN_END)):
        rows = spark.table(name).where(partition_filter(C.OPEN_END))
        made = [r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect() if r["key"] == MATCH_KEY]
        if made != [match_key]:
            rows = rows.drop(*MATCH_KEYS)
    else:
        rows = None
    return None if rows is None else rows.drop(sd.CHANGE)


@contextmanager
def shuffle_partitions(spark: SparkSession, number: int | None) -> Iterator[None]:
    """Plan shuffles with ``number`` partitions (None: as they are), so that they
    meet a table of as many buckets; the session's own settings come back after."""
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    before = {c: spark.conf.get(c, None) for c in names} if number else {}
    try:
        for c in before:
            spark.conf.set(c, str(number))
        yield
    finally:
        for c, value in before.items():
            if value is None:
                spark.conf.unset(c)
            else:
                spark.conf.set(c, value)


def _write_bucketed(rows: DataFrame, name: str, path: str, keys: Sequence[str], normalize: bool,
                    buckets: int) -> dict[str, int]:
    """Write a version as a catalog table bucketed on its match key. The join's
    partitions are its buckets, so a task writes one file to each ``end_dt``."""
    spark, mk, rows = rows.sparkSession, match_key_names(len(keys)), with_match_key(rows, keys, normalize)
    obs = Observation("version")
    metrics = [F.count_if(F.col(sd.CHANGE) == F.lit(c)).alias(c) for c in CHANGES]
    (rows.observe(obs, *metrics, F.count(F.lit(1)).alias("_total"))
     .write.format("parquet").mode("overwrite").option("partitionOverwriteMode", "static")
     .option("path", path).partitionBy(C.PARTITION_COLUMN).bucketBy(buckets, *mk).sortBy(*mk)
     .saveAsTable(name))
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES "
              f"({string_lit(MATCH_KEY)} = {string_lit(match_key_property(keys, normalize))})")
    return {k: int(v) for k, v in obs.get.items()}


def run_cdc_versioned(spark: SparkSession, table: str, keys: str | Iterable[str], root: str,
                      database: str, *, as_of=None, load_ts=None, order_by=None,
                      compare: Iterable[str] | None = None,
                      fingerprint: str | None = C.FINGERPRINT_COLUMN, normalize: bool = True,
                      prep: DataFrame | None = None, evolve: bool = False, keep: int = 2,
                      rows_per_file: int = 5_000_000, buckets: int | None = None,
                      lease_ttl: float = run_log.TTL) -> dict:
    """Run one CDC load of ``table`` and show it through the view
    ``<database>.<table>``; parameters and counts as ``run_cdc``. ``buckets``: keep
    the open rows in that many buckets of their match key (about their size divided
    by that of a shuffle partition); the load's shuffles get as many partitions."""
    keys, paths, run_id = as_list(keys), TablePaths(root, table), run_log.new_run_id()
    result: dict = {"table": table}
    with run_log.Lease(spark, paths.runs, run_id, lease_ttl) as lease:
        last = run_log.last_state(spark, paths.runs)
        if last and last["state"] in (run_log.VERIFIED, run_log.PUBLISHING):
            _show(spark, paths, database, last, lease)
            result["completed"] = last["run_id"]
        elif last is None and spark.catalog.tableExists(f"{database}.{table}"):
            raise LostPartition(f"{database}.{table} exists, but {paths.runs} has no record of it")
        stamps = resolve_stamps(spark, as_of, load_ts)
        result["as_of"] = str(stamps.as_of)
        valid, rejected = read_extract(spark, paths, prep, keys)
        result["rejected"] = write_observed(rejected, f"{paths.rejected}/run={run_id}",
                                            name=f"{table}_rejected")["_total"]
        if valid.isEmpty():
            return result | {"status": "empty_prep"}

        shown, number, kept = _versions(last)
        snap = sd.prepare_snapshot(valid, keys, order_by=order_by, normalize=normalize)
        current = (version_rows(spark, paths, database, shown, match_key_property(keys, normalize))
                   if shown else None)
        if shown and current is None:
            raise LostPartition(f"version {shown} of {paths.versions} has no open partition")
        per_key = None
        if current is None:
            rows = sd.initial_load(snap, stamps).withColumn(sd.CHANGE, F.lit(C.INSERTED))
            result["status"] = "initial_load"
        else:
            per_key = Observation(f"{table}_rows_per_key")
            rows = sd.next_state(snap, current, keys, stamps, compare=compare, evolve=evolve,
                                 fingerprint=fingerprint, normalize=normalize, tag=True, rows_per_key=per_key)
            result["status"] = "incremental"
        stage = _folder(paths, number)
        if buckets:
            with shuffle_partitions(spark, buckets):
                seen = _write_bucketed(rows, open_name(database, table, number), stage, keys, normalize, buckets)
        else:
            seen = write_observed(rows, stage, sd.CHANGE, CHANGES, partition_by=[C.PARTITION_COLUMN],
                                  name=f"{table}_version")
        if per_key is not None and (per_key.get[keyed_join.ROWS_PER_KEY] or 0) > 1:
            report_shared_keys(current, keys, normalize)
        open_rows = sum(seen[c] for c in (C.INSERTED, C.UPDATED, C.UNCHANGED))
        closed_rows = seen[sd.CLOSED_BY_UPDATE] + seen[C.DELETED]
        if open_rows == 0:
            raise RuntimeError("no current rows would remain; the view is left as it was")
        facts = {"token": lease.token, "number": number, "highest": number, "before": shown, "stage": stage,
                 "kept": (kept + [number])[-max(1, keep):], "observed": seen, "closed": closed_rows,
                 "closed_day": closed_date(stamps).isoformat(),
                 "columns": [c for c in rows.columns if c not in (sd.CHANGE, C.PARTITION_COLUMN)],
                 "rows_per_file": rows_per_file}
        lease.check()
        run_log.write_state(spark, paths.runs, run_id, run_log.STAGED, facts)
        verify_staged(spark, stage, sd.CHANGE, seen)
        run_log.write_state(spark, paths.runs, run_id, run_log.VERIFIED, facts)
        _show(spark, paths, database, facts | {"run_id": run_id}, lease)
        return result | {"version": number, "I": seen[C.INSERTED], "U": seen[C.UPDATED],
                         "Z": seen[C.UNCHANGED], "D": seen[C.DELETED], "closed": closed_rows,
                         "current": open_rows}


def _versions(last: dict | None) -> tuple[int, int, list[int]]:
    """The version the view shows (0: none), the next free number, and the versions
    whose open partitions are kept."""
    if last is None:
        return 0, 1, []
    if last["state"] == run_log.STAGED:             # never shown; its number isn't used again
        return last["before"], last["highest"] + 1, last["kept"][:-1] or [last["before"]][:last["before"]]
    return last["number"], last["highest"] + 1, last["kept"]


def _show(spark: SparkSession, paths: TablePaths, database: str, run: dict, lease: run_log.Lease) -> None:
    """Register a verified version and move the view to it; each step can be
    done again."""
    facts = {k: v for k, v in run.items() if k not in ("run_id", "state")} | {"token": lease.token}
    lease.check()
    run_log.write_state(spark, paths.runs, run["run_id"], run_log.PUBLISHING, facts)
    base, number = base_name(database, paths.table), run["number"]
    closed = partition_dir(run["stage"], run["closed_day"])
    if run["closed"]:
        compact = f"{run['stage']}-closed"          # few rows, but one file from every task of the diff
        files = max(1, -(-run["closed"] // run["rows_per_file"]))
        spark.read.parquet(closed).drop(sd.CHANGE, *MATCH_KEYS).repartition(files).write.mode("overwrite").parquet(compact)
    _base_table(spark, base, paths, run)
    for lost in range(run["before"] + 1, number):   # versions rolled back
        _drop_partitions(spark, base, f"{RUN} = {lost}")
    if not spark.catalog.tableExists(open_name(database, paths.table, number)):
        _add_partition(spark, base, number, C.OPEN_END.isoformat())
    if run["closed"]:
        _add_partition(spark, base, number, run["closed_day"], compact)
    spark.catalog.refreshTable(base)
    lease.check()
    show_version(spark, database, paths.table, number, run["columns"])
    run_log.write_state(spark, paths.runs, run["run_id"], run_log.DONE, facts)
    drop_versions(spark, paths, database, run)


def is_registered(spark: SparkSession, database: str, table: str, number: int) -> bool:
    """Whether the catalog has the open rows of a version."""
    spec = f"{RUN} = {number}, {C.PARTITION_COLUMN} = DATE'{C.OPEN_END.isoformat()}'"
    return (spark.catalog.tableExists(open_name(database, table, number))
            or bool(partitions(spark, base_name(database, table), spec)))


def pinned(spark: SparkSession, paths: TablePaths) -> list[int]:
    """Versions that have a backup (``plans.manifest_backup``), ascending."""
    return sorted(int(n.removesuffix(".json")) for n in list_names(spark, paths.backups) if n.endswith(".json"))


def drop_versions(spark: SparkSession, paths: TablePaths, database: str, run: dict) -> None:
    """Drop the open rows of versions before the shown one that are neither kept
    nor have a backup; their closed rows stay."""
    base, number, end = base_name(database, paths.table), run["number"], C.OPEN_END.isoformat()
    stay = {*run["kept"], *pinned(spark, paths), number}
    plain = [int(p[RUN]) for p in partitions(spark, base) if p[C.PARTITION_COLUMN] == end]
    bucketed = _bucketed_versions(spark, database, paths.table)
    for old in {*plain, *bucketed} - stay:
        if old > number:
            continue
        if old in bucketed:
            spark.sql(f"DROP TABLE IF EXISTS {open_name(database, paths.table, old)}")
        else:
            _drop_partitions(spark, base, f"{RUN} = {old}, {C.PARTITION_COLUMN} = DATE'{end}'")
        delete_folder(spark, _folder(paths, old))


def _bucketed_versions(spark: SparkSession, database: str, table: str) -> list[int]:
    prefix = open_name(database, table, "").split(".", 1)[1].lower()
    names = [r["tableName"].lower() for r in spark.sql(f"SHOW TABLES IN {database} LIKE '{prefix}*'").collect()]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.removeprefix(prefix).isdigit())


def partitions(spark: SparkSession, base: str, spec: str = "") -> list[dict]:
    """The partitions of the base table (those that ``spec`` names), as the catalog
    has them: a few for each run."""
    where = f" PARTITION ({spec})" if spec else ""
    return [dict(p.split("=", 1) for p in r[0].split("/"))
            for r in spark.sql(f"SHOW PARTITIONS {base}{where}").collect()]


def _drop_partitions(spark: SparkSession, base: str, spec: str) -> None:
    """Drop every partition that ``spec`` (of one or both columns) names."""
    specs = [f"PARTITION ({RUN} = {p[RUN]}, {C.PARTITION_COLUMN} = DATE'{p[C.PARTITION_COLUMN]}')"
             for p in partitions(spark, base, spec)]
    if specs:
        spark.sql(f"ALTER TABLE {base} DROP IF EXISTS {', '.join(specs)}")


def _base_table(spark: SparkSession, base: str, paths: TablePaths, run: dict) -> None:
    schema = {f.name: f.dataType.simpleString()
              for f in spark.read.parquet(partition_dir(run["stage"], C.OPEN_END.isoformat())).schema.fields}
    columns = [f"{quote(c)} {schema[c]}" for c in run["columns"]]
    if not spark.catalog.tableExists(base):
        spark.sql(f"CREATE TABLE {base} ({', '.join(columns)}, {RUN} INT, {C.PARTITION_COLUMN} DATE) "
                  f"USING parquet PARTITIONED BY ({RUN}, {C.PARTITION_COLUMN}) LOCATION '{paths.versions}'")
        return
    have = {c.name.lower() for c in spark.catalog.listColumns(base)}
    new = [text for c, text in zip(run["columns"], columns, strict=True) if c.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {base} ADD COLUMNS ({', '.join(new)})")


def _add_partition(spark: SparkSession, base: str, number: int, end_dt: str, location: str = "") -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"ALTER TABLE {base} ADD IF NOT EXISTS PARTITION "
              f"({RUN} = {number}, {C.PARTITION_COLUMN} = DATE'{end_dt}'){where}")


def show_version(spark: SparkSession, database: str, table: str, number: int, columns: Iterable[str]) -> None:
    """Point the view at version ``number``: one statement, one catalog entry."""
    names = ", ".join([quote(c) for c in columns] + [C.PARTITION_COLUMN])
    end = f"DATE'{C.OPEN_END.isoformat()}'"
    query = f"SELECT {names} FROM {base_name(database, table)} WHERE {RUN} <= {number} AND "
    bucketed = open_name(database, table, number)
    if spark.catalog.tableExists(bucketed):
        query += (f"{C.PARTITION_COLUMN} < {end} UNION ALL "
                  f"SELECT {names} FROM {bucketed} WHERE {C.PARTITION_COLUMN} = {end}")
    else:
        query += f"({C.PARTITION_COLUMN} < {end} OR {RUN} = {number})"
    view = f"{database}.{table}"
    spark.sql(f"ALTER VIEW {view} AS {query}" if spark.catalog.tableExists(view)
              else f"CREATE VIEW {view} AS {query}")


def rollback(spark: SparkSession, table: str, root: str, database: str) -> int:
    """Show the version before the one shown, in one step; returns its number.
    The next load diffs against it and gets a number of its own."""
    paths, run_id = TablePaths(root, table), run_log.new_run_id()
    with run_log.Lease(spark, paths.runs, run_id) as lease:
        last = run_log.last_state(spark, paths.runs)
        if last is None or last["state"] != run_log.DONE:
            raise RuntimeError(f"the last run of {table} is not done; run the load again first")
        before = last["before"]
        if not before or version_rows(spark, paths, database, before) is None:
            raise RuntimeError(f"no version before {last['number']} of {table} is kept")
        lease.check()
        show_version(spark, database, table, before, last["columns"])
        facts = {k: v for k, v in last.items() if k not in ("run_id", "state")}
        run_log.write_state(spark, paths.runs, run_id, run_log.DONE, facts | {
            "number": before, "before": 0, "kept": [before], "token": lease.token})
        return before
