"""Backups of the versioned CDC table by manifest: files are listed, not copied.

The files that a version shows are immutable (``plans.versioned_job``), so its backup
is a list of them: ``<table>/backups/<number>/``, written by Spark, with the length,
the rows and a checksum of each file, and ``<number>.json``, which is created last
and makes the backup count. The open rows of a version that has a backup are kept
until the backup is dropped, whatever ``keep`` the loads name.

A checksum is an order-free sum over the rows as Spark reads them, so it covers the
readable contents, not the bytes. Columns that are NULL in a row don't count, and a
column that later runs add changes no checksum of older files. Closed rows that an
earlier backup lists are not read again: a backup reads the open rows and what the
runs since then closed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from .. import config as C
from ..functions.keys import column
from ..sources.files import create_text, delete_file, delete_folder, partition_dir, path_exists, read_text
from . import run_log
from .publish import TablePaths
from .versioned_job import (RUN, base_name, drop_versions, is_registered, partitions, pinned,
                            show_version)

CLOSED, FILE, LENGTH, ROWS, DIGEST, CHECK = "closed", "file", "length", "rows", "digest", "check"
MANIFEST = (f"{RUN} int, {CLOSED} boolean, {FILE} string, {LENGTH} bigint, {ROWS} bigint, {DIGEST} bigint, "
            f"{CHECK} bigint")


class DamagedBackup(RuntimeError):
    """Files of a backup are gone, or hold something else than was listed."""


def _row_hash(schema: StructType):
    """A hash of a row's values by column name; NULLs don't count."""
    parts = []
    for f in schema.fields:
        value = F.map_entries(column(f.name)) if isinstance(f.dataType, MapType) else column(f.name)
        parts.append(F.when(column(f.name).isNull(), F.lit(0).cast("long"))
                     .otherwise(F.xxhash64(F.lit(f.name.lower()), value)))
    return F.xxhash64(reduce(lambda a, b: a.bitwiseXOR(b), parts))


def _list_files(spark: SparkSession, schema: StructType, folders: Sequence[tuple[int, str, str]]) -> DataFrame:
    """The files in those of ``folders`` (number, end_dt, folder) that exist: one scan
    and one aggregation, combined before its shuffle."""
    found = [f for _, _, f in folders if path_exists(spark, f)]
    if not found:
        return spark.createDataFrame([], MANIFEST)
    rows = (spark.read.schema(schema).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
            .parquet(*found))
    return (rows.select(F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_size").alias(LENGTH),
                        _row_hash(schema).alias("h"))
            .groupBy(FILE, LENGTH)
            .agg(F.count(F.lit(1)).alias(ROWS), F.bit_xor("h").alias(DIGEST),
                 F.sum(F.shiftrightunsigned("h", 32)).alias(CHECK))
            .select(F.regexp_extract(FILE, rf"/{RUN}=(\d+)(-closed)?/[^/]+(/[^/]+)?$", 1).cast("int").alias(RUN),
                    F.col(FILE).rlike(rf"/{RUN}=\d+-closed/[^/]+$").alias(CLOSED),
                    FILE, LENGTH, ROWS, DIGEST, CHECK))


def _record(spark: SparkSession, paths: TablePaths, number: int) -> dict:
    path = f"{paths.backups}/{number:012d}.json"
    if not path_exists(spark, path):
        raise ValueError(f"version {number} of {paths.table} has no backup")
    return json.loads(read_text(spark, path))


def _folders(spark: SparkSession, paths: TablePaths, database: str, number: int) -> list[tuple[int, str, str]]:
    """(number, end_dt, folder) of the partitions that a version shows: one entry
    per run, as the catalog has them."""
    end = C.OPEN_END.isoformat()
    closed = [(int(p[RUN]), p[C.PARTITION_COLUMN]) for p in partitions(spark, base_name(database, paths.table))]
    stage = lambda n: f"{paths.versions}/{RUN}={n}"
    return [(n, e, f"{stage(n)}-closed") for n, e in sorted(closed) if n <= number and e != end] + [
        (number, end, partition_dir(stage(number), end))]


def backup_version(spark: SparkSession, table: str, root: str, database: str, keep: int = 2) -> dict:
    """Back up the version the view shows; the last ``keep`` backups stay. Returns
    its number, files, rows, and how many folders were read for it."""
    paths = TablePaths(root, table)
    with run_log.Lease(spark, paths.runs, run_log.new_run_id()) as lease:
        last = run_log.last_state(spark, paths.runs)
        if last is None or last["state"] != run_log.DONE:
            raise RuntimeError(f"the last run of {table} is not done; run the load again first")
        number = last["number"]
        have = pinned(spark, paths)
        if number not in have:
            schema = spark.table(f"{database}.{table}").schema
            schema = StructType([f for f in schema.fields if f.name.lower() != C.PARTITION_COLUMN])
            folders = _folders(spark, paths, database, number)
            known, older = [], None
            for n in [n for n in reversed(have) if n < number][:1]:
                record = _record(spark, paths, n)
                types = {f.name.lower(): f.dataType for f in schema.fields}
                same = all(types.get(f.name.lower()) == f.dataType
                           for f in StructType.fromJson(record["schema"]).fields)
                if same:            # else the same values might hash otherwise
                    known = [tuple(x) for x in record["folders"][:-1]]
                    older = spark.read.schema(MANIFEST).parquet(f"{paths.backups}/{n}")
            fresh = [f for f in folders if f not in known]
            files = _list_files(spark, schema, fresh)
            reused = [f for f in folders if f in known]
            if reused:
                wanted = spark.createDataFrame([f[0] for f in reused], "int").toDF(RUN)
                files = files.unionByName(older.where(CLOSED).join(wanted, RUN, "left_semi"))
            target = f"{paths.backups}/{number}"
            files.write.mode("overwrite").parquet(target)
            total = (spark.read.schema(MANIFEST).parquet(target)
                     .agg(F.count(F.lit(1)).alias("n"), F.sum(ROWS).alias("rows")).first())
            lease.check()
            create_text(spark, f"{paths.backups}/{number:012d}.json", json.dumps(
                {"folders": folders, "columns": last["columns"], "schema": schema.jsonValue(),
                 "files": total["n"], "rows": total["rows"] or 0, "read": len(fresh)}))
        for old in pinned(spark, paths)[:-max(1, keep)]:
            delete_file(spark, f"{paths.backups}/{old:012d}.json")
            delete_folder(spark, f"{paths.backups}/{old}")
        drop_versions(spark, paths, database, last)
        record = _record(spark, paths, number)
        return {"version": number, **{k: record[k] for k in ("files", "rows", "read")}}


def damaged_files(spark: SparkSession, table: str, root: str, number: int) -> DataFrame:
    """Files of a backup that are not as listed: ``file``, ``problem`` (``gone``:
    nothing can be read from it; ``changed``). Reads every file of the version."""
    paths = TablePaths(root, table)
    record = _record(spark, paths, number)
    now = _list_files(spark, StructType.fromJson(record["schema"]), [tuple(f) for f in record["folders"]])
    facts = [LENGTH, ROWS, DIGEST, CHECK]
    then = spark.read.schema(MANIFEST).parquet(f"{paths.backups}/{number}")
    both = then.select(FILE, F.struct(*facts).alias("then")).join(
        now.select(FILE, F.struct(*facts).alias("now")), FILE, "left")
    return (both.where(~F.col("then").eqNullSafe(F.col("now")))
            .select(FILE, F.when(F.col("now").isNull(), "gone").otherwise("changed").alias("problem")))


def restore_version(spark: SparkSession, table: str, root: str, database: str, number: int) -> int:
    """Show a version that has a backup again, by one step of the view, after every
    file was compared with its list. The next load diffs against it. Returns the
    number of rows shown.

    The view then has the rows that the version had. A version that the shown one
    doesn't come from (loads followed a rollback before it) can't be shown: the
    history it needs has left the catalog."""
    paths, run_id = TablePaths(root, table), run_log.new_run_id()
    with run_log.Lease(spark, paths.runs, run_id) as lease:
        last = run_log.last_state(spark, paths.runs)
        if last is None or last["state"] != run_log.DONE:
            raise RuntimeError(f"the last run of {table} is not done; run the load again first")
        record = _record(spark, paths, number)
        bad = damaged_files(spark, table, root, number).head(3)
        if bad:
            raise DamagedBackup(f"backup {number} of {table}: {[(r[FILE], r['problem']) for r in bad]}")
        if (_folders(spark, paths, database, number) != [tuple(f) for f in record["folders"]]
                or not is_registered(spark, database, table, number)):
            raise DamagedBackup(f"the catalog no longer has the history of version {number} of {table}")
        lease.check()
        show_version(spark, database, table, number, record["columns"])
        facts = {k: v for k, v in last.items() if k not in ("run_id", "state")}
        run_log.write_state(spark, paths.runs, run_id, run_log.DONE, facts | {
            "number": number, "before": 0, "kept": [number], "columns": record["columns"], "token": lease.token})
        return record["rows"]
