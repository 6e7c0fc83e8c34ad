"""Backup, stage-verify-publish and catalog repair.

Staging protocol
----------------
1. The rows to publish are written once to a staging folder. The write is
   observed (``DataFrame.observe``): per-change counts are collected by the
   write job itself, in its result stage, so no second pass over the plan is
   needed and a retried task is counted once.
2. The staged copy is read back and counted per change; any difference from
   the observed counts stops the job before the target is touched.
3. The staged copy (a materialised table in shared storage, which also cuts
   the lineage) is published with *dynamic* partition overwrite: only the
   partitions present in the staged data are replaced, all others stay.

Writers never ``coalesce(1)``: every task writes its own files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.keys import quote
from ..sources.files import partition_dir


class StagingMismatch(RuntimeError):
    """The staged copy does not hold what the plan produced."""


@dataclass(frozen=True)
class TablePaths:
    """Folders of one table under a shared root: ``<root>/<table>/...``."""

    root: str
    table: str

    def _p(self, leaf: str) -> str:
        return f"{self.root.rstrip('/')}/{self.table}/{leaf}"

    @property
    def prep(self) -> str:
        return self._p(C.PREP_DIR)

    @property
    def target(self) -> str:
        return self._p(C.TARGET_DIR)

    @property
    def stage(self) -> str:
        return self._p(C.STAGE_DIR)

    @property
    def backup(self) -> str:
        return self._p(C.BACKUP_DIR)

    @property
    def runs(self) -> str:
        return self._p(C.RUNS_DIR)

    @property
    def versions(self) -> str:
        return self._p(C.VERSIONS_DIR)

    @property
    def backups(self) -> str:
        return self._p(C.BACKUPS_DIR)

    @property
    def rejected(self) -> str:
        return self._p(C.REJECT_DIR)


def write_observed(df: DataFrame, path: str, change_col: str | None = None,
                   changes: Sequence[str] = (), partition_by: Sequence[str] = (),
                   mode: str = "overwrite", name: str = "staged") -> dict[str, int]:
    """Write ``df`` and return its row count (``_total``) and the count per
    value of ``change_col``, observed by the write job itself."""
    obs = Observation(name)
    metrics = [F.count_if(F.col(change_col) == F.lit(c)).alias(c) for c in changes]
    metrics.append(F.count(F.lit(1)).alias("_total"))
    w = df.observe(obs, *metrics).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return {k: int(v) for k, v in obs.get.items()}


def backup(df: DataFrame, path: str, name: str = "backup") -> int:
    """Replace the backup copy at ``path`` with ``df`` (every task writes its
    own files) and return the number of rows copied, counted by the write."""
    return write_observed(df, path, name=name)["_total"]


def staged_counts(spark: SparkSession, path: str, change_col: str) -> dict[str, int]:
    """Row count per change value of a staged copy (one small aggregate job
    reading a single column)."""
    rows = (spark.read.parquet(path).groupBy(change_col).agg(F.count(F.lit(1)).alias("n"))
            .collect())
    return {r[0]: int(r[1]) for r in rows}


def verify_staged(spark: SparkSession, path: str, change_col: str,
                  observed: dict[str, int]) -> dict[str, int]:
    """Compare the read-back counts with the observed ones; raise on any
    difference. Returns the read-back counts."""
    back = staged_counts(spark, path, change_col)
    want = {k: v for k, v in observed.items() if k != "_total" and v}
    if back != want or sum(back.values()) != observed.get("_total", sum(want.values())):
        raise StagingMismatch(f"staged copy at {path}: wrote {observed}, read back {back}")
    return back


def publish_partitions(spark: SparkSession, staged_path: str, target_path: str,
                       partition_col: str = C.PARTITION_COLUMN,
                       drop: Sequence[str] = (), columns: Sequence[str] | None = None,
                       only: str | None = None, files: int | None = None) -> None:
    """Replace, in the target, exactly the partitions present in the staged
    copy (dynamic partition overwrite); untouched partitions stay.

    ``only`` publishes just that partition value (the staged read is pruned
    to it); ``files`` re-splits those rows into that many files, for a
    partition whose rows are few but spread over every task of the diff."""
    staged = spark.read.parquet(staged_path)
    if only is not None:
        staged = staged.where(F.col(quote(partition_col)) == F.lit(only).cast("date"))
    if drop:
        staged = staged.drop(*drop)
    if columns is not None:
        staged = staged.select(*[F.col(quote(c)) for c in columns])
    if files:
        staged = staged.repartition(files)
    (staged.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col)
     .parquet(target_path))


def register_table(spark: SparkSession, name: str, path: str,
                   partitions: Sequence[str] | None = None) -> None:
    """Make ``name`` an external Parquet table over ``path`` and bring its
    partition list and file listing up to date. Nothing may read the table
    between the publish and this call.

    A new table is created and repaired once (``MSCK REPAIR`` lists every
    partition). Afterwards only the ``partitions`` (``end_dt`` values) a run
    touched are added, which costs one catalog call each instead of a scan
    of the whole history."""
    if not spark.catalog.tableExists(name) or partitions is None:
        if not spark.catalog.tableExists(name):
            spark.catalog.createTable(name, path=path, source="parquet")
        repair(spark, name)
        return
    _add_columns(spark, name, partition_dir(path, partitions[0]))
    for value in partitions:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION "
                  f"({C.PARTITION_COLUMN} = DATE'{value}')")
    spark.catalog.refreshTable(name)


def _add_columns(spark: SparkSession, name: str, folder: str) -> None:
    """Give the catalog table the columns that only the files in ``folder`` have."""
    have = {c.name.lower() for c in spark.catalog.listColumns(name)}
    new = [f"{quote(f.name)} {f.dataType.simpleString()}"
           for f in spark.read.parquet(folder).schema.fields if f.name.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")


def repair(spark: SparkSession, name: str) -> None:
    """``MSCK REPAIR TABLE`` (when the catalog tracks partitions), then
    ``REFRESH TABLE`` so cached listings see the new files."""
    try:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    except Exception as e:  # tables without tracked partitions need no repair
        if "NOT_A_PARTITIONED_TABLE" not in str(e) and "not partitioned" not in str(e).lower():
            raise
    spark.catalog.refreshTable(name)


def reconcile(spark: SparkSession, name: str) -> dict[str, list[str]]:
    """Bring the catalog's partitions and the folders of a table together, both
    ways: folders without an entry are added, entries whose folder is gone are
    dropped. Returns both, for the log."""
    listed = lambda: {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    before = listed()
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    after = listed()
    return {"added": sorted(after - before), "dropped": sorted(before - after)}
