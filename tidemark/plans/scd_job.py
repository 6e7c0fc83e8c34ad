"""SCD type 0/1/2 loads into a JDBC table or a Parquet folder.

The next state is computed by ``operators.scd`` and always *staged* in the
shared scratch folder before it reaches the target: a plan that reads a
table must never write into it directly (an overwrite truncates before the
read, an append can be re-read by a retried task). Type 0 stages and appends
only the new rows; types 1 and 2 stage the full next state and replace the
target with it in one write (JDBC: truncate + insert, DDL kept; Parquet type 2:
only the versions in force and those that expire on the load's day).

Each load keeps a record beside its staged copies (``plans.run_log``). A load
that stopped before its copy was verified has not touched the target and is
forgotten; one that stopped later is completed from that copy by the next load,
before the target is read: a replacement that stopped half-way must never be
taken for the target's state. Staged copies alternate between two folders, so a
new load never overwrites the copy that a completion may need.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.sqltext import as_date
from ..functions.keys import as_list, quote, resolve
from ..operators import scd as S
from ..session import stage_folder
from ..sources.files import path_exists
from ..sources.jdbc import jdbc_count, move_statements, read_jdbc, run_once, write_jdbc
from . import run_log
from .cdc_job import resolve_stamps
from .publish import verify_staged, write_observed

ALL_CHANGES = (S.NEW, S.CHANGED, S.KEPT, S.EXPIRED, S.HISTORY)


def next_state(kind: int, source: DataFrame, target: DataFrame, keys, stamps, **kw) -> DataFrame:
    if kind == 0:
        kw.pop("compare", None)
        return S.scd0(source, target, keys, tag=True, **kw)
    if kind == 1:
        return S.scd1(source, target, keys, tag=True, **kw)
    if kind == 2:
        return S.scd2(source, target, keys, stamps, tag=True, **kw)
    raise ValueError("kind must be 0, 1 or 2")


class PublishFailed(RuntimeError):
    """The verified rows are staged but not all published; run the load again."""


# rows to publish, and the facts of the run: mode, run_id, as_of, observed, ...
Publish = Callable[[DataFrame, dict], None]


def run_scd(spark: SparkSession, kind: int, source: DataFrame,
            target: DataFrame | Callable[[], DataFrame], keys: str | Iterable[str],
            publish: Publish, *, as_of=None, compare: Iterable[str] | None = None,
            normalize: bool = False, order_by=None, evolve: bool = False, move: bool = False,
            state_path: str | None = None, stage_key: str = "",
            lease_ttl: float = run_log.TTL) -> dict:
    """Compute, stage, verify and publish one SCD load.

    ``target`` is called after an unfinished run has been completed, and gives the
    target as it then is. ``publish(df, run)`` writes the staged rows to the
    target with ``run["mode"]`` ``append`` (type 0) or ``overwrite`` (types 1, 2).
    With ``move`` only new and changed rows are staged, with their change letter,
    mode ``move``; ``publish`` then must not act twice for one ``run["run_id"]``.
    ``state_path`` holds the record, the lease and two staged copies in turn, by
    default the folder of ``stage_key`` (the target's name) under
    ``spark.checkpoint.dir``. Running a load again after any failure is safe."""
    # SCD rows carry a date only (expiry_date); no load timestamp is written
    stamps = resolve_stamps(spark, as_of, load_ts="")
    read_target = target if callable(target) else lambda: target
    keys = as_list(keys)
    path = state_path or stage_folder(spark, f"scd{kind}", stage_key)
    runs, run_id = f"{path}/{C.RUNS_DIR}", run_log.new_run_id()
    with run_log.Lease(spark, runs, run_id, lease_ttl) as lease:
        last = run_log.last_state(spark, runs)
        result: dict = {"kind": kind}
        if last and last["state"] in (run_log.VERIFIED, run_log.PUBLISHING):
            _complete(spark, runs, last, read_target, publish, lease)
            result["completed"] = last["run_id"]
        now = read_target()
        if kind == 2:
            now = S.scd2_frame(now)
        nxt = next_state(kind, source, now, keys, stamps, compare=compare,
                         normalize=normalize, order_by=order_by, evolve=evolve)
        if move:
            rows, mode = nxt.where(F.col(S.CHANGE).isin(S.NEW, S.CHANGED)), "move"
        elif kind == 0:
            rows, mode = nxt.where(F.col(S.CHANGE) == S.NEW), "append"
        else:
            rows, mode = nxt, "overwrite"
        slot = 1 - last["slot"] if last else 0
        stage = f"{path}/{slot}"
        observed = write_observed(rows, stage, S.CHANGE, ALL_CHANGES, name=f"scd{kind}")
        facts = {"slot": slot, "stage": stage, "observed": observed, "mode": mode, "keys": keys,
                 "normalize": normalize, "as_of": str(as_date(stamps.as_of)), "token": lease.token}
        lease.check()
        run_log.write_state(spark, runs, run_id, run_log.STAGED, facts)
        verify_staged(spark, stage, S.CHANGE, observed)
        run_log.write_state(spark, runs, run_id, run_log.VERIFIED, facts)
        _publish(spark, runs, facts | {"run_id": run_id}, publish, lease)
        counts = {k: v for k, v in observed.items() if k != "_total"}
        if move:                     # unchanged and expired rows are not sent
            counts = {k: counts[k] for k in (S.NEW, S.CHANGED)}
        return {**result, "mode": mode, "staged": stage, **counts}


def _publish(spark: SparkSession, runs: str, run: dict, publish: Publish, lease: run_log.Lease,
             rows: DataFrame | None = None) -> None:
    """Publish a verified staged copy (or ``rows``, what is left of it), with a
    record before and after."""
    facts = {k: v for k, v in run.items() if k not in ("run_id", "state")} | {"token": lease.token}
    lease.check()
    run_log.write_state(spark, runs, run["run_id"], run_log.PUBLISHING, facts)
    if run["mode"] == "overwrite" or run["observed"]["_total"]:      # else nothing is new
        if rows is None:
            rows = spark.read.parquet(run["stage"])
            rows = rows if run["mode"] == "move" else rows.drop(S.CHANGE)
        try:
            publish(rows, run)
        except Exception as e:
            raise PublishFailed(f"publish failed; the verified rows are staged at {run['stage']}; run the "
                                "load again, which completes this one first") from e
    run_log.write_state(spark, runs, run["run_id"], run_log.DONE, facts)


def _complete(spark: SparkSession, runs: str, run: dict, read_target: Callable[[], DataFrame],
              publish: Publish, lease: run_log.Lease) -> None:
    """Publish the staged copy of a run that stopped. A replacement is written
    again, whole; of an append, the rows whose keys the target lacks (a database
    commits task by task, so some may be there)."""
    verify_staged(spark, run["stage"], S.CHANGE, run["observed"])
    rows = None
    if run["mode"] == "append" and run["observed"][S.NEW]:
        staged = spark.read.parquet(run["stage"]).drop(S.CHANGE)
        rows = S.new_keys(staged, read_target(), run["keys"], normalize=run["normalize"],
                          dedupe_source=False, evolve=True)
    _publish(spark, runs, run, publish, lease, rows)


def run_scd_jdbc(spark: SparkSession, kind: int, url: str, source_table: str,
                 target_table: str, keys: str | Iterable[str], *,
                 properties: dict | None = None, partition_column: str | None = None,
                 num_partitions: int | None = None, predicates: list[str] | None = None,
                 bucket_column: str | None = None, histogram_column: str | None = None,
                 single_task: bool = False, move: bool = False, key_type: str = "VARCHAR(1000)",
                 **kw) -> dict:
    """The database flavour: read source and target over JDBC, split as
    ``read_jdbc`` says, publish back over JDBC. Types 1 and 2 replace the
    target by what was read, so before anything is written the rows the split
    reads are compared with the database's own counts.

    With ``move`` the target is not replaced: new and changed rows go to the table
    ``<target>_TM_STAGE`` (string keys as ``key_type``), and one transaction of the
    database applies them. Target keys must be unique (type 2: among rows in force)."""
    read = lambda t: read_jdbc(spark, url, t, properties=properties,
                               partition_column=partition_column, num_partitions=num_partitions,
                               predicates=predicates, bucket_column=bucket_column,
                               histogram_column=histogram_column, single_task=single_task)

    def whole(name: str) -> DataFrame:
        df = read(name)
        there, got = jdbc_count(spark, url, name, properties), df.count()
        if there != got:
            raise RuntimeError(f"the split reads {got} of {there} rows of {name}; "
                               "its conditions must be disjoint and complete")
        return df

    def publish(df: DataFrame, run: dict) -> None:
        if run["mode"] == "move":
            _move(spark, kind, url, target_table, df, run, properties, num_partitions, key_type)
        else:
            write_jdbc(df, url, target_table, run["mode"], properties=properties,
                       num_partitions=num_partitions)
    kw.setdefault("stage_key", f"{url}|{target_table}")
    return run_scd(spark, kind, whole(source_table), lambda: whole(target_table), keys, publish,
                   move=move, **kw)


def _move(spark: SparkSession, kind: int, url: str, target: str, rows: DataFrame, run: dict,
          properties: dict | None, num_partitions: int | None, key_type: str) -> None:
    """New and changed rows into a staging table beside the target, then one
    transaction that applies them. A failure before its commit leaves the target as
    it was; the run's mark, set in the same transaction, keeps it from acting twice."""
    stage = f"{target}_TM_STAGE"
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    keys = [resolve(rows, k) for k in run["keys"]]
    texts = {k for k in keys if types[k] == "string"}
    columns = [c for c in rows.columns if c != S.CHANGE]
    names = {c.lower(): c for c in columns}
    column_types = ", ".join([f"{quote(S.CHANGE)} VARCHAR(1)"] + [f"{quote(k)} {key_type}" for k in sorted(texts)])
    write_jdbc(rows, url, stage, "overwrite", truncate=False, properties=properties,
               num_partitions=num_partitions, column_types=column_types)
    sent = jdbc_count(spark, url, stage, properties)
    if sent != run["observed"]["_total"]:
        raise RuntimeError(f"{stage} holds {sent} rows, {run['observed']['_total']} were sent")
    run_once(spark, url, run["run_id"], move_statements(
        spark, kind, url, stage, target, keys, columns, texts if run["normalize"] else set(), S.CHANGE,
        names.get(C.SCD2_FLAG, ""), names.get(C.SCD2_EXPIRY, ""), as_date(run["as_of"]), C.LATEST, C.EXPIRED),
        properties)


def read_parquet_target(spark: SparkSession, path: str, source: DataFrame) -> DataFrame:
    """The Parquet target; empty, with the source's columns, if it has no files
    (it doesn't exist, or a replacement stopped after it had removed them)."""
    if path_exists(spark, path):
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
    return source.limit(0)


def write_parquet(df: DataFrame, path: str, mode: str, partition_by: Iterable[str] = ()) -> None:
    """Append to or replace a Parquet target; with partitions only those in ``df``."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def run_scd_parquet(spark: SparkSession, kind: int, source: DataFrame, target_path: str,
                    keys: str | Iterable[str], *, as_of=None, **kw) -> dict:
    """The file flavour: the target is a Parquet folder (may not exist yet, in
    which case the source schema starts it empty).

    Type 2 keeps one folder per ``flag`` and ``expiry_date``. A load reads and
    replaces the versions in force (``flag=1``) and the folder of versions
    that expire on its own day; older history is neither read nor rewritten."""
    if kind == 2:
        return _scd2_parquet(spark, source, target_path, keys, as_of=as_of, **kw)
    def target() -> DataFrame:
        return read_parquet_target(spark, target_path, source)

    def publish(df: DataFrame, run: dict) -> None:
        write_parquet(df, target_path, run["mode"])
    kw.setdefault("stage_key", target_path)
    return run_scd(spark, kind, source, target, keys, publish, as_of=as_of, **kw)


def _scd2_parquet(spark: SparkSession, source: DataFrame, path: str, keys, *, as_of=None,
                  **kw) -> dict:
    as_of = str(as_date(resolve_stamps(spark, as_of, load_ts="").as_of))
    parts = [C.SCD2_FLAG, C.SCD2_EXPIRY]
    live, today = (f"{path.rstrip('/')}/{C.SCD2_FLAG}={flag}" for flag in (C.LATEST, C.EXPIRED))
    today = f"{today}/{C.SCD2_EXPIRY}={as_of}"

    def stored(folder: str, flag: int, expiry: str | None) -> DataFrame | None:
        if not path_exists(spark, folder):
            return None
        df = spark.read.option("recursiveFileLookup", "true").parquet(folder)
        return df.withColumns({C.SCD2_FLAG: F.lit(flag), C.SCD2_EXPIRY: F.lit(expiry).cast("date")})

    def target() -> DataFrame:
        now = stored(live, C.LATEST, None)
        if now is None:
            if path_exists(spark, path):
                raise ValueError(f"{path} has no {C.SCD2_FLAG}={C.LATEST} folder; it is not a type-2 "
                                 "target in this layout, or has lost its current versions")
            now = S.scd2_frame(source.limit(0).withColumn(C.SCD2_FLAG, F.lit(C.LATEST)))
        expired = stored(today, C.EXPIRED, as_of)
        # a second load on one day must not lose the first one's
        return now if expired is None else now.unionByName(expired, allowMissingColumns=True)

    def publish(df: DataFrame, run: dict) -> None:
        write_parquet(df, path, run["mode"], parts)
    kw.setdefault("stage_key", path)
    return run_scd(spark, 2, source, target, keys, publish, as_of=as_of, **kw)


def read_scd2_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A type-2 target as ``run_scd_parquet`` writes it, all versions."""
    df = spark.read.parquet(path)
    return df.withColumns({C.SCD2_FLAG: F.col(C.SCD2_FLAG).cast("int"),
                           C.SCD2_EXPIRY: F.col(C.SCD2_EXPIRY).cast("date")})
