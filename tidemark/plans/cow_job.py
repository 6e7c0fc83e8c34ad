"""SCD type 1 by copy-on-write: only files with changed rows are written anew.

The table is a folder of immutable Parquet files and a list of the live ones,
``manifest/<number>.json``, created exclusively: readers take the newest list, so
they see the whole old or the whole new state, and a load that fails before its
list is written has changed nothing. Files and lists of earlier versions stay
until ``vacuum``; they are the backup, at no copy.

A load reads the key, the compared columns and the file name of every row
(``_metadata.file_path``), and joins them with the source once. That gives the
files with changed rows, and which source rows have their key in other files. The
changed files are read whole and rewritten together with the new keys. Rows are
kept in ranges of their keys, so that changes of neighbouring keys touch few files.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.keys import as_list, column, match_key_names, resolve, with_match_key
from ..functions.sqltext import ident, null_safe_differs
from ..operators import scd as S
from ..session import scratch_folder
from ..sources.files import create_text, delete_folder, delete_file, list_names, read_text
from . import run_log
from .publish import verify_staged, write_observed

FILE, ROW, CHANGED = "_tm_file", "_tm_row", "_tm_changed"


def _manifests(spark: SparkSession, path: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in list_names(spark, f"{path}/manifest")
            if n.endswith(".json")]


def live_files(spark: SparkSession, path: str, version: int | None = None) -> list[dict]:
    """The files of the newest list (or of ``version``): name and rows."""
    numbers = _manifests(spark, path)
    if not numbers:
        return []
    return json.loads(read_text(spark, f"{path}/manifest/{version or numbers[-1]:012d}.json"))["files"]


def read_cow(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table, or an earlier version of it that is still kept."""
    files = live_files(spark, path, version)
    if not files:
        raise ValueError(f"{path} has no version {version or ''} of a copy-on-write table")
    return spark.read.parquet(*[f"{path}/{f['name']}" for f in files])


def _write_files(spark: SparkSession, rows: DataFrame, path: str, run_id: str, keys: list[str],
                 n_files: int) -> list[dict]:
    """Write ``rows`` (tagged) in ``n_files`` ranges of the keys, compare with what
    can be read back, and list the files with their rows."""
    folder = f"data/run={run_id}"
    sorted_rows = (rows.repartitionByRange(n_files, *[column(k) for k in keys])
                   .sortWithinPartitions(*[column(k) for k in keys]))
    observed = write_observed(sorted_rows, f"{path}/{folder}", S.CHANGE, (S.NEW, S.CHANGED, S.KEPT), name="cow")
    verify_staged(spark, f"{path}/{folder}", S.CHANGE, observed)
    counts = (spark.read.parquet(f"{path}/{folder}").groupBy(F.col("_metadata.file_name").alias("f"))
              .agg(F.count(F.lit(1)).alias("n")).collect())                       # one row per file
    return [{"name": f"{folder}/{r['f']}", "rows": r["n"]} for r in sorted(counts)]


def run_scd1_cow(spark: SparkSession, source: DataFrame, path: str, keys: str | Iterable[str], *,
                 compare: Iterable[str] | None = None, normalize: bool = False, order_by=None,
                 rows_per_file: int = 5_000_000, lease_ttl: float = run_log.TTL) -> dict:
    """Load ``source`` into the table at ``path`` (made by the first load): new keys
    are added, rows that differ are replaced, others stay where they are."""
    keys, path, run_id = as_list(keys), path.rstrip("/"), run_log.new_run_id()
    with run_log.Lease(spark, f"{path}/{C.RUNS_DIR}", run_id, lease_ttl) as lease:
        numbers = _manifests(spark, path)
        old = live_files(spark, path)
        if not old:
            first = S.scd1(source, source.limit(0), keys, normalize=normalize, order_by=order_by, tag=True)
            staged = scratch_folder(spark, "cow-first")
            n = write_observed(first, staged, name="cow_first")["_total"]
            files = _write_files(spark, spark.read.parquet(staged), path, run_id, keys,
                                 max(1, -(-n // rows_per_file)))
            changed, rewritten, result = [], files, {"N": n, "U": 0}
        else:
            result, changed, rewritten = _rewrite(spark, source, path, old, run_id, keys, compare, normalize,
                                                  order_by, rows_per_file)
            gone = set(changed)
            files = [f for f in old if f["name"] not in gone] + rewritten
        if not old or rewritten:
            lease.check()
            number = numbers[-1] + 1 if numbers else 1
            text = json.dumps({"run_id": run_id, "replaced": changed, "files": files})
            if not create_text(spark, f"{path}/manifest/{number:012d}.json", text):
                raise run_log.Overlap(f"another load made version {number} of {path}")
            result["version"] = number
        return result | {"files_rewritten": len(changed), "files_written": len(rewritten),
                         "files_kept": len(files) - len(rewritten)}


def _rewrite(spark: SparkSession, source: DataFrame, path: str, old: list[dict], run_id: str, keys: list[str],
             compare, normalize: bool, order_by, rows_per_file: int) -> tuple[dict, list[str], list[dict]]:
    """Counts, names of the files to replace, and the files that replace them."""
    mk = match_key_names(len(keys))
    read = lambda names: spark.read.parquet(*[f"{path}/{n}" for n in names]).drop(S.CHANGE)
    target = read([f["name"] for f in old])
    if {c.lower() for c in target.columns} != {c.lower() for c in source.columns}:
        raise S.ColumnMismatch(f"columns of the source {source.columns} and the target {target.columns} differ")
    tkeys = [resolve(target, k) for k in keys]
    data = [c for c in (as_list(compare) if compare else target.columns)
            if c.lower() not in {k.lower() for k in keys}]
    differs = null_safe_differs([(ident("s", resolve(source, c)), ident("t", resolve(target, c))) for c in data])

    # one row per source key: where its row is, and whether it changes
    src = S.keyed_source(source, keys, normalize, order_by)
    tdata = [resolve(target, c) for c in data]
    narrow = target.select(*[column(c) for c in dict.fromkeys([*tkeys, *tdata])],
                           F.col("_metadata.file_path").alias(FILE))
    stored = (with_match_key(narrow, tkeys, normalize)
              .select(*mk, F.struct(*[column(c) for c in tdata]).alias("t"), FILE))
    hits = (src.select(*mk, F.struct(*[column(c) for c in source.columns]).alias("s"))
            .join(stored, mk, "left")
            .withColumn(CHANGED, F.col(FILE).isNotNull() & F.expr(differs)))
    staged = scratch_folder(spark, "cow-hits")
    hits.select(*mk, F.col("s").alias(ROW), FILE, CHANGED).write.parquet(staged)
    hits = spark.read.parquet(staged)

    by_name = {f["name"].rsplit("/", 2)[-2] + "/" + f["name"].rsplit("/", 1)[-1]: f for f in old}
    touched = [by_name["/".join(r[0].rsplit("/", 2)[-2:])]                          # names of files
               for r in hits.where(CHANGED).select(FILE).distinct().collect()]
    changed = sorted(f["name"] for f in touched)
    counts = hits.agg(F.count_if(F.col(FILE).isNull()).alias("N"), F.count_if(CHANGED).alias("U")).first()
    result = {"N": counts["N"], "U": counts["U"]}
    if not changed and not counts["N"]:
        return result, [], []
    # keys of other files stay out: they are stored and unchanged
    files = hits.where(CHANGED).select(FILE).distinct()
    part = (hits.where(F.col(FILE).isNotNull()).join(files, FILE, "left_semi").select(f"{ROW}.*")
            .unionByName(hits.where(F.col(FILE).isNull()).select(f"{ROW}.*")))
    base = read(changed) if changed else target.limit(0)
    rows = S.scd1(part, base, keys, compare=compare, normalize=normalize, dedupe_source=False, tag=True)
    n = counts["N"] + sum(f["rows"] for f in touched)
    rows_staged = scratch_folder(spark, "cow-rows")          # so that ranges are found without a second join
    rows.write.parquet(rows_staged)
    return result, changed, _write_files(spark, spark.read.parquet(rows_staged), path, run_id, keys,
                                         max(1, -(-n // rows_per_file)))


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Drop the lists of all but the last ``keep`` versions, and the files that none
    of those names (a failed load's included); returns the names of the files."""
    path = path.rstrip("/")
    with run_log.Lease(spark, f"{path}/{C.RUNS_DIR}", run_log.new_run_id()) as lease:
        numbers = _manifests(spark, path)
        live = {f["name"] for n in numbers[-keep:] for f in live_files(spark, path, n)}
        gone = []
        lease.check()
        for n in numbers[:-keep]:
            delete_file(spark, f"{path}/manifest/{n:012d}.json")
        for run in list_names(spark, f"{path}/data"):
            names = [f"data/{run}/{f}" for f in list_names(spark, f"{path}/data/{run}")]
            if not live & set(names):
                delete_folder(spark, f"{path}/data/{run}")
                gone += [n for n in names if n.endswith(".parquet")]
                continue
            for n in names:
                if n.endswith(".parquet") and n not in live:
                    delete_file(spark, f"{path}/{n}")
                    gone.append(n)
        return gone
