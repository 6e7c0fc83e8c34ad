"""Backups by manifest: no copy, checksums, retention, restore; default stamps."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from test_versions import LOADS, SCHEMA, states, table  # noqa: F401  (fixtures)
from tidemark.plans.cdc_job import run_cdc
from tidemark.plans.manifest_backup import DamagedBackup, backup_version, damaged_files, restore_version
from tidemark.plans.publish import TablePaths
from tidemark.sources.files import delete_folder


def backup(spark, table, **kw):  # noqa: F811
    return backup_version(spark, "t", table.root, table.database, **kw)


def restore(spark, table, number):  # noqa: F811
    return restore_version(spark, "t", table.root, table.database, number)


def data_files(table):  # noqa: F811
    return set(glob.glob(f"{table.root}/t/versions/**/*.parquet", recursive=True))


def test_a_backup_writes_no_data_file_and_restores(spark, table, states):  # noqa: F811
    table.load(0)
    table.load(1)
    before = data_files(table)
    out = backup(spark, table)
    assert data_files(table) == before and out["version"] == 2 and out["rows"] == len(states[2])
    listed = spark.read.parquet(f"{table.root}/t/backups/2")
    # every file with rows that the view shows, and no other
    shown = {r[0] for r in spark.table(table.name).select(F.input_file_name()).distinct().collect()}
    assert {r.file.rsplit("/", 1)[-1] for r in listed.collect()} == {f.rsplit("/", 1)[-1] for f in shown}
    assert all(os.path.getsize(r.file.removeprefix("file:")) == r.length for r in listed.collect())
    for i in (2, 3, 0):             # more loads than the job keeps versions
        table.load(i, keep=1)
    assert 2 in table.open_versions() and 3 not in table.open_versions()
    assert restore(spark, table, 2) == len(states[2]) and table.rows() == states[2]
    table.load(2)
    assert table.rows() == states[3]
    table.load(3)
    assert table.rows() == states[4]


def test_damage_is_found_and_not_shown(spark, table, states):  # noqa: F811
    table.load(0)
    table.load(1)
    backup(spark, table)
    table.load(2)
    assert damaged_files(spark, "t", table.root, 2).count() == 0
    files = spark.read.parquet(f"{table.root}/t/backups/2").collect()
    closed = next(r.file for r in files if r.closed).removeprefix("file:")
    spare = next(r.file for r in files if not r.closed).removeprefix("file:")
    with open(closed, "rb") as f:
        whole = f.read()
    crc = os.path.join(os.path.dirname(closed), "." + os.path.basename(closed) + ".crc")
    if os.path.exists(crc):
        os.remove(crc)
    with open(closed, "wb") as f:
        f.write(whole[:-7])
    other = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    assert [r.problem for r in damaged_files(spark, "t", table.root, 2).collect()] == ["gone"]
    with pytest.raises(DamagedBackup):
        restore(spark, table, 2)
    with open(closed, "wb") as f:
        f.write(whole)
    # a whole Parquet file with other rows under the old name
    other.write.parquet(f"{table.root}/other")
    made = next(p for p in glob.glob(f"{table.root}/other/*.parquet") if os.path.getsize(p) > 0
                and spark.read.parquet(p).count())
    with open(made, "rb") as f, open(spare, "wb") as g:
        g.write(f.read())
    spare_crc = os.path.join(os.path.dirname(spare), "." + os.path.basename(spare) + ".crc")
    if os.path.exists(spare_crc):
        os.remove(spare_crc)
    assert [r.problem for r in damaged_files(spark, "t", table.root, 2).collect()] == ["changed"]
    with pytest.raises(DamagedBackup):
        restore(spark, table, 2)
    assert table.rows() == states[3]


def test_retention_and_what_is_read(spark, table, states):  # noqa: F811
    for i, read in ((0, 1), (1, 2), (3, 2)):
        table.load(i, keep=1)
        assert backup(spark, table)["read"] == read      # the open rows, and what the run closed
    listed = spark.read.parquet(f"{table.root}/t/backups/3")
    assert {(r.run, r.closed) for r in listed.collect()} == {(2, True), (3, True), (3, False)}
    assert sum(r.rows for r in listed.collect()) == len(table.rows())
    assert table.open_versions() == [2, 3]               # the first backup was dropped with its rows
    assert restore(spark, table, 2) == len(states[2]) and table.rows() == states[2]
    with pytest.raises(ValueError):
        restore(spark, table, 1)


def test_a_version_of_another_branch_is_refused(spark, table):  # noqa: F811
    for i in (0, 1, 3):
        table.load(i)
    backup(spark, table)
    table.rollback()
    table.load(2)                                        # version 4 comes from 2, not from 3
    now = table.rows()
    with pytest.raises(DamagedBackup):
        restore(spark, table, 3)
    assert table.rows() == now


def test_default_stamps_lie_between_two_clock_readings(spark, tmp_root):
    prep = spark.createDataFrame(LOADS[0][1], SCHEMA)
    read = lambda: spark.range(1).select(F.current_date(), F.current_timestamp().cast("double")).first()
    before = read()
    run_cdc(spark, "t", ["k"], tmp_root, prep=prep)
    after = read()
    rows = (spark.read.parquet(TablePaths(tmp_root, "t").target)
            .select("bgn_dt", F.col("audit_inserted_ts").cast("double").alias("ts")).distinct().collect())
    assert len(rows) == 1 and before[0] <= rows[0].bgn_dt <= after[0]
    assert before[1] - 1e-5 <= rows[0].ts <= after[1]
    assert abs((dt.datetime.now(dt.UTC).date() - rows[0].bgn_dt).days) <= 1


def test_nothing_to_back_up(spark, table):  # noqa: F811
    with pytest.raises(RuntimeError):
        backup(spark, table)
    table.load(0)
    backup(spark, table)
    delete_folder(spark, f"{table.root}/t/versions/run=1")
    with pytest.raises(DamagedBackup):
        restore(spark, table, 1)
