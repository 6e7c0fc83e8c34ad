"""The CDC job on disk: initial load, incremental loads, same-day re-run,
history kept, empty snapshot, rejected keys, catalog registration."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans.cdc_job import run_cdc
from tidemark.plans.publish import TablePaths, StagingMismatch, verify_staged, write_observed
from tidemark.sources import derived as X
from tidemark.sources.files import read_current, read_target
from paths import SF001

OPEN = dt.date(9999, 12, 31)


def snap(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, row_md5 string")


def table(spark, root):
    return read_target(spark, TablePaths(root, "t").target)


def test_initial_then_incremental_then_same_day(spark, tmp_root):
    r1 = run_cdc(spark, "t", ["k"], tmp_root, as_of="2024-05-01", load_ts="2024-05-01 00:00:00",
                 prep=snap(spark, [("a", 1, "1"), ("b", 2, "2"), ("c", 3, "3")]))
    assert r1["status"] == "initial_load" and r1["I"] == 3
    r2 = run_cdc(spark, "t", ["k"], tmp_root, as_of="2024-06-01", load_ts="2024-06-01 00:00:00",
                 prep=snap(spark, [("a", 1, "1"), ("b", 20, "20"), ("d", 4, "4")]))
    assert (r2["I"], r2["U"], r2["Z"], r2["D"], r2["closed"]) == (1, 1, 1, 1, 2)
    r3 = run_cdc(spark, "t", ["k"], tmp_root, as_of="2024-06-01", load_ts="2024-06-01 12:00:00",
                 prep=snap(spark, [("a", 10, "10"), ("b", 20, "20"), ("d", 4, "4")]))
    assert (r3["U"], r3["carried"], r3["closed"]) == (1, 2, 1)
    t = table(spark, tmp_root)
    closed = t.where(F.col("end_dt") == F.lit("2024-05-31").cast("date"))
    assert sorted((r.k, r.v) for r in closed.collect()) == [("a", 1), ("b", 2), ("c", 3)]
    cur = t.where(F.col("end_dt") == F.lit(OPEN))
    assert sorted((r.k, r.v) for r in cur.collect()) == [("a", 10), ("b", 20), ("d", 4)]
    # re-running the same snapshot changes nothing
    before = sorted(map(tuple, t.collect()))
    r4 = run_cdc(spark, "t", ["k"], tmp_root, as_of="2024-06-01", load_ts="2024-06-01 13:00:00",
                 prep=snap(spark, [("a", 10, "10"), ("b", 20, "20"), ("d", 4, "4")]))
    assert (r4["I"], r4["U"], r4["D"], r4["Z"]) == (0, 0, 0, 3)
    assert sorted(map(tuple, table(spark, tmp_root).collect())) == before


def test_empty_snapshot_leaves_target_untouched(spark, tmp_root):
    run_cdc(spark, "t", ["k"], tmp_root, as_of="2024-05-01", load_ts="2024-05-01 00:00:00",
            prep=snap(spark, [("a", 1, "1")]))
    before = sorted(map(tuple, table(spark, tmp_root).collect()))
    r = run_cdc(spark, "t", ["k"], tmp_root, as_of="2024-06-01", load_ts="2024-06-01 00:00:00",
                prep=snap(spark, [(None, 5, "5")]))
    assert r["status"] == "empty_prep" and r["rejected"] == 1
    assert sorted(map(tuple, table(spark, tmp_root).collect())) == before
    assert spark.read.parquet(TablePaths(tmp_root, "t").rejected).count() == 1


def test_history_only_target_is_initial_load_that_keeps_history(spark, tmp_root):
    p = TablePaths(tmp_root, "t")
    hist = spark.createDataFrame(
        [("a", 1, "1", "I", dt.date(2020, 1, 1), dt.date(2020, 12, 31), dt.datetime(2020, 1, 1))],
        "k string, v int, row_md5 string, audit_flag string, bgn_dt date, end_dt date, audit_inserted_ts timestamp")
    hist.write.partitionBy("end_dt").parquet(p.target)
    r = run_cdc(spark, "t", ["k"], tmp_root, as_of="2024-06-01", load_ts="2024-06-01 00:00:00",
                prep=snap(spark, [("a", 2, "2")]))
    assert r["status"] == "initial_load"
    assert table(spark, tmp_root).count() == 2


def test_delete_then_reinsert(spark, tmp_root):
    run_cdc(spark, "t", ["k"], tmp_root, as_of="2024-05-01", load_ts="2024-05-01 00:00:00",
            prep=snap(spark, [("a", 1, "1"), ("b", 2, "2")]))
    run_cdc(spark, "t", ["k"], tmp_root, as_of="2024-05-10", load_ts="2024-05-10 00:00:00",
            prep=snap(spark, [("a", 1, "1")]))
    r = run_cdc(spark, "t", ["k"], tmp_root, as_of="2024-05-20", load_ts="2024-05-20 00:00:00",
                prep=snap(spark, [("a", 1, "1"), ("b", 2, "2")]))
    assert r["I"] == 1
    rows = sorted((x.k, x.end_dt) for x in table(spark, tmp_root).collect())
    assert rows == [("a", OPEN), ("b", dt.date(2024, 5, 9)), ("b", OPEN)]


def test_reads_prep_folder_and_registers_table(spark, tmp_root):
    p = TablePaths(tmp_root, "cust")
    X.customer_prep(spark, SF001).withColumn("audit_inserted_ts", F.current_timestamp()) \
        .write.parquet(p.prep)
    spark.sql("create database if not exists tm_test")
    r = run_cdc(spark, "cust", ["nm"], tmp_root, database="tm_test", as_of="2024-06-01",
                load_ts="2024-06-01 00:00:00")
    assert r["status"] == "initial_load"
    assert spark.table("tm_test.cust").count() == r["I"]
    assert "audit_inserted_ts" in spark.table("tm_test.cust").columns
    cur = read_current(spark, p.target)
    plan = cur._jdf.queryExecution().executedPlan().toString()
    assert "end_dt=9999-12-31" in plan                # only the open partition is listed
    assert dict(cur.dtypes)["end_dt"] == "date"
    # a second run adds just the touched partitions to the catalog
    changed = X.customer_prep(spark, SF001).withColumn("bal", F.col("bal") + 1) \
        .withColumn("row_md5", X.row_md5("bal", "seg"))
    r2 = run_cdc(spark, "cust", ["nm"], tmp_root, database="tm_test", as_of="2024-07-01",
                 load_ts="2024-07-01 00:00:00", prep=changed)
    assert r2["U"] == r["I"]
    t = spark.table("tm_test.cust")
    assert t.count() == 2 * r["I"]
    assert t.where("end_dt = DATE'2024-06-30'").count() == r["I"]
    parts = {r[0] for r in spark.sql("SHOW PARTITIONS tm_test.cust").collect()}
    assert parts == {"end_dt=2024-06-30", "end_dt=9999-12-31"}


def test_staging_mismatch_is_detected(spark, tmp_root):
    df = spark.createDataFrame([("a", "I"), ("b", "U")], "k string, _change string")
    path = f"{tmp_root}/stage"
    observed = write_observed(df, path, "_change", ["I", "U"])
    assert observed == {"I": 1, "U": 1, "_total": 2}
    verify_staged(spark, path, "_change", observed)
    with pytest.raises(StagingMismatch):
        verify_staged(spark, path, "_change", {"I": 2, "U": 1, "_total": 3})


def test_without_backup(spark, tmp_root):
    from tidemark.sources.files import path_exists
    p = TablePaths(tmp_root, "t")
    snap(spark, [("a", 1, "1"), ("b", 2, "2")]).write.parquet(p.prep)
    r1 = run_cdc(spark, "t", "k", tmp_root, as_of="2024-05-01",
                                   load_ts="2024-05-01 00:00:00", backup=False)
    assert r1["status"] == "initial_load" and r1["I"] == 2
    snap(spark, [("a", 1, "1"), ("b", 3, "3")]).write.mode("overwrite").parquet(p.prep)
    r2 = run_cdc(spark, "t", "k", tmp_root, as_of="2024-06-01", load_ts="2024-06-01 00:00:00",
                 backup=False)
    assert (r2["U"], r2["Z"], r2["closed"]) == (1, 1, 1)
    assert not path_exists(spark, p.backup)
    assert table(spark, tmp_root).count() == 3


def test_republish_completes_a_broken_publish(spark, tmp_root):
    from tidemark.plans.cdc_job import republish
    from tidemark.plans.publish import publish_partitions
    run_cdc(spark, "t", ["k"], tmp_root, as_of="2024-05-01", load_ts="2024-05-01 00:00:00",
            prep=snap(spark, [("a", 1, "1"), ("b", 2, "2")]))
    run_cdc(spark, "t", ["k"], tmp_root, as_of="2024-06-01", load_ts="2024-06-01 00:00:00",
            prep=snap(spark, [("a", 5, "5"), ("b", 2, "2")]))
    after = sorted((r.k, r.v, str(r.end_dt)) for r in table(spark, tmp_root).collect())
    # simulate a publish that stopped half way: the open partition lost a row
    broken = f"{tmp_root}/broken"
    table(spark, tmp_root).where("k = 'a' AND end_dt = DATE'9999-12-31'").write.parquet(broken)
    publish_partitions(spark, broken, TablePaths(tmp_root, "t").target)
    assert table(spark, tmp_root).where("end_dt = DATE'9999-12-31'").count() == 1
    republish(spark, "t", tmp_root)
    assert sorted((r.k, r.v, str(r.end_dt)) for r in table(spark, tmp_root).collect()) == after


def test_composite_key_job(spark, tmp_root):
    sch = "region string, id int, v int"
    run_cdc(spark, "t", ["region", "id"], tmp_root, as_of="2024-05-01", load_ts="2024-05-01 00:00:00",
            prep=spark.createDataFrame([("eu", 1, 10), ("us", 1, 20), ("eu", 2, 30)], sch))
    r = run_cdc(spark, "t", ["region", "id"], tmp_root, as_of="2024-06-01",
                load_ts="2024-06-01 00:00:00",
                prep=spark.createDataFrame([(" EU", 1, 10), ("us", 1, 21), ("us", 2, 40),
                                            (None, 3, 50)], sch))
    # (' EU', 1) matches ('eu', 1); ('us', 1) changed; ('us', 2) new; ('eu', 2) gone; NULL part rejected
    assert (r["Z"], r["U"], r["I"], r["D"], r["rejected"]) == (1, 1, 1, 1, 1)
    cur = table(spark, tmp_root).where("end_dt = DATE'9999-12-31'")
    assert sorted((x.region, x.id, x.v) for x in cur.collect()) == \
        [("eu", 1, 10), ("us", 1, 21), ("us", 2, 40)]


def test_closed_partition_file_count_follows_its_size(spark, tmp_root):
    import glob
    rows = [(f"k{i}", i, str(i)) for i in range(40)]
    run_cdc(spark, "t", ["k"], tmp_root, as_of="2024-05-01", load_ts="2024-05-01 00:00:00",
            prep=snap(spark, rows).repartition(8))
    changed = [(k, v + 1, str(v + 1)) if v < 9 else (k, v, m) for k, v, m in rows]
    r = run_cdc(spark, "t", ["k"], tmp_root, as_of="2024-06-01", load_ts="2024-06-01 00:00:00",
                prep=snap(spark, changed).repartition(8), rows_per_file=4)
    assert r["closed"] == 9
    closed_dir = f"{TablePaths(tmp_root, 't').target}/end_dt=2024-05-31"
    assert len(glob.glob(f"{closed_dir}/*.parquet")) == 3          # ceil(9 / 4)
    assert table(spark, tmp_root).count() == 49
