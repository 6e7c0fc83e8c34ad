"""JDBC source/sink and the SCD job against an embedded (in-process) Derby
database: no server, no port."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans.scd_job import read_scd2_parquet, run_scd_jdbc, run_scd_parquet
from tidemark.sources.jdbc import read_jdbc, write_jdbc
from paths import SF001

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture()
def url(tmp_root):
    return f"jdbc:derby:{tmp_root}/db;create=true"


def test_roundtrip_partitioned_read(spark, url):
    sup = spark.read.parquet(f"{SF001}/supplier.parquet")
    write_jdbc(sup, url, "SUPPLIER", "append", properties=DRIVER)
    back = read_jdbc(spark, url, "SUPPLIER", properties=DRIVER, partition_column="S_SUPPKEY",
                     num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, sup.collect()))
    write_jdbc(sup.where("s_suppkey < 3"), url, "SUPPLIER", "overwrite", properties=DRIVER)
    assert read_jdbc(spark, url, "SUPPLIER", properties=DRIVER, single_task=True).count() == 3
    pushed = read_jdbc(spark, url, "SUPPLIER", properties=DRIVER, single_task=True).where(F.col("s_suppkey") == 1)
    assert "PushedFilters: [*IsNotNull(s_suppkey), *EqualTo(s_suppkey,1)]" in \
        pushed._jdf.queryExecution().executedPlan().toString()


def _emp(spark):
    return spark.createDataFrame([(1, "a", 10.0, 1), (2, "b", 20.0, 1), (3, "c", 30.0, 2)],
                                 "EMPNO int, ENAME string, SAL double, DEPTNO int")


def test_scd_jobs_over_jdbc(spark, url):
    src = _emp(spark)
    write_jdbc(src, url, "EMP_SRC", "append", properties=DRIVER)
    for kind in (0, 1):
        write_jdbc(src.limit(0), url, f"EMP_SCD{kind}", "append", properties=DRIVER)
    r0 = run_scd_jdbc(spark, 0, url, "EMP_SRC", "EMP_SCD0", ["EMPNO"], properties=DRIVER, single_task=True)
    assert r0["N"] == 3
    r1 = run_scd_jdbc(spark, 1, url, "EMP_SRC", "EMP_SCD1", ["EMPNO"], properties=DRIVER, single_task=True)
    assert r1["N"] == 3
    # change the source: one raise, one new employee
    src2 = src.withColumn("SAL", F.when(F.col("EMPNO") == 2, 25.0).otherwise(F.col("SAL"))) \
        .unionByName(spark.createDataFrame([(4, "d", 40.0, 2)], src.schema))
    write_jdbc(src2, url, "EMP_SRC", "overwrite", properties=DRIVER)
    r0 = run_scd_jdbc(spark, 0, url, "EMP_SRC", "EMP_SCD0", ["EMPNO"], properties=DRIVER, single_task=True)
    assert r0["N"] == 1
    r1 = run_scd_jdbc(spark, 1, url, "EMP_SRC", "EMP_SCD1", ["EMPNO"], properties=DRIVER, single_task=True)
    assert (r1["N"], r1["U"], r1["K"]) == (1, 1, 2)
    t1 = {r.EMPNO: r.SAL for r in read_jdbc(spark, url, "EMP_SCD1", properties=DRIVER, single_task=True).collect()}
    assert t1 == {1: 10.0, 2: 25.0, 3: 30.0, 4: 40.0}
    t0 = {r.EMPNO: r.SAL for r in read_jdbc(spark, url, "EMP_SCD0", properties=DRIVER, single_task=True).collect()}
    assert t0 == {1: 10.0, 2: 20.0, 3: 30.0, 4: 40.0}


def test_scd2_job_over_jdbc(spark, url):
    src = _emp(spark)
    write_jdbc(src, url, "EMP_SRC2", "append", properties=DRIVER)
    empty = src.limit(0).select("*", F.lit(1).alias("FLAG"), F.lit(None).cast("date").alias("EXPIRY_DATE"))
    write_jdbc(empty, url, "EMP_SCD2", "append", properties=DRIVER)
    run_scd_jdbc(spark, 2, url, "EMP_SRC2", "EMP_SCD2", ["EMPNO"], properties=DRIVER, single_task=True, as_of="2024-06-01")
    src2 = src.withColumn("SAL", F.when(F.col("EMPNO") == 2, 25.0).otherwise(F.col("SAL")))
    write_jdbc(src2, url, "EMP_SRC2", "overwrite", properties=DRIVER)
    r = run_scd_jdbc(spark, 2, url, "EMP_SRC2", "EMP_SCD2", ["EMPNO"], properties=DRIVER, single_task=True,
                     as_of="2024-07-01")
    assert (r["U"], r["X"], r["K"]) == (1, 1, 2)
    rows = read_jdbc(spark, url, "EMP_SCD2", properties=DRIVER, single_task=True).collect()
    assert len(rows) == 4
    latest = {r.EMPNO: r.SAL for r in rows if r.FLAG == 1}
    assert latest == {1: 10.0, 2: 25.0, 3: 30.0}
    expired = [(r.EMPNO, r.SAL, str(r.EXPIRY_DATE)) for r in rows if r.FLAG == 0]
    assert expired == [(2, 20.0, "2024-07-01")]


def test_scd_job_over_parquet(spark, tmp_root):
    path = f"{tmp_root}/scd2"
    src = _emp(spark)
    run_scd_parquet(spark, 2, src, path, ["EMPNO"], as_of="2024-06-01")
    r = run_scd_parquet(spark, 2, src.withColumn("SAL", F.col("SAL") + 1), path, ["EMPNO"],
                        as_of="2024-07-01")
    assert (r["U"], r["X"]) == (3, 3)
    assert spark.read.parquet(path).count() == 6


def test_cli_scd_over_jdbc(spark, url, capsys):
    import json
    from tidemark.__main__ import main
    src = _emp(spark)
    write_jdbc(src, url, "CLI_SRC", "append", properties=DRIVER)
    write_jdbc(src.limit(0), url, "CLI_SCD1", "append", properties=DRIVER)
    assert main(["scd", "--kind", "1", "--url", url, "--source", "CLI_SRC", "--target", "CLI_SCD1",
                 "--keys", "EMPNO", "--partition-column", "EMPNO", "--num-partitions", "2",
                 "--prop", f"driver={DRIVER['driver']}"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["N"] == 3
    assert read_jdbc(spark, url, "CLI_SCD1", properties=DRIVER, single_task=True).count() == 3


def test_read_split_by_database_side_hash_buckets(spark, url):
    sup = spark.read.parquet(f"{SF001}/supplier.parquet")
    write_jdbc(sup, url, "SUP_HASH", "append", properties=DRIVER)
    preds = [f'MOD("s_suppkey", 4) = {i}' for i in range(4)]
    back = read_jdbc(spark, url, "SUP_HASH", properties=DRIVER, predicates=preds)
    assert back.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, sup.collect()))


def test_range_split_on_a_date_column(spark, url):
    o = spark.read.parquet(f"{SF001}/orders.parquet").selectExpr(
        "o_orderkey", "CAST(o_orderdate AS DATE) AS o_day", "o_totalprice")
    write_jdbc(o, url, "ORD_DAYS", "append", properties=DRIVER)
    back = read_jdbc(spark, url, "ORD_DAYS", properties=DRIVER, partition_column="o_day",
                     num_partitions=5)
    assert back.rdd.getNumPartitions() == 5
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, o.collect()))


def test_hash_buckets_are_complete(spark, url):
    df = spark.range(-50, 50).selectExpr("CASE WHEN id = 7 THEN NULL ELSE id END AS k", "id AS v")
    write_jdbc(df, url, "SUP_BUCKETS", properties=DRIVER)
    back = read_jdbc(spark, url, "SUP_BUCKETS", properties=DRIVER, bucket_column="k", num_partitions=8)
    assert back.rdd.getNumPartitions() == 8
    assert sorted(r.v for r in back.collect()) == list(range(-50, 50))
    with pytest.raises(ValueError):
        read_jdbc(spark, url, "SUP_BUCKETS", properties=DRIVER)


def test_incomplete_predicates_stop_before_the_overwrite(spark, url):
    df = spark.range(-5, 5).selectExpr("id AS k", "id AS v")
    for name in ("INC_SRC", "INC_TGT"):
        write_jdbc(df, url, name, properties=DRIVER)
    with pytest.raises(RuntimeError, match="disjoint and complete"):
        run_scd_jdbc(spark, 1, url, "INC_SRC", "INC_TGT", ["k"], properties=DRIVER,
                     predicates=['MOD("k", 2) = 0', 'MOD("k", 2) = 1'])
    assert read_jdbc(spark, url, "INC_TGT", properties=DRIVER, bucket_column="k").count() == 10


def test_scd2_parquet_leaves_old_history_alone(spark, tmp_root):
    import glob
    import os
    path = f"{tmp_root}/scd2"
    src = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    run_scd_parquet(spark, 2, src, path, ["k"], as_of="2024-06-01")
    run_scd_parquet(spark, 2, src.withColumn("v", F.col("v") + 1), path, ["k"], as_of="2024-06-02")
    old = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/flag=0/*/*.parquet")}
    run_scd_parquet(spark, 2, src.where("k = 1"), path, ["k"], as_of="2024-06-03")
    run_scd_parquet(spark, 2, src.where("k = 2"), path, ["k"], as_of="2024-06-03")
    assert old and all(os.stat(f).st_mtime_ns == t for f, t in old.items())
    got = sorted((r.k, r.v, r.flag, str(r.expiry_date)) for r in read_scd2_parquet(spark, path).collect())
    assert got == [(1, 10, 0, "2024-06-02"), (1, 10, 1, "None"), (1, 11, 0, "2024-06-03"),
                   (2, 20, 0, "2024-06-02"), (2, 20, 1, "None"), (2, 21, 0, "2024-06-03")]
