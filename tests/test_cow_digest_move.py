"""Copy-on-write type 1, digest diff, database moves, histogram splits, repair."""

import pytest
from pyspark.sql import functions as F

from test_skew import shuffle_records_written
from tidemark.operators import snapshot_diff as sd
from tidemark.operators.digest_diff import digest_next_state
from tidemark.plans import cow_job, run_log, scd_job
from tidemark.plans.cow_job import live_files, read_cow, run_scd1_cow, vacuum
from tidemark.plans.publish import reconcile
from tidemark.plans.scd_job import PublishFailed, run_scd_jdbc
from tidemark.sources import jdbc
from tidemark.sources.files import delete_folder, list_names
from tidemark.sources.jdbc import read_jdbc, run_once, write_jdbc

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


# ------------------------------------------------------------------ copy-on-write

def kv(df):
    return sorted((r.k, r.v) for r in df.collect())


def test_only_files_with_changed_rows_are_rewritten(spark, tmp_root):
    path = f"{tmp_root}/t"
    src = spark.range(1000).selectExpr("cast(id as int) AS k", "concat('v', id) AS v")
    out = run_scd1_cow(spark, src, path, ["k"], rows_per_file=100)
    assert (out["N"], out["U"], out["files_written"]) == (1000, 0, 10)
    before = {f["name"] for f in live_files(spark, path)}
    new = src.selectExpr("k", "CASE WHEN k BETWEEN 205 AND 215 THEN 'new' WHEN k = 950 THEN NULL ELSE v END AS v")
    new = new.unionByName(spark.createDataFrame([(5000, "x"), (None, "no key")], "k int, v string"))
    out = run_scd1_cow(spark, new, path, ["k"], rows_per_file=100)
    assert (out["N"], out["U"]) == (1, 12) and out["files_rewritten"] in (2, 3)
    after = {f["name"] for f in live_files(spark, path)}
    assert len(before & after) == 10 - out["files_rewritten"] == out["files_kept"]
    want = sorted((r.k, r.v) for r in new.where("k IS NOT NULL").collect())
    assert sorted(kv(read_cow(spark, path)), key=str) == sorted(want, key=str)
    assert kv(read_cow(spark, path, 1)) == kv(src)
    # nothing changed: no version, no file
    assert run_scd1_cow(spark, new, path, ["k"], rows_per_file=100) | {"N": 0} == {
        "N": 0, "U": 0, "files_rewritten": 0, "files_written": 0, "files_kept": len(after)}


def test_a_failed_load_changes_nothing_and_vacuum_clears_it(spark, tmp_root, monkeypatch):
    path = f"{tmp_root}/t"
    run_scd1_cow(spark, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, ["k"])
    new = spark.createDataFrame([(2, "B"), (2, "A"), (3, "c")], "k int, v string")
    with monkeypatch.context() as m:
        m.setattr(cow_job, "create_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run_scd1_cow(spark, new, path, ["k"])
    assert kv(read_cow(spark, path)) == [(1, "a"), (2, "b")]
    assert run_scd1_cow(spark, new, path, ["k"])["version"] == 2
    assert kv(read_cow(spark, path)) == [(1, "a"), (2, "A"), (3, "c")]
    assert len(list_names(spark, f"{path}/data")) == 3
    gone = vacuum(spark, path, keep=1)
    assert gone and len(list_names(spark, f"{path}/data")) == 1
    assert kv(read_cow(spark, path)) == [(1, "a"), (2, "A"), (3, "c")]
    with run_log.Lease(spark, f"{path}/runs", "other"):
        with pytest.raises(run_log.Overlap):
            run_scd1_cow(spark, new, path, ["k"])


# ------------------------------------------------------------------ digests

def stored(spark, rows, schema="k long, v string"):
    return spark.createDataFrame(rows, schema).selectExpr(
        "*", "'I' AS audit_flag", "date'2024-05-01' AS bgn_dt", "date'9999-12-31' AS end_dt",
        "timestamp'2024-05-01' AS audit_inserted_ts")


STAMPS = sd.Stamps("2024-06-01", "2024-06-01 00:00:00")


def both_ways(spark, new, old, bucket, keys=("k",)):
    plain = sd.next_state(sd.prepare_snapshot(new, list(keys)), old, list(keys), STAMPS, tag=True)
    digest = digest_next_state(new, old, list(keys), STAMPS, bucket=bucket, tag=True)
    rows = lambda df: sorted(str(r) for r in df.select(*plain.columns).collect())
    assert rows(digest) == rows(plain)
    return digest


@pytest.mark.parametrize("bucket", ["k div 4", "k", "k * 0", "nullif(k % 3, 1)"])
def test_digest_diff_equals_the_join(spark, bucket):
    old = stored(spark, [(i, f"v{i}") for i in range(40)] + [(None, "no key"), (100, None)])
    new = spark.createDataFrame(
        [(i, f"v{i}" if i % 9 else "new") for i in range(3, 50)] + [(20, "v20"), (20, "v20"), (21, "other"),
                                                                   (None, "x"), (100, None)], "k long, v string")
    both_ways(spark, new, old, bucket)


def test_text_keys_nulls_and_empty_sides(spark):
    old = stored(spark, [("a", "1"), ("b ", None), ("c", "3")], "k string, v string")
    new = spark.createDataFrame([("A", "1"), ("B", None), (" C", "4"), ("d", "")], "k string, v string")
    both_ways(spark, new, old, "ascii(trim(upper(k)))")
    both_ways(spark, new.limit(0), old, "ascii(trim(upper(k)))")
    both_ways(spark, new, old.limit(0), "ascii(trim(upper(k)))")


def test_clustered_changes_shuffle_a_fraction(spark, tmp_root):
    n = 20_000
    spark.range(n).selectExpr("id AS k", "concat('v', id) AS v").write.parquet(f"{tmp_root}/new")
    new = spark.read.parquet(f"{tmp_root}/new").selectExpr(
        "k", "CASE WHEN k BETWEEN 7000 AND 7199 THEN 'changed' ELSE v END AS v")
    stored(spark, [(0, "")]).limit(0).unionByName(spark.range(n).selectExpr(
        "id AS k", "concat('v', id) AS v", "'I' AS audit_flag", "date'2024-05-01' AS bgn_dt",
        "date'9999-12-31' AS end_dt", "timestamp'2024-05-01' AS audit_inserted_ts")).write.parquet(f"{tmp_root}/old")
    df = digest_next_state(new, spark.read.parquet(f"{tmp_root}/old"), ["k"], STAMPS, bucket="k div 100", tag=True)
    counts = df.groupBy(sd.CHANGE).count()
    assert sum(shuffle_records_written(counts)) < 0.1 * n
    assert {r[0]: r[1] for r in counts.collect()} == {"Z": n - 200, "U": 200, "C": 200}


# ------------------------------------------------------------------ staging table, one transaction

@pytest.fixture()
def url(tmp_root):
    return f"jdbc:derby:{tmp_root}/db;create=true"


LOADS = [[("a", "1"), ("b", "2"), ("c", "3")], [("a", "1"), ("b", "9"), ("d", "4")]]
AFTER = {0: [("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")],
         1: [("a", "1"), ("b", "9"), ("c", "3"), ("d", "4")],
         2: [("a", "1", "1", "None"), ("b", "2", "0", "2024-06-01"), ("b", "9", "1", "None"),
             ("c", "3", "1", "None"), ("d", "4", "1", "None")]}


def move(spark, url, kind, i):
    src = spark.createDataFrame(LOADS[i], "K string, V string")
    write_jdbc(src, url, "SRC", "overwrite", truncate=False, column_types="K VARCHAR(20), V VARCHAR(20)",
               properties=DRIVER)
    return run_scd_jdbc(spark, kind, url, "SRC", "T", ["K"], properties=DRIVER, single_task=True, move=True,
                        as_of=f"2024-0{5 + i}-01")


def table_rows(spark, url):
    return sorted(tuple(map(str, r)) for r in read_jdbc(spark, url, "T", properties=DRIVER, single_task=True).collect())


@pytest.mark.parametrize("kind", [0, 1, 2])
def test_move_in_one_transaction(spark, url, monkeypatch, kind):
    more = ", FLAG INT, EXPIRY_DATE DATE" if kind == 2 else ""
    run_once(spark, url, "ddl", [(f'CREATE TABLE T (K VARCHAR(20) NOT NULL, V VARCHAR(20){more})', [])], DRIVER)
    assert move(spark, url, kind, 0)["N"] == 3
    before = table_rows(spark, url)
    real = jdbc.move_statements
    with monkeypatch.context() as m:                 # the last statement fails: nothing of the others stays
        m.setattr(scd_job, "move_statements", lambda *a: real(*a) + [("INSERT INTO NOWHERE VALUES (1)", [])])
        with pytest.raises(PublishFailed):
            move(spark, url, kind, 1)
    assert table_rows(spark, url) == before
    real_once = jdbc.run_once

    def committed_then_lost(*a, **k):
        real_once(*a, **k)
        raise OSError("lost")
    with monkeypatch.context() as m:                 # committed, but the run doesn't hear of it
        m.setattr(scd_job, "run_once", committed_then_lost)
        with pytest.raises(PublishFailed):
            move(spark, url, kind, 1)
    assert table_rows(spark, url) == AFTER[kind]
    out = move(spark, url, kind, 1)
    assert out["completed"] and table_rows(spark, url) == AFTER[kind]
    assert (out["N"], out["U"]) == (0, 0)


# ------------------------------------------------------------------ equal-count splits

def test_histogram_splits_have_equal_counts(spark, url):
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 100 = 1 THEN NULL ELSE cast(exp(id / 200.0) as int) - 40 END AS k",
        "cast(id as int) AS v")
    write_jdbc(df, url, "SKEWED", properties=DRIVER)
    back = read_jdbc(spark, url, "SKEWED", properties=DRIVER, histogram_column="K", num_partitions=8)
    assert sorted(r.v for r in back.collect()) == list(range(3000))
    counts = sorted((r[1] for r in back.groupBy(F.spark_partition_id()).count().collect()), reverse=True)
    assert counts[0] < 1150 and counts[1] <= 2 * 3000 / 8 and len(counts) <= 16
    write_jdbc(df.limit(0), url, "NOTHING", properties=DRIVER)
    assert read_jdbc(spark, url, "NOTHING", properties=DRIVER, histogram_column="K").count() == 0
    write_jdbc(df.where("k IS NULL"), url, "NULLS", properties=DRIVER)
    assert read_jdbc(spark, url, "NULLS", properties=DRIVER, histogram_column="K").count() == df.where("k IS NULL").count()


# ------------------------------------------------------------------ repair, both ways

def test_reconcile_adds_and_drops(spark, tmp_root):
    db = "tidemark_rec_" + tmp_root.rsplit("-", 1)[-1].lower()
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/db'")
    path = f"{tmp_root}/t"
    rows = lambda *days: spark.createDataFrame([(1, d) for d in days], "v int, d string")
    rows("2024-01-01", "2024-01-02").write.partitionBy("d").parquet(path)
    spark.catalog.createTable(f"{db}.t", path=path, source="parquet")
    assert len(reconcile(spark, f"{db}.t")["dropped"]) == 0
    rows("2024-01-03").write.mode("append").partitionBy("d").parquet(path)
    delete_folder(spark, f"{path}/d=2024-01-01")
    assert reconcile(spark, f"{db}.t") == {"added": ["d=2024-01-03"], "dropped": ["d=2024-01-01"]}
    assert sorted(str(r.d) for r in spark.table(f"{db}.t").collect()) == ["2024-01-02", "2024-01-03"]
    spark.sql(f"DROP DATABASE {db} CASCADE")
