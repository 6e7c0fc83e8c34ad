"""The versioned CDC job, with and without buckets: what readers see between any
two steps, failures at every step, rollback, schema change."""

import pytest
from pyspark.sql import functions as F

from paths import SF01
from test_skew import shuffle_records_written
from tidemark.operators import snapshot_diff as sd
from tidemark.plans import run_log, versioned_job
from tidemark.plans.cdc_job import DuplicateCurrentKeys, LostPartition, run_cdc
from tidemark.plans.publish import StagingMismatch, TablePaths
from tidemark.plans.versioned_job import (base_name, match_key_property, open_name, rollback,
                                          run_cdc_versioned, shuffle_partitions, version_rows)
from tidemark.sources import derived as X

SCHEMA = "k string, v int, row_md5 string"
LOADS = [("2024-05-01", [("a", 1, "1"), ("b", 2, "2"), ("c", 3, "3")]),
         ("2024-06-01", [("a", 9, "9"), ("c", 3, "3"), ("d", 4, "4")]),
         ("2024-06-01", [("a", 9, "9"), ("c", 5, "5")]),
         ("2024-07-01", [("a", 9, "9"), ("e", 6, "6")])]
STEPS = ["write_observed", "verify_staged", "_base_table", "_add_partition", "show_version", "_drop_partitions",
         "delete_folder"]


def stamps(i):
    return {"as_of": LOADS[i][0], "load_ts": f"{LOADS[i][0]} 00:00:0{i}"}


@pytest.fixture(params=[None, 3], ids=["plain", "bucketed"])
def table(spark, tmp_root, request):
    db = "tidemark_v_" + tmp_root.rsplit("-", 1)[-1].lower()
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/db'")

    class T:
        name = f"{db}.t"

        def load(self, i, **kw):
            kw = {"prep": spark.createDataFrame(LOADS[i][1], SCHEMA), "buckets": request.param} | kw
            return run_cdc_versioned(spark, "t", ["k"], tmp_root, db, **stamps(i), **kw)

        def rows(self):
            if not spark.catalog.tableExists(self.name):
                return None
            cols = ["k", "v", "audit_flag", "bgn_dt", "end_dt", "audit_inserted_ts"]
            return sorted(tuple(map(str, r)) for r in spark.table(self.name).select(*cols).collect())

        def open_versions(self):
            listed = [r[0] for r in spark.sql(f"SHOW PARTITIONS {base_name(db, 't')}").collect()]
            return sorted([int(p.split("/")[0][4:]) for p in listed if p.endswith("9999-12-31")]
                          + versioned_job._bucketed_versions(spark, db, "t"))

        def rollback(self):
            return rollback(spark, "t", tmp_root, db)

        root, database = tmp_root, db
    yield T()
    spark.sql(f"DROP DATABASE {db} CASCADE")


@pytest.fixture(scope="module")
def states(spark, tmp_path_factory):
    """The table after each load, by the job that replaces partitions."""
    root, out = str(tmp_path_factory.mktemp("plain")), [None]
    for i in range(len(LOADS)):
        run_cdc(spark, "t", ["k"], root, prep=spark.createDataFrame(LOADS[i][1], SCHEMA), **stamps(i))
        df = spark.read.parquet(TablePaths(root, "t").target)
        out.append(sorted(tuple(map(str, r)) for r in df.select(
            "k", "v", "audit_flag", "bgn_dt", "end_dt", "audit_inserted_ts").collect()))
    return out


def test_readers_see_the_old_or_the_new_state(table, states, monkeypatch):
    seen = []

    def watched(real):
        def step(*a, **k):
            seen.append(table.rows())
            out = real(*a, **k)
            seen.append(table.rows())
            return out
        return step

    for name in STEPS:
        monkeypatch.setattr(versioned_job, name, watched(getattr(versioned_job, name)))
    monkeypatch.setattr(run_log, "write_state", watched(run_log.write_state))
    for i in range(len(LOADS)):
        seen.clear()
        table.load(i)
        switch = seen.index(states[i + 1])
        assert switch > 3 and all(s == states[i] for s in seen[:switch])
        assert all(s == states[i + 1] for s in seen[switch:])


@pytest.mark.parametrize("fail_at, when", [("verify_staged", "before"), ("_base_table", "before"),
                                           ("_add_partition", "before"), ("_add_partition", "after"),
                                           ("show_version", "before"), ("show_version", "after")])
def test_a_rerun_after_any_failure(table, states, monkeypatch, fail_at, when):
    table.load(0)
    real = getattr(versioned_job, fail_at)

    def broken(*a, **k):
        if when == "after":
            real(*a, **k)
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versioned_job, fail_at, broken)
        with pytest.raises(OSError):
            table.load(1)
    assert table.rows() == states[2 if (fail_at, when) == ("show_version", "after") else 1]
    table.load(1)
    assert table.rows() == states[2]


def test_a_planned_query_goes_on_reading_its_version(spark, table, states):
    table.load(0)
    df = spark.table(table.name)
    assert df.count() == 3
    planned = df.select("k")
    planned._jdf.queryExecution().executedPlan()
    table.load(1)
    assert sorted(r.k for r in planned.collect()) == ["a", "b", "c"]
    assert table.rows() == states[2]


def test_rollback_and_the_next_load(spark, table, states):
    for i in (0, 1, 2):
        table.load(i)
    assert table.rollback() == 2 and table.rows() == states[2]
    with pytest.raises(RuntimeError):
        table.rollback()
    out = table.load(2)
    assert out["version"] == 4 and table.rows() == states[3]
    table.load(3)
    assert table.rows() == states[4]
    assert table.open_versions() == [4, 5]
    names = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table.name}__versions").collect()}
    assert not any(n.startswith("run=3/") for n in names)


def test_an_unverified_version_is_never_shown(table, states, monkeypatch):
    table.load(0)
    with monkeypatch.context() as m:
        m.setattr(versioned_job, "verify_staged", lambda *a: (_ for _ in ()).throw(StagingMismatch("x")))
        with pytest.raises(StagingMismatch):
            table.load(1)
    assert table.rows() == states[1]
    assert table.load(1)["version"] == 3 and table.rows() == states[2]
    assert table.rollback() == 1 and table.rows() == states[1]


def test_columns_come_and_go(spark, table):
    table.load(0)
    wide = spark.createDataFrame([("a", 1, "1", "x"), ("b", 5, "5", "y")], SCHEMA + ", seg string")
    table.load(1, prep=wide)
    assert {(r.k, r.v): r.seg for r in spark.table(table.name).collect()}[("b", 5)] == "y"
    table.load(3, evolve=True, prep=spark.createDataFrame([("b", 5, "5"), ("c", 1, "1")], SCHEMA))
    got = {(r.k, str(r.end_dt)): r.seg for r in spark.table(table.name).collect()}
    assert got[("b", "9999-12-31")] == "y" and got[("c", "9999-12-31")] is None


def test_shared_keys_a_lost_version_and_overlap_stop_the_run(spark, table):
    table.load(0)
    with run_log.Lease(spark, TablePaths(table.root, "t").runs, "other"):
        with pytest.raises(run_log.Overlap):
            table.load(1)
    twice = spark.createDataFrame([("a", 1, "1"), ("A ", 2, "2")], SCHEMA)
    table.load(1, normalize=False, prep=twice)
    with pytest.raises(DuplicateCurrentKeys):
        table.load(2, normalize=True)
    versioned_job.delete_folder(spark, f"{table.root}/t/versions/run=2")
    with pytest.raises(LostPartition):
        table.load(2)


def test_loads_with_and_without_buckets_follow_each_other(spark, table, states):
    for i, buckets in enumerate([None, 3, 5, None]):
        table.load(i, buckets=buckets)
        assert table.rows() == states[i + 1]
    assert table.open_versions() == [3, 4] and spark.catalog.tableExists(open_name(table.database, "t", 3))
    assert table.rollback() == 3 and table.rows() == states[3]


def test_the_join_reads_bucketed_rows_in_place(spark, tmp_root):
    """Two loads; the third one's plan shuffles the extract alone, and a load
    leaves the session's settings as they were."""
    db = "tidemark_b_" + tmp_root.rsplit("-", 1)[-1].lower()
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/db'")
    settings = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    before = [spark.conf.get(c, None) for c in settings]
    for prep, day in ((X.orders_cur0(spark, SF01), "2024-05-01"), (X.orders_prep0(spark, SF01), "2024-06-01")):
        run_cdc_versioned(spark, "o", ["k"], tmp_root, db, as_of=day, prep=prep, buckets=5)
    assert [spark.conf.get(c, None) for c in settings] == before
    current = version_rows(spark, TablePaths(tmp_root, "o"), db, 2,
                           match_key_property(["k"], True))
    assert "__tidemark_key_0" not in version_rows(spark, TablePaths(tmp_root, "o"), db, 2,
                                                  match_key_property(["k"], False)).columns
    third = X.orders_cur0(spark, SF01).where("k % 11 <> 0")
    snap = sd.prepare_snapshot(third, ["k"])
    with shuffle_partitions(spark, 5):
        nxt = sd.next_state(snap, current, ["k"], sd.Stamps("2024-07-01", "2024-07-01 00:00:00"), tag=True)
        plan = nxt._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        written = shuffle_records_written(nxt.groupBy(sd.CHANGE).agg(F.count(F.lit(1)).alias("n")))
    assert sorted(written)[-1] == third.count()       # and a few partial counts
    files = spark.table(open_name(db, "o", 2)).where("end_dt = DATE'9999-12-31'").select("_metadata.file_name")
    assert files.distinct().count() == 5              # one file a bucket
    spark.sql(f"DROP DATABASE {db} CASCADE")
