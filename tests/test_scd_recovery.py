"""SCD loads that fail before, while and after they publish: a plain re-run of
the load ends like a clean run. Lease and record."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.plans import cdc_job, run_log, scd_job
from tidemark.plans.publish import StagingMismatch, TablePaths
from tidemark.plans.scd_job import PublishFailed, read_scd2_parquet, run_scd_jdbc, run_scd_parquet
from tidemark.sources.files import create_text, list_names, write_text
from tidemark.sources.jdbc import read_jdbc, write_jdbc

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
SCHEMA = "K int, V string"
DAYS = ["2024-05-01", "2024-06-01", "2024-06-01", "2024-07-01"]
LOADS = [[(1, "a"), (2, "b"), (3, "c"), (4, "d")],
         [(1, "a"), (2, "B"), (3, "C"), (5, "e")],
         [(2, "B"), (3, "again"), (6, "f")],
         [(1, "z"), (6, "g"), (7, "h")]]


class Target:
    def __init__(self, spark, kind, root):
        self.spark, self.kind, self.root = spark, kind, root

    def load(self, i):
        return self.run(self.spark.createDataFrame(LOADS[i], SCHEMA), DAYS[i])


class Files(Target):
    def run(self, src, day):
        return run_scd_parquet(self.spark, self.kind, src, f"{self.root}/t", ["K"], as_of=day)

    def rows(self):
        path = f"{self.root}/t"
        df = read_scd2_parquet(self.spark, path) if self.kind == 2 else self.spark.read.parquet(path)
        return sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns, key=str.lower)).collect())

    def break_at(self, m, step):
        real = scd_job.write_parquet

        def broken(df, path, mode, parts=()):
            if step == "between":          # some of the rows, as a stopped writer leaves them
                some = df.where("flag = 1") if parts else df.where("K % 2 = 1")
                real(some, path, mode, parts)
            if step == "after":
                real(df, path, mode, parts)
            raise OSError("lost")
        m.setattr(scd_job, "write_parquet", broken)


class Derby(Target):
    def __init__(self, spark, kind, root):
        super().__init__(spark, kind, root)
        self.url = f"jdbc:derby:{root}/db;create=true"
        more = [F.lit(1).alias("FLAG"), F.lit(None).cast("date").alias("EXPIRY_DATE")] if kind == 2 else []
        write_jdbc(spark.createDataFrame([], SCHEMA).select("*", *more), self.url, "T", properties=DRIVER)

    def run(self, src, day):
        write_jdbc(src, self.url, "SRC", "overwrite", properties=DRIVER)
        return run_scd_jdbc(self.spark, self.kind, self.url, "SRC", "T", ["K"], properties=DRIVER, single_task=True,
                            as_of=day)

    def rows(self):
        df = read_jdbc(self.spark, self.url, "T", properties=DRIVER, single_task=True)
        return sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns, key=str.lower)).collect())

    def break_at(self, m, step):
        real = scd_job.write_jdbc

        def broken(df, url, table, mode="append", **kw):
            if step == "between":          # truncated and half filled, or half appended
                real(df.where("K % 2 = 1"), url, table, mode, **kw)
            if step == "after":
                real(df, url, table, mode, **kw)
            raise OSError("lost")
        m.setattr(scd_job, "write_jdbc", broken)


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    """Per kind, the table after each clean load."""
    out = {}
    for kind in (0, 1, 2):
        t, out[kind] = Files(spark, kind, str(tmp_path_factory.mktemp(f"clean{kind}"))), []
        for i in range(len(LOADS)):
            t.load(i)
            out[kind].append(t.rows())
    return out


@pytest.mark.parametrize("step", ["before", "between", "after"])
@pytest.mark.parametrize("kind", [0, 1, 2])
@pytest.mark.parametrize("target", [Files, Derby])
def test_a_plain_rerun_ends_like_a_clean_run(spark, tmp_root, monkeypatch, clean, target, kind, step):
    t = target(spark, kind, tmp_root)
    t.load(0)
    with monkeypatch.context() as m:
        t.break_at(m, step)
        with pytest.raises(PublishFailed):
            t.load(1)
    assert t.load(1)["completed"] and t.rows() == clean[kind][1]


@pytest.mark.parametrize("kind", [0, 1, 2])
def test_a_later_load_completes_the_failed_one(spark, tmp_root, monkeypatch, clean, kind):
    """The second load of a day fails; the next day's goes on from its end."""
    t = Files(spark, kind, tmp_root)
    t.load(0)
    t.load(1)
    with monkeypatch.context() as m:
        t.break_at(m, "between")
        with pytest.raises(PublishFailed):
            t.load(2)
    assert t.load(3)["completed"] and t.rows() == clean[kind][3]


def test_an_unverified_stage_is_forgotten(spark, tmp_root, monkeypatch, clean):
    t = Files(spark, 2, tmp_root)
    t.load(0)
    with monkeypatch.context() as m:
        m.setattr(scd_job, "verify_staged", lambda *a: (_ for _ in ()).throw(StagingMismatch("x")))
        with pytest.raises(StagingMismatch):
            t.load(1)
    assert t.rows() == clean[2][0]
    assert "completed" not in t.load(1) and t.rows() == clean[2][1]


def test_the_done_record_is_lost(spark, tmp_root, monkeypatch, clean):
    """All is published, but the record of it isn't written."""
    for kind in (0, 2):
        t = Files(spark, kind, f"{tmp_root}/{kind}")
        t.load(0)
        real = run_log.write_state
        with monkeypatch.context() as m:
            m.setattr(run_log, "write_state", lambda s, f, r, st, facts, real=real: (_ for _ in ()).throw(OSError())
                      if st == "done" else real(s, f, r, st, facts))
            with pytest.raises(OSError):
                t.load(1)
        assert t.load(1)["completed"] and t.rows() == clean[kind][1]


# ------------------------------------------------------------------ lease, record

def test_an_overlapping_run_stops_before_it_writes(spark, tmp_root):
    t = Files(spark, 1, tmp_root)
    t.load(0)
    before = t.rows()
    path = scd_job.stage_folder(spark, "scd1", f"{tmp_root}/t")
    names = list_names(spark, path)
    with run_log.Lease(spark, f"{path}/runs", "other"):
        with pytest.raises(run_log.Overlap, match="other"):
            t.load(1)
    assert t.rows() == before and list_names(spark, path) == names
    t.load(1)
    assert t.rows() != before


def test_cdc_runs_take_turns(spark, tmp_root):
    snap = spark.createDataFrame([("a", 1, "1")], "k string, v int, row_md5 string")
    with run_log.Lease(spark, TablePaths(tmp_root, "t").runs, "other"):
        with pytest.raises(run_log.Overlap):
            cdc_job.run_cdc(spark, "t", ["k"], tmp_root, prep=snap, as_of="2024-05-01")
    assert list_names(spark, f"{tmp_root}/t") == ["runs"]
    assert cdc_job.run_cdc(spark, "t", ["k"], tmp_root, prep=snap, as_of="2024-05-01")["current"] == 1


def test_a_lost_drivers_lease_runs_out_and_the_old_run_is_fenced(spark, tmp_root):
    folder = f"{tmp_root}/runs"
    old = run_log.Lease(spark, folder, "old", ttl=1000).__enter__()
    with pytest.raises(run_log.Overlap):
        run_log.Lease(spark, folder, "new", ttl=1000).__enter__()
    old._stop.set()                                   # its driver renews no more
    new = run_log.Lease(spark, folder, "new", ttl=-1).__enter__()
    assert new.token == old.token + 1
    new.check()
    with pytest.raises(run_log.Overlap):
        old.check()
    old.__exit__()                                    # waking up late, it releases nothing of the new run
    with pytest.raises(run_log.Overlap):
        run_log.Lease(spark, folder, "third", ttl=1000).__enter__()
    new.__exit__()
    with run_log.Lease(spark, folder, "third", ttl=1000) as third:
        third.check()


def test_a_lease_is_renewed(spark, tmp_root):
    with run_log.Lease(spark, f"{tmp_root}/runs", "long", ttl=2.0):
        assert not threading.Event().wait(3)
        with pytest.raises(run_log.Overlap):
            run_log.Lease(spark, f"{tmp_root}/runs", "other", ttl=2.0).__enter__()


def test_newest_record_is_by_number_whatever_the_clock(spark, tmp_root, monkeypatch):
    folder = f"{tmp_root}/runs"
    run_log.write_state(spark, folder, "first", "done", {"token": 1})
    with monkeypatch.context() as m:                  # a host an hour behind
        m.setattr("time.time_ns", lambda: 1)
        m.setattr("time.time", lambda: 1.0)
        run_log.write_state(spark, folder, "second", "publishing", {"token": 1})
    assert run_log.last_state(spark, folder)["run_id"] == "second"
    # a fenced run's late record counts as older
    run_log.write_state(spark, folder, "third", "done", {"token": 2})
    run_log.write_state(spark, folder, "late", "publishing", {"token": 1})
    assert run_log.last_state(spark, folder)["run_id"] == "third"
    # a record cut short is none
    write_text(spark, f"{folder}/{99:012d}.json", json.dumps({"number": 99})[:5])
    assert run_log.last_state(spark, folder)["run_id"] == "third"
    for i in range(30):
        run_log.write_state(spark, folder, f"r{i}", "done", {"token": 3})
    assert len(list_names(spark, folder)) <= run_log.KEEP + 1
    assert run_log.last_state(spark, folder)["run_id"] == "r29"


def test_one_of_many_creates_a_file(spark, tmp_root):
    got = []
    threads = [threading.Thread(target=lambda i=i: got.append(create_text(spark, f"{tmp_root}/x/one", str(i))))
               for i in range(8)]
    for th in threads:
        th.start()
    for th in threads:
        th.join()
    assert sorted(got) == [False] * 7 + [True]
