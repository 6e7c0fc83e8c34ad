"""SCD type 0/1/2 operators."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import scd
from tidemark.operators.snapshot_diff import Stamps
from tidemark.sources import derived as X
from paths import SF01

ST = Stamps("2024-06-01", "2024-06-01 00:00:00")
SCHEMA = "k int, name string, sal double"


def df(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def as_set(d):
    return set(map(tuple, d.collect()))


def test_scd0_inserts_new_keys_only(spark):
    t = df(spark, [(1, "a", 1.0), (2, "b", 2.0)])
    s = df(spark, [(1, "a", 9.0), (3, "c", 3.0), (None, "n", 0.0)])
    assert as_set(scd.scd0(s, t, ["k"])) == {(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)}


def test_scd0_empty_target_loads_all(spark):
    s = df(spark, [(1, "a", 1.0), (1, "a2", 0.5), (2, "b", 2.0)])
    out = scd.scd0(s, df(spark, []), ["k"])
    assert as_set(out) == {(1, "a", 1.0), (2, "b", 2.0)}       # one row per key


def test_scd1_replaces_changed_rows_whole(spark):
    t = df(spark, [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, "d", 4.0), (5, None, None)])
    s = df(spark, [(1, "A", 1.0), (2, "b", 5.0), (3, "c", None), (6, "f", 6.0), (5, None, None)])
    out = scd.scd1(s, t, ["k"], compare=["sal"])
    assert as_set(out) == {(1, "a", 1.0),        # compare columns equal: target kept
                           (2, "b", 5.0),        # NULL -> 5 is a change
                           (3, "c", None),       # 3 -> NULL is a change
                           (4, "d", 4.0),        # target-only kept
                           (5, None, None),      # NULL = NULL: unchanged
                           (6, "f", 6.0)}        # new


def test_scd1_default_compare_uses_all_shared_columns(spark):
    t = df(spark, [(1, "a", 1.0)])
    s = df(spark, [(1, "A", 1.0)])
    assert as_set(scd.scd1(s, t, ["k"])) == {(1, "A", 1.0)}


def test_scd2_versions(spark):
    sch = "k int, name string, sal double, flag int, expiry_date date"
    old = dt.date(2023, 1, 1)
    t = df(spark, [(1, "a", 1.0, 1, None), (1, "a0", 0.5, 0, old), (2, "b", 2.0, 1, None),
                   (3, "c", 3.0, 1, None)], sch)
    s = df(spark, [(1, "a", 1.0), (2, "b", 2.5), (4, "d", 4.0)])
    out = scd.scd2(s, t, ["k"], ST, compare=["sal"])
    assert as_set(out) == {
        (1, "a", 1.0, 1, None), (1, "a0", 0.5, 0, old),        # unchanged; old version kept
        (2, "b", 2.5, 1, None), (2, "b", 2.0, 0, dt.date(2024, 6, 1)),   # changed
        (3, "c", 3.0, 1, None),                                # target-only stays open
        (4, "d", 4.0, 1, None)}                                # new


def test_scd2_old_version_equal_to_source_is_ignored(spark):
    sch = "k int, name string, sal double, flag int, expiry_date date"
    t = df(spark, [(1, "a", 2.0, 1, None), (1, "a", 1.0, 0, dt.date(2023, 1, 1))], sch)
    s = df(spark, [(1, "a", 2.0)])
    out = scd.scd2(s, t, ["k"], ST)
    assert out.where("flag = 1").count() == 1 and out.count() == 2


def test_scd2_full_load_without_expiry_column(spark):
    t = df(spark, [], "k int, name string, sal double, flag int")
    out = scd.scd2(df(spark, [(1, "a", 1.0)]), t, ["k"], ST)
    assert out.columns == ["k", "name", "sal", "flag", "expiry_date"]
    assert as_set(out) == {(1, "a", 1.0, 1, None)}


def test_scd_customer_totals(spark):
    prep, cur = X.customer_prep0(spark, SF01), X.customer_cur0(spark, SF01)
    cents = lambda d: d.select(F.sum(F.round(F.col("bal") * 100)).cast("long")).first()[0]
    s0 = scd.scd0(prep, cur, ["k"])
    assert s0.count() == 1500 and cents(s0) == 674358896
    s1 = scd.scd1(prep, cur, ["k"], compare=["bal", "seg"])
    assert s1.count() == 1500 and cents(s1) == 677358896
    t2 = cur.select("*", F.lit(1).alias("flag"), F.lit(None).cast("date").alias("expiry_date"))
    s2 = scd.scd2(prep, t2, ["k"], ST, compare=["bal", "seg"])
    assert s2.count() == 1800 and s2.where("flag = 1").count() == 1500
    assert s2.where("flag = 1").groupBy("k").count().where("count > 1").count() == 0


def test_null_key_target_rows_are_kept_and_skip_the_join(spark):
    t = df(spark, [(None, "x", 1.0), (None, "y", 2.0), (1, "a", 1.0)])
    s = df(spark, [(1, "a", 5.0), (2, "b", 2.0)])
    out = scd.scd1(s, t, ["k"])
    assert as_set(out) == {(None, "x", 1.0), (None, "y", 2.0), (1, "a", 5.0), (2, "b", 2.0)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan


def test_scd_plans_shuffle_each_side_once(spark):
    prep, cur = X.customer_prep0(spark, SF01), X.customer_cur0(spark, SF01)
    t2 = cur.select("*", F.lit(1).alias("flag"), F.lit(None).cast("date").alias("expiry_date"))
    for out in (scd.scd1(prep, cur, ["k"]), scd.scd2(prep, t2, ["k"], ST)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2, plan
        assert "BroadcastExchange" not in plan
        assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")   # partial top-1 first
