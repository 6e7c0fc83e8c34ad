"""Command line, for ``python -m tidemark ...`` or
``spark-submit --py-files tidemark.zip tidemark/__main__.py ...``:

  cdc --table T --keys K1,K2 --root ROOT [--database DB] [--as-of D] [--load-ts T]
      [--compare C1,C2] [--order-by C1,C2] [--rows-per-file N] [--no-backup] [--evolve]
  republish --table T --root ROOT [--database DB]
  scd --kind 0|1|2 --url URL --source S --target T --keys K [--compare C1,C2]
      (--partition-column C | --bucket-column C | --single-task) [--num-partitions N] [--normalize]
      [--prop key=value ...] [--as-of D]

Connection properties (user, password, driver) come only from ``--prop``.
Prints the run's counts as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from tidemark.session import CLUSTER_CONF


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("cdc", help="snapshot-diff load into <root>/<table>/tgt")
    c.add_argument("--table", required=True)
    c.add_argument("--keys", required=True, help="comma-separated natural key columns")
    c.add_argument("--root", required=True)
    c.add_argument("--database")
    c.add_argument("--as-of")
    c.add_argument("--load-ts")
    c.add_argument("--compare", help="comma-separated compare columns (default: the fingerprint)")
    c.add_argument("--order-by", help="comma-separated tie-break columns of the dedupe")
    c.add_argument("--rows-per-file", type=int, default=5_000_000)
    c.add_argument("--no-backup", action="store_true")
    c.add_argument("--evolve", action="store_true", help="go on when stored columns are missing")
    r = sub.add_parser("republish", help="complete a failed CDC publish from its staged copy")
    r.add_argument("--table", required=True)
    r.add_argument("--root", required=True)
    r.add_argument("--database")
    s = sub.add_parser("scd", help="SCD type 0/1/2 load of a JDBC table")
    s.add_argument("--kind", type=int, choices=(0, 1, 2), required=True)
    s.add_argument("--url", required=True)
    s.add_argument("--source", required=True)
    s.add_argument("--target", required=True)
    s.add_argument("--keys", required=True)
    s.add_argument("--compare", help="comma-separated compare columns (default: all shared)")
    s.add_argument("--partition-column")
    s.add_argument("--bucket-column", help="split by remainders of this whole-number column")
    s.add_argument("--num-partitions", type=int)
    s.add_argument("--single-task", action="store_true", help="read each table in one task")
    s.add_argument("--normalize", action="store_true", help="match string keys on trim(upper())")
    s.add_argument("--prop", action="append", default=[], help="JDBC property key=value")
    s.add_argument("--as-of")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"tidemark-{a.cmd}").getOrCreate()
    given = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in CLUSTER_CONF.items():         # defaults; what the user set stays
        if key not in given:
            spark.conf.set(key, value)
    if a.cmd == "cdc":
        from tidemark.plans.cdc_job import run_cdc
        out = run_cdc(spark, a.table, a.keys, a.root, database=a.database, as_of=a.as_of,
                      backup=not a.no_backup, load_ts=a.load_ts, evolve=a.evolve,
                      compare=a.compare.split(",") if a.compare else None,
                      order_by=a.order_by.split(",") if a.order_by else None,
                      rows_per_file=a.rows_per_file)
    elif a.cmd == "republish":
        from tidemark.plans.cdc_job import republish
        republish(spark, a.table, a.root, database=a.database)
        out = {"table": a.table, "status": "republished"}
    else:
        from tidemark.plans.scd_job import run_scd_jdbc
        props = dict(p.split("=", 1) for p in a.prop)
        out = run_scd_jdbc(spark, a.kind, a.url, a.source, a.target, a.keys, properties=props,
                           partition_column=a.partition_column, num_partitions=a.num_partitions,
                           bucket_column=a.bucket_column, single_task=a.single_task,
                           normalize=a.normalize, as_of=a.as_of, compare=a.compare.split(",") if a.compare else None)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
