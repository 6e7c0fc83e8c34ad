"""The command line drives the CDC job end to end (same session)."""

import json

from tidemark.__main__ import main
from tidemark.plans.publish import TablePaths
from tidemark.sources import derived as X
from paths import SF001


def test_cli_cdc(spark, tmp_root, capsys):
    X.customer_prep(spark, SF001).write.parquet(TablePaths(tmp_root, "cust").prep)
    assert main(["cdc", "--table", "cust", "--keys", "nm", "--root", tmp_root,
                 "--as-of", "2024-06-01"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["status"] == "initial_load" and out["I"] == spark.read.parquet(
        TablePaths(tmp_root, "cust").prep).count()


def test_cli_republish_keeps_a_complete_table(spark, tmp_root, capsys):
    from tidemark.sources.files import read_target
    X.customer_prep(spark, SF001).write.parquet(TablePaths(tmp_root, "c2").prep)
    assert main(["cdc", "--table", "c2", "--keys", "nm", "--root", tmp_root,
                 "--as-of", "2024-06-01"]) == 0
    before = sorted(map(tuple, read_target(spark, TablePaths(tmp_root, "c2").target).collect()))
    assert main(["republish", "--table", "c2", "--root", tmp_root]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["status"] == "republished"
    after = sorted(map(tuple, read_target(spark, TablePaths(tmp_root, "c2").target).collect()))
    assert after == before
