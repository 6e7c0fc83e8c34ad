"""The pipeline against brute force on a small table, and the SQL twins."""

import collections
import re

import corpus_pipeline
import oracle
import pytest
from pyspark.sql import functions as F
from test_dedup import brute_components, lower
from test_tokens_shards_mixing import brute_targets

import __spark_entry__ as entry
from tidemark.llm.common import row_number

SF01 = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(corpus_pipeline.LLM_SQL))
def test_sql_twins(spark, name):
    r = oracle.compare(spark, oracle.duck(SF01), entry.queries()[name], entry.oracle_sql()[name], SF01)
    assert r["ok"], r


def test_every_operator_is_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}


def test_pipeline(spark):
    """Stage one against the contract of op2, and the tokens of what the mix
    holds; the stages between are tested below."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    q = entry.queries()
    good = {r.doc_id for r in q["op2_quality_rules"](spark, SF01).collect() if r.kept}
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, SF01).collect()}
    assert kept == good
    out = corpus_pipeline.run(spark, SF01).collect()
    tokens = {r.doc_id: r for r in q["op6_sentencepiece"](spark, SF01).collect()}
    assert out and {r.doc_id for r in out} <= good
    assert all(tuple(r) == tuple(tokens[r.doc_id]) for r in out)


def test_stages_two_to_four_against_brute_force(spark, tmp_root):
    """Each stage on its predecessor's output: the survivors of the exact and
    the near dedup, and the words of the mix per source."""
    docs, read = spark.read.parquet(f"{SF01}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF01).write.parquet(f"{tmp_root}/{name}")
        docs = spark.read.parquet(f"{tmp_root}/{name}")
        read[name] = [(r.doc_id, r.text, r.source) for r in docs.collect()]

    last = {}
    for i, t, _ in read["quality rules"]:
        last[lower(t)] = max(i, last.get(lower(t), i))
    assert len(last) < len(read["quality rules"])
    assert sorted(i for i, _, _ in read["exact dedup"]) == sorted(last.values())

    first = {c for _, _, c in brute_components([r[:2] for r in read["exact dedup"]])}
    assert len(first) < len(last)
    assert sorted(i for i, _, _ in read["near dedup"]) == sorted(first)

    size, target = brute_targets(read["near dedup"])
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in read["near dedup"]}
    taken, longest = collections.Counter(), collections.Counter()
    for i, _, source in read["mixing"]:
        taken[source] += words[i]
        longest[source] = max(longest[source], words[i])
    assert taken.keys() == size.keys()
    assert all(target[k] - 1 <= taken[k] <= target[k] + longest[k] for k in size)


def test_row_numbers_outlive_a_change_of_cores(spark, tmp_root):
    path = f"{tmp_root}/many"
    (spark.range(40_000).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 512), 6).alias("text"))
     .repartition(3).write.option("parquet.block.size", 1 << 20).parquet(path))
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    seen = []
    try:
        for cores in (16, 2):            # as if executors went away between two scans
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", cores)
            docs = spark.read.parquet(path)
            seen.append(dict(docs.select("id", row_number(docs)).collect()))
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        if before is None:
            spark.conf.unset("spark.sql.files.minPartitionNum")
    assert seen[0] == seen[1]
