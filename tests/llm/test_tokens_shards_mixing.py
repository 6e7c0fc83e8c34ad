"""Tokenizer codec against the library; sharding and mixing laws."""

import collections
import hashlib
import random
import re
import zlib

import sentencepiece
from pyspark.sql import functions as F

from tidemark.llm.mixing import mix, mix_to_weights, van_der_corput
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.sentencepiece_codec import (PrefixTableCodec, decode_ids, encode_texts,
                                              load_vocabulary, token_digests)
from tidemark.llm.shard import external_shuffle, read_shards, write_shards

SF01 = "/root/testdata/sf0.01"

SP = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


# ---------------------------------------------------------------- tokens

def test_codec_equals_the_library():
    vocab = load_vocabulary(tokenizer_path())
    codec, rng = PrefixTableCodec(vocab), random.Random(11)
    alphabet = "abcdefghijklmnopqrstuvwxyz" * 3 + "      \n\t▁éèüß中文字🙂\x00АБВ0123456789.,!?-_#$⁇\u200b\r"
    for k in range(6000):
        s = "".join(rng.choice(alphabet) for _ in range(rng.choice([1, 2, 5, 20, 80])))
        if k % 3 == 0:
            s = "".join(rng.choice(vocab.pieces[259:]).replace("▁", " ") for _ in range(4))
        if k % 7 == 0:
            s = " " * rng.randrange(40) + s
        ids = SP.encode(s)
        assert codec.encode(s) == ids and codec.decode(ids) == SP.decode(ids), repr(s)


def test_long_segments_and_memo_limit(monkeypatch):
    import tidemark.llm.sentencepiece_codec as m
    monkeypatch.setattr(m, "MEMO", 3)
    monkeypatch.setattr(m, "PAIRS", 3)
    codec = PrefixTableCodec(load_vocabulary(tokenizer_path()))
    for s in ("ab" * 20_000, "the quick brown fox " * 50, " " * 1000):
        assert codec.encode(s) == SP.encode(s)


def test_token_digests_and_round_trip(docs_of):
    rows = [(1, None), (2, ""), (None, "a  b\n"), (4, "naïve 中文 🙂 " * 500), (4, "x")]
    df = docs_of(rows)
    want = sorted((str(i), len(ids := SP.encode(t or "")),
                   hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(SP.decode(ids).encode()).hexdigest()) for i, t in rows)
    got = sorted((str(r.doc_id), *r[1:]) for r in token_digests(df, tokenizer_path()).collect())
    assert got == want
    both = decode_ids(encode_texts(df, tokenizer_path()), tokenizer_path()).collect()
    assert all(r.decoded == (r.text or "") and list(r.ids) == SP.encode(r.text or "") for r in both)


# ---------------------------------------------------------------- shards

def test_shards_are_gapless_and_grow_into_the_new_one(docs_of):
    rows = [(i, "x" * (i % 50)) for i in range(3000)] + [(None, "t"), (None, None), (7, "again")]
    got = external_shuffle(docs_of(rows), bucket_bytes=500).collect()
    assert len(got) == len(rows) and max(r.bucket for r in got) > 2
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r)
        assert r.grown_shard in (r.shard, 40)
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    want = collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
                               for i, t in rows)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    grown = {r.doc_id: r.shard for r in external_shuffle(docs_of(rows), n_shards=41).collect()}
    assert all(grown[r.doc_id] == r.grown_shard for r in got if r.doc_id is not None)


def test_buckets_of_a_hot_key_stay_small(docs_of):
    """One id with a third of all bytes: its shard gets more buckets."""
    rows = [(7, "x" * 84)] * 1000 + [(i, "x" * 84) for i in range(100, 2100)]
    got = external_shuffle(docs_of(rows), bucket_bytes=5000).collect()
    size = collections.Counter()
    for r in got:
        size[r.shard, r.bucket] += r.size
    assert len(got) == 3000 and max(size.values()) < 3 * 5000


def test_shuffle_is_random_and_repeats(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    a, b = ([tuple(r) for r in external_shuffle(docs, n_shards=2).orderBy("shard", "slot").collect()]
            for _ in range(2))
    assert a == b
    ids = [r[0] for r in a]
    ascents = sum(x < y for x, y in zip(ids, ids[1:]))
    assert 0.45 < ascents / len(ids) < 0.55


def test_write_shards(spark, docs_of, tmp_root):
    rows = [(i, f"text {i}") for i in range(200)] + [(1, "text 1")]
    names = ["shard", "_shard", "slot", "grown_shard", "bucket", "rid", "h", "at", "places", "key", "row", "size"]
    docs = docs_of(rows).withColumns({c: F.lit(-1) for c in names})
    write_shards(docs.orderBy(F.rand(1)), f"{tmp_root}/shards", n_shards=5, bucket_bytes=1000)
    back = read_shards(spark, f"{tmp_root}/shards", docs.schema).collect()
    assert collections.Counter((r.row.doc_id, r.row.text) for r in back) == collections.Counter(rows)
    assert all(r.row[c] == -1 for r in back for c in names)
    by = collections.defaultdict(list)
    for r in back:
        by[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in by.values())


def test_a_task_holds_one_bucket(docs_of):
    """Every bucket is a partition of its own, also with a hot key and no ids."""
    for n in (600, 2400):
        rows = [(None, "x" * 84)] * (n // 3) + [(i, "x" * 84) for i in range(n - n // 3)]
        got = external_shuffle(docs_of(rows), bucket_bytes=5000).withColumn("task", F.spark_partition_id()).collect()
        size, buckets = collections.Counter(), collections.defaultdict(set)
        for r in got:
            size[r.task] += r.size
            buckets[r.task].add(r.bucket)
        assert max(map(len, buckets.values())) == 1 and max(size.values()) < 2 * 5000
        assert len({r.shard for r in got if r.doc_id is None}) == 1


def test_the_query_writes_the_shards(spark, monkeypatch, tmp_root):
    """op8 writes whole rows, and says of them what the assignment says."""
    from tidemark.llm import queries
    monkeypatch.setattr(queries, "scratch_folder", lambda s, name: f"{tmp_root}/{name}", raising=False)
    got = queries.op8_sharding(spark, SF01).collect()
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    back = read_shards(spark, f"{tmp_root}/shards", docs.schema)
    assert back.select("row.*").exceptAll(docs).isEmpty() and back.count() == len(got) == 1000
    texts = collections.defaultdict(set)
    for r in back.collect():
        texts[r.shard].add((r.slot, r.row.doc_id, zlib.crc32((r.row.text or "").encode())))
    assert all((r.slot, r.doc_id, r.text_crc32) in texts[r.shard] for r in got)
    want = external_shuffle(docs).drop("bucket", "rid").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_the_query_over_an_empty_table(spark, tmp_root):
    from tidemark.llm import queries
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_root}/documents.parquet")
    out = queries.op8_sharding(spark, tmp_root)
    assert out.collect() == [] and out.columns == queries.op8_sharding(spark, SF01).columns


# ---------------------------------------------------------------- mixing

def brute_targets(rows):
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(k for k in size if k is not None) + [k for k in size if k is None]
    w = {k: (3, 1, 2)[j % 3] for j, k in enumerate(order)}
    left, free, out = 1.5 * sum(size.values()), set(order), {}
    while free:
        share = left / sum(w[k] for k in free)
        full = [k for k in free if share * w[k] > 2 * size[k]]
        if not full:
            out.update({k: share * w[k] for k in free})
            break
        for k in full:
            out[k] = 2 * size[k]
            left -= out[k]
            free.discard(k)
    return size, out


def mixing_rows():
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([0, 1, 5, 40, 300]), "hot" if i % 3 == 0 else f"s{i % 7}é")
            for i in range(900)]
    return rows + [(1, None, None), (2, "a b c", None), (3, "w " * 5000, "Z"), (3, "w " * 5000, "Z")]


def test_mix_meets_targets(docs_of):
    rows = mixing_rows()
    size, target = brute_targets(rows)
    got = mix_to_weights(docs_of(rows)).collect()
    assert len(got) == len(rows)
    taken = collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[(r.source_size, round(r.target, 6))] += r.taken
    want = collections.Counter()
    for k in size:
        want[(size[k], round(target[k], 6))] += target[k]
    assert taken.keys() == want.keys()
    assert all(abs(taken[k] - want[k]) <= 1 for k in want)


def test_schedule_is_low_discrepancy_and_reruns_agree(docs_of):
    df = docs_of(mixing_rows()).cache()
    _, src, pieces = mix(df)
    slots = sorted({(r.slot, r.sid) for r in pieces.select("slot", "sid").collect()})
    n = collections.Counter(s for _, s in slots)
    half = collections.Counter(s for _, s in slots[:len(slots) // 2])
    assert all(abs(half[s] - n[s] / 2) <= 8 for s in n)
    again = mix(df)[2]
    assert sorted(map(tuple, pieces.collect())) == sorted(map(tuple, again.collect()))


def test_van_der_corput_is_its_own_inverse(spark):
    df = spark.range(64)
    rows = df.select("id", van_der_corput(df.id, 6).alias("a"),
                     van_der_corput(van_der_corput(df.id, 6), 6).alias("b")).collect()
    assert [r.a for r in rows][:4] == [0, 32, 16, 48]
    assert all(r.id == r.b for r in rows)


def test_empty_tables(docs_of):
    assert mix_to_weights(docs_of([])).collect() == []
    assert external_shuffle(docs_of([])).collect() == []
    assert token_digests(docs_of([]), tokenizer_path()).collect() == []
