"""Licence scan, Merkle manifest and importance resampling against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.llm import importance, licences, merkle
from tidemark.llm.importance import draw, importance_ranks
from tidemark.llm.licences import LicenceIndex, scan_licences, templates_of, words_of
from tidemark.llm.merkle import fold, leaf_digest, merkle_manifest, proof_digest

SF01 = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_importance_resampling"])
def test_query_matches_its_twin(spark, name):
    r = compare(spark, duck(SF01), entry.queries()[name], entry.oracle_sql()[name], SF01)
    assert r["ok"], r


# ---------------------------------------------------------------- Merkle

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves, fan):
    """Root, and per leaf its (left, right) from the leaf up."""
    paths, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = nodes[a // fan * fan:(a // fan + 1) * fan]
            paths[i].append(("".join(run[:a % fan]), "".join(run[a % fan + 1:])))
        nodes = [H(*nodes[i:i + fan]) for i in range(0, len(nodes), fan)]
        at = [a // fan for a in at]
    return nodes[0], paths


def brute_leaf(row):
    return H(*[f"{len(str(v).encode())}:{v}" if v is not None else "-" for v in row])


def brute_manifest(rows, fan):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, brute_leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [brute_tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fan) for g in names]
    root, over = brute_tree([t[0] for t in trees], fan)
    return sorted((str(x[3][0]), str(g), x[2], sub, root, path + up)
                  for g, (sub, paths), up in zip(names, trees, over, strict=True)
                  for x, path in zip(sorted(groups[g], key=lambda x: x[:3]), paths, strict=True))


def odd_rows():
    rng = random.Random(5)
    rows = [(i, "hot", "en", 3, f"Text {i}") for i in range(300)]
    rows += [(i, f"s{i % 23}é", None, None, None if i % 3 else "") for i in range(300, 420)]
    rows += [(None, None, None, None, None), (7, "lone", "xx", 1, "A" * 100_000), (8, "twice", "x", 1, "b"),
             (8, "twice", "x", 1, "b"), (8, "twice", "x", 1, "a"), (9, "", "x", 1, "empty name")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("fan, levels", [(16, 3), (16, 1), (2, 2), (3, 3)])
def test_manifest_equals_brute_force(spark, monkeypatch, fan, levels):
    monkeypatch.setattr(merkle, "FAN", fan)
    rows = odd_rows()
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle_manifest(df.repartition(5), levels=levels).withColumn("folded", fold(F.col("leaf"), F.col("proof")))
    got = got.collect()
    assert all(r.folded == r.root for r in got)
    assert sorted((str(r.doc_id), str(r.source), r.leaf, r.subroot, r.root, [tuple(x) for x in r.proof])
                  for r in got) == brute_manifest(rows, fan)


def test_a_changed_row_folds_to_another_root(spark):
    df = spark.createDataFrame(odd_rows(), "doc_id long, source string, lang string, n_chars long, text string")
    other = leaf_digest([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.lit("changed")])
    got = merkle_manifest(df, also={"other": other})
    got = got.select(fold(F.col("other"), F.col("proof")).alias("f"), "root", proof_digest(F.col("proof")).alias("p"))
    assert all(r.f != r.root and len(r.p) == 64 for r in got.collect())


def test_manifest_of_clashing_names_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a", "en", 1, "x")], "doc_id long, source string, lang string, n_chars long, "
                               "text string")
    plain = merkle_manifest(df).collect()
    names = ["grp", "id", "h", "n", "pos", "node", "item", "path", "info", "block", "kids", "d0", "task", "more",
             "leaf", "root", "subroot", "proof", "hs", "i"]
    assert merkle_manifest(df.withColumns({c: F.lit(9) for c in names})).collect() == plain
    assert plain[0].leaf == plain[0].root and plain[0].proof == []
    assert merkle_manifest(df.limit(0)).collect() == []


# ---------------------------------------------------------------- importance resampling

def brute_features(text):
    ws = words(text)
    return [" ".join(ws[i:i + k]) for k in (1, 2, 3) for i in range(len(ws) - k + 1)]


def brute_ranks(rows, target, share=(5, 100)):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = collections.Counter(), collections.Counter()
    for _, text in rows:
        s.update(map(bucket, brute_features(text)))
    for text in target:
        t.update(map(bucket, brute_features(text)))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (S + 10000.0) / ((s[b] + 1.0) * (T + 10000.0))))
            for b in range(10000)]
    out = []
    for at, (i, text) in enumerate(rows):
        fs = brute_features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[bucket(f)] for f in fs)
        out.append([i, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    order = sorted((r for r, (_, text) in zip(out, rows, strict=True) if len(words(text)) >= 20),
                   key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(order[:len(order) * share[0] // share[1]]):
        r[4] = k + 1
    return sorted(map(str, out))


def sample_texts(n):
    rng = random.Random(3)
    vocabulary = ["the", "of", "Zeta", "naïve", "42", "中文", "x1", "and", "Rho", "tau"]
    text = lambda: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-", " \x00"])
                           for _ in range(rng.choice([0, 3, 19, 20, 21, 60])))
    rows = [(i, text()) for i in range(n)]
    return rows + [(1, rows[1][1]), (1, rows[1][1]), (None, "one " * 30), (None, "one " * 30), (n, None), (n + 1, ""),
                   (n + 2, "long words " * 40_000)], [text() for _ in range(9)] + [None, ""]


@pytest.mark.parametrize("segments", [1, 3, 40])
def test_ranks_equal_brute_force(spark, docs_of, segments, monkeypatch):
    monkeypatch.setattr(importance, "PIECE", 1000)
    rows, target = sample_texts(400)
    got = importance_ranks(docs_of(rows, 7), spark.createDataFrame([(t,) for t in target], "text string"),
                           share=(30, 100), segments=segments)
    got = got.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(str(list(r)) for r in got) == brute_ranks(rows, target, (30, 100))


def test_equal_scores_spread_over_segments(spark, docs_of):
    """All rows share score and id: order and balance come from the row number."""
    rows = spark.range(0, 6000, 1, 6).select(F.lit(5).alias("score").cast("long"), F.lit(1).cast("long").alias("doc_id"),
                                             F.col("id").alias("rid")).checkpoint()
    got = importance.exact_ranks(rows, 8).withColumn("part", F.spark_partition_id())
    assert sorted((r.rid, r["rank"]) for r in got.collect()) == [(i, i + 1) for i in range(6000)]


def test_segments_are_even_whatever_the_scores(spark):
    rows = spark.range(0, 20_000, 1, 9).select(F.expr("cast(exp(id % 97 / 9) as long)").alias("score"),
                                               F.col("id").alias("doc_id"), F.col("id").alias("rid")).checkpoint()
    got = importance.exact_ranks(rows, 10).collect()
    want = sorted(got, key=lambda r: (-r.score, r.doc_id))
    assert [r["rank"] for r in want] == list(range(1, 20_001))


def test_draw_gives_whole_rows_and_empty_tables_none(spark, docs_of):
    rows, target = sample_texts(200)
    docs = docs_of(rows).withColumn("rid", F.lit("x")).withColumn("score", F.lit(1)).checkpoint()
    t = spark.createDataFrame([(x,) for x in target], "text string")
    got = draw(docs, t).select("row.*", "draw").collect()
    assert set(docs.columns) < set(got[0].asDict()) and {r.rid for r in got} == {"x"}
    assert sorted(r.draw["rank"] for r in got) == list(range(1, len(got) + 1))
    assert importance_ranks(docs.limit(0).checkpoint(), t).collect() == []
    assert importance_ranks(docs, t.limit(0)).count() == len(rows)


# ---------------------------------------------------------------- licences

def brute_base(text):
    ws = words(text)
    hits = []
    for label, phrase in licences.PHRASES:
        p = phrase.split()
        hits += [(i, label) for i in range(len(ws) - len(p) + 1) if ws[i:i + len(p)] == p]
    return len(ws), sorted(hits)


def brute_places(index, text):
    """Every template at every place of the text, with plain loops."""
    ws, out = words_of((text or "").encode()), []
    has = lambda p, a, b: any(ws[i:i + len(p)] == list(p) for i in range(max(0, a), b + 1))
    for t in index.templates:
        value = {w: index.worth[index.number[w]] for w in t.words}
        if t.exact:
            out += [(t.label, i, i + len(t.words), 1.0, True) for i in range(len(ws) - len(t.words) + 1)
                    if tuple(ws[i:i + len(t.words)]) == t.words]
            continue
        if not all(w in ws for p in t.key_phrases for w in p):
            continue
        own = sorted({w for w in t.words if w in ws}, key=lambda w: (-value[w], w))[:licences.ANCHORS]
        at = [o for o in range(-len(t.words), len(ws) + 1)
              if sum(any(t.words[i] == w and 0 <= o + i < len(ws) and ws[o + i] == w for i in range(len(t.words)))
                     for w in own) >= min(2, len(own))]
        good = []
        for o in at:
            worth = sum(value[w] for i, w in enumerate(t.words)
                        if w in ws[max(0, o + i - licences.SLACK):max(0, o + i + licences.SLACK + 1)])
            share = worth / sum(value[w] for w in t.words)
            keys = all(has(p, o - licences.SLACK, o + len(t.words) + licences.SLACK - len(p))
                       for p in t.key_phrases)
            if share >= licences.MIN_SHARE and keys:
                good.append((o, share))
        runs = []
        for o, share in good:
            if runs and o - runs[-1][-1][0] <= licences.SLACK:
                runs[-1].append((o, share))
            else:
                runs.append([(o, share)])
        for run in runs:
            o, share = max(run, key=lambda x: (round(x[1], 12), -x[0]))
            out.append((t.label, max(0, o), min(len(ws), o + len(t.words)), share, False))
    return sorted(out, key=lambda p: (p[1], p[2], p[0]))


def licence_texts():
    rng = random.Random(9)
    filler = "the of software under version license and to permission lorem ipsum dolor sit copy may".split()
    notices = [n[1] for n in licences.NOTICES] + [p for _, p in licences.PHRASES]
    out = [None, "", "Released under the MIT License.", "under the MIT of License", "CC BY-NC", "cc by\nNC cc by nc"]
    for n in notices:
        ws = n.split()
        changed = list(ws)
        del changed[rng.randrange(len(ws))]
        changed.insert(rng.randrange(len(ws)), "lorem")
        half = ws[:len(ws) // 2]
        shuffled = rng.sample(ws, len(ws))
        for body in (ws, changed, half, shuffled, ws + ws, ws + ["lorem"] * 6 + changed):
            before, after = (rng.choices(filler, k=rng.randrange(12)) for _ in range(2))
            out.append(" ".join(before + body + after))
    return out


def test_places_equal_brute_force():
    texts = licence_texts()
    templates = templates_of()
    counts = collections.Counter()
    for t in texts:
        counts.update(set(words_of((t or "").encode())))
    index = LicenceIndex(templates, len(texts), counts)
    n_found = 0
    for t in texts:
        got, want = index.places(words_of((t or "").encode())), brute_places(index, t)
        assert [p[:3] + p[4:] for p in got] == [p[:3] + p[4:] for p in want], t
        assert np.allclose([p[3] for p in got], [p[3] for p in want])
        n_found += len(got)
    assert n_found > 60


def test_notices_are_found_whole_changed_and_not_when_shuffled():
    index = LicenceIndex(templates_of())
    for label, text, _ in licences.NOTICES:
        ws = text.split()
        assert label in {p[0] for p in index.places(words_of(text.encode()))}, text
        keys = next(n[2] for n in licences.NOTICES if n[1] == text)
        for i in range(len(ws) + 1):                  # two words put in, anywhere but in a key phrase
            more = words(" ".join(ws[:i] + ["so", "called"] + ws[i:]))
            if all(f" {k} " in f" {' '.join(more)} " for k in keys):
                assert label in {p[0] for p in index.places([w.encode() for w in more])}, (text, i)
        assert not index.places(words_of(" ".join(reversed(ws)).encode()))
    assert not index.places(words_of(b"The license of the software is free: permission to copy version 3 of it"))


def test_query_over_the_given_tables(spark):
    got = {r.doc_id: r for r in entry.queries()["op11_license_scan"](spark, SF01).collect()}
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    named = 0
    for d in docs:
        n, hits = brute_base(d.text)
        r = got[d.doc_id]
        assert (r.n_words, r.n_base) == (n, len(hits))
        assert (r.first_word, r.last_word) == ((hits[0][0], hits[-1][0]) if hits else (None, None))
        assert r.base_labels == ",".join(sorted({x[1] for x in hits}))
        extra = {"gpl-3"} if "GNU General Public License, version 3" in (d.text or "") else set()
        assert r.labels == ",".join(sorted({x[1] for x in hits} | extra))
        assert (r.score > 0) == bool(r.labels) and r.score <= 1
        named += bool(r.labels)
    assert named > 5


def test_scan_of_odd_rows_and_no_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (None, "under the mit license " * 2000), (3, "x " * 200_000), (3, "x " * 200_000)]
    df = docs_of(rows).withColumn("places", F.lit(1)).withColumn("n_words", F.lit(1))
    got = sorted((str(r.doc_id), r.n_words, len(r.places)) for r in scan_licences(df).collect())
    assert got == [("1", 0, 0), ("2", 0, 0), ("3", 200_000, 0), ("3", 200_000, 0), ("None", 8000, 2000)]
    assert scan_licences(df.limit(0)).collect() == []
