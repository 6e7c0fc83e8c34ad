"""Exact and near dedup and line dedup against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.components import connected_components
from tidemark.llm.exact_dedup import (CountingQuotientFilter, drop_exact_copies, exact_dedup,
                                      merge_filters, repeated_fingerprints)
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.near_dedup import (WordHashes, drop_near_copies, min_max_signature, near_dedup,
                                     shingle_set)

ODD = [(None, "x y"), (1, None), (2, ""), (3, " \n"), (4, "Same"), (5, "sAME"), (5, "sAME"),
       (6, "É"), (7, "é"), (8, "z " * 20_000), (9, "z " * 20_000), (None, "X Y")]


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


# ------------------------------------------------------------------ exact

@given(st.lists(st.lists(st.integers(0, 2**20), max_size=40), min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_filters_merge_without_loss(parts):
    filters = []
    for p in parts:
        keys, n = np.unique(np.array(p, np.uint64) << np.uint64(40), return_counts=True)
        f = CountingQuotientFilter.of(64, keys, n)
        back = CountingQuotientFilter.from_bytes(f.to_bytes())
        assert (back.fingerprints() == keys).all() and (back.counts == n).all()
        filters.append(back)
    merged = merge_filters(filters)
    want = collections.Counter(x << 40 for p in parts for x in p)
    assert dict(zip(merged.fingerprints().tolist(), merged.counts.tolist())) == dict(want)


def test_repeated_fingerprints(spark):
    rows = [-1, -1, 5, 2**62, 2**62, 2**62, 7]
    df = spark.createDataFrame([(x,) for x in rows], "fp long").repartition(4)
    assert {(r.fp, r.n) for r in repeated_fingerprints(df).collect()} == {(-1, 2), (2**62, 3)}


def test_exact_dedup_on_odd_rows(docs_of):
    got = exact_dedup(docs_of(ODD)).collect()
    groups = collections.defaultdict(list)
    for i, t in ODD:
        groups[lower(t)].append(i)
    assert len(got) == len(ODD)
    by_sha = collections.defaultdict(list)
    for r in got:
        by_sha[r.text_sha256].append(r)
    for text, ids in groups.items():
        rows = by_sha[hashlib.sha256(text.encode()).hexdigest()]
        known = [i for i in ids if i is not None]
        assert {r.group_size for r in rows} == {len(ids)}
        assert {r.keep_id for r in rows} == {max(known) if known else None}
        assert sum(r.kept for r in rows) == 1


def test_drop_exact_copies_keeps_one_row_each(docs_of):
    out = drop_exact_copies(docs_of(ODD + [(5, "sAME")])).collect()
    assert len(out) == len({lower(t) for _, t in ODD})
    assert out[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


def test_clashing_column_names(spark):
    df = spark.createDataFrame([(1, "a b", "q"), (2, "A B", "q")],
                               "doc_id long, text string, rid string")
    df = df.selectExpr("*", "'x' as fp", "1 as kept", "'y' as row",
                                              "2 as row_key", "3 as votes").checkpoint()
    assert [r.doc_id for r in drop_exact_copies(df).collect()] == [2]
    assert [r.doc_id for r in drop_near_copies(df).collect()] == [1]
    assert drop_exact_copies(df).columns == df.columns


# ------------------------------------------------------------------- near

def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    ids = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        ids[find(k)].append(i)
    return [(i, len(sets[k]), min((x for x in ids[find(k)] if x is not None), default=None))
            for k, (i, _) in enumerate(rows)]


def near_rows(seed):
    """Families of edited copies around the threshold, exact copies, odd rows."""
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(6):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([8, 40, 120]))]
        for _ in range(14):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
                words[rng.randrange(len(words))] = f"v{rng.randrange(500)}"
            rows.append((i, " ".join(words)))
            i += 1
    return rows + [(900, None), (901, ""), (902, " \n "), (903, "one two"), (904, "ONE  two"),
                   (905, "one two three")]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_dedup_equals_brute_force(docs_of, seed):
    rows = near_rows(seed)
    got = near_dedup(docs_of(rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(
        brute_components(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_drop_near_copies_keeps_one_of_each_component(docs_of):
    rows = near_rows(3)
    kept = drop_near_copies(docs_of(rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for _, _, c in brute_components(rows)})


def test_near_dedup_with_null_ids_and_repeats(docs_of):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (4, "A b c d e f"), (4, "A b c d e f")]
    assert {r.component_id for r in near_dedup(docs_of(rows)).collect()} == {4}
    assert drop_near_copies(docs_of(rows)).count() == 1


def test_signature_matches_similarity():
    a = shingle_set(" ".join(f"w{i}" for i in range(400)), WordHashes())
    b = shingle_set(" ".join(f"w{i}" for i in range(40, 440)), WordHashes())
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = (min_max_signature(a) == min_max_signature(b)).mean()
    assert abs(same - j) < 0.15


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(k, k + 1) for k in range(0, 30)] + [(100, k) for k in range(101, 140)]
    edges += [(200 + k, 200 + (k + 1) % 9) for k in range(9)]
    got = {r.node: r.component for r in
           connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 0 if n < 100 else 100 if n < 200 else 200 for e in edges for n in e}


def test_components_of_a_path_that_falls_and_rises(spark, monkeypatch):
    """Ids fall to the middle of a path and rise again; rounds stay logarithmic."""
    from tidemark.llm import components
    rounds = []
    real = components.checkpointed
    monkeypatch.setattr(components, "checkpointed", lambda df: rounds.append(1) or real(df))
    n = 1600
    path = [*range(n - 1, -1, -2), *range(1 - n % 2, n, 2)]
    path = list(dict.fromkeys(path))
    got = connected_components(spark.createDataFrame(list(zip(path, path[1:])), "a long, b long")).collect()
    assert len(got) == len(path) and {r.component for r in got} == {min(path)}
    assert (len(rounds) - 2) // 3 <= 20


def test_millions_of_fingerprints_in_one_partition():
    import time

    import pyarrow as pa
    from tidemark.llm.exact_dedup import _partition_filters
    rng = np.random.default_rng(0)
    batches = [pa.RecordBatch.from_arrays([pa.array(rng.integers(-2**63, 2**63 - 1, 10_000))], ["fp"])
               for _ in range(200)]
    began = time.process_time()
    out = list(_partition_filters(4)(iter(batches + batches[:1])))
    blocks = out[0].column(1).to_pylist()
    assert sum(int(CountingQuotientFilter.from_bytes(b).counts.sum()) for b in blocks) == 2_010_000
    assert time.process_time() - began < 8


# ------------------------------------------------------------------ lines

def brute_lines(rows):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        lines, cut = (t or "").split("\n"), set()
        for k in range(len(lines) - 2):
            w = tuple(lines[k:k + 3])
            if any(x.strip(" \t\r\x0b\x0c") for x in w):
                cut.update(range(k, k + 3) if w in seen else ())
                seen.add(w)
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in cut), len(lines), len(cut))
    return out


def test_line_dedup_equals_brute_force(docs_of):
    rng = random.Random(7)
    rows = [(i, "\n".join(rng.choice("abc") + " x" for _ in range(rng.randrange(0, 30))))
            for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n" * 9), (103, "q\n" * 3000), (104, "q\n" * 3000)]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(docs_of(rows)).collect()}
    assert got == brute_lines(rows)


@pytest.mark.parametrize("op", [exact_dedup, drop_exact_copies, near_dedup, drop_near_copies,
                                dedup_lines])
def test_empty_table(docs_of, op):
    assert op(docs_of([])).collect() == []
