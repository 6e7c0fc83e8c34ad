"""Near-duplicates by min-max hashing.

A document's set: the distinct 5-word shingles of its whole text, A-Z
lower-cased; with fewer words the whole sequence is the one shingle. Two
documents are linked when 100 * |A & B| >= 75 * |A | B|.

* Signature: every permutation gives two values, the minimum and the maximum
  of the permuted shingles, so 64 hash evaluations per shingle make 128 values.
  32 bands of 4 values; a pair at similarity 0.75 misses all bands with a
  probability of (1 - 0.75^4)^32 = 5e-6.
* Documents with equal sets are one class; only classes are compared, copies
  need no links among themselves.
* Band buckets hold classes. Members of a bucket are compared with a pivot,
  and the links found join classes to components. Two members of one component
  need no further test. This is repeated with better pivots; then every pair of
  bucket members that is still apart is tested, unless the shingles each has
  for itself alone prove that the two cannot be similar. So no bucket is capped
  and no link between components is lost, and a bucket of n near copies costs
  about n tests instead of n^2.
* Every link is confirmed on the full sets of 64-bit shingle hashes.
* What is found out per bucket or component (pivots, smallest sizes, heads) is
  stored before it is joined to the rows. Adaptive execution splits a hot
  bucket only if both sides of the join come straight from a shuffle.

Defined results: NULL, empty and blank texts have no set, are linked with
nothing and are their own component; a component is named by its smallest id
that is not NULL (NULL if there is none); repeated rows are one class. An
empty table gives no rows. The row number ties both scans of the texts
together, so ``docs`` must be a table scan or a checkpoint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, row_number, text_or_empty, stable_rows
from .components import connected_components

SHINGLE = 5
SIMILAR = 75                    # percent
PERMUTATIONS, BANDS, ROWS = 64, 32, 4
BITMAP = 8                      # longs per bitmap of shingles
BITS = [f"b{i}" for i in range(BITMAP)]
MEMO = 400_000                  # word hashes remembered per task

_RNG = np.random.default_rng(20240601)
STEP = _RNG.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PERMUTE = _RNG.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BAND_STEP = _RNG.integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BAND_SALT = _RNG.integers(1, 1 << 63, BANDS, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of a word, remembered for the first MEMO words."""

    def __missing__(self, word: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) < MEMO:
            self[word] = h
        return h


def shingle_set(text: str, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()   # ASCII only, as bytes
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - SHINGLE + 1)
    width = min(SHINGLE, len(w))
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h += w[k:k + n] * STEP[k]
    return np.unique(_mixed(h))


def min_max_signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum, then maximum, under each permutation."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), 4096):
        permuted = shingles[at:at + 4096, None] * PERMUTE
        np.minimum(low, permuted.min(axis=0), out=low)
        np.maximum(high, permuted.max(axis=0), out=high)
    return np.concatenate([low, high])


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature.reshape(BANDS, ROWS)
    return _mixed((rows * BAND_STEP).sum(axis=1, dtype=np.uint64) + BAND_SALT).view(np.int64)


def _signatures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for texts in batches:
        out = []
        for t in texts:
            s = shingle_set(t, hashes)
            out.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                        band_keys(min_max_signature(s)) if len(s) else []))
        yield pd.DataFrame(out, columns=["n_shingles", "set_key", "bands"])


def _sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    hashes = WordHashes()
    for texts in batches:
        yield pd.Series([shingle_set(t, hashes).tobytes() for t in texts], dtype=object)


def _common(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64),
                                         assume_unique=True))
                      for a, b in zip(left, right, strict=True)], dtype="int64")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) that are similar by their full sets."""
    one = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb"))
    common = F.pandas_udf(_common, "long")
    both = (pairs.join(one, "a").join(two, "b")
            .select("a", "b", common("sa", "sb").alias("common"),
                    (F.octet_length("sa") / 8 + F.octet_length("sb") / 8).alias("total")))
    return both.filter(F.col("common") * 100
                       >= (F.col("total") - F.col("common")) * SIMILAR).select("a", "b")


def _similar_enough(most: Column, n: Column, m: Column) -> Column:
    return most * 100 >= (n + m - most) * SIMILAR


def _may_link(n: Column, m: Column) -> Column:
    """False only if sets of n and m shingles cannot be similar for their sizes."""
    return _similar_enough(F.least(n, m), n, m)


def _may_share(mine: str, other: str) -> Column:
    """False only if the two rows, given by the prefixes of their columns,
    cannot be similar: what they have in common lies in the shingles that
    others have too (n - u of them), without those whose bit the other one's
    bitmap lacks. The cheap half of the test is evaluated first."""
    def shared(a: str) -> Column:
        return F.col(a + "n") - F.col(a + "u")

    def lacking(a: str, b: str) -> Column:
        bits = [F.bit_count(F.col(f"{a}b{i}").bitwiseAND(F.bitwise_not(F.col(f"{b}b{i}"))))
                for i in range(BITMAP)]
        return sum(bits[1:], bits[0])

    n, m = F.col(mine + "n"), F.col(other + "n")
    return (_similar_enough(F.least(shared(mine), shared(other)), n, m)
            & _similar_enough(shared(mine) - lacking(mine, other), n, m)
            & _similar_enough(shared(other) - lacking(other, mine), n, m))


def _rows_of_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for cid, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            s = np.frombuffer(data.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), cid)), pa.array(s)],
                                             names=["cid", "shingle"])


def _bounds(sets: pd.Series, own: pd.Series) -> pd.DataFrame:
    """u: the number of shingles in ``own``; bits: a bitmap of all the others."""
    out = []
    for data, mine in zip(sets, own, strict=True):
        s = np.frombuffer(data, np.uint64)
        if mine is not None:
            s = np.setdiff1d(s, np.asarray(mine, np.int64).view(np.uint64), assume_unique=True)
        bits = np.zeros(BITMAP, np.uint64)
        np.bitwise_or.at(bits, (s >> np.uint64(6)) % np.uint64(BITMAP),
                         np.uint64(1) << (s & np.uint64(63)))
        out.append((0 if mine is None else len(mine), *bits.view(np.int64).tolist()))
    return pd.DataFrame(out, columns=["u", *BITS])


def _with_bounds(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``members`` with u, the number of shingles that no other class among
    them has, and a bitmap of the other shingles; without the rows that cannot
    be linked inside their bucket, whatever the other member."""
    used = checkpointed(sets.join(members.select("cid").distinct(), "cid", "left_semi"))
    own = (used.select("cid", "shingles").mapInArrow(_rows_of_sets, "cid long, shingle long")
           .groupBy("shingle").agg(F.count(F.lit(1)).alias("k"), F.min("cid").alias("cid"))
           .filter("k = 1").groupBy("cid").agg(F.collect_list("shingle").alias("own")))
    bounds = F.pandas_udf(_bounds, ", ".join(f"{c} long" for c in ("u", *BITS)))
    known = used.join(own, "cid", "left").select("cid", bounds("shingles", "own").alias("b"))
    least = checkpointed(members.groupBy("key").agg(F.min("n").alias("least")))
    shared = F.col("n") - F.col("u")
    return (members.join(known.select("cid", "b.*"), "cid").join(least, "key")
            .filter((shared >= F.col("least")) | _similar_enough(shared, F.col("n"), F.col("least")))
            .select("key", "cid", "n", "comp", "u", *BITS))


def _joined(labels: DataFrame, links: DataFrame, first: bool) -> DataFrame:
    """``labels`` (cid, comp) after the components that ``links`` connect are
    one. At first every class is its own component."""
    if not first:
        at = labels.select(F.col("cid").alias("a"), F.col("comp").alias("ca"))
        to = labels.select(F.col("cid").alias("b"), F.col("comp").alias("cb"))
        links = (links.join(at, "a").join(to, "b")
                 .select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    new = connected_components(links).withColumnRenamed("node", "comp")
    return checkpointed(labels.join(new, "comp", "left")
                        .select("cid", F.coalesce("component", "comp").alias("comp")))


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of buckets that still hold several components, with ``comp``."""
    here = members.join(labels, "cid")
    mixed = checkpointed(here.groupBy("key")
                         .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                         .filter("lo <> hi").select("key"))
    return checkpointed(here.join(mixed, "key", "left_semi"))


def _outside_main(here: DataFrame) -> DataFrame:
    """The rows of each bucket that are not in its largest component."""
    sizes = here.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("k"))
    main = checkpointed(sizes.groupBy("key").agg(F.max(F.struct("k", "comp")).alias("main")))
    return (here.join(main, "key").filter(F.col("comp") != F.col("main.comp")).drop("main"))


def _pivots(here: DataFrame, *first: Column) -> DataFrame:
    """One row per bucket, the first by ``first``, then by hash."""
    rest = [c for c in here.columns if c != "key"]
    order = F.struct(*first, F.xxhash64("cid").alias("_h"), *rest)
    return (here.groupBy("key").agg(F.min(order).alias("p"))
            .select("key", *[F.col(f"p.{c}").alias(c) for c in rest]))


def _class_components(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(cid, comp) of all classes that share a bucket. ``members``: key, cid, n.

    Turn 0 takes any pivot per bucket and settles most of them. Then the
    shingles that a class shares with no other are found, which bounds every
    similarity from above. Turn 1 takes the pivot with the smallest such share,
    the text that the others were made from; turn 2 all that is left outside
    the bucket's largest component."""
    labels = checkpointed(members.select("cid").distinct().withColumn("comp", F.col("cid")))
    here = members.withColumn("comp", F.col("cid"))       # every bucket has several classes
    for turn in range(3):
        if turn:
            here = _unsettled(members, labels)
        if here.isEmpty():
            break
        if turn == 1:
            here = checkpointed(_with_bounds(here, sets))
        members = here.drop("comp")
        if turn == 0:
            pivots = _pivots(here)
        elif turn == 1:
            pivots = _pivots(here, F.col("u") / F.col("n"))
        else:
            pivots = _outside_main(here)
        pivots = checkpointed(pivots.select(
            "key", *[F.col(c).alias("p_" + c) for c in here.columns if c != "key"]))
        may = _may_link(F.col("n"), F.col("p_n"))
        if turn:
            may = may & _may_share("", "p_")
        pairs = (here.join(pivots, "key").filter((F.col("comp") != F.col("p_comp")) & may)
                 .select(F.least("cid", "p_cid").alias("a"), F.greatest("cid", "p_cid").alias("b"))
                 .distinct())
        links = checkpointed(_confirmed(pairs, sets))
        if not links.isEmpty():
            labels = _joined(labels, links, turn == 0)
    return labels


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: rid, doc_id, n_shingles, component_id, and keep_rid, the
    number of the one row of its component that stays."""
    docs = stable_rows(docs)
    text = text_or_empty(F.col(text_col))
    signatures = F.pandas_udf(_signatures, "n_shingles long, set_key binary, bands array<long>")
    numbered = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                           row_number(docs).alias("rid"))
    signed = checkpointed(numbered.select("rid", "doc_id", signatures("text").alias("s"))
                          .select("rid", "doc_id", "s.*"))
    classes = checkpointed(
        signed.filter("n_shingles > 0").groupBy("set_key")
        .agg(F.min("rid").alias("cid"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid"))
             .alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")))
    bands = classes.select("cid", "n", F.explode("bands").alias("key"))
    shared = checkpointed(bands.groupBy("key").agg(F.count(F.lit(1)).alias("k"))
                          .filter("k > 1").select("key"))
    members = checkpointed(bands.join(shared, "key", "left_semi"))
    wanted = members.select(F.col("cid").alias("rid")).distinct()
    sets = checkpointed(numbered.select("rid", "text").join(wanted, "rid", "left_semi")
                        .select(F.col("rid").alias("cid"), F.pandas_udf(_sets, "binary")("text").alias("shingles")))
    labels = _class_components(members, sets)

    named = (classes.select("set_key", "first", "cid").join(labels, "cid", "left")
             .select("set_key", "first", F.coalesce("comp", "cid").alias("comp")))
    heads = checkpointed(named.groupBy("comp").agg(F.min("first").alias("head")))
    named = named.join(heads, "comp").select("set_key", F.col("head.doc_id").alias("component_id"),
                                             F.col("head.rid").alias("keep_rid"))
    empty = F.col("n_shingles") == 0
    return (signed.select("rid", "doc_id", "n_shingles", "set_key")
            .join(named, "set_key", "left")
            .select("rid", "doc_id", "n_shingles",
                    F.when(empty, F.col("doc_id")).otherwise(F.col("component_id"))
                    .alias("component_id"),
                    F.when(empty, F.col("rid")).otherwise(F.col("keep_rid")).alias("keep_rid")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    return near_groups(docs, id_col, text_col).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, the one with its smallest id."""
    docs = stable_rows(docs)
    gone = (near_groups(docs, id_col, text_col).filter("rid <> keep_rid").select("rid"))
    return (docs.select(F.struct("*").alias("row"), row_number(docs).alias("rid"))
            .join(gone, "rid", "left_anti").select("row.*"))
