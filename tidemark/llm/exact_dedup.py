"""Exact deduplication with counting quotient filters.

Two texts are equal when they are identical after lower-casing A-Z.

1. Every input partition builds one counting quotient filter (CQF) over the
   64-bit fingerprints of its normalised texts. The filter is cut into
   buckets by the leading fingerprint bits.
2. The blocks of a bucket meet in one task and merge losslessly: remainders
   are kept sorted, so a merge is one ordered pass that adds counts. A text
   that holds a third of all rows is one entry per partition by then.
3. Only fingerprints with a count above one go on to verification: SHA-256 of the
   normalised bytes and their number decide which rows are equal (the bytes
   themselves aren't moved). Fingerprints that merely collide fall apart here.

Defined results: NULL text counts as empty, so all NULL and empty texts are
one group. Of equal texts the row with the largest id stays; a NULL id loses
against any other; of rows that repeat both id and text exactly one stays.
An empty table gives an empty result. Other columns are not looked at, so
their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, checkpointed, shuffle_partitions


HOT_GROUPS = 50_000    # at most so many groups of about 150 bytes are broadcast


class CountingQuotientFilter:
    """Fingerprints of ``bits`` bits, split into a quotient (the slot run) and
    a remainder. Runs are stored in quotient order, remainders sorted inside
    their run, each with its count; no fingerprint bit is lost."""

    def __init__(self, bits: int, q: int, runs: np.ndarray, remainders: np.ndarray,
                 counts: np.ndarray):
        self.bits, self.q = bits, q
        self.runs, self.remainders, self.counts = runs, remainders, counts

    @classmethod
    def of(cls, bits: int, fingerprints: np.ndarray, counts: np.ndarray) -> CountingQuotientFilter:
        """From sorted distinct fingerprints and their counts."""
        n = len(fingerprints)
        q = min(bits, max(1, int(n).bit_length()))
        r = np.uint64(bits - q)
        runs = np.bincount((fingerprints >> r).astype(np.int64), minlength=1 << q)
        mask = np.uint64((1 << int(r)) - 1)
        return cls(bits, q, runs.astype(np.uint32), fingerprints & mask, counts.astype(np.uint64))

    def fingerprints(self) -> np.ndarray:
        """The stored fingerprints, in order."""
        quotients = np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs)
        return (quotients << np.uint64(self.bits - self.q)) | self.remainders

    def merge(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        return merge_filters([self, other])

    def to_bytes(self) -> bytes:
        head = np.array([self.bits, self.q, len(self.remainders)], dtype=np.uint64)
        return b"".join(x.tobytes() for x in (head, self.runs, self.remainders, self.counts))

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        bits, q, n = (int(x) for x in np.frombuffer(data, np.uint64, 3))
        runs = np.frombuffer(data, np.uint32, 1 << q, 24)
        at = 24 + 4 * (1 << q)
        return cls(bits, q, runs, np.frombuffer(data, np.uint64, n, at),
                   np.frombuffer(data, np.uint64, n, at + 8 * n))


def merge_filters(filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
    """One ordered pass over already sorted entries; equal ones add counts."""
    keys = np.concatenate([f.fingerprints() for f in filters])
    counts = np.concatenate([f.counts for f in filters])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if len(keys):
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, counts = keys[first], np.add.reduceat(counts, first)
    return CountingQuotientFilter.of(filters[0].bits, keys, counts)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of all runs, ascending, and the sums of their counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.empty(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def _partition_filters(bucket_bits: int):
    bits = 64 - bucket_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[tuple[np.ndarray, np.ndarray]] = []       # each more than twice the next
        for batch in batches:
            new = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            runs.append(np.unique(new, return_counts=True))
            while len(runs) > 1 and len(runs[-2][0]) <= 2 * len(runs[-1][0]):
                runs[-2:] = [_summed(*zip(*runs[-2:], strict=True))]
        if not runs:
            return
        keys, counts = _summed(*zip(*runs, strict=True))
        if not len(keys):
            return
        bucket = (keys >> np.uint64(bits)).astype(np.int64)
        inside = keys & np.uint64((1 << bits) - 1)
        edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        blocks = [CountingQuotientFilter.of(bits, k, c).to_bytes()
                  for k, c in zip(np.split(inside, edges[1:]), np.split(counts, edges[1:]),
                                  strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[edges], pa.int64()), pa.array(blocks, pa.binary())],
            names=["bucket", "block"])

    return build


def _merge_bucket(bucket_bits: int):
    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        f = merge_filters([CountingQuotientFilter.from_bytes(b) for b in pdf["block"]])
        many = f.counts > 1
        fp = f.fingerprints()[many] | (np.uint64(int(key[0])) << np.uint64(64 - bucket_bits))
        return pd.DataFrame({"fp": fp.view(np.int64), "n": f.counts[many].astype(np.int64)})

    return merge


def repeated_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """Fingerprints (column ``fp``, long) that occur more than once, with
    their counts, by merging one CQF per partition."""
    bucket_bits = min(20, max(1, (shuffle_partitions(fingerprints.sparkSession) - 1).bit_length()))
    return (fingerprints.select("fp")
            .mapInArrow(_partition_filters(bucket_bits), "bucket long, block binary")
            .groupBy("bucket").applyInPandas(_merge_bucket(bucket_bits), "fp long, n long"))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, fingerprint, SHA-256 and length of every normalised text; the
    texts themselves are read once and go no further."""
    norm = ascii_lower(F.col(text_col))
    return (docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm"))
            .select("doc_id", F.monotonically_increasing_id().alias("rid"),
                    F.xxhash64("norm").alias("fp"),
                    F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                    F.octet_length("norm").cast("long").alias("n_bytes")))


def copy_groups(digest: DataFrame) -> DataFrame:
    """Groups of two or more equal texts: text_sha256, n_bytes, the row that
    stays (keep_id, keep_rid) and group_size."""
    routed = digest.join(repeated_fingerprints(digest).select("fp"), "fp", "left_semi")
    return (routed.groupBy("text_sha256", "n_bytes")
            .agg(F.max(F.struct("doc_id", "rid")).alias("keep"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1")
            .select("text_sha256", "n_bytes", F.col("keep.doc_id").alias("keep_id"),
                    F.col("keep.rid").alias("keep_rid"), F.col("n").alias("group_size")))


def with_groups(digest: DataFrame) -> DataFrame:
    """``digest`` with keep_id, keep_rid and group_size (NULL if alone).

    Rows of a text with more than ``1 / HOT_GROUPS`` of all rows do not meet in
    one task: there are fewer than ``HOT_GROUPS`` such texts, so their groups
    are broadcast, and only the other rows are shuffled."""
    keys = ["text_sha256", "n_bytes"]
    groups = checkpointed(copy_groups(digest))
    limit = max(1000, digest.count() // HOT_GROUPS)
    hot = F.broadcast(groups.filter(F.col("group_size") > limit))
    cold = groups.filter(F.col("group_size") <= limit)
    return (digest.join(hot, keys)
            .unionByName(digest.join(hot, keys, "left_anti").join(cold, keys, "left")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The decision for every row of ``docs``: doc_id, keep_id, group_size,
    kept, text_sha256."""
    alone = F.col("keep_rid").isNull()
    return (with_groups(checkpointed(digests(docs, id_col, text_col)))
            .select("doc_id",
                    F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.coalesce(F.col("rid") == F.col("keep_rid"), F.lit(True)).alias("kept"),
                    "text_sha256"))


def _row_key(doc_id: Column, sha: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), sha)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that exact_dedup drops, with all its columns.
    One key per row (id and text) decides, so copies of a text spread evenly
    over the tasks and only the dropped keys are shuffled besides the rows. The
    keys are stored first: adaptive execution can then split a row that occurs
    very often."""
    digest = checkpointed(digests(docs, id_col, text_col))
    marked = checkpointed(with_groups(digest).filter("group_size is not null")
                          .select(_row_key(F.col("doc_id"), F.col("text_sha256")).alias("row_key"),
                                  (F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("stays")))
    gone = checkpointed(marked.filter("not stays").select("row_key").distinct())
    repeated = checkpointed(marked.filter("stays").groupBy("row_key").count().filter("count > 1"))
    sha = F.sha2(ascii_lower(F.col(text_col)).cast("binary"), 256)
    rows = docs.select(F.struct("*").alias("row"), _row_key(F.col(id_col), sha).alias("row_key"))
    out = rows.join(gone, "row_key", "left_anti")
    if not repeated.isEmpty():           # whole rows that occur again: one of each, combined
        twins = repeated.select("row_key")  # before the shuffle
        one = (out.join(twins, "row_key", "left_semi").groupBy("row_key")
               .agg(F.first("row").alias("row")))
        out = out.join(twins, "row_key", "left_anti").unionByName(one)
    return out.select("row.*")

