"""Resampling towards a target distribution by importance weights.

A text's features are all runs of one to three consecutive words, joined by one
space, repeats counted; each falls into a bucket by its checksum. How much more
frequent a bucket is in the target texts than in the documents is its gain (in
thousandths of a nat, with add-one smoothing). The gains are one array, as long
as there are buckets; a document's weight is the sum of its features' gains. A
Gumbel variable drawn from the id is added: the highest scores are then a sample
without replacement with probabilities in proportion to exp(weight / 1000).

Exact ranks come from parallel sorting by regular sampling. Each run (a task's
part of the documents) is sorted where it lies; every g-th row of each run is a
regular sample; the sorted samples give splitters at regular distances; each row
goes to the segment between its two splitters, where the runs' parts are merged;
prefix counts of the segments then turn a row's place in its segment into its
rank. With ``segments`` runs at most and about ``segments ** 2`` samples no
segment has more than about twice its share, whatever the scores. Equal scores
order by id, equal ids by the row's place in the table.

The documents are read twice: to count buckets, and to score. Both passes keep
only counts; long texts are cut at words into pieces of a few megabytes, and
features across a cut are kept.

Words are runs of ASCII letters and digits and of anything beyond ASCII, after
lower-casing A-Z. Defined results: NULL or empty text has no features and weight
0; texts of fewer than ``min_words`` words have a score but no rank; a NULL id
draws as the empty text does and orders last among equal scores; repeated rows
have equal scores and ranks of their own; without documents there are no rows;
without target texts the gains are those of empty counts. Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, row_number, shuffle_partitions

N_BUCKETS = 10_000
MIN_WORDS = 20
SHARE = (5, 100)          # drawn: floor(5 * N / 100)
SEED = 42
MAX_SEGMENTS = 1024
PIECE = 1 << 22

#: word bytes, A-Z lower-cased; all others become spaces
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                  for b in range(256))


def pieces_of_words(data: bytes) -> Iterator[list[bytes]]:
    data = data.translate(_TO_WORDS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def feature_checksums(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(words, checksums of the features that end in them), piece by piece. A
    checksum is carried on from one word to the next, so the features of two and
    three words are never built."""
    last: list[bytes] = []
    for words in pieces_of_words(data):
        ws, k = last + words, len(last)
        spaced = [b" " + w for w in ws]
        one = list(map(crc32, ws))
        two = list(map(crc32, spaced[1:], one))
        three = list(map(crc32, spaced[2:], two))
        yield len(words), np.array(one[k:] + two[max(0, k - 1):] + three[max(0, k - 2):], dtype=np.uint32)
        last = ws[-2:]


def _texts(column: pa.Array) -> Iterator[bytes]:
    binary = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    for x in binary:
        yield x.as_py() or b""


def bucket_counts(texts: DataFrame, text_col: str = "text", n_buckets: int = N_BUCKETS) -> np.ndarray:
    """Features of all texts by bucket; each task counts, then the sums meet."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for data in _texts(batch.column(0)):
                for _, sums in feature_checksums(data):
                    n += np.bincount(sums % n_buckets, minlength=n_buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], ["bucket", "n"])

    per_task = texts.select(F.col(text_col).cast("string")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(n_buckets, np.int64)
    for r in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():      # n_buckets rows at most
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    n, all_docs, all_target = len(docs), float(docs.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_docs + n) / ((s + 1) * (all_target + n))))
                     for s, t in zip(docs.astype(float).tolist(), target.astype(float).tolist(), strict=True)],
                    np.int64)


def weights(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, rid, n_words, n_features and weight of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), row_number(docs).alias("rid"),
                       F.col(text_col).cast("string").alias("text"))
    n_buckets = len(gains)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, data in enumerate(_texts(batch.column(2))):
                for n_words, sums in feature_checksums(data):
                    out[:, i] += n_words, len(sums), gains[sums % n_buckets].sum()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, out)],
                                             ["doc_id", "rid", "n_words", "n_features", "weight"])

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, rid long, n_words long, " \
             "n_features long, weight long"
    return rows.mapInArrow(score, schema)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a standard Gumbel variable, drawn from the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def exact_ranks(rows: DataFrame, segments: int) -> DataFrame:
    """``rows`` with their rank from 1 by score downwards, then doc_id, then rid;
    ``rows`` is a checkpoint."""
    up = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("rid").asc()]
    runs = checkpointed(rows.coalesce(segments).sortWithinPartitions(*up))
    step = max(1, runs.count() // segments ** 2)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    samples = runs.withColumn("place", place).filter(F.col("place") % step == step // 2)
    # segments ** 2 samples and one for each run, at most
    order = samples.select("score", "doc_id", "rid", F.row_number().over(Window.orderBy(*up)).alias("i"),
                           F.count(F.lit(1)).over(Window.partitionBy()).alias("m"))
    cuts = (order.filter("i * {0} div m > (i - 1) * {0} div m and i < m".format(segments))
            .orderBy(*up).collect())                              # fewer than segments rows
    tie = lambda doc_id, rid: (doc_id is None, 0 if doc_id is None else doc_id, rid)
    scores = np.array([-r["score"] for r in cuts], np.int64)
    ties = [(-r["score"], *tie(r["doc_id"], r["rid"])) for r in cuts]

    def segment_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = -batch.column("score").to_numpy()
            seg, until = np.searchsorted(scores, own, "left"), np.searchsorted(scores, own, "right")
            for i in np.flatnonzero(seg != until):                # the score of a splitter
                key = tie(batch.column("doc_id")[i].as_py(), batch.column("rid")[i].as_py())
                seg[i] = bisect_right(ties, (int(own[i]), *key))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(seg.astype(np.int32))],
                                             [*batch.schema.names, "segment"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema) + ", segment int"
    merged = checkpointed(runs.mapInArrow(segment_of, schema)
                          .repartitionById(segments, F.col("segment"))
                          .sortWithinPartitions("segment", *up))
    merged = merged.withColumn("at", F.monotonically_increasing_id())
    first = (merged.groupBy("segment").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("c"))
             .withColumn("before", F.sum("c").over(Window.orderBy("segment")) - F.col("c")))
    return (merged.join(F.broadcast(first.select("segment", "first", "before")), "segment")   # segments rows
            .withColumn("rank", F.col("before") + F.col("at") - F.col("first") + 1)
            .drop("segment", "at", "first", "before"))


def importance_ranks(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS,
                     n_buckets: int = N_BUCKETS, seed: int = SEED, segments: int | None = None) -> DataFrame:
    """doc_id, rid, n_words, n_features, weight, score and rank of every row of
    ``docs``; rank is NULL for rows that are not drawn."""
    gains = bucket_gains(bucket_counts(docs, text_col, n_buckets), bucket_counts(target, text_col, n_buckets))
    scored = checkpointed(weights(docs, gains, id_col, text_col)
                          .withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)))
    eligible = scored.filter(F.col("n_words") >= min_words)
    n_drawn = eligible.count() * share[0] // share[1]
    segments = segments or max(1, min(MAX_SEGMENTS, shuffle_partitions(docs.sparkSession)))
    ranked = exact_ranks(eligible, segments)
    drawn = F.when(F.col("rank") <= n_drawn, F.col("rank")).cast("long")
    rest = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", drawn).unionByName(rest)


def draw(docs: DataFrame, target: DataFrame, **kw) -> DataFrame:
    """The drawn rows of ``docs`` (a table scan or a checkpoint), whole, with
    their rank in the struct column ``draw`` beside the row's struct ``row``."""
    ranks = (importance_ranks(docs, target, **kw).filter(F.col("rank").isNotNull())
             .select("rid", F.struct("rank", "score", "weight").alias("draw")))
    return (docs.select(F.struct("*").alias("row"), row_number(docs).alias("rid"))
            .join(ranks, "rid").select("row", "draw"))
