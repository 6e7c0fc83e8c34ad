"""Sharding by a two-pass external shuffle, built-in functions only.

Pass 1 scatters the records into buckets by seeded hashes. A record's shard
follows rendezvous hashing of its key (the ``key`` law): the shard with the
largest seeded hash wins, so one more shard takes rows only into itself. Each
shard is cut into buckets of about ``bucket_bytes``, as many as its own bytes
need, again by a seeded hash, now of the single row, so that a repeated key
spreads over the buckets.

Pass 2 takes one bucket at a time, puts it into a defined order, permutes it
with a seeded Fisher-Yates shuffle of its places (``shuffle``), and numbers the
records; buckets follow one another inside their shard. ``write_shards`` moves
the whole rows this way and writes the shards; ``external_shuffle`` only assigns
shard and slot.

Each bucket is a partition of its own (``repartitionById``), so no task holds two
and their size is what a task needs.

Defined results: NULL text has no bytes (size 16); all NULL ids are one key, whose
rows share a shard and spread over its buckets; repeated rows share a shard (same
key) and get different slots; a text longer than ``bucket_bytes`` makes its own
bucket that large. An empty table gives no rows. Written rows stand in one struct
column, so their own columns may have any name. The row hash needs a stable scan
order: what isn't a scan or a checkpoint is checkpointed first, and the small
columns are written once to the checkpoint folder.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from .common import checkpointed, row_number, stable_rows, text_or_empty

OVERHEAD = 16          # bytes a record takes besides its text
BUCKET_BYTES = 64 << 20


def _score(key: Column, shard: Column | int, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), key, F.lit(shard) if isinstance(shard, int) else shard)


def rendezvous_shard(key: Column, n_shards: int, seed: int) -> Column:
    """The shard in 0..n_shards-1 with the largest seeded hash of (key, shard)."""
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)),
                                   lambda s: F.struct(_score(key, s, seed).alias("h"), s.alias("s"))))
    return best["s"]


def records(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            rid: Column | None = None, *more: str) -> DataFrame:
    """The small columns of every record, a number of its own (``rid``), and
    ``more`` columns as they are."""
    t = text_or_empty(F.col(text))
    return docs.select(F.col(doc_id).alias("doc_id"),
                       (F.octet_length(t) + F.lit(OVERHEAD)).cast("long").alias("size"),
                       F.crc32(t.cast("binary")).alias("text_crc32"),
                       (F.monotonically_increasing_id() if rid is None else rid).alias("rid"),
                       *more)


def external_shuffle(docs: DataFrame, n_shards: int = 40, seed: int = 20240601,
                     bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Shard and slot of every row: doc_id, size, text_crc32, law, shard,
    slot, grown_shard (the shard if there were one more), bucket, rid."""
    rows = checkpointed(records(docs, id_col, text_col))        # numbered once, then stored
    return (shuffle_records(rows, rows, n_shards, seed, bucket_bytes)
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                    "grown_shard", "bucket", "rid"))


def _key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


def _scatter(rows: DataFrame, n_shards: int, seed: int, per_shard: list[int]) -> DataFrame:
    """Pass 1: ``rows`` (doc_id, text_crc32, rid and any others) with their
    shard, grown_shard and bucket (numbered through all shards)."""
    first = [sum(per_shard[:s]) for s in range(n_shards)]
    of_shard = lambda xs: F.element_at(F.array(*[F.lit(x).cast("long") for x in xs]), F.col("shard") + 1)
    return (rows.withColumn("key", _key())
            .withColumn("shard", rendezvous_shard(F.col("key"), n_shards, seed).cast("int"))
            .withColumn("grown_shard",
                        F.when(_score(F.col("key"), n_shards, seed)
                               > _score(F.col("key"), F.col("shard"), seed), F.lit(n_shards))
                        .otherwise(F.col("shard")).cast("int"))
            .withColumn("bucket", (of_shard(first) + F.pmod(F.xxhash64(F.lit(seed + 1), "rid"),
                                                            of_shard(per_shard))).cast("int"))
            .drop("key"))


def shuffle_records(small: DataFrame, rows: DataFrame, n_shards: int, seed: int,
                    bucket_bytes: int) -> DataFrame:
    """Both passes over ``rows``, of which ``small`` holds the stored output of
    ``records``: ``rows`` with shard, grown_shard, bucket and slot. The rows are
    shuffled once; a bucket's permutation is an array of its places."""
    sizes = (small.groupBy(rendezvous_shard(_key(), n_shards, seed).alias("shard"))
             .agg(F.sum("size").alias("bytes")).collect())                   # n_shards rows at most
    per_shard = [1] * n_shards
    for r in sizes:
        per_shard[r["shard"]] = math.ceil(r["bytes"] / bucket_bytes)
    n_buckets = sum(per_shard)

    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    # Fisher-Yates of each bucket; in a fixed order, as the generator runs on
    places = (_scatter(small, n_shards, seed, per_shard)
              .groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
              .repartitionById(n_buckets, F.col("bucket")).sortWithinPartitions("bucket")
              .select("bucket", "start",
                      F.shuffle(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")),
                                seed + 3).alias("places")))
    within = Window.partitionBy("bucket").orderBy("h", "rid")
    return (_scatter(rows, n_shards, seed, per_shard).withColumn("h", F.xxhash64(F.lit(seed + 2), "rid"))
            .repartitionById(n_buckets, F.col("bucket"))
            .withColumn("at", F.row_number().over(within))
            .join(places.hint("merge"), "bucket")
            .withColumn("slot", (F.col("start") + F.element_at("places", F.col("at"))).cast("long"))
            .drop("h", "at", "start", "places"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 40, seed: int = 20240601,
                 bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write whole rows (struct ``row``) as one folder per ``shard``, sorted by
    ``slot``, with ``grown_shard``. ``docs`` is read once for the small columns,
    which are stored, and once for the rows, which are shuffled once."""
    docs = stable_rows(docs)
    rid = row_number(docs)
    small = checkpointed(records(docs, id_col, text_col, rid))
    rows = docs.select(F.struct("*").alias("row"), rid.alias("rid"))
    rows = records(rows, f"row.{id_col}", f"row.{text_col}", F.col("rid"), "row")
    (shuffle_records(small, rows, n_shards, seed, bucket_bytes)
     .sortWithinPartitions("shard", "slot").select("row", "shard", "slot", "grown_shard")
     .write.partitionBy("shard").parquet(path))


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """row, shard, slot and grown_shard of what ``write_shards`` wrote from rows
    of ``schema``."""
    whole = StructType([StructField("row", schema), StructField("slot", LongType()),
                        StructField("grown_shard", IntegerType()), StructField("shard", IntegerType())])
    return spark.read.schema(whole).parquet(path)


def written_shards(spark: SparkSession, path: str, schema: StructType, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row that
    ``write_shards`` wrote, from the written texts."""
    back = read_shards(spark, path, schema)
    return (records(back, f"row.{id_col}", f"row.{text_col}", F.lit(0), "shard", "slot", "grown_shard")
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"))
