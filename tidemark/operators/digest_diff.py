"""The snapshot diff through digests: only parts of the table that differ are
joined.

Both sides are cut into buckets of neighbouring keys. A bucket's digest is the
number of its rows and two order-free sums of hashes of (match key, compared
values); it is one aggregation per side, combined before its shuffle, so what is
shuffled are buckets, not rows. Buckets with equal digests hold the same keys with
the same values (up to a chance of about 2^-90 a bucket): their stored rows are
the result, unchanged, straight from the scan. All other buckets go through the
usual join.

The extract isn't deduplicated first (that would shuffle it): stored rows have one
row per key, so a bucket in which the extract repeats a key has another count, and
is deduplicated on its way to the join.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.keys import (all_present, any_null, as_list, column, conform, match_key_exprs, match_key_names,
                              resolve)
from ..session import ensure_checkpoint_root
from . import snapshot_diff as sd

BUCKET = "_tm_bucket"
BROADCAST_ROWS = 1_000_000         # buckets that differ: 16 bytes each


def _hashed(df: DataFrame, keys: Sequence[str], compared: Sequence[str], types: dict[str, str],
            bucket: Column, normalize: bool) -> DataFrame:
    """Bucket and two hashes of every row, in the extract's types."""
    names = [resolve(df, k) for k in keys]
    parts = [*[x.cast(types[k.lower()])
               for k, x in zip(keys, match_key_exprs(df, names, normalize).values(), strict=True)],
             *[column(resolve(df, c)).cast(types[c.lower()]) for c in compared]]
    # NULL and a value must hash differently, wherever they stand
    row = F.struct(*[x for p in parts for x in (p.isNull(), p)])
    return df.select(bucket.alias(BUCKET), F.xxhash64(row).alias("h"), F.hash(row).cast("long").alias("g"))


def differing_buckets(new: DataFrame, old: DataFrame) -> DataFrame:
    """Buckets in which two sides (as ``_hashed``) differ, or that one side lacks."""
    both = new.withColumn("s", F.lit(1)).unionByName(old.withColumn("s", F.lit(-1)))
    return (both.groupBy(BUCKET).agg(F.sum("s").alias("n"), F.bit_xor("h").alias("h"),
                                     F.sum(F.col("g") * F.col("s")).alias("g"))
            .where("n <> 0 or h <> 0 or g <> 0").select(BUCKET).where(F.col(BUCKET).isNotNull()))


def digest_next_state(prep: DataFrame, current: DataFrame, keys: str | Iterable[str], stamps: sd.Stamps, *,
                      bucket: str, order_by=None, compare: Iterable[str] | None = None,
                      fingerprint: str | None = C.FINGERPRINT_COLUMN, normalize: bool = True,
                      tag: bool = False) -> DataFrame:
    """``snapshot_diff.next_state`` of an extract (not deduplicated; ``order_by``
    as in ``prepare_snapshot``) and the stored current rows, joined only where they
    differ.

    ``bucket`` is SQL over columns both sides have, a whole number that depends on
    the match key alone, such as ``k div 1000``: neighbouring keys together, so that
    changes that lie together stay in few buckets. Rows without a bucket or a key
    part go through the join. Both sides are read twice, so they should be scans."""
    keys = as_list(keys)
    ensure_checkpoint_root(prep.sparkSession)
    valid, _ = sd.split_rejected(prep, keys)
    compared = sd._compare_columns(valid, keys, compare, fingerprint)
    keys = [resolve(valid, k) for k in keys]
    types = {f.name.lower(): f.dataType.simpleString() for f in valid.schema.fields}
    b = F.expr(bucket).cast("long")
    okeys = [resolve(current, k) for k in keys]
    stored = current.where(all_present(okeys))
    differ = differing_buckets(_hashed(valid, keys, compared, types, b, normalize),
                               _hashed(stored, keys, compared, types, b, normalize)).checkpoint(eager=True)
    if differ.count() <= BROADCAST_ROWS:
        differ = F.broadcast(differ)

    def part(df: DataFrame, how: str) -> DataFrame:
        return df.withColumn(BUCKET, b).join(differ, BUCKET, how).drop(BUCKET)

    snap = sd.prepare_snapshot(part(valid, "left_semi").unionByName(valid.where(b.isNull())), keys,
                               order_by=order_by, normalize=normalize)
    changed = (part(stored, "left_semi").unionByName(stored.where(b.isNull()))
               .unionByName(current.where(any_null(okeys))))
    nxt = sd.next_state(snap, changed, keys, stamps, compare=compare, fingerprint=fingerprint,
                        normalize=normalize, tag=True)
    equal = part(stored.where(b.isNotNull()), "left_anti")
    out = nxt.unionByName(conform(equal, nxt, {sd.CHANGE: F.lit(C.UNCHANGED)}))
    return out if tag else out.drop(sd.CHANGE)
