"""Mixing sources to target weights with a low-discrepancy schedule, built-in
functions only.

Sources by code point (NULL last) weigh 3, 1, 2, repeating, and share 150% of
all words; no target exceeds twice its source, what is above is reshared by
weight (water-filling).

* Every source is shuffled by a seeded hash and cut into blocks of equally
  many words; the last block of a pass is what is left.
* The schedule has as many slots as blocks are wanted. Slots are the grid
  points 0..2^m-1 in van der Corput (bit-reversed) order, mapped through the
  cumulative block counts of the sources: over the full period each grid
  point occurs once, so every source gets exactly its count, and at any moment
  the mix is close to the target weights.
* Slots are ranked per source, and rank r takes the r-th block, starting over
  after the last one; the last slot is cut where the target is reached.

Ranks and running totals of a source that holds a third of all rows are not
computed in one window: slots and documents are cut into about sqrt(n) chunks,
whose totals are summed first.

Defined results: NULL or empty text has size 0 and takes nothing; NULL is a
source of its own; repeated rows each count; an empty table gives no rows. The
row number and the shuffle hash are fixed by writing the small columns once.
The joins on blocks and chunks grow with the data and are merge joins; left to
itself, the planner takes the expanded tables for as small as their sources.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, row_number, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5            # of all words
CAP = 2.0              # times the source's words
SEED = 20240601
CHUNK = 1 << 14        # grid points made per row of the first expansion


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"),
                       row_number(docs).alias("rid"))


def targets(rows: DataFrame) -> DataFrame:
    """One row per source: sid, source, source_size, target. The windows run
    over the table of sources, not over documents."""
    by_point = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                          (F.col("sid") % len(WEIGHTS) + 1).cast("int"))
    src = (rows.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("sid", F.row_number().over(by_point) - 1)
           .withColumn("w", weight).withColumn("cap", F.lit(CAP) * F.col("source_size")))
    # level: words per weight at which no uncapped source is above its cap. Sources
    # fill up in the order of cap / weight; with the first j full, the rest share
    # what is left, and the first j whose level the next source can hold is right.
    fill = Window.orderBy(F.col("cap") / F.col("w"), "sid")
    full = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = ((F.lit(SHARE) * F.sum("source_size").over(every)
              - F.coalesce(F.sum("cap").over(full), F.lit(0.0)))
             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(full), F.lit(0.0))))
    holds = F.when(F.col("level") <= F.col("cap") / F.col("w"), F.struct("place", "level"))
    return (src.withColumn("level", level).withColumn("place", F.row_number().over(fill))
            .withColumn("level", F.min(holds).over(every)["level"])
            .select("sid", "source", F.col("source_size").cast("long").alias("source_size"),
                    F.least(F.col("cap"), F.coalesce(F.col("w") * F.col("level"), F.lit(0.0)))
                    .alias("target")))


def _div(a: Column, b: Column | int) -> Column:
    """Whole-number division."""
    return F.call_function("div", a, F.lit(b).cast("long") if isinstance(b, int) else b)


def _blocks_of(words: Column, block: int) -> Column:
    return _div(words + (block - 1), block)


def van_der_corput(point: Column, bits: int) -> Column:
    """Bit reversal of ``point`` in ``bits`` bits (its own inverse)."""
    return F.conv(F.reverse(F.lpad(F.bin(point), bits, "0")), 2, 10).cast("long")


def schedule(src: DataFrame, block: int) -> DataFrame:
    """Slots of the mix from (sid, source_size, target): slot, sid, rank,
    epoch, block, and ``upto``, the place in the source where it ends."""
    words = F.round("target").cast("long")
    rest = words - F.col("full") * F.col("source_size")
    in_pass = _blocks_of(F.col("source_size"), block)
    src = (src.filter("source_size > 0 and target >= 0.5")
           .withColumn("full", _div(words, F.col("source_size")))
           .withColumn("rest", rest).withColumn("in_pass", in_pass)
           .withColumn("n", F.col("full") * F.col("in_pass") + _blocks_of(F.col("rest"), block))
           .withColumn("start", F.sum("n").over(Window.orderBy("sid")) - F.col("n")))
    src = checkpointed(src)
    n = src.agg(F.sum("n")).first()[0] or 1
    bits = max(1, (int(n) - 1).bit_length())
    low = bits // 2                       # 2^low slots a chunk, 2^(bits-low) chunks
    points = (src.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), _div(F.col("n") - 1, CHUNK))))
              .withColumn("c", F.col("c") * CHUNK)
              .repartition("sid", "c")
              .withColumn("point", F.explode(F.sequence(
                  F.col("start") + F.col("c"),
                  F.col("start") + F.least(F.col("c") + CHUNK, F.col("n")) - 1)))
              .withColumn("slot", van_der_corput(F.col("point"), bits))
              .withColumn("chunk", F.shiftright("slot", low)))
    before = (points.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("k"))
              .withColumn("before", F.sum("k").over(Window.partitionBy("sid").orderBy("chunk"))
                          - F.col("k")).drop("k"))
    rank = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1
    ranked = (points.withColumn("in_chunk", rank).join(before.hint("merge"), ["sid", "chunk"])
              .withColumn("rank", F.col("before") + F.col("in_chunk"))
              .withColumn("epoch", _div(F.col("rank"), F.col("in_pass")))
              .withColumn("block", F.col("rank") - F.col("epoch") * F.col("in_pass")))
    return ranked.select("slot", "sid", "rank", "epoch", "block",
                         F.when(F.col("epoch") < F.col("full"), F.col("source_size"))
                         .otherwise(F.col("rest")).alias("upto"))


def blocks(rows: DataFrame, block: int, n_rows: int) -> DataFrame:
    """Documents laid end to end per source in shuffled order and cut into
    blocks of ``block`` words: rid, sid, block, start and end in the source's
    word count, and ``doc_start``, where the document begins."""
    chunks = max(1, math.isqrt(n_rows))
    h = F.xxhash64(F.lit(SEED), "rid")
    rows = (rows.filter("size > 0").withColumn("h", h)
            .withColumn("chunk", F.pmod(F.shiftrightunsigned("h", 1), F.lit(chunks))))
    before = (rows.groupBy("sid", "chunk").agg(F.sum("size").alias("words"))
              .withColumn("before", F.sum("words").over(Window.partitionBy("sid").orderBy("chunk"))
                          - F.col("words")).drop("words"))
    run = F.sum("size").over(Window.partitionBy("sid", "chunk").orderBy("h", "rid"))
    laid = (rows.withColumn("in_chunk", run - F.col("size")).join(before.hint("merge"), ["sid", "chunk"])
            .withColumn("doc_start", F.col("before") + F.col("in_chunk"))
            .withColumn("doc_end", F.col("doc_start") + F.col("size")))
    first = _div(F.col("doc_start"), block)
    last = _div(F.col("doc_end") - 1, block)
    return (laid.withColumn("block", F.explode(F.sequence(first, last)))
            .select("rid", "sid", "block", "doc_start",
                    F.greatest("doc_start", F.col("block") * block).alias("start"),
                    F.least("doc_end", (F.col("block") + 1) * block).alias("end")))


def block_words(total: float) -> int:
    """Words per block: grows as the root of the whole, so both the number of
    slots and the block stay moderate at any size."""
    return max(1, int(math.sqrt(total) / 8))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, sources, pieces): every document with its row number and source
    id; the targets; and the pieces of the mix in schedule order (slot): which
    words [start, end) of which document (rid) are taken there."""
    rows = checkpointed(sizes(docs, id_col, text_col, source_col))
    src = checkpointed(targets(rows))
    n, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    block = block_words(SHARE * (total or 0))
    known = rows.join(src.select("sid", "source", "source_size", "target"),
                      rows["source"].eqNullSafe(src["source"])).select(
        "rid", "doc_id", rows["source"], "size", "sid", "source_size", "target")
    cut = blocks(known, block, n)
    slots = schedule(src, block)
    pieces = (cut.join(slots.hint("merge"), ["sid", "block"]).withColumn("end", F.least("end", "upto"))
              .filter("end > start")
              .select("slot", "sid", "rank", "rid", (F.col("start") - F.col("doc_start")).alias("start"),
                      (F.col("end") - F.col("doc_start")).alias("end")))
    return known, src, pieces


def mix_to_weights(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source") -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size,
    target, taken, first_slot."""
    known, _, pieces = mix(docs, id_col, text_col, source_col)
    taken = pieces.groupBy("rid").agg(F.sum(F.col("end") - F.col("start")).alias("taken"),
                                      F.min("slot").alias("first_slot"))
    return (known.join(taken, "rid", "left")
            .select("doc_id", F.col("size").cast("long").alias("size"), "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot", "rid"))


def materialise_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The mix as whole documents, with the columns of ``docs``, in schedule
    order: a document occurs at every slot that takes its first word, and is
    read to its end there, so a source runs over by less than one document.
    ``docs`` must be a table scan or a checkpoint (rows meet by number)."""
    _, _, pieces = mix(docs, id_col, text_col, source_col)
    starts = pieces.filter("start = 0").select("rid", "slot")
    return (docs.select(F.struct("*").alias("row"), row_number(docs).alias("rid"))
            .join(starts, "rid").select("row", "slot", "rid")
            .repartitionByRange("slot", "rid").sortWithinPartitions("slot", "rid").select("row.*"))
