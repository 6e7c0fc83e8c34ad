"""Line dedup over overlapping three-line windows, built-in functions only.

Every three consecutive lines of a text are one window, named by a 128-bit
hash. A window found twice or more, anywhere, keeps its first occurrence (by
id, NULL last, then row, then line); every later one covers its three lines.
Covered positions of a document are merged to intervals, and these lines are
removed. A removed line always has an equal, earlier line in the window that
kept it, so the first copy of a passage stays whole somewhere.

Lines end at ``\\n`` and are compared as they are. Defined results: windows of
blank lines only do not count; texts of fewer than three lines and NULL (which
counts as empty) stay as they are; repeated rows are later occurrences; an
empty table gives no rows. Rows meet their intervals by number, so ``docs``
must be a table scan or a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, checkpointed, row_number, text_or_empty

SPAN = 3
NEW_LINE = "\n"


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per window: rid, doc_id, pos and its hash (h1, h2)."""
    lines = F.split(text_or_empty(F.col(text_col)), NEW_LINE)
    hashed = F.transform("lines", lambda x: F.struct(
        F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), x.rlike(WORD).alias("w")))

    def window(i):
        at = [F.get(F.col("hashed"), i + k) for k in range(SPAN)]
        counts = at[0]["w"]
        for x in at[1:]:
            counts = counts | x["w"]
        return F.struct(i.alias("pos"), F.xxhash64(*[x["a"] for x in at]).alias("h1"),
                        F.xxhash64(*[x["b"] for x in at]).alias("h2"), counts.alias("counts"))

    return (docs.select(row_number(docs).alias("rid"), F.col(id_col).alias("doc_id"),
                        lines.alias("lines"))
            .filter(F.size("lines") >= SPAN)
            .select("rid", "doc_id", hashed.alias("hashed"))
            .select("rid", "doc_id", F.explode(F.transform(
                F.sequence(F.lit(0), F.size("hashed") - SPAN), window)).alias("w"))
            .filter("w.counts").select("rid", "doc_id", "w.pos", "w.h1", "w.h2"))


def covered_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row with something to remove: rid and the merged intervals ``cut``,
    an ordered array of (first line, last line)."""
    found = checkpointed(windows(docs, id_col, text_col))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid", "pos")
    first = (found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("h1", "h2", F.col("first.rid").alias("rid0"),
                                     F.col("first.pos").alias("pos0")))
    first = checkpointed(first)       # straight from a shuffle, a very common window can be split
    later = (found.join(first, ["h1", "h2"]).filter("rid <> rid0 or pos <> pos0")
             .select("rid", "pos"))
    in_order = Window.partitionBy("rid").orderBy("pos")
    gap = F.coalesce(F.col("pos") - F.lag("pos").over(in_order) > SPAN, F.lit(True))
    return (later.withColumn("gap", gap.cast("int"))
            .withColumn("island", F.sum("gap").over(in_order))
            .groupBy("rid", "island")
            .agg(F.min("pos").alias("s"), (F.max("pos") + (SPAN - 1)).alias("e"))
            .groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("cut")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text without the covered lines, n_lines, n_removed, and the
    removed intervals (``cut``)."""
    cut = covered_lines(docs, id_col, text_col)
    rows = docs.select(row_number(docs).alias("rid"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"),
                       F.split(text_or_empty(F.col(text_col)), NEW_LINE).alias("lines"))
    n = F.size("lines")

    def between(k):
        start = F.when(k == 0, F.lit(0)).otherwise(F.get("cut", k - 1)["e"] + 1)
        end = F.coalesce(F.get("cut", k)["s"], n)
        return F.slice("lines", start + 1, end - start)

    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("cut")), between))
    removed = F.aggregate("cut", F.lit(0), lambda acc, x: acc + x["e"] - x["s"] + 1)
    return (rows.join(cut, "rid", "left")
            .select("doc_id",
                    F.when(F.col("cut").isNull(), F.coalesce("text", F.lit("")))
                    .otherwise(F.array_join(kept, NEW_LINE)).alias("text"),
                    n.cast("long").alias("n_lines"),
                    F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"), "cut"))
