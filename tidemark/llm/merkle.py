"""Merkle manifest of a dataset: a digest per row, a tree per group, a root over
all groups, and for every row the siblings that prove it belongs to the root.

Each row is a leaf: SHA-256 of its columns, each as UTF-8 byte count, colon,
value, or ``-`` if NULL. Leaves of a group ascend by ``order_col``; while a group
has more than one node, every ``FAN`` consecutive nodes become the digest of
their joined hexadecimal digests. What remains is the group's subroot; the
subroots, in the groups' order (NULL first, then by UTF-8 bytes), are the leaves
of the last tree. Digests are lower-case hexadecimal text.

The tree is a nested struct. A row's rank is written in digits of base ``FAN``;
rows of equal higher digits are a block (``FAN ** LEVELS`` leaves at most). In a
block the lowest digit is grouped away first, then the next, each time nesting
the child structs in rank order, so a block ends as one row that holds its part
of the tree. Blocks are leaves of the blocks above, tier by tier. Proofs go the
other way: what lies above a block meets the block's row by one grouping, and
transform and explode hand each child the digests left and right of it, level by
level, without a join. No text is shuffled, and no row holds more than a block.

Ranks come from a range partitioning by group and order, so a group with any
share of all rows spreads over many tasks; what a task can't see, the rows of its
group in the tasks before, is a prefix sum over one row per task and group.

Defined results: NULL columns are ``-``; a NULL id orders first; equal ids order
by digest, and fully equal rows each get a place and a proof of their own; a group
of one row has its leaf as subroot; an empty table gives no rows; other columns,
whatever their names, are neither read nor returned; texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed

FAN = 16
LEVELS = 3          # a block: FAN ** LEVELS leaves


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    def field(value: Column) -> Column:
        v = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return digest(F.concat(*[field(v) for v in values]))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``proof`` give."""
    return F.aggregate(proof, leaf, lambda acc, x: digest(F.concat(x["left"], acc, x["right"])))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(proof, lambda x: F.concat(x["left"], x["right"])), ""))


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (with ``grp``) and their place (``pos``, from 0) in their group
    by ``order``, and the group's size (``n``)."""
    keys = ["grp", *order]
    runs = checkpointed(rows.repartitionByRange(*keys).sortWithinPartitions(*keys))
    at = F.monotonically_increasing_id()        # of a checkpoint: partition and place in it
    runs = (runs.withColumn("task", F.shiftright(at, 33).cast("int"))
            .withColumn("idx", at.bitwiseAND(F.lit((1 << 33) - 1))))
    before = Window.partitionBy("grp").orderBy("task")
    starts = (runs.groupBy("grp", "task").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("c"))
              .select("grp", "task",
                      (F.sum("c").over(before) - F.col("c") - F.col("first")).alias("shift"),
                      F.sum("c").over(Window.partitionBy("grp")).alias("n")))
    return (runs.join(starts, ["grp", "task"])
            .withColumn("pos", F.col("idx") + F.col("shift")).drop("task", "idx", "shift"))


def _nested(nodes: DataFrame, levels: int) -> DataFrame:
    """One row per block: grp, n (nodes of the group), block, node. ``nodes``
    has grp, n, pos, h (digest) and item (what a leaf of the block carries)."""
    digits = [f"d{k}" for k in range(levels)]
    df = (nodes.selectExpr("grp", "n", f"pos div {FAN ** levels} as block", "struct(h, item) as node",
                           *[f"cast(pos div {FAN ** k} % {FAN} as int) as d{k}" for k in range(levels)])
          .repartition("grp", "block"))
    for k in range(levels):                      # one exchange serves all levels
        keys = ["grp", "n", "block", *digits[k + 1:]]
        df = (df.groupBy(*keys)
              .agg(F.sort_array(F.collect_list(F.struct(f"d{k}", "node"))).alias("kids"))
              .select(*keys, F.col("kids.node").alias("kids")))
        joined = digest(F.array_join(F.col("kids.h"), ""))
        h = F.when(F.col("n") > FAN ** k, joined).otherwise(F.col("kids")[0]["h"])
        df = df.select(*keys, F.struct(h.alias("h"), F.col("kids")).alias("node"))
    return df


def _tiers(nodes: DataFrame, n_max: int, levels: int) -> list[DataFrame]:
    """Blocks of nodes, blocks of blocks, and so on until each group has one."""
    tiers = []
    while True:
        tiers.append(checkpointed(_nested(nodes, levels)))
        n_max = -(-n_max // FAN ** levels)
        if n_max <= 1:
            return tiers
        nodes = tiers[-1].selectExpr("grp", f"(n + {FAN ** levels - 1}) div {FAN ** levels} as n",
                                     "block as pos", "node.h as h", "struct(block) as item")


def _with_paths(tiers: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """grp, item, path (array of left and right) and info of every leaf, from
    ``tops``: grp, block, path and info of every group's last block."""
    for depth, blocks in reversed(list(enumerate(tiers))):
        both = blocks.unionByName(tops, allowMissingColumns=True).repartition("grp", "block")
        df = both.groupBy("grp", "block").agg(*[F.first(c, ignorenulls=True).alias(c)
                                                for c in ("n", "node", "path", "info")])
        for k in reversed(range(levels)):
            hs = F.col("hs")
            side = F.struct(F.array_join(F.slice(hs, F.lit(1), F.col("i")), "").alias("left"),
                            F.array_join(F.slice(hs, F.col("i") + 2, F.lit(FAN)), "").alias("right"))
            df = (df.select("grp", "n", "path", "info", F.col("node.kids.h").alias("hs"),
                            F.posexplode("node.kids").alias("i", "node"))
                  .select("grp", "n", "info", "node",
                          F.when(F.col("n") > FAN ** k, F.concat(F.array(side), F.col("path")))
                          .otherwise(F.col("path")).alias("path")))
        tops = df.select("grp", F.col("node.item").alias("item"), "path", "info")
        if depth:
            tops = tops.select("grp", F.col("item.block").alias("block"), "path", "info")
    return tops


def merkle_manifest(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
                    group_col: str = "source", order_col: str = "doc_id",
                    also: Mapping[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """``order_col``, ``group_col``, leaf, subroot, root and proof of every row.

    proof is an array of (left, right), from the leaf up: the joined digests of
    the siblings before and after the node, see ``fold``. ``also`` names further
    expressions over ``docs`` to return, such as the digest of another copy."""
    also = dict(also or {})
    name = F.col(group_col).cast("string")
    # sorts as the names do: NULL first, then by bytes
    leaves = checkpointed(docs.select(
        F.coalesce(F.concat(F.lit("+"), name), F.lit("")).alias("grp"),
        F.col(order_col).alias("id"), leaf_digest([F.col(c) for c in columns]).alias("h"),
        F.struct(F.col(group_col).alias("group"), *[c.alias(f"x{i}") for i, c in enumerate(also.values())])
        .alias("more")))
    placed = checkpointed(_placed(leaves, ["id", "h"]))
    nodes = placed.select("grp", "n", "pos", "h", F.struct("id", "h", "more").alias("item"))
    tiers = _tiers(nodes, placed.agg(F.max("n")).first()[0] or 0, levels)

    # the tree over the groups: one leaf per subroot
    subroots = tiers[-1].select(F.lit("").alias("grp"), F.col("grp").alias("id"),
                                F.col("node.h").alias("h"))
    groups = checkpointed(_placed(subroots, ["id"]))
    group_nodes = groups.select("grp", "n", "pos", "h", F.struct("id", "h").alias("item"))
    group_tiers = _tiers(group_nodes, groups.agg(F.max("n")).first()[0] or 0, levels)
    root = group_tiers[-1].select("grp", "block", F.expr("cast(array() as array<struct<left:string,right:string>>)")
                                  .alias("path"), F.col("node.h").alias("info"))
    tops = (_with_paths(group_tiers, root, levels)
            .select(F.col("item.id").alias("grp"), F.lit(0).cast("long").alias("block"), "path",
                    F.struct(F.col("item.h").alias("subroot"), F.col("info").alias("root")).alias("info")))
    out = _with_paths(tiers, checkpointed(tops), levels)
    return out.select(F.col("item.id").alias(order_col), F.col("item.more.group").alias(group_col),
                      F.col("item.h").alias("leaf"), "info.subroot", "info.root",
                      F.col("path").alias("proof"),
                      *[F.col(f"item.more.x{i}").alias(c) for i, c in enumerate(also)])
