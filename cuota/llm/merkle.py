"""Merkle manifest of a dataset: a tree of digests per group and one over the groups, built with lag and lead windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuota.llm.common import stored
from cuota.llm.ranks import ranked

# Levels that one pass climbs. Its windows hold blocks of 2^LEVELS nodes, however large the group.
LEVELS = 10

SIDES = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: each value as its length in UTF-8 bytes, a colon and itself, or `-` if null."""
    texts = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def fold(sides: Column, leaf: Column) -> Column:
    """The root that a leaf leads to by its siblings: `sides` has what stands left and right of it, level by level."""
    return F.aggregate(sides, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def siblings(sides: Column) -> Column:
    """The siblings put together, level by level."""
    return F.array_join(F.transform(sides, lambda s: F.concat(s["left"], s["right"])), "")


def climb(nodes: DataFrame, levels: int) -> DataFrame:
    """`nodes` (`_key`, `_rank`, `_node`, `_height`, others) with `_block`, the siblings `_sides` of each on the way to
    the top of its block of 2^`levels` nodes, and that `_top` on the block's first row.

    A node of level n is held by the row of its first leaf, so its sibling is held 2^n rows further on if it is the first
    child, and 2^n rows back if it is the second: lead and lag of a fixed offset, masked by the slot. Past the end of the
    block they are null: a run of one. The first child's row hashes the parent. `_height` levels are climbed at most.
    All levels share one partitioning and order, so the rows are shuffled and sorted once.
    """
    rows = nodes.withColumn("_block", F.shiftright("_rank", levels)).withColumn("_top", F.col("_node"))
    block = Window.partitionBy("_key", "_block").orderBy("_rank")
    for level in range(levels):
        step = 1 << level
        holds = (F.col("_rank").bitwiseAND(F.lit(step - 1)) == 0) & (F.col("_height") > level)
        second = F.col("_rank").bitwiseAND(F.lit(step)) != 0
        rows = rows.withColumn("_on", F.lead("_top", step).over(block)).withColumn("_back", F.lag("_top", step).over(block))
        left = F.coalesce(F.when(second, F.col("_back")), F.lit(""))
        right = F.coalesce(F.when(~second, F.col("_on")), F.lit(""))
        parent = F.when(F.col("_height") <= level, F.col("_top")).when(holds & ~second, digest(F.col("_top"), right))
        rows = rows.withColumn(f"_side{level}", F.when(holds, F.struct(left.alias("left"), right.alias("right")))
                               ).withColumn("_top", parent)
    so_far = block.rowsBetween(Window.unboundedPreceding, 0)
    sides = [F.last(f"_side{n}", ignorenulls=True).over(so_far) for n in range(levels)]  # from the row that holds the node
    return rows.withColumn("_sides", F.array_compact(F.array(*sides))).drop(
        "_on", "_back", *[f"_side{n}" for n in range(levels)])


def grow(leaves: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """Trees over `leaves` (`_key`, `_rank`, `_node`, others), one per key.

    Gives the leaves with `_block` and `_sides` of their block, and per block (`_key`, `_block`) the siblings `_upper`
    from its top to the key's root, and that `_root`. Each pass hands one row per block to the next.
    """
    high = F.max("_rank")  # of n leaves the last has rank n - 1, whose binary digits are the levels of the tree
    heights = leaves.groupBy("_key").agg(F.when(high > 0, F.length(F.bin(high))).otherwise(F.lit(0)).alias("_height"))
    heights = stored(heights.withColumnRenamed("_key", "_of"), "merkle-heights")
    left = heights.agg(F.max("_height")).first()[0] or 0
    nodes = leaves.join(heights, F.col("_key") == F.col("_of")).drop("_of")
    passes = []
    while True:
        climbed = climb(nodes, levels)
        first = climbed.where(F.col("_rank") == F.shiftleft("_block", levels))
        tops = stored(first.select("_key", F.col("_block").alias("_rank"), F.col("_top").alias("_node"),
                                   F.greatest(F.col("_height") - levels, F.lit(0)).alias("_height")), "merkle-tops")
        passes.append((climbed, tops))
        if left <= levels:
            break
        nodes, left = tops, left - levels
    upper = passes[-1][1].select("_key", F.col("_rank").alias("_block"), F.array().cast(SIDES).alias("_upper"),
                                 F.col("_node").alias("_root"))
    for climbed, _ in reversed(passes[1:]):
        joined = climbed.join(upper, ["_key", "_block"])
        upper = stored(joined.select("_key", F.col("_rank").alias("_block"), F.concat("_sides", "_upper").alias("_upper"),
                                     "_root"), "merkle-upper")
    return passes[0][0], upper


def merkle_manifest(df: DataFrame, *, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
                    id: str = "doc_id", group: str = "lang", carry: dict[str, Column] | None = None,
                    levels: int = LEVELS) -> DataFrame:
    """(id, `leaf`, `sides`, `subroot`, `root`, carried columns) for every row of `df`.

    A row's leaf is the digest of `columns`. The leaves of a group stand in order of `id`; every two of them in turn, the
    last perhaps alone, become their digest until one is left, the group's `subroot`. The subroots, in the bytewise order
    of the groups, null first, give the `root` the same way. `sides` proves a row: `fold(sides, leaf)` is the root.
    Columns of `carry` are computed in the one pass over the texts and go along.

    Leaves are spread by ranges of group and id, so a group that holds most rows fills many tasks; then blocks of
    2^`levels` leaves are windows, and one row per block goes on to the next pass. Texts never move. Null values have a
    mark of their own in a leaf; null ids come first, rows with equal ids stand in the order of their leaves, and equal
    rows are leaves each. An empty table gives an empty result. Other columns of `df`, with whatever names, are not read.
    """
    carry = carry or {}
    key = F.coalesce(F.concat(F.lit("1"), F.col(f"`{group}`").cast("string")), F.lit("0"))  # null sorts before all
    own = stored(df.select(key.alias("_key"), F.col(f"`{id}`").alias("_id"),
                           leaf_digest(*[F.col(f"`{c}`") for c in columns]).alias("_node"),
                           *[c.alias(f"_carry{n}") for n, c in enumerate(carry.values())]), "merkle-leaves")
    leaves, upper = grow(ranked(own, "_key", ["_id", "_node"], "merkle-ordered"), levels)
    roots = upper.where("_block = 0").select(F.lit(0).alias("_key"), F.col("_key").alias("_group"), F.col("_root").alias("_node"))
    tops, above = grow(ranked(stored(roots, "merkle-roots"), "_key", ["_group"], "merkle-groups"), levels)
    last = tops.join(above, ["_key", "_block"]).select("_group", F.concat("_sides", "_upper").alias("_last"),
                                                       F.col("_root").alias("root"))
    upper = stored(upper.join(last, F.col("_key") == F.col("_group")).select(
        "_key", "_block", F.concat("_upper", "_last").alias("_upper"), F.col("_root").alias("subroot"), "root"), "merkle-all")
    return leaves.join(upper, ["_key", "_block"]).select(
        F.col("_id").alias(id), F.col("_node").alias("leaf"), F.concat("_sides", "_upper").alias("sides"), "subroot", "root",
        *[F.col(f"_carry{n}").alias(name) for n, name in enumerate(carry)])
