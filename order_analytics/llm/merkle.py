"""Merkle manifest of a table: a tree of digests for each group, and one over the groups' roots.

H is the lowercase hexadecimal SHA-256 of its inputs joined, digests taken as their hexadecimal text. A leaf is H of a row's
fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value. The leaves of a group stand in the
order of their id; while several nodes remain, every ``FAN`` consecutive ones, the last run maybe fewer, become
their H. What remains is the group's subroot; the subroots, in the order of their group (null first, then by UTF-8 bytes), give
the root in the same way.

Levels are strings: a block is ``BLOCK`` consecutive nodes of a tree, aligned, so that its inner levels depend on itself
alone. It keeps each level as one string of 64 digits a node. Fixed-width substrings of a level hash to the level above, and the digits
on both sides of a node within its run are the segments of its sibling path. The blocks' tops are the nodes of the next round,
which has 1/``BLOCK`` of the rows, until each tree is one block. Segments then go down again, round by round, to the leaves.

No group is ever one task's: places come from a sort of all rows over range partitions and from the number of rows of a group in each partition.

A null or repeated id: null comes first, rows of one id stand by their leaf; each row is a leaf, and all are returned. Equal
rows are equal leaves beside each other, which of them stands first makes no difference. Empty texts differ from null ones. A group of
one row has its leaf as subroot; a table of one group has its subroot as root. An empty table gives no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from order_analytics.operators import staging

FAN = 8
#: Levels of one block; it has FAN ** LEVELS nodes, 32 kB of digits in its lowest level.
LEVELS = 3
BLOCK = FAN**LEVELS
DIGITS = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: monotonically_increasing_id keeps the partition above this bit and the row's place in it below.
PLACE_BITS = 33


def leaf(values: Sequence[Column]) -> Column:
    """H of the fields of one row."""
    texts = [value.cast("string") for value in values]
    sized = [F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts]
    return F.sha2(F.concat(*sized), 256)


def _placed(rows: DataFrame, order: Sequence[str], label: str) -> tuple[DataFrame, str]:
    """The rows with ``place``, their number within their ``tree`` from 0 in the given order, and the path to drop later."""
    sorted_rows = rows.orderBy("tree", *order).withColumn("stamp", F.monotonically_increasing_id())
    stamped, path = staging.write_table(sorted_rows, label)
    part = F.shiftright("stamp", PLACE_BITS)
    runs = stamped.groupBy("tree", part.alias("part")).agg(F.min("stamp").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("ahead", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    numbered = stamped.withColumn("part", part).join(runs, ["tree", "part"])
    return numbered.withColumn("place", F.col("stamp") - F.col("first") + F.col("ahead")).drop("part", "first", "ahead", "stamp"), path


def _digits(level: Column, first: Column | int, count: Column | int) -> Column:
    """So many nodes of a level, from a place on; fewer at its end."""
    return F.substring(level, (F.lit(first) if isinstance(first, int) else first) * DIGITS + 1, (F.lit(count) if isinstance(count, int) else count) * DIGITS)


def _parents(level: Column) -> Column:
    """The level above, from fixed-width runs of digits."""
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / (FAN * DIGITS)).cast("int") - 1)
    hashed = F.transform(runs, lambda run: F.sha2(_digits(level, run * FAN, FAN), 256))
    return F.encode(F.array_join(hashed, ""), "US-ASCII")


def _blocks(nodes: DataFrame, carried: Sequence[str], label: str) -> tuple[DataFrame, str]:
    """(tree, block, members, level_0 ..., alone): the aligned blocks of ``nodes(tree, place, node, *carried)``.

    Levels are binary, so that a substring is a slice. Levels above the top of a tree's only block are null.
    """
    member = F.struct("place", "node", *carried)
    held = nodes.groupBy("tree", F.expr(f"place div {BLOCK}").alias("block")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    last = nodes.groupBy("tree").agg((F.max("place") < BLOCK).alias("alone"))
    held = held.join(last, "tree")
    held = held.withColumn("level_0", F.encode(F.array_join(F.col("members.node"), ""), "US-ASCII"))
    for level in range(1, LEVELS + 1):
        below = F.col(f"level_{level - 1}")
        # a tree's only block ends at its top; one of several always has all levels, runs of one node included
        held = held.withColumn(f"level_{level}", F.when(~F.col("alone") | (F.length(below) > DIGITS), _parents(below)))
    return staging.write_table(held, label)


def _top() -> Column:
    return F.decode(F.coalesce(*[F.col(f"level_{level}") for level in range(LEVELS, -1, -1)]), "US-ASCII")


def _segments(inside: Column) -> Column:
    """The digits on both sides of a node, a pair for each level of its block below the top."""
    steps = []
    for level in range(LEVELS):
        digits, place = F.col(f"level_{level}"), (inside / FAN**level).cast("int")
        within = place % FAN
        left, right = _digits(digits, place - within, within), _digits(digits, place + 1, FAN - 1 - within)
        steps.append(F.struct(left.alias("left"), right.alias("right")))
    depth = sum((F.col(f"level_{level}").isNotNull().cast("int") for level in range(1, LEVELS + 1)), F.lit(0))
    return F.slice(F.array(*steps), 1, depth)


def _climb(nodes: DataFrame, carried: Sequence[str], label: str) -> tuple[DataFrame, DataFrame]:
    """(tree, root) of each tree, and the nodes with ``carried`` and their ``path`` to the root."""
    rounds, roots = [], []
    while True:
        blocks, _ = _blocks(nodes, carried if not rounds else (), f"{label}-{len(rounds)}")
        rounds.append(blocks)
        roots.append(blocks.filter("alone").select("tree", _top().alias("root")))
        several = blocks.filter("not alone")
        if not several.limit(1).count():
            break
        nodes = several.select("tree", F.col("block").alias("place"), _top().alias("node"))
    path = F.expr("cast(array() as array<struct<left: binary, right: binary>>)")
    above = None
    for blocks in reversed(rounds):
        if above is None:
            blocks = blocks.withColumn("above", path)
        else:
            tails = above.select("tree", F.col("place").alias("block"), F.col("path").alias("above"))
            blocks = blocks.join(tails, ["tree", "block"], "left").withColumn("above", F.coalesce("above", path))
        kept = blocks.schema["members"].dataType.elementType.names
        within = F.transform("members", lambda member, inside: F.struct(*[member[name].alias(name) for name in kept], _segments(inside).alias("inner")))  # noqa: B023
        opened = blocks.select("tree", "above", F.inline(within))
        above = opened.select("tree", *kept, F.concat("inner", "above").alias("path"))
    return functools.reduce(DataFrame.union, roots), above


def _siblings(path: Column) -> Column:
    """All sibling digits from the leaf up, each level from left to right."""
    return F.concat(F.lit("").cast("binary"), F.array_join(F.transform(path, lambda step: F.decode(F.concat(step["left"], step["right"]), "US-ASCII")), "").cast("binary"))


def _folded(start: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of its path."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["left"], node.cast("binary"), step["right"]), 256))


def manifest(
    rows: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang", claimed: Column | None = None
) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``proof_sha256`` is H of the row's sibling path. ``folded_root`` is what the ``claimed`` leaf, an expression on the row, null
    for the row's own, gives with that path, and ``verified`` whether it is the root.
    """
    spark = rows.sparkSession
    own = leaf([F.col(name) for name in fields])
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    claim = F.lit(None).cast("string") if claimed is None else claimed
    leaves = rows.select(tree.alias("tree"), F.col(key).alias("id"), own.alias("node"), claim.alias("claim"))
    leaves, leaf_folder = staging.write_table(leaves, "leaves")  # texts are read once, the sort reads digests
    leaves, sorted_folder = _placed(leaves, ["id", "node"], "sorted-leaves")
    subroots, members = _climb(leaves, ["id", "claim"], "leaf-blocks")
    subroots, subroot_folder = staging.write_table(subroots.withColumnRenamed("root", "subroot"), "subroots")
    for folder in (leaf_folder, sorted_folder):
        staging.drop_table(spark, folder)

    groups = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("subroot").alias("node"))
    placed, group_folder = _placed(groups, ["group"], "groups")
    top, paths = _climb(placed, ["group"], "group-blocks")
    staging.drop_table(spark, group_folder)
    crowns = paths.join(top, "tree").select(F.col("group").alias("tree"), F.col("node").alias("subroot"), "root", F.col("path").alias("crown"))

    path = F.concat("path", "crown")
    proved = members.join(crowns, "tree").select(
        F.col("id").alias(key),
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        F.sha2(_siblings(path), 256).alias("proof_sha256"),
        _folded(F.coalesce("claim", "node"), path).alias("folded_root"),
    )
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))
