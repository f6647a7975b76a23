"""Merkle manifest of a dataset, by slot pivots.

Nodes of a tree are numbered in order. Conditional aggregates spread the nodes
below each node over columns, one per slot. Concatenating the columns of siblings
and hashing gives their parent; leaving out the own column gives a node's siblings.
One pivot covers several levels, so a tree of n leaves takes log n / LEVELS rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repopulse.llm.sweep import in_order
from repopulse.session import staged

#: Levels that one pivot covers where a parent has two children.
LEVELS = 4


def hashed(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the parts, put together."""
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(*fields: Column) -> Column:
    """Hash of a row's fields, each as its length in octets, a colon and its value, or `-` for null."""

    def token(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return hashed(*map(token, fields))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings on a path, level by level, left to right."""
    return hashed(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, leaf, lambda node, x: hashed(x["left"], node, x["right"]))


def _placed(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """Nodes (tree, key, hash, row) as (tree, place, n, hash, row), numbered from 0 in each tree.

    The order is that of key, null first, then hash. Each range of the global order
    numbers its own nodes; those before it are added from one count per range and
    tree. `n` is the number of nodes of the tree.
    """
    ordered = in_order(spark, nodes, "tree", "key", "hash")
    counts = ordered.groupBy("part", "tree").agg(F.count("*").alias("here"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "part",
        "tree",
        F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"),
        F.sum("here").over(tree).alias("n"),
    )
    own = Window.partitionBy("part", "tree").orderBy("key", "hash", "row_id")
    numbered = ordered.withColumn("at", F.row_number().over(own) - 1)
    place = F.col("at") + F.col("before")
    return numbered.join(starts, ["part", "tree"]).select(
        "tree", place.alias("place"), "n", "hash", "row"
    )


def _pivoted(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """One row per block of fanout ** levels nodes that share an ancestor that many levels up.

    Columns `s<slot>` hold the block's nodes, and `h<level>_<i>` the i-th hash of
    each level above them. A tree that is down to one node keeps it as it is.
    """
    width = fanout**levels
    slot = F.col("place") % width
    node = F.struct("hash", "row")
    blocks = nodes.groupBy("tree", F.floor(F.col("place") / width).alias("block")).agg(
        F.max("n").alias("n"),
        *(F.first(F.when(slot == i, node), ignorenulls=True).alias(f"s{i}") for i in range(width)),
    )
    blocks = blocks.withColumns({f"h0_{i}": F.col(f"s{i}.hash") for i in range(width)})
    for level in range(1, levels + 1):
        above = {}
        for i in range(fanout ** (levels - level)):
            kids = [F.col(f"h{level - 1}_{i * fanout + k}") for k in range(fanout)]
            joined = hashed(*(F.coalesce(kid, F.lit("")) for kid in kids))
            parent = F.when(kids[0].isNotNull(), joined)
            above[f"h{level}_{i}"] = F.when(_has(level, fanout), parent).otherwise(kids[0])
        blocks = blocks.withColumns(above)
    return blocks


def _has(level: int, fanout: int) -> Column:
    """Whether a tree of n nodes has that many levels above them."""
    return F.col("n") > fanout ** (level - 1)


def _steps(slot: int, fanout: int, levels: int) -> Column:
    """The siblings of one slot and of its ancestors inside a block, from below."""
    steps = []
    for level in range(1, levels + 1):
        at = slot // fanout ** (level - 1)
        run, own = at // fanout * fanout, at % fanout
        text = lambda k: F.coalesce(F.col(f"h{level - 1}_{run + k}"), F.lit(""))  # noqa: E731, B023
        left = F.concat(F.lit(""), *(text(k) for k in range(own)))
        right = F.concat(F.lit(""), *(text(k) for k in range(own + 1, fanout)))
        step = F.struct(left.alias("left"), right.alias("right"))
        steps.append(F.when(_has(level, fanout), step))
    return F.array_compact(F.array(*steps))


def _climb(spark: SparkSession, nodes: DataFrame, fanout: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The pivots of every round, and the roots (tree, hash) that the last one ends with.

    The driver sees the size of the largest tree.
    """
    rounds, most = [], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1 or not rounds:
        blocks = staged(spark, _pivoted(nodes, fanout, levels), "blocks")
        rounds.append(blocks)
        most = -(-most // fanout**levels)
        nodes = blocks.select(
            "tree",
            F.col("block").alias("place"),
            F.ceil(F.col("n") / fanout**levels).alias("n"),
            F.col(f"h{levels}_0").alias("hash"),
            F.lit(None).cast("string").alias("row"),
        )
    return rounds, nodes.select("tree", "hash")


def _descend(blocks: DataFrame, paths: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(tree, place, hash, row, path, *others) of a round's nodes, given those of the blocks above them.

    Blocks are joined, not nodes, and spread over rows only after that.
    """
    others = [c for c in paths.columns if c not in ("tree", "place", "hash", "row", "path")]
    above = paths.select("tree", F.col("place").alias("block"), "path", *others)
    slots = [
        F.when(
            F.col(f"s{i}").isNotNull(),
            F.struct(
                F.lit(i).alias("slot"),
                F.col(f"s{i}").alias("node"),
                F.concat(_steps(i, fanout, levels), "path").alias("path"),
            ),
        )
        for i in range(fanout**levels)
    ]
    spread = blocks.join(above, ["tree", "block"]).select(
        "tree", "block", *others, F.explode(F.array_compact(F.array(*slots))).alias("slot")
    )
    place = F.col("block") * fanout**levels + F.col("slot.slot")
    return spread.select(
        "tree", place.alias("place"), "slot.node.hash", "slot.node.row", "slot.path", *others
    )


def manifest(
    spark: SparkSession,
    rows: DataFrame,
    leaf: Column,
    group: str = "lang",
    key: str = "doc_id",
    carry: list[str] | None = None,
    fanout: int = 2,
) -> DataFrame:
    """(row, leaf, subroot, root, path) of every row; `carry` names the columns of the struct `row`.

    Rows of a group are leaves in the order of `key`, null first, then of their
    hashes. Every `fanout` consecutive nodes become the hash of them put together,
    the last run from as many as there are, until one is left: the group's subroot,
    a lone leaf itself. Groups, null first, then by their octets, make the root in
    the same way. `path` lists (left, right) per level, the siblings before and
    after the node, from the leaf through the subroot to the root.

    Null fields are what `leaf` makes of them. Repeated rows are leaves of their
    own, next to each other. Texts of any length count whole and are read once. An
    empty table has no rows and no root. Columns may have any name.

    A hash is 64 characters and nothing else of a row but `carry` is shuffled. No
    group has more than fanout ** LEVELS rows, whatever the groups' sizes.
    """
    kept = rows.columns if carry is None else carry
    levels = max(1, LEVELS // max(1, (fanout - 1).bit_length()))
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    leaves = rows.select(
        tree.alias("tree"),
        F.col(f"`{key}`").alias("key"),
        leaf.alias("hash"),
        F.struct(*(rows[f"`{c}`"] for c in kept)).alias("row"),
    )
    rounds, subroots = _climb(spark, _placed(spark, leaves), fanout, levels)
    subroots = staged(spark, subroots, "subroots")
    tops = subroots.select(
        F.lit("").alias("tree"), F.col("tree").alias("key"), "hash", F.struct("tree", "hash").alias("row")
    )
    top_rounds, roots = _climb(spark, _placed(spark, tops), fanout, levels)
    paths = roots.select(
        "tree",
        F.lit(0).cast("long").alias("place"),
        F.array().cast("array<struct<left:string,right:string>>").alias("path"),
        F.col("hash").alias("root"),
    )
    for blocks in reversed(top_rounds):
        paths = _descend(blocks, paths, fanout, levels)
    paths = staged(
        spark,
        paths.select(
            F.col("row.tree").alias("tree"),
            F.lit(0).cast("long").alias("place"),
            "path",
            F.col("row.hash").alias("subroot"),
            "root",
        ),
        "paths",
    )
    for blocks in reversed(rounds):
        paths = _descend(blocks, paths, fanout, levels)
    return paths.select("row", F.col("hash").alias("leaf"), "subroot", "root", "path")


def verified(found: DataFrame, leaf: Column) -> Column:
    """Whether `leaf` is the one that the manifest's root was made from."""
    return folded(leaf, found["path"]) == found["root"]
