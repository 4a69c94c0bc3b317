"""Merkle manifest of a dataset: one root that vouches for every row, and a proof per row.

Rows are leaves of one tree per group, and the groups' roots those of one more tree. Two nodes in a row
become the hash of their hex digests put together; the last one of an odd level is hashed alone. An
aligned block of 256 nodes keeps each of its levels as one hex string: parents are hashes of substrings
of fixed width, and a sibling is the substring beside a node's own. The blocks' roots are the nodes of
the next round, until one is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.llm.ordering import numbered
from txnguard.session import materialise

#: Hex digits of a digest, and the levels that a block holds.
WIDTH, LEVELS = 64, 8
BLOCK = 1 << LEVELS


def leaf(*fields: Column) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its length in bytes, a colon and itself."""

    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def _levels(bottom: Column, depth: Column) -> Column:
    """The block's levels, from the bottom one on, each as one string."""

    def with_next(levels: Column, _: Column) -> Column:
        level = F.element_at(levels, -1)
        last = F.floor((F.octet_length(level) - 1) / (2 * WIDTH)).cast("int")
        parents = F.transform(
            F.sequence(F.lit(0), last), lambda i: F.sha2(F.substring(level, i * (2 * WIDTH) + 1, F.lit(2 * WIDTH)), 256)
        )
        return F.array_append(levels, F.array_join(parents, ""))

    return F.aggregate(F.array_repeat(F.lit(0), depth), F.array(bottom), with_next)


def _with_levels(blocks: DataFrame) -> DataFrame:
    """A tree with more than one block goes through all levels of each, even with one node in the last."""
    depth = F.expr(f"if(n > {BLOCK}, {LEVELS}, if(n > 1, length(bin(n - 1)), 0))").cast("int")
    bottom = F.array_join(F.transform("nodes", lambda x: x["hash"]), "")
    return blocks.withColumn("levels", _levels(bottom, depth))


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, n, pos, hash, of) by aligned block, in order; ``of`` is what a node is the hash of."""
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    member = F.sort_array(F.collect_list(F.struct("pos", "hash", "of")))
    return materialise(nodes.groupBy("tree", "n", block).agg(member.alias("nodes")))


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each round, and (tree, root)."""
    rounds = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        rounds.append(_blocks(nodes))
        roots = _with_levels(rounds[-1]).select("tree", "n", "block", F.element_at("levels", -1).alias("hash"))
        if most <= BLOCK:
            return rounds, roots.select("tree", F.col("hash").alias("root"))
        most = -(-most // BLOCK)
        n = F.ceil(F.col("n") / BLOCK).alias("n")
        nodes = materialise(roots.select("tree", n, F.col("block").alias("pos"), "hash", F.lit(None).cast("void").alias("of")))


def _descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """(tree, hash, of, path, <told>) of every node of the first round, given (tree, path, told) of each root.

    A path has a step per level up to the root: ``<`` or ``>`` for the side that the sibling is on, and
    the sibling, which is empty for a node hashed alone.
    """
    above = above.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        depth = F.size("levels") - 1
        steps = F.expr(
            f"""transform(
                transform(levels, (level, k) -> named_struct('level', level, 'i', shiftright(node.pos % {BLOCK}, k))),
                s -> concat(if(s.i % 2 = 1, '<', '>'), substring(s.level, {WIDTH} * CAST(s.i ^ 1 AS int) + 1, {WIDTH})))"""
        )
        whole = _with_levels(blocks).join(materialise(above), ["tree", "block"])
        inside = whole.select("tree", "levels", "path", "told", F.explode("nodes").alias("node"))
        path = F.concat(F.slice(steps, F.lit(1), depth), F.col("path"))
        nodes = inside.select("tree", "node.pos", "node.hash", "node.of", path.alias("path"), "told")
        above = nodes.select("tree", F.col("pos").alias("block"), "path", "told")
    return nodes.drop("pos")


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""

    def up(below: Column, step: Column) -> Column:
        sibling = F.substring(step, 2, WIDTH)
        pair = F.when(F.left(step, F.lit(1)) == "<", F.concat(sibling, below)).otherwise(F.concat(below, sibling))
        return F.sha2(pair, 256)

    return F.aggregate(path, node, up)


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: F.substring(step, 2, WIDTH)), ""), 256)


def build(leaves: DataFrame, group_col: str, order_col: str, leaf_col: str, carried: list[str]) -> DataFrame:
    """The manifest: per row ``row`` (struct of the ``carried`` columns), leaf, path, subroot (its group's
    root) and root.

    Leaves ascend by ``order_col`` (nulls first, ties by leaf) within a group; groups are ordered bytewise
    by name, null first, which is a group of its own. Repeated rows are leaves of their own. A group of
    one row has its leaf as root. An empty table gives no rows.
    """
    tree = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))
    rows = materialise(
        leaves.select(tree.alias("tree"), F.col(leaf_col).alias("hash"), F.col(order_col).alias("order"), F.struct(*carried).alias("of"))
    )
    rounds, subroots = _climb(numbered(rows, "tree", ["order", "hash"]))
    groups = materialise(subroots.select(F.lit("").alias("tree"), F.col("root").alias("hash"), F.col("tree").alias("of")))
    tops, root = _climb(numbered(groups, "tree", ["of"]))
    start = root.select("tree", F.array().cast("array<string>").alias("path"), F.struct("root").alias("told"))
    told = F.struct("told.root", F.col("hash").alias("subroot")).alias("told")
    above = _descend(tops, start).select(F.col("of").alias("tree"), "path", told)
    return _descend(rounds, above).select(F.col("of").alias("row"), F.col("hash").alias("leaf"), "path", "told.subroot", "told.root")
