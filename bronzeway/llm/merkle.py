"""Merkle manifest of a dataset, with a proof for every row.

Rows are leaves of one binary tree per group; the groups' roots are leaves of one
more. Trees are hashed in blocks of consecutive leaves, ten levels at a time.
Proofs come by pointer jumping: a node holds the siblings on its way to an
ancestor, and a join of the nodes with themselves doubles the ancestor's distance
and joins the two segments, until every leaf is at the root.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeway.operators.ranking import with_position
from bronzeway.sources.tables import stored

#: Levels that are hashed in one round: a block has 2 ** LEVELS leaves.
LEVELS = 10
#: Ancestors of up to so many bytes, as counted, are sent to all tasks.
SENT_BYTES = 2 << 20
#: Bytes of a step of a proof: the side of the sibling, and its digest.
STEP = 33
LEFT, RIGHT, NONE = b"L", b"R", b"N"
#: The tree above the groups.
TOP = -1


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, one behind the other; NULL is left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def field_text(column: Column) -> Column:
    """A value for hashing: ``-`` for NULL, else its bytes in UTF-8, ``:`` and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    return digest(*(field_text(c) for c in columns))


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def _pairs(level: Column) -> Column:
    """Digests of every two consecutive ones; the last may be alone."""
    at = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int"))
    return F.transform(
        at, lambda i: F.unhex(digest(_hex(F.get(level, 2 * i)), _hex(F.get(level, 2 * i + 1))))
    )


def _levels(nodes: DataFrame) -> DataFrame:
    """(tree, depth, base, block, levels) from nodes (tree, depth, level, pos, digest).

    ``levels`` holds the block's digests of its own level and of up to LEVELS above.
    """
    held = F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "digest"))), lambda e: e["digest"]
    )
    blocks = (
        nodes.filter(F.col("level") < F.col("depth"))
        .groupBy("tree", "depth", F.col("level").alias("base"), F.shiftright("pos", LEVELS).alias("block"))
        .agg(held.alias("held"))
    )
    height = F.least(F.lit(LEVELS), F.col("depth") - F.col("base"))
    levels = F.aggregate(
        F.sequence(F.lit(1), height),
        F.array("held"),
        lambda built, _: F.concat(built, F.array(_pairs(F.element_at(built, -1)))),
    )
    return blocks.select("tree", "depth", "base", "block", levels.alias("levels"))


def _steps(blocks: DataFrame) -> DataFrame:
    """(tree, depth, level, pos, step): the sibling of every node below the top of its block."""

    def step(level):
        def one(_, i):
            sibling = F.when(i % 2 == 0, F.get(level, i + 1)).otherwise(F.get(level, i - 1))
            side = F.when(sibling.isNull(), F.lit(NONE)).when(i % 2 == 0, F.lit(RIGHT)).otherwise(F.lit(LEFT))
            return F.concat(side, F.coalesce(sibling, F.lit(b"\0" * 32)))

        return F.transform(level, one)

    below = F.slice("levels", 1, F.size("levels") - 1)
    by_level = blocks.select("tree", "depth", "base", "block", F.posexplode(below).alias("j", "nodes"))
    placed = by_level.select(
        "tree", "depth", "base", "block", "j", F.posexplode(step(F.col("nodes"))).alias("i", "step")
    )
    return placed.select(
        "tree",
        "depth",
        (F.col("base") + F.col("j")).alias("level"),
        (F.col("block") * F.expr(f"shiftleft(1L, {LEVELS} - j)") + F.col("i")).alias("pos"),
        "step",
    )


def _tops(blocks: DataFrame) -> DataFrame:
    """The highest node of each block, as a node of the next round."""
    return blocks.select(
        "tree",
        "depth",
        (F.col("base") + F.size("levels") - 1).alias("level"),
        F.col("block").alias("pos"),
        F.element_at(F.element_at("levels", -1), 1).alias("digest"),
    )


def _grow(leaves: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """(steps, roots) of all trees over ``leaves`` (tree, depth, level, pos, digest)."""
    steps, roots, nodes = None, leaves.filter("depth = 0"), leaves
    for _ in range(0, depth, LEVELS):
        blocks = stored(_levels(nodes), "levels")
        nodes = _tops(blocks)
        steps = _steps(blocks) if steps is None else steps.union(_steps(blocks))
        roots = roots.union(nodes.filter(F.col("level") == F.col("depth")))
    if steps is None:
        steps = leaves.filter(F.lit(False)).withColumn("step", F.col("digest")).drop("digest")
    return steps, roots.select("tree", "digest")


def _depth(count: Column) -> Column:
    """Levels above ``count`` leaves."""
    return F.when(count <= 1, 0).otherwise(F.length(F.bin(count - 1))).cast("int")


def _jumped(nodes: DataFrame, ancestors: DataFrame, small: bool) -> DataFrame:
    """Nodes that point to their ancestor's ancestor; those at the root stay.

    Each has a key and the key of its ancestor, ``up``, and the ``steps`` on the way.
    """
    far = ancestors.select(
        F.col("key").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2")
    )
    joined = nodes.join(F.broadcast(far) if small else far, "up", "left")
    return joined.withColumns(
        {
            "steps": F.when(F.col("steps2").isNull(), F.col("steps")).otherwise(F.concat("steps", "steps2")),
            "up": F.coalesce("up2", "up"),
        }
    ).drop("up2", "steps2")


def manifest(
    docs: DataFrame,
    leaf: Column,
    id: str = "doc_id",
    group: str = "lang",
    carry: Sequence[Column] = (),
) -> DataFrame:
    """One row per document: id, group, ``leaf``, ``subroot``, ``root``, ``proof``, and ``carry``.

    ``leaf`` is the hex digest of a row. In a group (NULL is one) leaves ascend by
    id, NULL first, then by leaf; while a level has several nodes, every two
    consecutive ones become the digest of both, a last one alone its own digest.
    The groups' roots, by group (NULL first, text by its bytes), go on likewise. A lone
    leaf is its group's ``subroot``; with one group that is the ``root``. ``proof``
    holds a step of 33 bytes for every level: the side of the sibling (``L``, ``R``,
    ``N`` for none) and its digest.

    Repeated rows are leaves of their own; which of two equal ones is first is open,
    and the rows of the result are the same either way. No rows give none. Texts may
    be of any length, as only the digest moves. Columns of ``docs`` that are not named
    are left out, so their names cannot clash with those of the result; ``carry``
    columns come last, and must have names of their own.
    """
    own = [f"_carry{i}" for i in range(len(carry))]
    rows = docs.select(
        F.col(id).alias("id"), F.col(group).alias("group"), F.unhex(leaf).alias("digest"),
        *(c.alias(n) for c, n in zip(carry, own)),
    )
    names = [id, group, "leaf", "subroot", "root", "proof", *(n for n, _ in _named(docs, carry))]
    by_group = F.asc_nulls_first("group")
    placed = with_position(
        stored(rows, "leaves"), [by_group, F.asc_nulls_first("id"), F.asc("digest")], "at"
    )
    trees = placed.groupBy("group").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    trees = stored(with_position(trees, [by_group], "tree"), "trees").select(
        F.col("group").alias("of"),
        "first",
        (F.col("tree") - 1).alias("tree"),
        _depth(F.col("n")).alias("depth"),
        "n",
    )
    total = trees.agg(F.count("*").alias("trees"), F.sum("n").alias("n"), F.max("depth").alias("depth")).first()
    over = max(total.trees - 1, 0).bit_length()
    leaves = stored(
        placed.join(trees, F.col("group").eqNullSafe(F.col("of"))).select(
            "id", "group", "tree", "depth", F.lit(0).alias("level"),
            (F.col("at") - F.col("first")).alias("pos"), "digest", *own,
        ),
        "placed",
    )
    nodes = leaves.select("tree", "depth", "level", "pos", "digest")
    steps, roots = _grow(nodes, total.depth or 0)
    roots = stored(roots, "roots")
    above = roots.select(
        F.lit(TOP).cast("bigint").alias("tree"), F.lit(over).alias("depth"), F.lit(0).alias("level"),
        F.col("tree").alias("pos"), "digest",
    )
    top_steps, top = _grow(above, over)
    root = top.select(F.concat_ws("", _hex(F.col("digest")))).first()

    place = F.struct("tree", "level", "pos")
    parent = F.struct("tree", (F.col("level") + 1).alias("level"), F.shiftright("pos", 1).alias("pos"))
    # A group's root is a leaf of the tree above: one key for both.
    groups = trees.select(F.col("tree").alias("of"), F.col("depth").alias("own"))
    seams = top_steps.filter("level = 0").join(groups, F.col("pos") == F.col("of"))
    pointed = (
        steps.select(place.alias("key"), parent.alias("up"), F.col("step").alias("steps"))
        .union(
            top_steps.filter("level > 0").select(place.alias("key"), parent.alias("up"), F.col("step").alias("steps"))
        )
        .union(
            seams.select(
                F.struct(F.col("of").alias("tree"), F.col("own").alias("level"), F.lit(0).cast("bigint").alias("pos")).alias("key"),
                parent.alias("up"),
                F.col("step").alias("steps"),
            )
        )
    )
    first = pointed.filter("key.level = 0").filter(F.col("key.tree") != TOP)
    held = leaves.withColumn("key", place).drop("tree", "depth", "level", "pos")
    held = held.join(first, "key", "left").withColumn("steps", F.coalesce("steps", F.lit(b"")))
    # At distance d only nodes from level d on are still an ancestor of a leaf.
    ancestors, reach = pointed.filter("key.level >= 1 OR key.tree = -1"), 1
    while reach < (total.depth or 0) + over:
        if reach > 1:
            ancestors = ancestors.filter(f"key.level >= {reach} OR key.tree = {TOP}")
        ancestors = stored(ancestors, "ancestors")
        # Nodes from level d on: no more than n / 2**(d-1), one a level of each tree, and the tree above.
        most = 2 * (total.n >> reach) + total.trees * (total.depth + 3)
        small = most * (STEP * reach + 64) <= SENT_BYTES
        held = _jumped(held, ancestors, small)
        ancestors = _jumped(ancestors, ancestors, small)
        reach *= 2
    subroots = trees.join(roots, "tree").select("of", _hex(F.col("digest")).alias("subroot"))
    return (
        held.join(subroots, F.col("group").eqNullSafe(F.col("of")))
        .select(
            "id", "group", _hex(F.col("digest")), "subroot",
            F.lit(root[0] if root else None).cast("string"), "steps", *own,
        )
        .toDF(*names)
    )


def _named(docs: DataFrame, columns: Sequence[Column]) -> list[tuple[str, str]]:
    return docs.select(*columns).dtypes if columns else []


def _side(proof: Column, i: Column) -> Column:
    return F.substring(proof, i * STEP + 1, F.lit(1))


def _sibling(proof: Column, i: Column) -> Column:
    return _hex(F.substring(proof, i * STEP + 2, F.lit(32)))


def _count(proof: Column) -> Column:
    """Numbers of the steps of a proof; an empty one has none."""
    n = (F.octet_length(proof) / STEP).cast("int")
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf (hex) gives with the siblings of a proof."""

    def up(below, i):
        side, sibling = _side(proof, i), _sibling(proof, i)
        return digest(
            F.when(side == F.lit(LEFT), sibling), below, F.when(side == F.lit(RIGHT), sibling)
        )

    return F.aggregate(_count(proof), leaf, up)


def proof_digest(proof: Column) -> Column:
    """Digest of the siblings of a proof, from the leaf to the root."""
    there = F.filter(_count(proof), lambda i: _side(proof, i) != F.lit(NONE))
    return F.sha2(F.array_join(F.transform(there, lambda i: _sibling(proof, i)), ""), 256)
