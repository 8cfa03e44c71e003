"""Merkle manifest of a table: one tree a group over its sorted rows, one tree over the groups' roots, proofs of rows.

A leaf is the digest of a row's fields. While a group has several nodes, every `fanout` consecutive ones become their
digest (the last run may be shorter). The method, level by level, is a window of fixed offsets:

1. Leaves are written with their place in the group. Places come from a range-partitioned, sorted table: position in
   the partition plus the rows of the group in earlier partitions, so that no task sorts a whole group.
2. Rows are dealt by (group, chunk of fanout^levels consecutive places). Inside a chunk the node of level k stands at
   its first row. `lag` and `lead` by fixed offsets j * fanout^k give the other nodes of its run, masked by its slot
   in the run and by the run's length; rows of slot 0 (first children) hash the run into the parent.
3. A running `last` hands the siblings of each level to all rows below the node.
4. The chunks' roots are the rows of the next, much smaller round, until each group has one node; the groups' roots go
   through the same rounds as one group. Joins by chunk bring the upper siblings down to the rows.

A chunk is at most `fanout^levels` rows (4,096 by default), of a group of any size. Rounds follow the logarithm of the
largest group. Verification folds each row's leaf, as it is found now, with the siblings of the manifest.

Defined cases: nulls in any field count as `-`; a null group is a group of its own, ordered first; rows of equal place
in the order (repeated rows, repeated or null ids) are ordered by leaf, and equal rows are interchangeable; an empty
table gives no rows; a group of one row has its leaf as root; columns that are not fields are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import col, partitions, stored

FANOUT = 2
#: Levels that one round settles.
LEVELS = 12

_PART_BITS = 33  # monotonically_increasing_id() is the partition, shifted by this, plus the position in it


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the joined parts."""
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as `-` if null, else its UTF-8 byte count, `:` and the value."""

    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*(part(f) for f in fields))


def group_key(group: Column) -> Column:
    """A key that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with `at`, their place in `tree` by the order given, and `n`, the rows of the tree. Written."""
    tie = F.monotonically_increasing_id()
    ranged = rows.withColumn("__tie", tie).repartitionByRange(partitions(rows.sparkSession), "tree", *order, "__tie")
    ranged = ranged.sortWithinPartitions("tree", *order, "__tie").drop("__tie")
    # Numbered after the sort: the position in the partition.
    ranged = stored(ranged.withColumn("__row", F.monotonically_increasing_id()), "merkle-sorted")
    ranged = ranged.withColumn("__part", F.shiftright("__row", _PART_BITS))
    runs = ranged.groupBy("tree", "__part").agg(F.min("__row").alias("__first"), F.count("*").alias("__rows"))
    line = Window.partitionBy("tree").orderBy("__part")
    before = F.coalesce(F.sum("__rows").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(
        "tree", "__part", "__first", before.alias("__before"), F.sum("__rows").over(Window.partitionBy("tree")).alias("n")
    )
    return (
        ranged.join(runs, ["tree", "__part"])
        .withColumn("at", F.col("__before") + F.col("__row") - F.col("__first"))
        .drop("__row", "__part", "__first", "__before")
    )


def _round(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Nodes (tree, at, n, node, ..) with `chunk`, the chunk's `top` at its first row, and their `path` inside the chunk.

    A path is an array of (left, right), the joined siblings on both sides, from the lowest level up.
    """
    out = nodes.withColumn("chunk", F.floor(F.col("at") / fanout**levels).cast("long")).withColumn("__n0", F.col("node"))
    line = Window.partitionBy("tree", "chunk").orderBy("at")
    sides = []
    for k in range(levels):
        step = fanout**k
        here, up = F.col(f"__n{k}"), f"__n{k + 1}"
        at = F.floor(F.col("at") / step)
        count = F.ceil(F.col("n") / step)
        slot = F.when(F.col("at") % step == 0, at % fanout)  # null at rows that hold no node
        length = F.least(F.lit(fanout), count - at + slot)
        none = F.lit("")
        shifts = range(1, fanout)
        back = {j: F.lag(here, j * step).over(line) for j in shifts}
        ahead = {j: F.lead(here, j * step).over(line) for j in shifts}
        many = count > 1
        left = F.concat(*(F.when(slot >= j, back[j]).otherwise(none) for j in reversed(shifts)))
        right = F.concat(*(F.when(slot + j < length, ahead[j]).otherwise(none) for j in shifts))
        side = F.when(many & slot.isNotNull(), F.struct(left.alias("left"), right.alias("right")))
        parent = F.when(slot == 0, F.when(many, digest(here, right)).otherwise(here))
        out = out.withColumns({f"__s{k}": side, up: parent})
        sides.append(f"__s{k}")
    so_far = line.rowsBetween(Window.unboundedPreceding, 0)
    own = F.array(*(F.last(s, ignorenulls=True).over(so_far) for s in sides))
    out = out.withColumn("path", F.array_compact(own)).withColumn("top", F.col(f"__n{levels}"))
    return out.drop(*sides, *(f"__n{k}" for k in range(levels + 1)))


_NO_PATH = "array<struct<left:string,right:string>>"


def _bare(tops: DataFrame) -> DataFrame:
    """Trees of one node: the node is the root."""
    return tops.withColumns({"path": F.array().cast(_NO_PATH), "subroot": F.col("node"), "root": F.col("node")})


def _climb(nodes: DataFrame, fanout: int, levels: int, crown: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Nodes with `path`, `subroot` and `root`; `crown` tells these of the trees' last nodes."""
    done = _round(nodes, fanout, levels)
    size = fanout**levels
    largest = nodes.agg(F.max("n").alias("n")).first().n or 0
    tops = done.where(F.col("at") % size == 0)
    tops = tops.select("tree", F.col("chunk").alias("at"), F.ceil(F.col("n") / size).alias("n"), F.col("top").alias("node"))
    tops = stored(tops, "merkle-tops")
    above = _climb(tops, fanout, levels, crown) if largest > size else crown(tops)
    above = above.select("tree", F.col("at").alias("chunk"), F.col("path").alias("__above"), "subroot", "root")
    joined = done.drop("top").join(above, ["tree", "chunk"])
    return joined.withColumn("path", F.concat("path", "__above")).drop("__above", "chunk")


def fold(found: Column, path: Column) -> Column:
    """The root that follows from a node and the siblings of its path."""
    return F.aggregate(path, found, lambda node, s: digest(s["left"], node, s["right"]))


def proof(path: Column) -> Column:
    """All siblings, level by level, left to right, as one digest."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(leaves: DataFrame, order: Sequence[str], fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Leaves (tree, node, the order's columns, ..) with `subroot`, `root` and `path`, the siblings from leaf to root."""

    def crown(tops: DataFrame) -> DataFrame:
        trees = tops.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "node")
        above = _climb(placed(trees, ["group"]), fanout, levels, _bare)
        above = above.select(F.col("group").alias("tree"), "path", "root")
        return tops.withColumn("subroot", F.col("node")).join(above, "tree")

    return _climb(placed(leaves, [*order, "node"]), fanout, levels, crown).drop("at", "n")


def leaves_of(docs: DataFrame, fields: Sequence[str], group: str, keep: dict[str, Column]) -> DataFrame:
    """(tree, node) of each row, beside the columns of `keep`."""
    kept = [c.alias(name) for name, c in keep.items()]
    return docs.select(group_key(col(group)).alias("tree"), leaf([col(f) for f in fields]).alias("node"), *kept)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_proofs(docs: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """The manifest of a table of documents, and each row verified as the tampering of the contract leaves it.

    Rows whose id has a crc32 divisible by 7 are found with n_chars one larger.
    """
    touched = F.crc32(F.coalesce(col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 0
    n_chars = F.when(touched, col("n_chars") + 1).otherwise(col("n_chars"))
    found = leaf([n_chars if f == "n_chars" else col(f) for f in FIELDS])
    leaves = stored(leaves_of(docs, FIELDS, "lang", {"doc_id": col("doc_id"), "found": found}), "merkle-leaves")
    told = manifest(leaves, ["doc_id"], fanout, levels)
    folded = fold(F.col("found"), F.col("path"))
    return told.select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root", proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
