import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from driftline.llm import merkle
from tests.llm import rows as R

FIELDS = merkle.FIELDS


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes, fanout):
    """Levels of a tree, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[i : i + fanout]) for i in range(0, len(low), fanout)])
    return levels


def path(levels, i, fanout):
    """(left, right) siblings of the i-th leaf, level by level."""
    out = []
    for nodes in levels[:-1]:
        a = i - i % fanout
        run = nodes[a : a + fanout]
        out.append(("".join(run[: i - a]), "".join(run[i - a + 1 :])))
        i //= fanout
    return out


def brute(rows, fanout=2):
    """{(doc_id, leaf): (subroot, root, proof, folded, verified)} of rows in the order of FIELDS."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[g] = plain_tree([plain_leaf(r) for r in groups[g]], fanout)
    top = plain_tree([trees[g][-1][0] for g in order], fanout)
    out = []
    for k, g in enumerate(order):
        for i, row in enumerate(groups[g]):
            steps = path(trees[g], i, fanout) + path(top, k, fanout)
            touched = zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 7 == 0
            found = list(row)
            if touched and row[3] is not None:
                found[3] += 1
            node = plain_leaf(found)
            for left, right in steps:
                node = h(left, node, right)
            root = top[-1][0]
            proof = h(*(a + b for a, b in steps))
            out.append((row[0], plain_leaf(row), trees[g][-1][0], root, proof, node, node == root))
    return out


def key(v):
    return tuple((x is not None, x) for x in v)


def check(docs, fanout=2, levels=merkle.LEVELS):
    rows = [tuple(r[f] for f in FIELDS) for r in docs.collect()]
    got = [tuple(r) for r in merkle.document_proofs(docs, fanout, levels).collect()]
    assert sorted(got, key=key) == sorted(brute(rows, fanout), key=key)
    return got


def numbered(spark, n, langs=3):
    return spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("text "), F.col("id")).alias("text"),
        F.when(F.col("id") % 3 == 0, "en").when(F.col("id") % langs > 0, F.concat(F.lit("l"), F.col("id") % langs)).alias("lang"),
        F.lit("s").alias("source"),
        F.when(F.col("id") % 11 > 0, F.col("id") * 3).alias("n_chars"),
    )


def test_hard_rows(spark):
    got = check(R.table(spark))
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n,fanout,levels", [(1, 2, 12), (2, 2, 12), (3, 2, 1), (130, 2, 3), (97, 3, 2), (65, 4, 1), (200, 2, 12)])
def test_every_size_and_fanout(spark, n, fanout, levels):
    check(numbered(spark, n).repartition(3), fanout, levels)


def test_many_groups_and_one_group(spark):
    check(numbered(spark, 90, langs=40), 2, 2)
    check(numbered(spark, 70).withColumn("lang", F.lit(None).cast("string")), 2, 4)


def test_repeated_rows_and_ids(spark):
    docs = numbered(spark, 20)
    check(docs.unionByName(docs).unionByName(docs.withColumn("text", F.lit("other"))), 2, 2)


def test_empty_table(spark):
    assert merkle.document_proofs(numbered(spark, 0)).count() == 0


def test_any_change_of_a_field_is_found(spark):
    docs = numbered(spark, 40)
    fields = ["doc_id", "text", "n_chars"]
    leaves = merkle.leaves_of(docs, fields, "lang", {"doc_id": F.col("doc_id")})
    told = merkle.manifest(leaves, ["doc_id"]).select("doc_id", "path", "root")
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 5, "TEXT").otherwise(F.col("text")))
    now = changed.select("doc_id", merkle.leaf([F.col(f) for f in fields]).alias("now")).join(told, "doc_id")
    bad = now.where(merkle.fold(F.col("now"), F.col("path")) != F.col("root")).collect()
    assert [r.doc_id for r in bad] == [5]
