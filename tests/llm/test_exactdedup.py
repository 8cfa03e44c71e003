import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from driftline.llm import exactdedup
from tests.llm import rows as R


def brute(rows):
    """Per row (id, text): the id that stays, the size of its class, its digest; and the classes."""
    classes = defaultdict(list)
    for i, text in rows:
        classes[re.sub(r"[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), i is None, i))
    out = []
    for i, text in rows:
        normal = re.sub(r"[\x20\x09-\x0d]", "", text or "")
        best = min(classes[normal], key=lambda k: (k[0], k[1], k[2] or 0))
        out.append((i, best[2], len(classes[normal]), hashlib.sha256(normal.encode()).hexdigest()))
    return out, classes


def plain(df, text="text"):
    return [(r.doc_id, r[text]) for r in df.collect()]


def by_text(key):
    return lambda v: tuple((x is None, x) for x in v)


@pytest.mark.parametrize(
    "key",
    [exactdedup.content_hash, lambda t: (F.length(t) % 3).cast("string").cast("binary"), lambda t: F.lit(b"same")],
    ids=["hash", "three hashes", "one hash"],
)
def test_hard_rows_equal_brute_force_under_any_hash(spark, key):
    docs = R.table(spark)
    want, classes = brute(plain(docs))
    got = exactdedup.dedup(docs, key=key).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=by_text(0)) == sorted(want, key=by_text(0))
    assert sum(r.kept for r in got) == len(classes)
    assert all(r.id == r.keep_id for r in got if r.kept)


def test_exactly_one_row_of_repeated_rows_stays(spark):
    rows = [(1, "a b", "x")] * 4 + [(2, "ab", "y")] * 3 + [(None, " ab  ", "z"), (None, None, "z"), (7, "\t", "w"), (3, "c", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `row` string").repartition(3)
    kept = exactdedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=by_text(0)) == [(3, "c"), (7, "\t"), (None, " ab  ")]


def test_keep_one_leaves_other_columns_as_they_came(spark):
    docs = R.table(spark)
    _, classes = brute(plain(docs))
    kept = exactdedup.keep_one(docs)
    assert kept.schema == docs.schema and kept.count() == len(classes)
    assert exactdedup.keep_one(docs.limit(0)).count() == 0


def test_a_hot_group_is_salted(spark, monkeypatch):
    monkeypatch.setattr(exactdedup, "SALT_ROWS", 7)
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy of all").otherwise(F.concat(F.lit("t"), F.col("id") % 150)).alias("text")
    )
    want, _ = brute(plain(docs))
    got = [(r.id, r.keep_id, r.group_size, r.text_sha256) for r in exactdedup.dedup(docs).collect()]
    assert sorted(got) == sorted(want)


def test_text_ids_and_empty_table(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x\ny"), ("c", "xy")], "name string, body string")
    got = {r.id: (r.keep_id, r.kept) for r in exactdedup.dedup(docs, "name", "body").collect()}
    assert got == {"a": ("a", True), "b": ("a", False), "c": ("a", False)}
    assert exactdedup.dedup(docs.limit(0), "name", "body").count() == 0
