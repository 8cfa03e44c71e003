from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import neardup
from tests.llm import rows as R


def shingle_set(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(texts):
    """Smallest id reachable, by comparing everything."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    label = {i: i for i in texts}
    for a, b in combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 85 * len(x | y) and label[a] != label[b]:
            lo, hi = sorted((label[a], label[b]))
            label = {i: lo if v == hi else v for i, v in label.items()}
    return sets, label


def compare(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in neardup.link(df).collect()}
    sets, label = brute(texts)
    assert len(got) == len(texts)
    for i, r in got.items():
        assert r.n_shingles == len(sets[i])
        assert (r.component_id, r.kept) == (label[i], label[i] == i), i


def test_hard_rows_match_brute_force(spark):
    texts = {r[0]: r[1] for r in R.rows() if r[0] is not None}
    docs = R.table(spark)
    got = neardup.link(docs).collect()
    sets, label = brute(texts)
    assert len(got) == len(R.rows())
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), label[r.doc_id])


def test_chains_and_a_crowded_bucket(spark):
    """A chain whose ends are far apart, and a crowd around one text whose members link only through others."""
    base = R.prose(41, 300)
    texts, k = {}, 1000
    chain = base
    for step in range(12):
        chain = R.changed(R.changed(chain, 20 * step + 3), 20 * step + 9)
        texts[k] = chain
        k -= 1
    crowd = R.prose(42, 120)
    for i in range(40):
        t = crowd
        for j in range(1 + i % 3):
            t = R.changed(t, (37 * i + 41 * j) % 120)
        texts[2000 + 7 * i] = t
    compare(spark, texts)


def test_blocks_of_a_bucket_find_what_stars_leave(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    a, b = R.prose(51, 200), None
    b = a
    for j in range(0, 200, 9):
        b = R.changed(b, j)
    texts = {}
    for i in range(6):
        texts[10 + i] = R.changed(a, 40 + 11 * i)
        texts[30 + i] = R.changed(b, 40 + 11 * i)
    compare(spark, texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = neardup.features(df)
    classes = found.select("set_key", F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "signature")
    members = classes.select(F.lit(1).cast("long").alias("bucket"), "node", F.lit(12).cast("long").alias("n_nodes"))
    labels = spark.createDataFrame([(10, 10)], "node long, component long")
    links = {(r.a, r.b) for r in neardup.unsettled(members, labels, classes, df.select(F.col("doc_id").alias("id"), "text")).collect()}
    sets, label = brute(texts)
    assert all(100 * len(sets[x] & sets[y]) >= 85 * len(sets[x] | sets[y]) for x, y in links)
    joined = {i: i for i in texts}
    for x, y in links:
        lo, hi = sorted((joined[x], joined[y]))
        joined = {i: lo if v == hi else v for i, v in joined.items()}
    assert joined == label


def test_bayesian_bounds_keep_pairs_at_the_threshold():
    least = neardup.least_matches(0.85)
    assert list(least) == sorted(least) and least[-1] < 0.85 * neardup.HASHES
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**32, (2000, neardup.HASHES), np.int64).astype(np.uint32)
    b = np.where(rng.random(a.shape) < 0.85, a, a + np.uint32(1))
    assert len(neardup.surviving(a, b)) == len(a)
    far = np.where(rng.random(a.shape) < 0.4, a, a + np.uint32(1))
    assert len(neardup.surviving(a, far)) == 0


def test_keep_one_returns_whole_rows(spark):
    docs = R.table(spark)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    _, label = brute({r[0]: r[1] for r in R.rows() if r[0] is not None})
    assert {r.doc_id for r in kept.collect()} == {i for i, c in label.items() if i == c} | {None}


def test_empty_table(spark):
    assert neardup.link(R.table(spark).limit(0)).count() == 0


@pytest.mark.parametrize("text", [None, "", " \n"])
def test_no_words_no_shingles(text):
    assert len(neardup.shingles(text)) == 0
