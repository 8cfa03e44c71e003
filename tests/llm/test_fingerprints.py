import hashlib
import random

import pytest
from pyspark.sql import functions as F

from driftline.llm import fingerprints as S
from tests.llm import rows as R


def test_edited_texts_and_likeness(spark):
    rows = [(r[0], r[1] or "") for r in R.rows() if r[0] is not None]
    rows = sorted(set(rows), key=lambda r: (-r[0], r[1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in S.compare(docs).collect()}
    prints = {}
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[1][:half]
        r = got[i]
        assert (r.n_chars, r.next_id) == (len(t), following[0])
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.following == got[following[0]].own
        prints.setdefault(t, set()).add(r.own)
        if edited == t:
            assert r.own == r.changed
    assert all(len(x) == 1 for x in prints.values())
    assert prints[""] == {0}
    assert len(set.union(*prints.values())) > 20


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    got = S.compare(R.table(spark)).collect()
    assert len(got) == len(R.rows())
    assert sum(r.doc_id is None for r in got) == 1


def test_one_row_follows_itself(spark):
    (r,) = S.compare(spark.createDataFrame([(4, "a b c d")], "doc_id long, text string")).collect()
    assert r.next_id == 4 and r.own == r.following


def test_votes_match_a_plain_count(spark):
    text = R.prose(61, 50)
    words = list(dict.fromkeys(text.split()))
    hashes = [r.x for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w").alias("x")).collect()]
    total, want = sum(map(len, words)), 0
    for j in range(64):
        if 2 * sum(len(w) for w, x in zip(words, hashes) if (x >> j) & 1) > total:
            want |= 1 << j
    (r,) = S.fingerprints(spark.createDataFrame([(1, 5, text)], "doc_id long, h long, t string")).collect()
    assert r.f & (2**64 - 1) == want


@pytest.mark.parametrize("radius", [0, 2, 3])
def test_block_tables_find_the_whole_radius(spark, radius):
    x, prints = 12345, []
    for k in range(40):
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        prints += [x, x ^ (1 << k), x ^ (1 << k) ^ (1 << 63), x ^ (7 << k), x ^ (15 << k), x]
    prints = [p - 2**64 if p >> 63 else p for p in prints]
    rows = spark.createDataFrame(list(enumerate(prints)), "doc_id long, f long")
    got = {r.q: r.n_near for r in S.near_counts(rows, radius).collect()}
    want = {f: sum(bin((f ^ g) & (2**64 - 1)).count("1") <= radius for g in prints) - 1 for f in prints[::20]}
    assert got == want


def shingles(text):
    words = text.split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def test_recall_of_near_copies_and_their_partners(spark):
    """Texts of 80 to 400 words with so many words replaced that 5-shingle similarity lies between 0.8 and 1."""
    draw, docs, alike = random.Random(5), [], {}
    for k in range(300):
        words = R.prose(3000 + k, 80 + 8 * (k % 40)).split()
        other = list(words)
        for at in draw.sample(range(len(words)), max(1, round(len(words) * draw.uniform(0.008, 0.022)))):
            other[at] = draw.choice(R.prose(draw.randrange(9000), 30).split())
        a, b = shingles(" ".join(words)), shingles(" ".join(other))
        docs += [(20 * k, " ".join(words)), (20 * k + 1, " ".join(other))]
        alike[20 * k] = len(a & b) / len(a | b)
    rows = spark.createDataFrame(docs, "doc_id long, t string").selectExpr("doc_id", "doc_id AS h", "t")
    prints = S.fingerprints(rows).select("doc_id", "f")
    of = {r.doc_id: r.f for r in prints.collect()}
    got = {r.q: r for r in S.near_counts(prints).collect()}
    caught = {}
    for i, likeness in alike.items():
        r = got[of[i]]
        distance = bin((of[i] ^ of[i + 1]) & (2**64 - 1)).count("1")
        assert r.copy_id == i and (r.n_near >= 1) >= (distance <= S.RADIUS)
        caught[i] = of[i] == of[i + 1] or r.near_id == i + 1
    high = [caught[i] for i, x in alike.items() if 0.85 <= x < 1]
    low = [caught[i] for i, x in alike.items() if 0.8 <= x < 0.85]
    print("recall", len(high), sum(high) / len(high), len(low), sum(low) / len(low))
    assert len(high) > 100 and sum(high) >= 0.9 * len(high)
    assert len(low) > 30 and sum(low) >= 0.75 * len(low)


def test_answers_return_to_the_rows_that_ask(spark):
    """A fingerprint in a third of all rows, null ids, and rows that do not ask."""
    rows = [(k, 7 if k % 3 == 0 else k * 0x9E3779B97F4A7C15 % 2**63) for k in range(600)] + [(None, 7)]
    told = spark.createDataFrame(rows, "doc_id long, own long")
    got = S.with_near(told).collect()
    assert sorted((r.doc_id or -1, r.own) for r in got) == sorted((i or -1, f) for i, f in rows)
    for r in got:
        if r.doc_id is None or r.doc_id % 20:
            assert r.n_near is None and r.copy_id is None
        else:
            want = sum(bin(f ^ r.own).count("1") <= S.RADIUS for _, f in rows) - 1
            assert (r.n_near, r.copy_id) == (want, min(i for i, f in rows if f == r.own and i is not None))


def test_empty_table(spark):
    assert S.compare(R.table(spark).limit(0)).count() == 0


def test_block_tables_are_not_broadcast(spark):
    """Spark takes a table after an explode for as small as before, so its own choice may pass all of it through the driver."""
    rows = spark.range(60).selectExpr("id AS doc_id", "xxhash64(id div 2) AS f")
    found = S.near_counts(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {r.q: r.n_near for r in found.collect()} == {r.f: 1 for r in rows.where("doc_id % 20 = 0").collect()}
