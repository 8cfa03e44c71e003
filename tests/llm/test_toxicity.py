import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import toxicity
from tests.llm import rows as R


def corpus(n=400):
    """Texts of which every fifth holds an insult; labels for all."""
    docs = [(i, R.prose(i, 40) + (" you blorftag " if i % 5 == 0 else " you kind ") + R.prose(i + 1000, 20)) for i in range(n)]
    return docs, [(i, int(i % 5 == 0)) for i in range(n)]


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = corpus()
    return toxicity.train(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    )


def test_held_out_rows_are_told_apart(spark, model):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = toxicity.score(df, model).select("row.doc_id", "toxicity.*", toxicity.held_out(F.col("row.doc_id")).alias("held"))
    wrong = [r for r in rows.collect() if r.held and r.predicted != dict(labels)[r.doc_id]]
    assert not wrong


def test_training_is_bounded_and_never_sees_held_out_rows(spark):
    docs, labels = corpus(100)
    text = spark.createDataFrame([*docs, (None, "x"), (3, "again")], "doc_id long, text string")
    known = spark.createDataFrame([*labels, (7, None), (8, 5), (None, 1)], "id long, y int")
    few = toxicity.training_rows(text, known, "doc_id", "text", 30, 10**9).collect()
    assert 28 <= len(few) <= 31
    chars = toxicity.training_rows(text, known, "doc_id", "text", 1000, 4000).collect()
    assert 0 < sum(len(r.text) for r in chars) <= 4000
    held = {r.i for r in spark.range(100).select(F.col("id").alias("i"), toxicity.held_out(F.col("id")).alias("h")).where("h").collect()}
    everything = toxicity.training_rows(text, known, "doc_id", "text", 1000, 10**9).collect()
    assert not held & {r.id for r in everything}


def test_hard_rows_score_and_come_whole(spark, model):
    docs = R.table(spark)
    rows = toxicity.score(docs, model).select("row.text", "toxicity.*").collect()
    assert len(rows) == len(R.rows())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in rows)


@pytest.mark.parametrize("labels", [[], [(1, 1), (3, 1)], [(1, 0)], [(1, 7), (None, 1)]])
def test_nothing_learnt_rejects_nothing(spark, labels):
    docs = spark.createDataFrame([(1, "a"), (3, "b"), (5, None), (6, "")], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    rows = toxicity.score(docs, model).select("toxicity.*").collect()
    assert len(rows) == 4 and all(r.predicted == 0 and r.score == pytest.approx(toxicity.UNTAUGHT) for r in rows)
    assert toxicity.keep_clean(docs, model).count() == 4
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_a_long_text_does_not_displace_the_sample(spark):
    docs, labels = corpus(200)
    held = {r.i for r in spark.range(200).select(F.col("id").alias("i"), toxicity.held_out(F.col("id")).alias("h")).where("h").collect()}
    turns = {r.id: r.t for r in spark.range(200).select("id", F.xxhash64("id").alias("t")).collect()}
    first = min((i for i in turns if i not in held), key=turns.get)
    long = [(i, t + " word" * 20_000 if i == first else t) for i, t in docs]
    size = sum(len(t) for _, t in docs)
    df, known = spark.createDataFrame(long, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    sample = toxicity.training_rows(df, known.selectExpr("doc_id id", "toxic y"), "doc_id", "text", 1000, size).collect()
    assert len(sample) >= 200 - len(held) - 1
    only = toxicity.training_rows(df, known.selectExpr("doc_id id", "toxic y"), "doc_id", "text", 1000, 10).collect()
    assert sorted(r.y for r in only) == [0, 1]
    model = toxicity.train(df, known, train_chars=size)
    wrong = [r for r in toxicity.score(df, model).select("row.doc_id", "toxicity.*").collect() if r.doc_id in held and r.predicted != dict(labels)[r.doc_id]]
    assert not wrong


def plain_features(text):
    """Hashed byte n-grams of the lower-cased text between blanks, one at a time, in whole numbers."""
    words = text.lower().split()
    data, found = (" " + " ".join(words) + " ").encode(), set()
    if not words:
        return found
    for n in toxicity.NGRAMS:
        for i in range(len(data) - n + 1):
            x = 0
            for byte in data[i : i + n]:
                x = (x * 16777619 + byte) % 2**32
            x = (x ^ (n * 2654435761 % 2**32)) * 2246822519 % 2**32
            x = (x ^ (x >> 15)) * 3266489917 % 2**32
            found.add(x >> (32 - toxicity.BITS))
    return found


@pytest.mark.parametrize("text", ["", " ", "a", "ab", "You BLORFTAG you", "日本 É\tx  y", "aaaa aaaa aaaa", R.prose(1, 60)])
def test_features_equal_a_plain_version(text):
    assert set(toxicity.Features().of(text).tolist()) == plain_features(text)


def test_fit_equals_a_plain_version():
    docs, labels = corpus(60)
    texts, y = [t for _, t in docs], np.array([v for _, v in labels])
    number, weight, bias = toxicity.fit(texts, y)
    sets = [plain_features(t) for t in texts]
    counts = {f: [sum(f in s for s, v in zip(sets, y, strict=True) if v == c) for c in (0, 1)] for f in set().union(*sets)}
    n1 = int(y.sum())
    ratio = {f: np.log((p + 1) / (n1 + 2)) - np.log((q + 1) / (len(y) - n1 + 2)) for f, (q, p) in counts.items()}
    used = sorted(f for f, c in counts.items() if sum(c) >= toxicity.LEAST_ROWS and abs(ratio[f]) >= toxicity.LEAST_RATIO)
    assert number.tolist() == used
    # The same steps on the whole matrix.
    x = np.array([[ratio[f] if f in s else 0.0 for f in used] + [1.0] for s in sets])
    w = np.zeros(x.shape[1])
    w[-1] = np.log((n1 + 1) / (len(y) - n1 + 1))
    ridge = np.append(np.full(len(used), toxicity.RIDGE), 0.0)

    def loss(w):
        z = x @ w
        return np.mean(np.logaddexp(0, z) - y * z) + 0.5 * (ridge * w * w).sum()

    start, m, v = loss(w), np.zeros_like(w), np.zeros_like(w)
    for step in range(1, toxicity.STEPS + 1):
        g = x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y) + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    assert np.allclose(weight, w[:-1] * [ratio[f] for f in used], rtol=1e-4, atol=1e-5) and bias == pytest.approx(w[-1], abs=1e-6)
    assert loss(w) < 0.1 * start


def test_features_are_distinct():
    got = toxicity.Features().of("abab abab ABAB")
    assert len(set(got.tolist())) == len(got) > 0
    assert len(toxicity.Features().of("")) == 0
