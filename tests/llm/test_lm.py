import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from driftline.llm import lm
from tests.llm import rows as R


@pytest.fixture(scope="module")
def scored(spark):
    return lm.score(R.table(spark)).collect()


def test_base_scores_match_brute_force(scored):
    rows = R.rows()
    taught = Counter()
    for r in rows:
        if crc32(("" if r[0] is None else str(r[0])).encode()) % 7 != 2:
            taught.update(lm.tokens(r[1] or ""))
    n, v = sum(taught.values()), len(taught)
    want = {r[0]: lm.tokens(r[1] or "") for r in rows}
    assert len(scored) == len(rows)
    for r in scored:
        said = want[r.doc_id]
        assert (r.n_tokens, r.train_tokens) == (len(said), n)
        assert r.n_known == sum(taught[w] > 0 for w in said)
        assert math.isclose(r.base_score, sum(math.log10((taught[w] + 1) / (n + v + 1)) for w in said), rel_tol=1e-9)
        assert r.score < 0


def test_predictions_of_a_class_add_up_to_one():
    rng = np.random.default_rng(3)
    n_words = 40
    word = np.repeat(np.arange(n_words), 2)
    kind = np.tile([1, 2], n_words)
    count = rng.integers(0, 60, len(word))
    cells = lm.Cells(word, kind, count, n_words, [], [])
    tables = np.bincount(kind, weights=np.minimum(count, 3), minlength=lm.CLASSES)
    customers = np.bincount(kind, weights=count, minlength=lm.CLASSES)
    for leaf, at_root, root_tables in lm.seatings(cells, lm.Totals(int(count.sum()), n_words, 0.6, 0.5, customers, tables, 1.0, 1.0), 1, 2, 3):
        assert (leaf[count > 0] >= 1).all() and (leaf <= count).all()
        assert (at_root == np.bincount(word, weights=leaf)).all() and (root_tables <= at_root).all()
        totals = lm.Totals(
            int(count.sum()), n_words, 0.6, 0.5, customers, np.bincount(kind, weights=leaf, minlength=lm.CLASSES), float(at_root.sum()), float(root_tables.sum())
        )
        p = totals.root(at_root, root_tables)
        unknown = totals.root(np.zeros(1), np.zeros(1))
        assert math.isclose(p.sum() + unknown[0], 1.0)
        for k in (1, 2):
            own = kind == k
            below = lm.STRENGTH + customers[k]
            back = (lm.STRENGTH + 0.6 * totals.tables[k]) / below
            mass = ((count - 0.6 * leaf)[own] / below + back * p).sum() + back * unknown[0]
            assert math.isclose(mass, 1.0)


def test_small_cells_reach_the_restaurant_process():
    """Seats of one dish follow the two-parameter process: the mean number of tables is known in closed form."""
    c, discount, opening = 8, 0.5, 1.5
    seats = lm.Seating(np.full(4000, c), discount, np.random.default_rng(5))
    for _ in range(12):
        seats.sweep(np.full(4000, opening))
    # weights of seatings by number of tables, customer by customer
    weight = np.zeros(c + 1)
    weight[1] = 1.0
    for seated in range(1, c):
        nxt = np.zeros(c + 1)
        for t in range(1, seated + 1):
            nxt[t] += weight[t] * (seated - discount * t)
            nxt[t + 1] += weight[t] * opening
        weight = nxt
    mean = (weight * np.arange(c + 1)).sum() / weight.sum()
    assert abs(seats.tables.mean() - mean) < 0.1


def mean_tables(c, discount, opening):
    """The mean by the recursion over customers, in full."""
    t = np.arange(c + 1)
    log = np.full(c + 1, -np.inf)
    log[1] = 0.0
    with np.errstate(divide="ignore"):
        for seated in range(1, c):
            joined = log + np.log(np.maximum(seated - discount * t, 0))
            log = np.logaddexp(joined, np.concatenate([[-np.inf], log[:-1] + np.log(opening)]))
            log -= log.max()
    return (np.exp(log) * t).sum() / np.exp(log).sum()


@pytest.mark.parametrize(
    "c, discount, opening",
    [(8, 0.7, 0.8), (16, 0.7, 0.8), (40, 0.5, 1.5), (200, 0.6, 3.0), (1024, 0.9, 40.0), (1500, 0.3, 9.0), (9000, 0.8, 100.0), (20000, 0.2, 5.0), (9000, 0.7, 900.0)],
)
def test_cells_of_all_sizes_reach_the_restaurant_process(c, discount, opening):
    seats = lm.Seating(np.full(3000, c), discount, np.random.default_rng(c))
    found = []
    for _ in range(4):
        seats.sweep(np.full(3000, opening))
        found.append(seats.tables.mean())
    assert abs(np.mean(found) / mean_tables(c, discount, opening) - 1) < 0.015


def test_root_tables_of_a_round_are_not_left_near_one():
    """Every word is the only customer of eight contexts: eight customers in the unigram restaurant."""
    n = 4000
    cells = lm.Cells(np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), n, [], [], np.full(n, 8))
    totals = lm.Totals(8 * n, n, 0.8, 0.7, np.zeros(0), np.zeros(0), 8.0 * n, 2.36 * n)
    opening = (lm.STRENGTH + 0.7 * 2.36 * n) / (n + 1)
    ((_, _, tables),) = lm.seatings(cells, totals, 1, 0, 1)
    assert abs(tables.mean() / mean_tables(8, 0.7, opening) - 1) < 0.02


def test_held_out_texts_of_one_kind_gain(spark):
    docs = [(i, " ".join(R.words(i % 4, 60))) for i in range(60)]
    got = lm.score(spark.createDataFrame(docs, "doc_id long, text string"))
    held = [r for r in got.collect() if r.held_out]
    assert held and all(r.score > r.base_score for r in held)
    assert {r.held_out: r.perplexity < r.base_perplexity for r in lm.perplexity(got).collect()} == {True: True, False: True}


def test_contexts_are_words_not_their_endings(spark):
    docs = [(i, ("onezz red", "twozz blue")[i % 2]) for i in range(200)]
    held = [i for i in range(200, 300) if lm._held(i)][:2]
    docs += [(held[0], "onezz red"), (held[1], "onezz blue")]
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert got[held[0]].base_score - got[held[1]].base_score < 0.1
    assert got[held[0]].score - got[held[1]].score > 1


def test_predictions_match_counts_where_no_seating_is_random(spark):
    """Each cell but one seen once: one table each, whatever is drawn."""
    docs = [(i, t) for i, t in zip([i for i in range(60) if not lm._held(i)], ("a b", "b c", "c a", "d e f"))]
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    pairs, words, types = Counter(), Counter(), Counter()
    for _, t in docs:
        w = [b"\n", *lm.tokens(t)]
        pairs.update(zip(w, w[1:]))
        words.update(w[1:])
    assert set(pairs.values()) == {1}
    types.update(a for a, _ in pairs)
    followed = Counter(b for _, b in pairs)
    n, v = len(pairs), len(words)
    widths = Counter(followed.values())
    d, e = lm._discount(n, 0), lm._discount(widths[1], widths[2])
    for i, t in docs:
        w, lo, hi = [b"\n", *lm.tokens(t)], 0.0, 0.0
        for a, b in zip(w, w[1:]):
            # a word's root tables lie between one and its customers
            some = [(1, sum(followed.values())), (followed[b], v)]
            p = [(followed[b] - e * t + (lm.STRENGTH + e * all_tables) / (v + 1)) / (lm.STRENGTH + n) for t, all_tables in some]
            x, y = [(1 - d + (lm.STRENGTH + d * types[a]) * q) / (lm.STRENGTH + words[a]) for q in p]
            lo, hi = lo + math.log10(min(x, y)), hi + math.log10(max(x, y))
        assert lo - 1e-6 <= got[i].score <= hi + 1e-6


def test_empty_table(spark):
    assert lm.score(R.table(spark).limit(0)).count() == 0


def test_without_training_text(spark):
    held = next(i for i in range(100) if crc32(str(i).encode()) % 7 == 2)
    (r,) = lm.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.score, r.base_score) == (3, 0, 0, 0.0, 0.0)


def test_scored_predictions_add_up_to_one(spark):
    """Probabilities read back from scores: with the end token and one unknown word they form a stochastic matrix.

    With a(u) the log chance of u at the start, score(u w) - score(w) is the log chance of w after u plus a(u) - a(w): a
    similar matrix, whose largest eigenvalue is one exactly if the predictions of every context add up to one.
    """
    rng = np.random.default_rng(8)
    known = [f"w{k}" for k in range(9)]
    chances = rng.dirichlet(np.full(len(known), 0.4))
    taught = [(i, " ".join(rng.choice(known, 40, p=chances))) for i in range(400) if not lm._held(i)]
    seen = sorted({w for _, t in taught for w in t.split()})
    ids = iter(i for i in range(400, 10_000) if lm._held(i))
    states = [*seen, "never"]
    texts = {(u, w): f"{u} {w}" for u in states for w in states} | {(u, ""): u for u in states} | {("", ""): ""}
    asked = {k: (next(ids), t) for k, t in texts.items()}
    docs = spark.createDataFrame([*taught, *asked.values()], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in lm.score(docs).collect()}
    assert all(got[i].held_out for i, _ in asked.values())
    score = {k: got[i].score for k, (i, _) in asked.items()}
    matrix = np.ones((len(states) + 1,) * 2)  # the last row and column: the end token
    for x, u in enumerate(states):
        for y, w in enumerate(states):
            matrix[x, y] = 10 ** (score[u, w] - score[w, ""])
        matrix[x, -1] = 10 ** score[u, ""]
    matrix[-1, -1] = 10 ** score["", ""]
    assert abs(np.abs(np.linalg.eigvals(matrix)).max() - 1) < 1e-6
