"""Boosted trees from counts a bin, against the same rules worked out row by row."""

import glob

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from driftline.operators import models, trees

SIZES = (3,)
NUMERIC, SLOTS = ("z_a", "z_b"), ("i_c",)
WEIGHTS = (1.0, 2.5)


def rows(spark, n=1200):
    """(label, two numbers, one of them with gaps, a slot; the last slot stands for an unseen category)."""
    number = (F.col("id") * 7919) % 1009 / F.lit(100.0)
    made = spark.range(n).select(
        number.alias("z_a"), ((F.col("id") * 31) % 17).cast("double").alias("z_b"), (F.col("id") % 4).cast("double").alias("i_c"),
    )
    hit = (F.col("z_a") + F.when(F.col("i_c") == 1, 3.0).otherwise(0.0) > 6) != (F.col("z_b") == 3)
    return made.withColumn("label", hit.cast("int")).repartition(5)


def features(df):
    slots = [(F.col("i_c") == k).cast("double").alias(f"o_{k}") for k in range(SIZES[0])]
    return VectorAssembler(inputCols=["z_a", "z_b", "o_0", "o_1", "o_2"], outputCol="features").transform(df.select("*", *slots))


def grown(df, **more):
    params = models.settings("gbt", **({"maxIter": 4, "maxDepth": 3} | more))
    return trees.boosting(df, NUMERIC, SLOTS, SIZES, WEIGHTS, df.count(), params)


def test_every_split_is_the_best_of_all_rows(spark):
    df = rows(spark)
    table = df.toPandas()
    y = np.where(table["label"] == 1, 1.0, -1.0)
    w = np.where(table["label"] == 1, WEIGHTS[1], WEIGHTS[0])
    x = np.column_stack([table["z_a"], table["z_b"], *[(table["i_c"] == k) * 1.0 for k in range(3)]])

    def gain(here, left, r):
        def parts(m):
            return w[m].sum(), (w * r)[m].sum()

        (wl, sl), (wr, sr), (wt, st) = parts(here & left), parts(here & ~left), parts(here)
        return (sl * sl / wl + sr * sr / wr - st * st / wt) / wt

    margin = np.zeros(len(y))
    for turn, (tree, step) in enumerate(grown(df)):
        r = y if turn == 0 else 4 * y / (1 + np.exp(2 * y * margin))
        at = {0: np.ones(len(y), bool)}
        for node, split in enumerate(tree.split):
            here = at[node]
            assert tree.rows[node] == here.sum()
            assert np.allclose(tree.stats[node], [w[here].sum(), (w * r)[here].sum(), (w * r * r)[here].sum()])
            if split is None:
                margin[here] += step * (w * r)[here].sum() / w[here].sum()
                continue
            feature, column, value, _ = split
            left = x[:, feature] <= value if column < 2 else x[:, feature] == value
            tried = [x[:, f] <= c for f in (0, 1) for c in tree.shape.cuts[f]] + [x[:, f] == 1 for f in (2, 3, 4)]
            best = max(gain(here, m, r) for m in tried if min((here & m).sum(), (here & ~m).sum()) >= 20)
            assert gain(here, left, r) == pytest.approx(best) == pytest.approx(tree.gain[node])
            at[tree.children[node][0]], at[tree.children[node][1]] = here & left, here & ~left
    assert turn == 3 and np.mean((margin > 0) == (y > 0)) > 0.9


def test_the_model_scores_as_its_trees(spark):
    df = rows(spark)
    made = grown(df)
    model = trees.stored_model(spark, models.estimator("gbt", 1.0, maxIter=4, maxDepth=3), made, 5)
    told = model.transform(features(df)).select("z_a", "z_b", "i_c", models.positive_proba().alias("p")).toPandas()
    codes = made[0][0].shape.codes([told[c].to_numpy() for c in (*NUMERIC, *SLOTS)])
    margin = np.zeros(len(told))
    for tree, step in made:
        node = None
        for _ in range(3):
            node = tree.walk().step(codes, node)
        margin += step * np.array([s / w for w, s, _ in tree.stats])[node]
    assert np.allclose(told["p"], 1 / (1 + np.exp(-2 * margin)))
    assert model.getOrDefault("maxDepth") == 3 and model.numFeatures == 5


def test_rows_are_a_few_bytes_and_all_there(spark):
    df = rows(spark)
    shape = trees.layout(df, NUMERIC, SIZES, WEIGHTS, df.count(), 128, 42)
    held = trees.blocks(df, NUMERIC, SLOTS, shape).collect()
    assert sum(codes.shape[1] for codes, _ in held) == df.count()
    assert sum(n0 for _, n0 in held) == df.where("label = 0").count()
    assert all(codes.dtype == np.uint8 and codes.shape[0] == 2 for codes, _ in held)


def test_wide_categories_keep_a_code_a_row():
    shape = trees.Layout.of([np.arange(5.0)], [3000])
    codes = shape.codes([np.array([-1.0, 9.0]), np.array([0.0, 3000.0])])
    assert shape.dtype == np.uint16 and sorted(shape.widths) == [6, 3001]
    assert sorted(map(tuple, codes.tolist())) == [(0, 5), (0, 3000)]


def test_cuts_lie_between_values_by_weight():
    assert trees.cuts_of(np.array([3.0, 1.0, 1.0, np.nan]), np.ones(4), 8).tolist() == [2.0]
    assert trees.cuts_of(np.array([1.0, 1.0]), np.ones(2), 8).size == 0
    many = trees.cuts_of(np.arange(1000.0), np.ones(1000), 10)
    assert len(many) == 9 and abs(many[4] - 499.5) < 2


def test_checkpoints_change_nothing_and_are_dropped(spark):
    df = rows(spark).persist()
    made = [grown(df, maxIter=5, checkpointInterval=every) for every in (2, 100)]
    assert [t.split[0][:3] for t, _ in made[0]] == [t.split[0][:3] for t, _ in made[1]]
    assert np.allclose(made[0][-1][0].stats, made[1][-1][0].stats)
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert not glob.glob(f"{root}/rdd-*")
    df.unpersist()


def test_a_forest_holds_its_draws_and_scores_as_its_trees(spark, monkeypatch):
    monkeypatch.setattr(trees, "TREES_A_PASS", 2)
    df = rows(spark)
    params = models.settings("forest", numTrees=5, maxDepth=4)
    made = trees.forest(df, NUMERIC, SLOTS, SIZES, WEIGHTS, df.count(), params)
    assert len(made) == 5 and len({t.rows[0] for t, _ in made}) > 1
    assert all(abs(t.rows[0] - df.count()) < 6 * df.count() ** 0.5 for t, _ in made)
    for tree, _ in made:
        for node, children in enumerate(tree.children):
            if children:
                assert tree.rows[node] == sum(tree.rows[c] for c in children) and min(tree.rows[c] for c in children) >= 8
                assert np.allclose(tree.stats[node], np.sum([tree.stats[c] for c in children], axis=0))
    model = trees.stored_model(spark, models.estimator("forest", 1.0, numTrees=5, maxDepth=4), made, 5)
    told = model.transform(features(df)).select("z_a", "z_b", "i_c", "label", models.positive_proba().alias("p")).toPandas()
    codes = made[0][0].shape.codes([told[c].to_numpy() for c in (*NUMERIC, *SLOTS)])
    share = np.zeros(len(told))
    for tree, _ in made:
        node = None
        for _ in range(4):
            node = tree.walk().step(codes, node)
        stats = np.array(tree.stats)
        share += (stats[:, 1] / stats.sum(axis=1))[node] / 5
    assert np.allclose(told["p"], share)
    assert np.mean((told["p"] > 0.5) == (told["label"] == 1)) > 0.8


def test_a_split_by_gini_uses_the_allowed_features():
    shape = trees.Layout.of([np.array([0.5, 1.5]), np.array([0.5])], [2])
    rng = np.random.default_rng(1)
    x = [rng.integers(0, 3, 400) * 1.0, rng.integers(0, 2, 400) * 1.0, rng.integers(0, 3, 400) * 1.0]
    y = (x[0] > 1) ^ (rng.random(400) < 0.1)
    codes = shape.codes(x)
    classes = [[np.bincount(codes[k][y == c], minlength=w)[None, :] * 1.0 for k, w in enumerate(shape.widths)] for c in (0, 1)]
    both = [a + b for a, b in zip(*classes, strict=True)]

    def gini(m):
        return 1 - np.mean(y[m]) ** 2 - np.mean(~y[m]) ** 2

    for allowed in ([1, 1, 1, 1], [0, 1, 0, 0], [0, 0, 0, 1]):
        got = trees.best_splits(shape, both, both, classes, 8, np.array([allowed], bool))[0]
        sides = [(0, x[0] <= 0.5), (0, x[0] <= 1.5), (1, x[1] <= 0.5), (2, x[2] == 0), (3, x[2] == 1)]
        gains = [(gini(m | True) - m.mean() * gini(m) - (~m).mean() * gini(~m), f) for f, m in sides if allowed[f]]
        assert (got[0], got[1]) == (pytest.approx(max(gains)[0]), max(gains)[1])


def test_no_level_counts_more_than_half_of_the_rows(spark, monkeypatch):
    """The larger child is the rest of its parent, and the root's rows are counted for the first tree only."""
    seen, summed = [], trees._summed

    def kept(held, count):
        seen.append(summed(held, count))
        return seen[-1]

    monkeypatch.setattr(trees, "_summed", kept)
    df = rows(spark)
    made = grown(df, maxIter=3)
    groups, n = len(made[0][0].shape.groups), df.count()
    first, roots = seen[0], [found for found in seen[1:-1] if len(found) == groups + 1]
    assert first[0].sum() + first[1].sum() == n and len(roots) == 2
    levels = [found for found in seen if len(found) == 3 * groups][1:]
    assert len(levels) == 6 and all(0 < found[0].sum() + found[1].sum() <= n / 2 for found in levels)


@pytest.mark.parametrize("depth", [1, 2, 5, 6, 7])
def test_rows_come_down_where_a_walk_leads_them(depth):
    """All turns in one word, for trees with early leaves, and node by node below WORD_LEVELS."""
    shape = trees.Layout.of([np.arange(40.0), np.arange(9.0)], [3, 700])
    draw = np.random.default_rng(depth)
    codes = shape.codes([draw.integers(-1, 41, 3000) * 1.0, draw.integers(-1, 10, 3000) * 1.0,
                         draw.integers(0, 4, 3000) * 1.0, draw.integers(0, 701, 3000) * 1.0])
    tree, waiting = trees.Tree(shape), [0]
    while waiting:
        node = waiting.pop(0)
        if tree.depth[node] < depth and (node == 0 or draw.random() < 0.8):
            column = int(draw.integers(0, 4))
            waiting += tree.divide(node, (column, column, 1.0, draw.random(shape.cells[column]) < 0.5))
    for down in range(1, depth + 1):
        node = None
        for _ in range(down):
            node = tree.walk().step(codes, node)
        found = tree.descent(down)
        assert np.array_equal(found.nodes.take(found.places(codes)), node)
        assert trees._counted(found, np.zeros(len(found.nodes), dtype=np.int64), 1, shape.widths, (1.0, 2.0))(
            (codes, 1000, None, None))[0].sum() == 1000


def test_a_rest_without_rows_has_no_sum():
    parents = [np.array([[3.0, 1.0]]), np.array([[2.0, 0.0]]), np.array([[0.1 + 0.2, 0.7]])]
    left = [np.array([[3, 0]]), np.array([[2, 0]]), np.array([[0.3, 0.0]])]
    rows0, rows1, total = trees._with_rest(left, parents, np.array([True]))
    assert rows0.tolist() == [[3, 0], [0, 1]] and rows1.tolist() == [[2, 0], [0, 0]]
    assert total.tolist() == [[0.3, 0.0], [0.0, 0.7]]
    other = trees._with_rest(left, parents, np.array([False]))
    assert other[0].tolist() == [[0, 1], [3, 0]] and other[2].tolist() == [[0.0, 0.7], [0.3, 0.0]]
