"""Exported models against the ML library and against a walk of the same tables in DuckDB."""

import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from weather_rows import weather

from driftline.functions import columns as X
from driftline.operators import exported, models, split
from driftline.operators import features as FT
from driftline.plans.weather import WEATHER

SMALL = {"gbt": {"maxIter": 3, "maxDepth": 3}, "forest": {"numTrees": 3, "maxDepth": 4}}


@pytest.fixture(scope="module")
def fitted(spark):
    rows = split.time_split(weather(spark, 480), "Date", target="RainTomorrow").where("RainTomorrow IS NOT NULL")
    rows = rows.withColumn("id", F.xxhash64(*WEATHER.key))
    params = FT.fit(rows.where("split = 'train'"), WEATHER)
    versions, _, _ = models.train_candidates(rows, WEATHER, None, params, SMALL)
    label = X.encode_label(F.col("RainTomorrow"), WEATHER.positive, WEATHER.negative)
    inputs = exported.inputs(rows.withColumn("label", label), WEATHER, params, ["id", "label", "split"])
    return rows, params, versions, inputs, exported.Inputs.of(WEATHER, params)


def library(rows, version):
    return {r.id: r.proba for r in models.score(rows, WEATHER, version).select("id", "proba").collect()}


def stage(versions, name):
    return versions[name].pipeline.stages[-1]


def same(got, want):
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_coefficients_score_as_the_library_does(spark, fitted):
    rows, params, versions, inputs, shape = fitted
    weights = exported.coefficients(spark, stage(versions, "logreg"), WEATHER, params)
    assert weights.count() == params.width + 1
    scored = exported.margin(inputs, weights, shape).select("id", exported.logistic(F.col("margin")).alias("proba"))
    same({r.id: r.proba for r in scored.collect()}, library(rows, versions["logreg"]))


def test_gradient_vanishes_at_the_fit_and_nowhere_else(spark, fitted):
    _, params, versions, inputs, shape = fitted
    train, total = FT.with_weight(inputs.where("split = 'train'"), "label", "balanced")
    weights = exported.coefficients(spark, stage(versions, "logreg"), WEATHER, params)
    told = {r.slot: r for r in exported.logreg_gradient(train, weights, shape).collect()}
    assert len(told) == params.width + 1 and max(abs(r.gradient) for r in told.values()) < 1e-4
    moved = weights.withColumn("weight", F.col("weight") + F.when(F.col("slot") == 2, 0.3).otherwise(0.0))
    off = {r.slot: r.gradient for r in exported.logreg_gradient(train, moved, shape).collect()}
    # the same on a dense matrix
    data = train.select("label", "weight", "z", "slots").collect()
    x = np.zeros((len(data), params.width))
    for i, r in enumerate(data):
        x[i, : len(r.z)] = r.z
        for s, start in zip(r.slots, shape.offsets, strict=False):
            if s is not None:
                x[i, start + s] = 1
    w = np.array([told[k].weight for k in range(params.width)])
    w[2] += 0.3
    y, weight = np.array([r.label for r in data]), np.array([r.weight for r in data])
    miss = weight * (1 / (1 + np.exp(-(x @ w + told[-1].weight))) - y)
    want = (x.T @ miss + w) / total
    assert np.allclose([off[k] for k in range(params.width)], want, atol=1e-12)
    assert abs(off[2]) > 1e-2


WALK = """
WITH RECURSIVE t AS (
  SELECT i.id, n.tree, 0 AS node FROM i, (SELECT DISTINCT tree FROM n) n
  UNION ALL
  SELECT t.id, t.tree, CASE WHEN CASE WHEN n.threshold IS NOT NULL THEN v <= n.threshold ELSE v = n.left_value END THEN n."left" ELSE n."right" END
  FROM t JOIN n USING (tree, node) JOIN i USING (id), LATERAL (SELECT i.x[n.feature + 1] AS v) WHERE n."left" >= 0
)
SELECT t.id, sum({value}) AS s FROM t JOIN n USING (tree, node) WHERE n."left" < 0 GROUP BY 1
"""


@pytest.mark.parametrize("name", ["forest", "gbt"])
def test_nodes_score_as_the_library_and_as_duckdb_does(spark, fitted, name):
    rows, params, versions, inputs, shape = fitted
    table = exported.nodes(spark, stage(versions, name))
    depth, trees = stage(versions, name).getOrDefault("maxDepth"), 3
    score = exported.score_forest if name == "forest" else exported.score_boosting
    got = {r.id: r.proba for r in score(inputs, table, shape, depth, trees, ["id"]).collect()}
    want = library(rows, versions[name])
    same(got, want)
    dense = F.transform(F.sequence(F.lit(0), F.lit(params.width - 1)), shape.value)
    i, n = inputs.select("id", dense.alias("x")).toPandas(), table.toPandas()  # noqa: F841
    value = "stats[2] / (stats[1] + stats[2]) / 3" if name == "forest" else "prediction * tree_weight"
    walked = dict(duckdb.sql(WALK.format(value=value)).fetchall())
    same({k: v if name == "forest" else 1 / (1 + np.exp(-2 * v)) for k, v in walked.items()}, want)


def test_boosting_statistics_follow_from_the_rows(spark, fitted):
    _, _, versions, inputs, shape = fitted
    table = exported.nodes(spark, stage(versions, "gbt"))
    train, _ = FT.with_weight(inputs.where("split = 'train'"), "label", "positive")
    found = {(r.tree, r.node): r for r in exported.boosting_statistics(train, table, shape, 3, 3).collect()}
    stored = table.collect()
    assert {(r.tree, r.node) for r in stored} == found.keys() and {r.tree for r in stored} == {0, 1, 2}
    for r in stored:
        f = found[r.tree, r.node]
        assert np.allclose([f.weight, f.total, f.squares], list(r.stats), rtol=1e-9, atol=1e-7)
    gains = exported.split_gains(table, False).collect()
    assert gains and all(abs(r.gain - r.recomputed) < 1e-9 for r in gains)
    # a wrong node is told
    wrong = train.withColumn("weight", F.col("weight") * F.when(F.get("z", F.lit(0)) > 0, 1.01).otherwise(1.0))
    other = {(r.tree, r.node): r.weight for r in exported.boosting_statistics(wrong, table, shape, 3, 3).collect()}
    assert any(abs(other[k] - f.weight) > 1e-3 for k, f in found.items())


def test_levels_are_compiled_one_by_one(spark, capsys):
    """Each level is a stage of generated code of its own; the leaves are those of a plain walk."""
    schema = "tree int, node int, feature int, threshold double, left_value double, left int, right int"
    inner = [(0, n, n % 4, 0.5 if n % 4 < 2 else None, None if n % 4 < 2 else 1.0, 2 * n + 1, 2 * n + 2) for n in range(31)]
    listed = inner + [(0, n, -1, None, None, -1, -1) for n in range(31, 63)]
    table = spark.createDataFrame(listed, schema)
    shape = exported.Inputs(("a", "b"), ("c",), (2,))
    given = [([x / 3.0, y / 3.0], [s]) for x in range(4) for y in range(4) for s in (0, 1, None)]
    rows = spark.createDataFrame(given, "z array<double>, slots array<int>")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = exported.routed(rows, table, shape, 5, 1)
        out.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert len(sizes) >= 5 and max(sizes) < 8000

    def walk(z, slot):
        node = 0
        while node < 31:
            f = node % 4
            left = z[f] <= 0.5 if f < 2 else slot == f - 2
            node = 2 * node + (1 if left else 2)
        return node

    assert {(tuple(r["z"]), r["slots"][0]): r["node"] for r in out.collect()} == {(tuple(z), s[0]): walk(z, s[0]) for z, s in given}
