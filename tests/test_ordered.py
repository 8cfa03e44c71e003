"""Order statistics against numpy, with hot values and hot groups."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.operators import ordered as O


def frame(spark, values, parts=5):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").repartition(parts)


@pytest.mark.parametrize(
    "data",
    [
        list(range(1, 101)),
        [5.0] * 400 + list(np.random.default_rng(1).normal(size=700)),
        [1.0],
        [2.0, 2.0],
        [1e-9 * i for i in range(333)],
        list(np.random.default_rng(2).lognormal(sigma=4, size=2500)),
        [-1e300, 0.0, 1e300, 7.5],
    ],
)
def test_exact_quantiles(spark, data):
    probs = [i * 0.1 for i in range(10)] + [1.0]
    got = O.exact_quantiles(frame(spark, [*data, None, float("nan")]), ["x"], probs)["x"]
    want = np.quantile(np.array(data, dtype=float), probs)
    assert got == list(want)


def test_exact_quantiles_empty_and_several_columns(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    assert O.exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [2.0], "b": None}


def test_quantiles_survive_missed_brackets(spark, monkeypatch):
    monkeypatch.setattr(O, "_values_at_ranks", lambda *a: {})
    data = np.random.default_rng(3).normal(size=500)
    got = O.exact_quantiles(frame(spark, data), ["x"], [0.1, 0.5, 0.95])["x"]
    assert np.allclose(got, np.quantile(data, [0.1, 0.5, 0.95]), rtol=0, atol=1e-12)


def test_grouped_quantiles_with_hot_group(spark):
    rng = np.random.default_rng(4)
    rows = [("hot", float(v)) for v in rng.normal(size=3000)] + [(f"g{i % 7}", float(i % 13)) for i in range(500)]
    rows += [(None, 1.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    got = {r["g"]: (r["n"], r["p50"], r["p95"]) for r in O.grouped_quantiles(df, ["g"], "x", {"p50": 0.5, "p95": 0.95}).collect()}
    for g in {r[0] for r in rows}:
        v = np.array([x for k, x in rows if k == g])
        n, p50, p95 = got[g]
        assert n == len(v)
        assert np.allclose([p50, p95], np.quantile(v, [0.5, 0.95]), rtol=0, atol=1e-12)


def test_ranges_follow_value_order(spark):
    rng = np.random.default_rng(5)
    v = np.sort(np.concatenate([rng.random(3000), 10 ** (-12 * rng.random(2000)), [0, 1, 0.5, -3, 7]]))
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    edges = sorted(set(map(float, v[::37])))
    cells = df.select("x", O.range_id("x", edges).alias("r")).orderBy("x").collect()
    for a, b in zip(cells, cells[1:]):
        assert a["r"] <= b["r"]
    want = np.searchsorted(edges, [c["x"] for c in cells], side="right")
    order = [c["r"] for c in cells]
    assert all((x == y) == (p == q) for x, y, p, q in zip(want, want[1:], order, order[1:]))


@pytest.mark.parametrize("ends", [[math.inf], [-math.inf], [math.inf, -math.inf], [math.inf] * 40 + [-math.inf] * 40])
def test_infinite_values_are_ranked(spark, ends):
    v = [float(x) for x in range(101)] + ends
    df = spark.createDataFrame([(x,) for x in v], "x double").repartition(3)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = O.exact_quantiles(df, ["x"], probs)["x"]
    v.sort()
    for p, q in zip(probs, got, strict=True):
        h = (len(v) - 1) * p
        lo, hi = v[math.floor(h)], v[math.ceil(h)]
        want = lo if lo == hi else lo + (hi - lo) * (h - math.floor(h))
        assert q == want or math.isclose(q, want)
    assert all(math.isfinite(e) for e in O.range_edges(df, ["x"])["x"])


def test_crowded_values_spread_over_the_ranges(spark):
    df = spark.range(100_000).select((0.5 + F.col("id") / 1e8).alias("x")).repartition(8)
    edges = O.range_edges(df, ["x"], 64)["x"]
    sizes = [r["count"] for r in df.groupBy(O.range_id("x", edges)).count().collect()]
    assert len(sizes) >= 60 and max(sizes) < 5 * 100_000 / 64
