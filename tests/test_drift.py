import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from weather_rows import weather

from driftline.operators import drift as D
from driftline.plans.weather import SHIFT, WEATHER


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").repartition(3)


def psi(spark, ref, cur):
    r = D.psi(frame(spark, ref), frame(spark, cur), ["x"]).first()
    return r["score"], r["reason"]


BASE = list(range(1, 101))


@pytest.mark.parametrize(
    "cur,want",
    [(BASE, 0.0), ([v + 10 for v in BASE], 1.151281033571558), ([v + 1000 for v in BASE], 11.512810335715578)],
)
def test_psi(spark, cur, want):
    assert math.isclose(psi(spark, BASE, cur)[0], want, rel_tol=1e-12, abs_tol=1e-15)


def test_psi_zero_reasons(spark):
    assert psi(spark, [3.0] * 50, BASE) == (0.0, "too_few_cuts")
    assert psi(spark, [0.0] * 65 + [1.0] * 35, BASE) == (0.0, "too_few_cuts")
    assert psi(spark, BASE, list(range(9)) + [None] * 5) == (0.0, "short_window")
    assert psi(spark, list(range(9)), BASE) == (0.0, "short_reference")


def brute_psi(ref, cur):
    cuts = np.unique(np.quantile(ref, np.linspace(0, 1, 11)))
    r = np.clip(np.histogram(ref, cuts)[0] / len(ref), 1e-6, None)
    c = np.clip(np.histogram(cur, cuts)[0] / len(cur), 1e-6, None)
    return float(np.sum((c - r) * np.log(c / r)))


def test_windows_match_brute_force(spark):
    rng = np.random.default_rng(1)
    ref = np.round(rng.normal(size=700), 2)
    ref_t = rng.choice(["a", "b", None], 700)
    rows, sides = [], {}
    for w, (shift, n) in {"hot": (0.4, 2000), "w1": (0, 150), "w2": (3, 90)}.items():
        x = np.round(rng.normal(size=n) + shift, 2)
        t = rng.choice(["a", "c", None], n) if w != "w1" else np.array(["a"] * n, dtype=object)
        sides[w] = (x, t)
        rows += [(w, float(a), b) for a, b in zip(x, t)]
    r = spark.createDataFrame([(float(a), b) for a, b in zip(ref, ref_t)], "x double, t string").repartition(4)
    c = spark.createDataFrame(rows, "win string, x double, t string").repartition(4)
    got_psi = {x["win"]: x["score"] for x in D.psi(r, c, ["x"], ["win"]).collect()}
    got_tv = {x["win"]: x["score"] for x in D.total_variation(r, c, ["t"], ["win"]).collect()}
    got_w1 = {x["win"]: x["score"] for x in D.wasserstein(r, c, ["x"], ["win"]).collect()}
    got_js = {x["win"]: x["score"] for x in D.jensen_shannon(r, c, ["t"], ["win"]).collect()}
    for w, (x, t) in sides.items():
        assert math.isclose(got_psi[w], brute_psi(ref, x), rel_tol=1e-9, abs_tol=1e-12)
        keys = ["a", "b", "c", None]
        p = np.array([np.mean([v is k if k is None else v == k for v in ref_t]) for k in keys])
        q = np.array([np.mean([v is k if k is None else v == k for v in t]) for k in keys])
        assert math.isclose(got_tv[w], 0.5 * np.abs(p - q).sum(), abs_tol=1e-12)
        m = (p + q) / 2
        kl = lambda a: sum(v * math.log2(v / u) for v, u in zip(a, m) if v > 0)
        assert math.isclose(got_js[w], math.sqrt(max(0.5 * kl(p) + 0.5 * kl(q), 0)), abs_tol=1e-9)
        grid = np.unique(np.concatenate([ref, x]))
        fr = np.searchsorted(np.sort(ref), grid, side="right") / len(ref)
        fc = np.searchsorted(np.sort(x), grid, side="right") / len(x)
        w1 = (np.abs(fr - fc)[:-1] * np.diff(grid)).sum() / max(ref.std(), 0.001)
        assert math.isclose(got_w1[w], w1, rel_tol=1e-9)


def test_shift_moves_features_and_halves_do_not(spark):
    df = weather(spark, 500)
    moved = D.drift_report(df, D.shift_features(df, SHIFT), WEATHER).first()
    assert moved["psi_share"] >= 0.30 and moved["n_columns"] == 21
    cut = F.date_add(F.lit("2012-01-01").cast("date"), 250)
    halves = D.drift_report(df.where(F.col("Date") < cut), df.where(F.col("Date") >= cut), WEATHER).first()
    assert halves["psi_share"] < 0.30


def test_shift_keeps_null_and_contract_range(spark):
    df = spark.createDataFrame([(None,), (499.0,), (1.0,)], "Rainfall double")
    got = [r[0] for r in D.shift_features(df, {"Rainfall": SHIFT["Rainfall"]}).collect()]
    assert sorted(got, key=str) == sorted([None, 500.0, 9.0], key=str)


def test_flip_leaves_features_alone(spark):
    df = weather(spark, 300)
    out = D.flip_labels(df, "RainTomorrow", "Yes", "No", WEATHER.key, 0.5, 9)
    assert D.drift_report(df, out, WEATHER).first()["psi_share"] == 0.0
    changed = df.join(out, [*WEATHER.key]).where(df.RainTomorrow != out.RainTomorrow).count()
    assert 110 < changed < 190


@pytest.mark.parametrize("share,recall,kind", [(0.05, 0.42, "concept_drift"), (0.55, 0.42, "data_drift"), (0.05, 0.80, "stable")])
def test_classify(spark, share, recall, kind):
    assert spark.range(1).select(D.classify(F.lit(share), F.lit(recall))).first()[0] == kind


@pytest.mark.parametrize(
    "history,reasons",
    [([(0.02, 0.81), (0.03, 0.79)], []), ([(0.44, 0.70)], ["data_drift"]), ([(0.05, 0.40), (0.04, 0.82)], []),
     ([(0.05, 0.40), (0.04, 0.45)], ["concept_drift_two_windows"]), ([(0.05, None), (0.04, 0.45)], []),
     ([(0.05, 0.40)], [])],
)
def test_retrain_rule(spark, history, reasons):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(history)], "seq int, drift_share double, realized_recall double")
    last = D.retrain_decision(df, "seq").orderBy(F.desc("seq")).first()
    assert last["reasons"] == reasons and last["retrain"] == bool(reasons)
    weekly = D.retrain_decision(df, "seq", scheduled=True).orderBy(F.desc("seq")).first()
    assert weekly["reasons"] == ["scheduled_weekly", *reasons]


def test_scheduled_without_history(spark):
    row = D.scheduled_only(spark.range(1)).first()
    assert row["retrain"] and row["reasons"] == ["scheduled_weekly"]


def test_shadowed_window_name_is_refused(spark):
    df = spark.createDataFrame([(1, 2.0)], "v int, x double")
    with pytest.raises(ValueError, match="may not be named"):
        D.wasserstein(df, df, ["x"], ["v"])


def test_an_empty_side_keeps_every_column(spark):
    some = spark.createDataFrame([(float(i), "a") for i in range(30)], "x double, c string")
    none = some.limit(0)
    for ref, cur in ((some, none), (none, some), (none, none)):
        (r,) = D.psi(ref, cur, ["x"]).collect()
        assert (r["score"], r["reason"] is None) == (0.0, False)
        (r,) = D.wasserstein(ref, cur, ["x"]).collect()
        assert r["score"] == 0.0
        (r,) = D.jensen_shannon(ref, cur, ["c"]).collect()
        assert r["score"] == 0.0
    scores = [D.total_variation(a, b, ["c"]).first()["score"] for a, b in ((some, none), (none, some), (none, none))]
    assert scores == [0.5, 0.5, 0.0]


def test_infinite_reference_values(spark):
    ref = [float(i) for i in range(50)] + [math.inf] * 10 + [-math.inf] * 10
    score, reason = psi(spark, ref, [float(i) for i in range(50)])
    assert reason is None and score > 0 and math.isfinite(score)
    assert psi(spark, ref, ref)[0] == 0.0


def test_wasserstein_of_many_windows_matches_brute_force(spark):
    rng = np.random.default_rng(8)
    ref = np.round(rng.normal(0, 3, 700), 1)
    sides = {w: np.round(rng.normal(w / 10, 1 + w % 4, 1 + 13 * w), 1) for w in range(25)}
    sides[25] = np.array([100.0, 100.0, -50.0])
    sides[26] = np.array([np.inf, 1.0, np.nan])
    a = spark.createDataFrame([(float(v),) for v in ref], "x double").repartition(3)
    b = spark.createDataFrame([(w, float(v)) for w, vs in sides.items() for v in vs], "win int, x double").repartition(5)
    known = D.profile(a, ["x"])
    got = {r["win"]: r["score"] for r in D.wasserstein(known, b, ["x"], ["win"]).collect()}
    assert set(got) == set(sides)
    for w, vs in sides.items():
        own = vs[np.isfinite(vs)]
        grid = np.sort(np.concatenate([ref, own]))
        fr = np.searchsorted(np.sort(ref), grid[:-1], side="right") / len(ref)
        fc = np.searchsorted(np.sort(own), grid[:-1], side="right") / len(own)
        want = (np.abs(fr - fc) * np.diff(grid)).sum() / max(ref.std(), 0.001)
        assert math.isclose(got[w], want, rel_tol=1e-9, abs_tol=1e-9), w


def test_more_windows_than_any_list(spark):
    cur = spark.range(40_002).selectExpr("id div 2 AS win", "cast(id % 7 AS double) AS x")
    ref = spark.range(100).selectExpr("cast(id % 7 AS double) AS x")
    out = D.wasserstein(ref, cur, ["x"], ["win"])
    assert out.where("score IS NOT NULL").count() == 20_001


def test_a_profile_serves_every_detector(spark):
    ref, cur = weather(spark, 300), weather(spark, 200).where("Humidity3pm IS NOT NULL")
    known = D.reference_profile(ref, WEATHER)
    for f in (D.drift_scores, D.drift_second):
        a = {r["column"]: r["score"] for r in f(ref, cur, WEATHER).collect()}
        b = {r["column"]: r["score"] for r in f(known, cur, WEATHER).collect()}
        assert a == b
    less = cur.drop(WEATHER.numeric[0])
    assert {r["column"]: r["score"] for r in D.drift_scores(known, less, WEATHER).collect()} == {
        r["column"]: r["score"] for r in D.drift_scores(ref, less, WEATHER).collect()
    }


def test_rows_are_counted_before_they_are_placed(spark, monkeypatch):
    """Value ranges are looked up once a distinct value, and a reference is read once for all its uses."""
    read = {"ref": spark.sparkContext.accumulator(0), "cur": spark.sparkContext.accumulator(0)}
    asked = []

    def tracked(n, side, shift):
        def mark(part):
            for batch in part:
                read[side].add(batch.num_rows)
                yield batch

        rows = spark.range(n).select(((F.col("id") % 50) + shift).cast("double").alias("x"))
        return rows.mapInArrow(mark, rows.schema)

    below = D._reference_below

    def looked(c, numbers):
        # counted rows come from a written table: no plan above them reads the window or the reference again
        asked.extend([len(c.inputFiles()), len(numbers.inputFiles())])
        return below(c, numbers)

    monkeypatch.setattr(D, "_reference_below", looked)
    score = D.wasserstein(tracked(2000, "ref", 0), tracked(1000, "cur", 5), ["x"]).first()["score"]
    assert score == pytest.approx(5 / (sum((k - 24.5) ** 2 for k in range(50)) / 50) ** 0.5)
    assert min(asked) > 0
    assert read["cur"].value == 1000  # the values' counts, once
    assert read["ref"].value == 3 * 2000  # sketch of the borders, counts, moments
