import numpy as np
from pyspark.sql import functions as F

from driftline.operators import metrics as M


def frame(spark, y, p, g=None):
    rows = [(int(a), float(b), (g[i] if g else "g")) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "label int, proba double, g string")


def brute(y, p):
    y, p = np.asarray(y), np.asarray(p)
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    ap, before = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        tp = (hit & (y == 1)).sum()
        ap += (tp / len(pos) - before) * tp / hit.sum()
        before = tp / len(pos)
    return auc, ap


def test_ties(spark):
    m = M.binary_metrics(frame(spark, [1, 0, 1, 0, 1, 0, 0, 1], [0.9, 0.9, 0.7, 0.5, 0.5, 0.5, 0.2, 0.1]), 0.5).first()
    assert m["roc_auc"] == 0.53125 and abs(m["average_precision"] - 0.5416666666666666) < 1e-15
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (3, 3, 1, 1)
    assert m["cost"] == 8.0


def test_degenerate(spark):
    assert M.roc_auc(frame(spark, [1, 0, 1], [0.4] * 3)).first()[0] == 0.5
    one = frame(spark, [0, 0, 0], [0.2, 0.4, 0.6])
    m = M.binary_metrics(one, 0.5).first()
    assert m["roc_auc"] is None and m["recall"] == 0.0 and m["f1"] == 0.0
    assert M.choose_threshold(one).first()["threshold"] == 0.05


def test_threshold_fixture(spark):
    df = frame(spark, [1, 1, 1, 1, 0, 0, 0, 0], [0.9, 0.8, 0.4, 0.35, 0.3, 0.2, 0.1, 0.05])
    best = M.choose_threshold(df, 0.72).first()
    assert best["threshold"] == 0.30999999999999994 and best["cost"] == 0.0 and best["recall"] == 1.0
    curve = {r["grid_index"]: r["cost"] for r in M.cost_curve(df).collect()}
    assert len(curve) == 91
    half = M.confusion(df, 0.5).first()
    assert best["cost"] <= half["fp"] + 5 * half["fn"]


def test_random_groups_match_brute_force(spark):
    rng = np.random.default_rng(7)
    n = 1500
    g = ["hot" if i % 3 else f"g{i % 5}" for i in range(n)]
    p = np.where(rng.random(n) < 0.3, 0.25, np.round(rng.random(n) ** 3, 3))
    y = (rng.random(n) < p).astype(int)
    df = frame(spark, y, p, g).repartition(5)
    curve_grid = 0.05 + np.arange(91) * ((0.95 - 0.05) / 90)
    got = {r["g"]: r for r in M.binary_metrics(df, 0.3, ["g"]).collect()}
    picked = {r["g"]: r for r in M.choose_threshold(df, 0.72, ["g"]).collect()}
    for k in set(g):
        idx = [i for i in range(n) if g[i] == k]
        auc, ap = brute(y[idx], p[idx])
        assert abs(got[k]["roc_auc"] - auc) < 1e-12 and abs(got[k]["average_precision"] - ap) < 1e-12
        best = None
        for t in curve_grid:
            hit = p[idx] >= t
            rec = (hit & (y[idx] == 1)).sum() / max(y[idx].sum(), 1)
            cost = (hit & (y[idx] == 0)).sum() + 5 * (~hit & (y[idx] == 1)).sum()
            if rec >= 0.72 and (best is None or cost < best[0]):
                best = (cost, t)
        assert picked[k]["cost"] == best[0] and picked[k]["threshold"] == best[1]


def test_auc_ignores_monotone_change(spark):
    rng = np.random.default_rng(8)
    p = rng.random(300)
    y = (rng.random(300) < p).astype(int)
    a = M.roc_auc(frame(spark, y, p)).first()[0]
    b = M.roc_auc(frame(spark, y, p**5)).first()[0]
    assert abs(a - b) < 1e-12


def test_slices_skip_small_and_single_class(spark):
    y = [0, 1] * 20 + [1] * 40 + [0, 1]
    g = ["ok"] * 40 + ["single"] * 40 + ["small"] * 2
    out = M.slice_metrics(frame(spark, y, [0.5] * 82, g), 0.5, ["g"]).collect()
    assert [r["g"] for r in out] == ["ok"]


def test_policy_costs(spark):
    r = M.policy_costs(frame(spark, [1, 1, 0, 0, 0], [0.9, 0.1, 0.8, 0.2, 0.3]), 0.5).first()
    assert (r["model_cost"], r["never_cost"], r["always_cost"]) == (6.0, 10.0, 3.0)


def test_decisions_already_made(spark):
    df = frame(spark, [1, 1, 0], [0.9, 0.1, 0.8]).withColumn("predicted", (F.col("proba") >= 0.5).cast("int"))
    assert M.decision_cost(df, "predicted").first()["cost"] == 6.0


def test_unusable_rows_are_counted_and_take_part_in_nothing(spark):
    rows = [(1, 0.9), (0, 0.2), (None, 0.8), (1, None), (0, float("nan")), (2, 0.7), (-1, 0.1)]
    df = spark.createDataFrame([(*r, "g") for r in rows] + [(None, 0.5, "h")], "label int, proba double, g string")
    got = {r["g"]: r for r in M.binary_metrics(df, 0.5, ["g"]).collect()}
    assert (got["g"]["n_rows"], got["g"]["n_unusable"], got["g"]["roc_auc"]) == (2, 5, 1.0)
    assert (got["h"]["n_rows"], got["h"]["n_unusable"], got["h"]["roc_auc"]) == (0, 1, None)
    c = M.confusion(df, 0.5).first()
    assert (c["tp"], c["fp"], c["fn"], c["tn"]) == (1, 0, 0, 1)


def test_crowded_scores_match_brute_force(spark):
    rng = np.random.default_rng(12)
    p = 0.5 + rng.integers(0, 4000, 3000) / 4e6
    y = (rng.random(3000) < 0.3 + 0.4 * (p > 0.5005)).astype(int)
    m = M.binary_metrics(frame(spark, y, p).repartition(6), 0.5005).first()
    auc, ap = brute(y, p)
    assert abs(m["roc_auc"] - auc) < 1e-12 and abs(m["average_precision"] - ap) < 1e-12
