import pytest

from driftline.operators import registry as R

CANDS = "run_id int, model_name string, roc_auc double, recall double, model_mb double"


@pytest.mark.parametrize(
    "auc,recall,base,mb,failing",
    [(0.90, 0.80, 0.85, 2.0, None), (0.90, 0.40, 0.85, 2.0, "recall_ok"), (0.90, 0.80, 0.85, 40.0, "size_ok"),
     (0.70, 0.80, 0.60, 2.0, "floor_ok"), (0.80, 0.80, 0.85, 2.0, "improve_ok")],
)
def test_gate(spark, auc, recall, base, mb, failing):
    df = spark.createDataFrame([(1, "gbt", auc, recall, mb)], CANDS)
    r = R.bless(df, ["run_id"], forced=base).first()
    assert r["blessed"] == (failing is None)
    for c in ("floor_ok", "recall_ok", "size_ok", "improve_ok"):
        assert r[c] == (c != failing)


def three(spark):
    rows = [(1, "logreg", 0.8712, 0.8537, 0.0072), (1, "gbt", 0.8877, 0.8246, 0.5793), (1, "forest", 0.8563, 0.8348, 3.2332)]
    return spark.createDataFrame(rows, CANDS)


def test_real_candidates(spark):
    out = {r["model_name"]: r for r in R.with_selected(R.bless(three(spark), ["run_id"]), ["run_id"]).collect()}
    assert out["logreg"]["blessed"] and out["logreg"]["baseline_auc"] is None
    assert out["gbt"]["selected"] and round(out["gbt"]["improvement"], 4) == 0.0165
    assert not out["forest"]["improve_ok"] and round(out["forest"]["improvement"], 4) == -0.0149


def test_ties_go_to_the_smaller_model_and_no_winner_skips(spark):
    rows = [(1, "a", 0.9, 0.9, 2.0), (1, "b", 0.9, 0.9, 1.0), (2, "a", 0.6, 0.9, 1.0)]
    sel = R.with_selected(R.bless(spark.createDataFrame(rows, CANDS), ["run_id"]), ["run_id"])
    got = {r["run_id"]: (r["next"], r["winner"]) for r in R.route(sel, ["run_id"]).collect()}
    assert got == {1: ("push", "b"), 2: ("skip", None)}


def test_versions_continue(spark):
    first = R.register(three(spark), ["model_name"])
    assert sorted(r["version"] for r in first.collect()) == [1, 2, 3]
    assert sorted(r["version"] for r in R.register(three(spark), ["model_name"], versions=first).collect()) == [4, 5, 6]


EV = "event_seq bigint, version bigint, model_name string"
VS = "version bigint"


def rollback(spark, events, versions):
    e = spark.createDataFrame([(s, v, "m") for s, v in events], EV)
    vs = spark.createDataFrame([(v,) for v in versions], VS)
    history = R.production_history(e)
    move = R.rollback_target(vs, history, R.production(e))
    return history, move


def test_rollback_prefers_history(spark):
    history, move = rollback(spark, [(1, 2), (2, 4), (3, 4)], [1, 2, 3, 4])
    assert [r["version"] for r in history.orderBy("event_seq").collect()] == [2, 4]
    assert move.first()["target"] == 2
    assert [r["version"] for r in R.trim_history(history, move).collect()] == [2]


def test_rollback_without_history_takes_next_lower(spark):
    history, move = rollback(spark, [(1, 3)], [1, 2, 3])
    assert move.first()["target"] == 2
    assert [r["version"] for r in R.trim_history(history, move).collect()] == [2]


def test_rollback_impossible(spark):
    assert rollback(spark, [(1, 1)], [1])[1].first()["problem"].startswith("rolling back takes two")
    assert rollback(spark, [(1, 1)], [1, 2])[1].first()["problem"] == "no version is older than the one in production"
