"""Whole runs on the weather example."""

import json

import pytest
from pyspark.sql import functions as F
from weather_rows import weather

from driftline.operators import models
from driftline.operators.contract import ContractError
from driftline.plans import run
from driftline.plans.weather import ACTION_NO, ACTION_YES, SHIFT, WEATHER
from driftline.sources import records
from driftline.operators import split

SMALL = {"gbt": {"maxIter": 15}, "forest": {"numTrees": 20}}


def test_bad_batch_stops_before_training(spark, tmp_path):
    paths = run.Paths(str(tmp_path / "p"))
    raw = weather(spark, 30).withColumn("Humidity3pm", F.when(F.col("Date") == "2012-01-01", 140.0).otherwise(F.col("Humidity3pm")))
    with pytest.raises(ContractError, match="Humidity3pm"):
        run.train_run(spark, raw, WEATHER, paths, "bad", 1)
    assert records.read_records(spark, paths.table("versions")) is None
    alerts = records.open_alerts(records.read_records(spark, paths.table("alerts")), ["source"], "event_seq")
    assert "validation failed" in alerts.first()["message"] and alerts.first()["total_failures"] == 1


def test_full_run_promotes_then_rolls_back(spark, tmp_path):
    paths = run.Paths(str(tmp_path / "p"))
    raw = weather(spark, 480).withColumn("RISK_MM", F.lit(9))
    raw = raw.unionAll(raw.limit(7))
    summary = run.train_run(spark, raw, WEATHER, paths, "r1", 1, overrides=SMALL).first()
    assert summary["blessed"] and summary["promoted"] and summary["n_candidates"] == 3
    assert (summary["train"], summary["val"], summary["test"]) == (336, 72, 72)
    versions = spark.read.parquet(paths.table("versions"))
    assert sorted(r["version"] for r in versions.collect()) == [1, 2, 3]
    winner = versions.where("selected").first()
    assert winner["roc_auc"] >= 0.75 and winner["recall"] >= 0.70 and winner["model_mb"] <= 25
    assert run.serving_auc(spark, paths) == winner["roc_auc"]
    assert "RISK_MM" not in spark.read.parquet(paths.stage("r1", "examples")).columns
    assert spark.read.parquet(paths.stage("r1", "examples")).count() == 480
    # A second candidate set that cannot beat the forced baseline is registered, not promoted.
    cands = versions.select(*[c for c in versions.columns if c in ("model_name", "model_mb", "roc_auc", "recall", "threshold")])
    second = run.publish(spark, cands.withColumn("run_id", F.lit("r2")), paths, "r2", 2, forced_baseline=0.999999).first()
    assert second["next"] == "skip" and not second["promoted"]
    third = run.publish(spark, cands.withColumn("run_id", F.lit("r3")), paths, "r3", 3).first()
    assert third["promoted"]
    assert spark.read.parquet(paths.table("versions")).agg(F.max("version")).first()[0] == 9
    # the records of a run say what was trained on what, and how
    info = spark.read.parquet(paths.table("split_info")).where("run_id = 'r1'").collect()
    assert {r["dropped_unlabeled"] for r in info} == {0}
    data = spark.read.parquet(paths.table("data_versions")).first()
    assert data["n_bytes"] > 0 and (data["train_rows"], data["val_rows"], data["test_rows"]) == (336, 72, 72)
    made = {r["model_name"]: r for r in spark.read.parquet(paths.table("experiments")).collect()}
    assert json.loads(made["gbt"]["params"])["maxIter"] == SMALL["gbt"]["maxIter"]
    assert all(r["data_version"] == data["hash_xor"] for r in made.values())
    # a fourth promotion, then back step by step; the alias names the pipeline that serves
    fourth = run.publish(spark, cands.withColumn("run_id", F.lit("r4")), paths, "r4", 4).first()
    lived = [summary["promoted_version"], third["promoted_version"], fourth["promoted_version"]]
    first = run.rollback(spark, paths, 5).first()
    assert (first["current"], first["target"]) == (lived[2], lived[1])
    meta = run.serving_metadata(spark, paths).first()
    assert (meta["version"], meta["rolled_back_from"]) == (lived[1], lived[2])
    second = run.rollback(spark, paths, 6).first()
    assert (second["current"], second["target"]) == (lived[1], lived[0])
    assert [r["version"] for r in run.history(spark, paths).collect()] == [lived[0]]
    live = run.serving_version(spark, paths)
    assert (live.version, live.model_name, live.threshold) == (str(lived[0]), winner["model_name"], winner["threshold"])
    examples = spark.read.parquet(paths.stage("r1", "examples")).limit(20)
    scored = models.score_table(examples, WEATHER, live, ACTION_YES, ACTION_NO).collect()
    assert len(scored) == 20 and {r["model_version"] for r in scored} == {live.version}


@pytest.mark.parametrize("dies_at", ["versions", "alias_events", "production_history", "commits"])
def test_a_publication_shows_as_a_whole_or_not_at_all(spark, tmp_path, monkeypatch, dies_at):
    paths = run.Paths(str(tmp_path / "p"))
    rows = [("gbt", 0.9, 0.8, 1.0, 0.4), ("logreg", 0.8, 0.8, 1.0, 0.5)]
    cands = spark.createDataFrame(rows, "model_name string, roc_auc double, recall double, model_mb double, threshold double")

    def publish(name, event):
        return run.publish(spark, cands.withColumn("run_id", F.lit(name)), paths, name, event).first()

    def state():
        seen = [sorted(map(str, run.seen(spark, paths, t).collect())) for t in ("versions", "alias_events", "production_history")]
        return seen, str(run.serving_metadata(spark, paths).first())

    publish("r1", 1)
    before = state()
    write, commit = records.write_event, records.commit

    def dying(df, path, event):
        if path.endswith(dies_at):
            raise OSError("lost")
        return write(df, path, event)

    def no_commit(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(records, "write_event", dying)
        if dies_at == "commits":
            m.setattr(records, "commit", no_commit)
        with pytest.raises(OSError):
            publish("r2", 2)
    assert state() == before
    first = publish("r2", 2)
    after = state()
    assert first["promoted_version"] == 3 and len(after[0][0]) == 4 and len(after[0][1]) == 2
    assert publish("r2", 2) == first and state() == after
    with monkeypatch.context() as m:
        m.setattr(records, "commit", no_commit)
        with pytest.raises(OSError):
            run.rollback(spark, paths, 3)
    assert state() == after
    move = run.rollback(spark, paths, 3).first()
    assert (move["current"], move["target"]) == (3, 1) and run.rollback(spark, paths, 3).first() == move
    assert run.serving_metadata(spark, paths).first()["version"] == 1 and commit is records.commit


@pytest.fixture(scope="module")
def model(spark):
    parts = split.time_split(weather(spark, 480), "Date", target="RainTomorrow")
    versions, rows, _ = models.train_candidates(parts, WEATHER, ["logreg"])
    return versions["logreg"], rows.first(), parts


def test_scoring(spark, model):
    version, row, parts = model
    out = models.score_table(parts.where("split = 'test'"), WEATHER, version, ACTION_YES, ACTION_NO)
    rows = out.collect()
    assert len(rows) == row["n_rows"]
    for r in rows:
        assert 0 <= r["proba"] <= 1
        assert r["action"] == (ACTION_YES if r["proba"] >= version.threshold else ACTION_NO)


def test_monitor_exercise_and_cycle(spark, model):
    version, _, parts = model
    out = run.monitor_exercise(
        parts.drop("split"), WEATHER, SHIFT, lambda df: models.score(df, WEATHER, version), version.threshold, size=200
    )
    kinds = {r["window_id"]: r for r in out.collect()}
    assert kinds["data_drift"]["kind"] == "data_drift" and kinds["data_drift"]["retrain"]
    assert kinds["clean"]["kind"] in ("stable", "data_drift")
    assert run.retrain_cycle(out) == (kinds["data_drift"]["retrain"] and kinds["concept_2"]["retrain"])


def test_retrain_recent(spark):
    out = run.retrain_recent(weather(spark, 480), WEATHER, serving_auc=0.99999, model_mb=0.5, overrides=SMALL).first()
    assert out["model_name"] == "gbt" and out["baseline_auc"] == 0.99999 and not out["selected"]


def test_retraining_ends_in_a_decision(spark, tmp_path):
    paths = run.Paths(str(tmp_path / "p"))
    first = run.retrain_run(spark, weather(spark, 480), WEATHER, paths, "n1", 1, overrides=SMALL).first()
    assert first["promoted"] and first["winner"] == "gbt"
    versions = spark.read.parquet(paths.table("versions")).first()
    assert versions["model_mb"] > 0 and run.serving_version(spark, paths).version == "1"
    # the same table again can't improve on the version that serves unless it is at least as good
    again = run.retrain_run(spark, weather(spark, 480), WEATHER, paths, "n2", 2, overrides=SMALL).first()
    assert again["n_candidates"] == 1 and again["next"] in ("push", "skip")
    bad = weather(spark, 60).withColumn("Humidity3pm", F.lit(140.0))
    with pytest.raises(ContractError):
        run.retrain_run(spark, bad, WEATHER, paths, "n3", 3, overrides=SMALL)
    alerts = records.open_alerts(records.read_records(spark, paths.table("alerts")), ["source"], "event_seq")
    assert alerts.first()["run_id"] == "n3"


def test_the_cycle_starts_a_retrain_when_both_triggers_fired(spark):
    def decisions(*fired):
        rows = [(w, w in fired) for w in ("clean", "data_drift", "concept_1", "concept_2")]
        return spark.createDataFrame(rows, "window_id string, retrain boolean")

    started = []
    assert run.retrain_cycle(decisions("data_drift", "concept_2"), lambda: started.append(1))
    assert not run.retrain_cycle(decisions("data_drift"), lambda: started.append(2))
    assert started == [1]


def test_candidate_subset():
    assert models.candidates(["forest"]) == ["forest"]
    assert models.candidates() == ["logreg", "gbt", "forest"]


def test_a_cycle_starts_only_when_every_trigger_fired(spark):
    def told(rows):
        found = run.cycle_triggers(spark.createDataFrame(rows, "window_id string, retrain boolean"))
        return {r["window_id"]: (r["fired"], r["starts"]) for r in found.collect()}

    both = told([("clean", False), ("data_drift", True), ("concept_1", False), ("concept_2", True)])
    assert both == {"data_drift": (True, True), "concept_2": (True, True)}
    assert told([("data_drift", True), ("concept_2", False)]) == {"data_drift": (True, False), "concept_2": (False, False)}
    assert told([("data_drift", True)]) == {"data_drift": (True, False), "concept_2": (False, False)}
    assert told([]) == {"data_drift": (False, False), "concept_2": (False, False)}
