"""Bounded streams over several micro-batches against the batch operators."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from driftline.functions.columns import unit_hash
from driftline.operators import contract, drift, models, tally, telemetry
from driftline.plans.catalog.stream_queries import REQUESTS
from driftline.streaming import core, jobs

DAYS = 12
SCHEMA = "event_id bigint, ts timestamp, event_type string, value double"


def events(spark):
    u = lambda n: unit_hash([F.col("id"), F.lit(n)], 3)
    kinds = F.array(*[F.lit(k) for k in ("signup", "purchase", "view", "click", "error")])
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return spark.range(600).select(
        F.col("id").alias("event_id"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * (DAYS * 1440 // 600)).cast("int"))).alias("ts"),
        F.element_at(kinds, (F.floor(u("k") * 5) + 1).cast("int")).alias("event_type"),
        F.round(u("v") * 400, 2).alias("value"),
    )


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """Three files in time order, one micro-batch each."""
    folder = str(tmp_path_factory.mktemp("events"))
    df = events(spark)
    for i in range(3):
        part = df.where((F.col("event_id") >= i * 200) & (F.col("event_id") < (i + 1) * 200)).toPandas()
        part["ts"] = part["ts"].dt.tz_localize("UTC")
        name = os.path.join(folder, f"part{i}.parquet")
        part.to_parquet(name, coerce_timestamps="us", allow_truncated_timestamps=True)
        os.utime(name, (time.time() - 100 + i, time.time() - 100 + i))
    return folder


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def with_day(df):
    return df.withColumn("day", F.col("ts").cast("date"))


def paths(tmp_path, *names):
    return [str(tmp_path / n) for n in names]


def test_gate_equals_batch(spark, source, tmp_path):
    good, bad, state = paths(tmp_path, "good", "bad", "state")
    core.finish(jobs.gate_stream(with_day(stream(spark, source)), REQUESTS, good, bad, state))
    a, q = contract.gate_rows(with_day(events(spark)), REQUESTS)
    ids = lambda df: sorted(r[0] for r in df.select("event_id").collect())
    assert ids(core.read_batches(spark, good)) == ids(a)
    assert ids(core.read_batches(spark, bad)) == ids(q)
    # A restart finds nothing new and changes nothing.
    core.finish(jobs.gate_stream(with_day(stream(spark, source)), REQUESTS, good, bad, state))
    assert ids(core.read_batches(spark, good)) == ids(a)


def test_rate_and_p95_equal_batch_on_closed_windows(spark, source, tmp_path):
    log = stream(spark, source).withColumn("latency_ms", F.col("value"))
    batch = events(spark).withColumn("latency_ms", F.col("value"))
    line = batch.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    out, state, out2, state2 = paths(tmp_path, "rate", "rs", "p95", "ps")
    rate = jobs.rate_stream(log, "ts", width="60 minutes", slide="30 minutes", seconds=3600.0)
    core.finish(core.append_sink(rate, out, state))
    got = {(r["window_start"], r["window_end"]): r["requests"] for r in spark.read.schema(rate.schema).parquet(out).collect()}
    want = telemetry.rolling(batch, "60 minutes", "30 minutes").groupBy("w").count().collect()
    want = {(r["w"]["start"], r["w"]["end"]): r["count"] for r in want if r["w"]["end"] <= line}
    assert got == want
    p95 = jobs.p95_stream(log, "ts", width="60 minutes", slide="30 minutes")
    core.finish(core.append_sink(p95, out2, state2))
    got = {r["window_end"]: r["p95_seconds"] for r in spark.read.schema(p95.schema).parquet(out2).collect()}
    counted = telemetry.bucket_counts(telemetry.rolling(batch, "60 minutes", "30 minutes"), ["w"])
    rows = counted.select(F.col("w.end").alias("e"), telemetry.bucket_quantile(0.95).alias("p")).collect()
    assert got == {r["e"]: r["p"] for r in rows if r["e"] <= line}


def test_dedup(spark, source, tmp_path):
    out, state = paths(tmp_path, "dedup", "state")
    twice = stream(spark, source).unionByName(stream(spark, source).where("event_id % 7 = 0"))
    unique = jobs.dedup_stream(twice, "ts", ["event_id"], "2 days")
    core.finish(core.append_sink(unique, out, state))
    df = spark.read.schema(unique.schema).parquet(out)
    assert df.count() == 600 and df.select("event_id").distinct().count() == 600


def test_feedback_pairs_only_labels_in_time(spark, source, tmp_path):
    out, state = paths(tmp_path, "pairs", "state")
    p = stream(spark, source).select("event_id", "ts", (F.col("value") / 400).alias("proba"))
    late = F.when(F.col("event_id") % 5 == 0, F.expr("INTERVAL 3 DAYS")).otherwise(F.expr("INTERVAL 1 DAY"))
    l = stream(spark, source).select("event_id", (F.col("ts") + late).alias("label_ts"), (F.col("event_id") % 2).cast("int").alias("label"))
    joined = jobs.feedback_join(p, l, ["event_id"], "ts", "label_ts", delay="5 days")
    core.finish(core.append_sink(joined, out, state))
    pairs = spark.read.schema(joined.schema).parquet(out)
    assert sorted(r[0] for r in pairs.select("event_id").collect()) == [i for i in range(600) if i % 5]
    assert jobs.realized_by_window(pairs, "ts", "1 day", 0.5).agg(F.sum(F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))).first()[0] == 480


def test_drift_reports_each_closed_window_once(spark, source, tmp_path):
    staged, history, state = paths(tmp_path, "staged", "history", "state")
    scored = lambda df: df.withColumns({"label": (F.col("event_id") % 2).cast("int"), "proba": F.col("value") / 400})
    ref = events(spark).where("event_id < 150")
    started = []
    query = jobs.drift_stream(
        scored(stream(spark, source)), ref, REQUESTS, "ts", "2 days", 0.5, staged, history, state,
        second=True, on_report=jobs.retrain_trigger(started.append),
    )
    core.finish(query)
    got = core.read_batches(spark, history)
    batch = scored(events(spark)).withColumn("window_start", F.window("ts", "2 days")["start"])
    line = batch.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    want = drift.monitor_windows(ref, batch, REQUESTS, ["window_start"], 0.5)
    want = want.where(F.col("window_start") + F.expr("INTERVAL 2 DAYS") <= F.lit(line))
    cols = ["window_start", "drift_share", "psi_share", "second_share", "realized_recall", "realized_roc_auc", "kind"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())
    assert got.count() == got.select("window_start").distinct().count() >= 4
    decisions = jobs.retrain_stream(got)
    assert decisions.count() == got.count()
    last = [r["retrain"] for r in decisions.orderBy("window_start").collect()]
    assert bool(started) >= last[-1] and all(started)


def test_drift_state_holds_counters_and_no_rows(spark, source, tmp_path):
    work, history, state = paths(tmp_path, "work", "history", "state")
    scored = lambda df: df.withColumns({"label": (F.col("event_id") % 2).cast("int"), "proba": (F.col("event_id") % 4) / 4.0})
    query = jobs.drift_stream(scored(stream(spark, source)), events(spark).where("event_id < 150"), REQUESTS, "ts", "2 days", 0.5, work, history, state)
    core.finish(query)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    # A window: 10 bins, outside, missing; 5 categories; 4 scores. At most a batch's windows and one before are open.
    assert max(held) <= 4 * (12 + 5 + 4) and held[-1] <= 2 * (12 + 5 + 4)
    stored = {p.relative_to(work).parts[0] for p in (tmp_path / "work").rglob("*.parquet")}
    assert stored == {"profile", "counters", "tail"}
    assert len(list((tmp_path / "work" / "counters").iterdir())) <= 2 and len(list((tmp_path / "work" / "tail").iterdir())) <= 3


def test_counted_windows_give_the_same_record(spark):
    rows = events(spark).withColumns(
        {
            "label": F.when(F.col("event_id") % 17 > 0, (F.col("event_id") % 2)).cast("int"),
            "proba": F.when(F.col("event_id") % 19 > 0, F.col("value") / 400).otherwise(F.lit(float("nan"))),
            "value": F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 11 == 0, float("inf")).otherwise(F.col("value")),
            "event_type": F.when(F.col("event_id") % 5 > 0, F.col("event_type")),
            "w": F.col("event_id") % 3,
        }
    )
    known = drift.reference_profile(rows.where("event_id < 150"), REQUESTS)
    want = drift.monitor_windows(known, rows, REQUESTS, ["w"], 0.5)
    got = drift.monitor_windows(known, tally.tally(rows, known, ["w"], 0.5, values=True), REQUESTS, ["w"], 0.5)
    assert sorted(got.collect()) == sorted(want.collect())


def test_late_rows_are_counted(spark, tmp_path):
    folder, work, history, state, late, late_state, good, bad, gate_late, gate_state = paths(
        tmp_path, "in", "work", "history", "state", "late", "late-state", "good", "bad", "gate-late", "gate-state"
    )
    rows = events(spark).withColumns({"label": (F.col("event_id") % 2).cast("int"), "proba": F.col("value") / 400})
    last = rows.agg(F.max("ts")).first()[0]
    ref = events(spark).where("event_id < 150")

    def feed(df):
        df.coalesce(1).write.mode("append").parquet(folder)
        source = lambda: spark.readStream.schema(rows.schema).parquet(folder)
        core.finish(jobs.drift_stream(source(), ref, REQUESTS, "ts", "2 days", 0.5, work, history, state))
        core.finish(jobs.arrivals_stream(source(), "ts", late, late_state, width="2 days"))
        core.finish(jobs.gate_stream(with_day(source()), REQUESTS, good, bad, gate_state, ts="ts", arrivals=gate_late))

    feed(rows)
    first = core.read_batches(spark, history).count()
    feed(rows.where(F.col("ts") < F.lit(last - dt.timedelta(days=3))).limit(7))
    for table in (late, gate_late):
        told = spark.read.parquet(table).orderBy("batch").collect()
        assert [(r.n_rows, r.n_late) for r in told] == [(600, 0), (7, 7)]
        assert {r.line for r in told} == {last - dt.timedelta(minutes=10)}
    assert core.read_batches(spark, history).count() == first


def test_unmatched_predictions_are_emitted(spark, source, tmp_path):
    out, state = paths(tmp_path, "pairs", "state")
    p = stream(spark, source).select("event_id", "ts", (F.col("value") / 400).alias("proba"))
    late = F.when(F.col("event_id") % 5 == 0, F.expr("INTERVAL 3 DAYS")).otherwise(F.expr("INTERVAL 1 DAY"))
    l = stream(spark, source).select("event_id", (F.col("ts") + late).alias("label_ts"), (F.col("event_id") % 2).cast("int").alias("label"))
    joined = jobs.feedback_join(p, l, ["event_id"], "ts", "label_ts", delay="1 day", unmatched=True)
    core.finish(core.append_sink(joined, out, state))
    rows = spark.read.schema(joined.schema).parquet(out).collect()
    assert sorted(r.event_id for r in rows if r.label is not None) == [i for i in range(600) if i % 5]
    lost = sorted(r.event_id for r in rows if r.label is None)
    line = events(spark).agg(F.max("ts")).first()[0] - dt.timedelta(days=3)
    assert lost == [r.event_id for r in events(spark).where("event_id % 5 = 0").orderBy("event_id").collect() if r.ts < line]
    told = jobs.coverage_by_window(spark.read.schema(joined.schema).parquet(out), "ts", "1 day").agg(F.sum("predictions"), F.sum("unmatched")).first()
    assert tuple(told) == (len(rows), len(lost))


@pytest.mark.parametrize("hold", [0.0, 60.0, 150.0])
def test_alerts_on_a_stream_equal_the_batch(spark, tmp_path, hold):
    folder, out, state = paths(tmp_path, "series", "alerts", "state")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    gap = F.when(F.col("id") > 40, 300).otherwise(0)  # an hour's silence in the middle would drop the state
    series = spark.range(80).select(
        (F.col("id") % 2).alias("host"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.floor(F.col("id") / 2) * 60 + gap).cast("decimal(18,6)"))).alias("at"),
        F.when(F.col("id") % 23 > 0, unit_hash([F.col("id")], 5)).alias("v"),
    )
    met = F.col("v") > 0.35
    want = telemetry.alert_islands(series, "slow", met, hold, "warning", "at", ["host"], 60.0)
    fired = lambda df: sorted(tuple(r) for r in df.select("host", "alert", "severity", "fired_at", "pending_since", "held_seconds").collect())
    for i in range(4):
        series.where(f"at >= timestamp'2024-01-01 00:00:00' + INTERVAL {i * 11} MINUTE AND at < timestamp'2024-01-01 00:00:00' + INTERVAL {(i + 1) * 11 if i < 3 else 999} MINUTE").coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(series.schema).parquet(folder)
        core.finish(core.append_sink(jobs.alert_stream(source, "slow", met, hold, "warning", "at", ["host"]), out, state))
    got = fired(spark.read.parquet(out))
    assert got == fired(want) and got


def test_scoring_follows_the_alias_and_keeps_refusals(spark, tmp_path):
    folder, out, refused, state = paths(tmp_path, "in", "out", "refused", "state")
    rows = with_day(events(spark)).withColumn("outcome", F.when(F.col("event_id") % 2 == 0, "Yes").otherwise("No"))
    third = F.when(F.col("event_id") % 3 == 0, "test").when(F.col("event_id") % 3 == 1, "val").otherwise("train")
    good, _ = contract.gate_rows(rows, REQUESTS)
    versions, _, _ = models.train_candidates(good.withColumn("split", third), REQUESTS, ["logreg"], overrides={"logreg": {"maxIter": 5}})
    saved = str(tmp_path / "model")
    versions["logreg"].pipeline.write().overwrite().save(saved)
    alias = {"version": "1"}

    def current():
        return models.load_version(saved, 0.5, "logreg", alias["version"])

    def feed(df):
        df.coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(rows.schema).parquet(folder)
        core.finish(jobs.score_stream(source, REQUESTS, current, out, state, "act", "wait", ["event_id"], refused))

    feed(rows.where("event_id < 300"))
    alias["version"] = "2"
    feed(rows.where("event_id >= 300"))
    got = core.read_batches(spark, out)
    split = {r["model_version"]: (r["lo"], r["hi"]) for r in got.groupBy("model_version").agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).collect()}
    assert split["1"][1] < 300 <= split["2"][0]
    bad = core.read_batches(spark, refused)
    assert got.count() + bad.count() == rows.count()
    assert bad.where("size(reasons) = 0").isEmpty() and not bad.isEmpty()
