import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from driftline.operators import telemetry as K

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def log(spark, rows):
    return spark.createDataFrame(
        [(T0 + dt.timedelta(seconds=s), "predict", st, float(ms), st == "ok") for s, st, ms in rows],
        "ts timestamp, endpoint string, status string, latency_ms double, positive boolean",
    )


def test_slo(spark):
    ms = np.random.default_rng(1).exponential(60, 200)
    df = log(spark, [(i * 0.05, "ok", v) for i, v in enumerate(ms)])
    r = K.slo_report(df).first()
    assert np.allclose([r["p50_ms"], r["p95_ms"]], np.percentile(ms, [50, 95]), rtol=0, atol=1e-9)
    assert abs(r["throughput_rps"] - 200 / 9.95) < 1e-9 and r["throughput_pass"]


def test_histogram_and_bucket_quantile(spark):
    df = log(spark, [(0, "ok", 5), (1, "ok", 20), (2, "ok", 120), (3, "ok", 4000)])
    h = {r["le"]: r["requests"] for r in K.latency_histogram(df).collect()}
    assert h[0.005] == 1 and h[0.025] == 2 and h[0.15] == 3 and h[1.0] == 3 and h[float("inf")] == 4
    b = K.bucket_counts(df, [])
    assert b.select(K.bucket_quantile(0.95)).first()[0] == 1.0
    assert abs(b.select(K.bucket_quantile(0.5)).first()[0] - 0.025) < 1e-12
    assert abs(b.select(K.bucket_quantile(0.625)).first()[0] - 0.125) < 1e-12
    assert K.bucket_counts(df.where("false"), []).select(K.bucket_quantile(0.95)).first()[0] is None


def test_hold_time(spark):
    on = [*range(15, 81, 5), *range(120, 140, 5)]
    series = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), s in on) for s in range(0, 200, 5)], "ts timestamp, bad boolean")
    fired = K.alert_islands(series, "a", F.col("bad"), 60.0, "warning").orderBy("fired_at").collect()
    assert [(r["fired_at"].replace(tzinfo=dt.timezone.utc) - T0).total_seconds() for r in fired] == [75, 80]


def test_gap_ends_an_island(spark):
    at = [0, 60, 120, 600, 660]
    series = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), True) for s in at], "ts timestamp, bad boolean")
    fired = K.alert_islands(series, "a", F.col("bad"), 120.0, "warning", step_seconds=60.0).collect()
    assert len(fired) == 1
    assert K.alert_islands(series, "a", F.col("bad"), 0.0, "warning", step_seconds=60.0).count() == 5


def test_null_never_alerts(spark):
    series = spark.createDataFrame([(T0, None)], "ts timestamp, recall double")
    assert K.alert_islands(series, "a", F.col("recall") < 0.6, 0.0, "ticket").isEmpty()


def test_counts(spark):
    df = log(spark, [(0, "ok", 5), (1, "rejected", 1), (2, "ok", 3)]).withColumn("positive", F.col("latency_ms") > 4)
    assert {(r["status"], r["requests"]) for r in K.request_counts(df).collect()} == {("ok", 2), ("rejected", 1)}
    assert K.decision_counts(df).first().asDict() == {"positive": 1, "negative": 1, "rejected": 1}


def test_latest_gauges(spark):
    h = spark.createDataFrame([(1, 0.1, 0.9), (2, 0.4, None)], "seq int, drift_share double, recall double")
    r = K.latest_gauges(h, "seq", values=["drift_share", "recall"]).first()
    assert r["drift_share"] == 0.4 and r["recall"] is None
