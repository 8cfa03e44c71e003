"""Streaming queries: a bounded run over the events table, then a read of the sink.

Window results hold closed windows only, so their SQL stops at the watermark line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.columns import rounded
from driftline.operators import models
from driftline.operators import telemetry as K
from driftline.plans.catalog.base import ORACLES, q6, r6, register, table
from driftline.plans.catalog.drift_queries import psi_sql, tv_sql
from driftline.plans.catalog.telemetry_queries import SLIDE_SQL, as_log, ntz, p95_sql
from driftline.session import scratch_path
from driftline.spec import TableSpec, between, flatten, isin, not_null
from driftline.streaming import core, jobs

REQUESTS = TableSpec(
    name="requests",
    key=("event_id",),
    date="day",
    numeric=("value",),
    categorical=("event_type",),
    target="outcome",
    rules=flatten(
        [
            not_null("day"),
            between("value", 0, 300),
            isin("event_type", "signup", "purchase", "view", "click"),
            isin("outcome", "Yes", "No", training=True),
        ]
    ),
)

LINE_SQL = """
line AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE AS line FROM events)
"""


def stream(spark: SparkSession, sf: str) -> DataFrame:
    return core.parquet_stream(spark, sf, "events.parquet")


def _sink(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    core.finish(core.append_sink(df, path, scratch_path(spark, f"{name}-state")))
    return path


def _append(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    return spark.read.schema(df.schema).parquet(_sink(spark, df, name))


def as_requests(events: DataFrame) -> DataFrame:
    return events.withColumn("day", F.col("ts").cast("date"))


@register(
    "stream_gate",
    """WITH r AS (SELECT concat_ws('; ', CASE WHEN value > 300 THEN 'value less_than_or_equal_to(300)' END,
          CASE WHEN event_type = 'error' THEN 'event_type isin([''signup'', ''purchase'', ''view'', ''click''])' END) AS reasons FROM events)
       SELECT reasons, count(*) AS n_rows FROM r GROUP BY 1""",
)
def stream_gate(spark: SparkSession, sf: str) -> DataFrame:
    good, bad, state = (scratch_path(spark, n) for n in ("accepted", "quarantine", "gate-state"))
    core.finish(jobs.gate_stream(as_requests(stream(spark, sf)), REQUESTS, good, bad, state))
    accepted = core.read_batches(spark, good).withColumn("reasons", F.lit(""))
    rejected = core.read_batches(spark, bad).withColumn("reasons", F.concat_ws("; ", "reasons"))
    both = accepted.select("reasons").unionByName(rejected.select("reasons"))
    return both.groupBy("reasons").agg(F.count("*").alias("n_rows"))


def _scored_stream(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(scored answers, refused requests) of a run over the events."""
    events = as_requests(table(spark, sf, "events"))
    truth = (F.col("value") > 50) != (F.col("event_id") % 10 == 0)
    labelled = events.withColumn("outcome", F.when(truth, F.lit("Yes")).otherwise(F.lit("No")))
    third = F.when(F.col("event_id") % 3 == 0, "test").when(F.col("event_id") % 3 == 1, "val").otherwise("train")
    versions, _, _ = models.train_candidates(labelled.withColumn("split", third), REQUESTS, ["logreg"])
    out, refused, state = (scratch_path(spark, n) for n in ("scored", "refused", "score-state"))
    query = jobs.score_stream(
        as_requests(stream(spark, sf)), REQUESTS, lambda: versions["logreg"], out, state, "act", "wait", ["event_id"], refused
    )
    core.finish(query)
    return core.read_batches(spark, out), core.read_batches(spark, refused)


@register("stream_score")
def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    return _scored_stream(spark, sf)[0].groupBy("action", "model_name").agg(F.count("*").alias("n_rows"))


@register(
    "stream_score_gate",
    """WITH r AS (SELECT concat_ws('; ', CASE WHEN value > 300 THEN 'value less_than_or_equal_to(300)' END,
          CASE WHEN event_type = 'error' THEN 'event_type isin([''signup'', ''purchase'', ''view'', ''click''])' END) AS reasons FROM events)
       SELECT reasons, count(*) AS n_rows FROM r GROUP BY 1""",
)
def stream_score_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Every request is either scored or refused with its reasons."""
    scored, refused = _scored_stream(spark, sf)
    both = scored.select(F.lit("").alias("reasons")).unionByName(refused.select(F.concat_ws("; ", "reasons").alias("reasons")))
    return both.groupBy("reasons").agg(F.count("*").alias("n_rows"))


@register(
    "stream_rate",
    f"""WITH {SLIDE_SQL}, {LINE_SQL} SELECT window_start, window_end, count(*) AS requests,
        {q6('count(*) / 300.0::DOUBLE')} AS rate FROM sl, line WHERE window_end <= line GROUP BY 1, 2""",
)
def stream_rate(spark: SparkSession, sf: str) -> DataFrame:
    out = _append(spark, jobs.rate_stream(as_log(stream(spark, sf)), "ts"), "rate")
    return out.select(ntz("window_start"), ntz("window_end"), "requests", r6("rate"))


@register(
    "stream_p95",
    f"""WITH {SLIDE_SQL}, {LINE_SQL}, {p95_sql('sl')}
        SELECT window_end, requests, {q6('p95_seconds')} AS p95_seconds FROM p95, line WHERE window_end <= line""",
)
def stream_p95(spark: SparkSession, sf: str) -> DataFrame:
    out = _append(spark, jobs.p95_stream(as_log(stream(spark, sf)), "ts"), "p95")
    return out.select(ntz("window_end"), "requests", r6("p95_seconds"))


@register("stream_dedup", "SELECT event_type, count(*) AS n_rows FROM events GROUP BY 1")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    twice = stream(spark, sf).unionByName(stream(spark, sf).where("event_id % 7 = 0"))
    out = _append(spark, jobs.dedup_stream(twice, "ts", ["event_id"]), "dedup")
    return out.groupBy("event_type").agg(F.count("*").alias("n_rows"))


EVENT_LABEL_SQL = "CASE WHEN (value > 50) <> (event_id % 10 = 0) THEN 1 ELSE 0 END"
EVENT_SCORE_SQL = "floor(least(value / 100.0::DOUBLE, 1) * 1e4 + 0.5) / 1e4"


def event_label() -> Column:
    return ((F.col("value") > 50) != (F.col("event_id") % 10 == 0)).cast("int")


def event_score() -> Column:
    return rounded(F.least(F.col("value") / F.lit(100.0), F.lit(1.0)), 4)


@register(
    "stream_feedback",
    f"""WITH p AS (SELECT date_trunc('day', ts) AS window_start, {EVENT_LABEL_SQL} AS label, {EVENT_SCORE_SQL} AS proba FROM events
                   WHERE event_id % 5 <> 0)
        SELECT window_start, count(*) FILTER (WHERE proba >= 0.5::DOUBLE AND label = 1) AS tp,
          count(*) FILTER (WHERE proba >= 0.5::DOUBLE AND label = 0) AS fp,
          count(*) FILTER (WHERE proba < 0.5::DOUBLE AND label = 1) AS fn,
          count(*) FILTER (WHERE proba < 0.5::DOUBLE AND label = 0) AS tn,
          {q6('coalesce(count(*) FILTER (WHERE proba >= 0.5::DOUBLE AND label = 1) / nullif(sum(label), 0)::DOUBLE, 0)')} AS recall
        FROM p GROUP BY 1""",
)
def stream_feedback(spark: SparkSession, sf: str) -> DataFrame:
    """Labels arrive a day later; one in five arrives after three days, outside the bound."""
    predictions = stream(spark, sf).select("event_id", "ts", event_score().alias("proba"))
    delay = F.when(F.col("event_id") % 5 == 0, F.expr("INTERVAL 3 DAYS")).otherwise(F.expr("INTERVAL 1 DAY"))
    labels = stream(spark, sf).select("event_id", (F.col("ts") + delay).alias("label_ts"), event_label().alias("label"))
    joined = jobs.feedback_join(predictions, labels, ["event_id"], "ts", "label_ts")
    pairs = _append(spark, joined, "feedback")
    out = jobs.realized_by_window(pairs, "ts", "1 day", 0.5)
    return out.select(ntz("window_start"), "tp", "fp", "fn", "tn", r6("recall"))


@register(
    "stream_unmatched",
    f"""WITH {LINE_SQL} SELECT date_trunc('day', ts) AS window_start, count(*) AS predictions,
          count(*) FILTER (WHERE event_id % 5 = 0) AS unmatched FROM events, line
        GROUP BY 1, line HAVING date_trunc('day', ts) + INTERVAL 3 DAY <= line""",
)
def stream_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions without a label in time, for days of which every prediction has expired by the end of the run."""
    predictions = stream(spark, sf).select("event_id", "ts", event_score().alias("proba"))
    delay = F.when(F.col("event_id") % 5 == 0, F.expr("INTERVAL 3 DAYS")).otherwise(F.expr("INTERVAL 1 DAY"))
    labels = stream(spark, sf).select("event_id", (F.col("ts") + delay).alias("label_ts"), event_label().alias("label"))
    joined = jobs.feedback_join(predictions, labels, ["event_id"], "ts", "label_ts", unmatched=True)
    pairs = _append(spark, joined, "unmatched")
    line = table(spark, sf, "events").agg((F.max("ts") - F.expr("INTERVAL 10 MINUTES")).alias("line"))
    out = jobs.coverage_by_window(pairs, "ts", "1 day").withColumn("window_start", ntz("window_start"))
    closed = F.col("window_start") + F.expr("INTERVAL 3 DAYS") <= F.date_trunc("MILLISECOND", "line").cast("timestamp_ntz")
    return out.join(F.broadcast(line), closed).drop("line")


@register(
    "stream_late",
    """WITH b AS (SELECT event_id % 3 AS batch, ts FROM events),
       m AS (SELECT batch, max(ts) - INTERVAL 10 MINUTE AS line FROM b GROUP BY 1),
       r AS (SELECT batch, max(line) OVER (ORDER BY batch) AS line,
               max(line) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM m)
       SELECT batch, any_value(line) AS line, count(*) AS n_rows, count(*) FILTER (WHERE ts < before) AS n_late
       FROM b JOIN r USING (batch) GROUP BY batch""",
)
def stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """Events arriving in three parts without order: the rows of each micro-batch that are behind the watermark."""
    folder, out, state = (scratch_path(spark, n) for n in ("arrivals-in", "arrivals", "arrivals-state"))
    events = table(spark, sf, "events").select("event_id", "ts")
    for k in range(3):
        events.where(F.col("event_id") % 3 == k).write.mode("append").parquet(folder)
        source = spark.readStream.schema(events.schema).parquet(folder)
        core.finish(jobs.arrivals_stream(source, "ts", out, state))
    return spark.read.parquet(out).select(F.col("batch").cast("long").alias("batch"), ntz("line"), "n_rows", "n_late")


@register(
    "stream_alerts",
    f"""WITH line AS (SELECT max(ts) FILTER (WHERE event_type <> 'signup') - INTERVAL 10 MINUTE AS calls,
          max(ts) FILTER (WHERE event_type = 'error') - INTERVAL 10 MINUTE AS refused FROM events)
        SELECT a.* FROM ({ORACLES['alerts_hold']}) a, line
        WHERE fired_at <= date_trunc('millisecond', CASE alert WHEN 'high_latency' THEN calls ELSE refused END)""",
)
def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts with hold over the sinks of the p95 and rejection streams."""
    calls = as_log(stream(spark, sf))
    slow = jobs.p95_stream(calls.where("endpoint = 'predict'"), "ts")
    refused = jobs.rate_stream(calls.where("status = 'rejected'"), "ts")
    found = []
    for df, rule, met, hold in (
        (slow, "high_latency", F.col("p95_seconds") > K.P95_ALERT_SECONDS, 60.0),
        (refused, "schema_rejections", F.col("rate") > 0, 0.0),
    ):
        series = spark.readStream.schema(df.schema).parquet(_sink(spark, df, f"series-{rule}"))
        found.append(_append(spark, jobs.alert_stream(series, rule, met, hold, "warning", "window_end"), f"alert-{rule}"))
    return K.alerts(found).select("alert", "severity", ntz("fired_at"))


def _drift_history(spark: SparkSession, sf: str) -> DataFrame:
    def scored(df: DataFrame) -> DataFrame:
        return df.withColumns({"label": event_label(), "proba": event_score()})

    ref = table(spark, sf, "events").where(F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz"))
    work, history, state = (scratch_path(spark, n) for n in ("drift-work", "history", "drift-state"))
    query = jobs.drift_stream(
        scored(stream(spark, sf)), ref, REQUESTS, "ts", "5 days", 0.5, work, history, state
    )
    core.finish(query)
    return core.read_batches(spark, history)


DRIFT_SQL = f"""
p AS (SELECT time_bucket(INTERVAL 5 DAY, ts, TIMESTAMP '1970-01-01') AS window_start, value, event_type,
        {EVENT_LABEL_SQL} AS label, {EVENT_SCORE_SQL} AS proba FROM events), {LINE_SQL},
ref AS (SELECT value, event_type FROM events WHERE ts < TIMESTAMP '2024-01-11'),
cur AS (SELECT p.* FROM p, line WHERE window_start + INTERVAL 5 DAY <= line), {psi_sql('window_start', ['value'])},
{tv_sql('window_start', txt=['event_type'])},
sc AS (SELECT window_start, score FROM psi
       UNION ALL SELECT window_start, 0.5 * sum(abs(p - q)) FROM tsh GROUP BY window_start, "column"),
sh2 AS (SELECT window_start, floor(avg((score >= 0.2::DOUBLE)::INT) * 1e4 + 0.5) / 1e4 AS drift_share FROM sc GROUP BY 1),
rc AS (SELECT window_start, floor(coalesce(count(*) FILTER (WHERE proba >= 0.5::DOUBLE AND label = 1)
         / nullif(sum(label), 0)::DOUBLE, 0) * 1e4 + 0.5) / 1e4 AS realized_recall FROM cur GROUP BY 1),
mon AS (SELECT * FROM sh2 JOIN rc USING (window_start))
"""


@register(
    "stream_drift",
    f"""WITH {DRIFT_SQL}
        SELECT window_start, drift_share, realized_recall, CASE WHEN drift_share >= 0.30::DOUBLE THEN 'data_drift'
          WHEN realized_recall < 0.60::DOUBLE THEN 'concept_drift' ELSE 'stable' END AS kind FROM mon""",
)
def stream_drift(spark: SparkSession, sf: str) -> DataFrame:
    return _drift_history(spark, sf).select(ntz("window_start"), "drift_share", "realized_recall", "kind")


@register(
    "stream_retrain",
    f"""WITH {DRIFT_SQL}, l AS (SELECT *, lag(realized_recall) OVER (ORDER BY window_start) AS before FROM mon),
        d AS (SELECT *, CASE WHEN drift_share >= 0.30::DOUBLE THEN 'data_drift' END AS a,
          CASE WHEN realized_recall < 0.60::DOUBLE AND before < 0.60::DOUBLE THEN 'concept_drift_two_windows' END AS b FROM l)
        SELECT window_start, drift_share, realized_recall, CASE WHEN drift_share >= 0.30::DOUBLE THEN 'data_drift'
          WHEN realized_recall < 0.60::DOUBLE THEN 'concept_drift' ELSE 'stable' END AS kind,
          concat_ws(',', a, b) AS reasons, a IS NOT NULL OR b IS NOT NULL AS retrain FROM d""",
)
def stream_retrain(spark: SparkSession, sf: str) -> DataFrame:
    out = jobs.retrain_stream(_drift_history(spark, sf))
    return out.select(ntz("window_start"), "drift_share", "realized_recall", "kind", F.concat_ws(",", "reasons").alias("reasons"), "retrain")
