"""Request-log queries; the events table plays the log (value = latency in ms)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import drift as D
from driftline.operators import telemetry as K
from driftline.plans.catalog import base as B
from driftline.plans.catalog import drift_queries as DQ
from driftline.plans.catalog.base import q6, r6, register, table

LOG_SQL = """
log AS (
  SELECT event_id, ts, CASE WHEN event_type = 'signup' THEN 'health' ELSE 'predict' END AS endpoint,
         CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'ok' END AS status,
         value AS latency_ms, value > 50 AS positive FROM events)
"""


def as_log(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        "event_id",
        "ts",
        F.when(kind == "signup", F.lit("health")).otherwise(F.lit("predict")).alias("endpoint"),
        F.when(kind == "error", F.lit("rejected")).otherwise(F.lit("ok")).alias("status"),
        F.col("value").alias("latency_ms"),
        (F.col("value") > 50).alias("positive"),
    )


def log(spark: SparkSession, sf: str) -> DataFrame:
    return as_log(table(spark, sf, "events"))


def ntz(c: str) -> Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


@register("request_counts", f"WITH {LOG_SQL} SELECT endpoint, status, count(*) AS requests FROM log GROUP BY 1, 2")
def request_counts(spark: SparkSession, sf: str) -> DataFrame:
    return K.request_counts(log(spark, sf))


@register(
    "decision_counts",
    f"""WITH {LOG_SQL} SELECT endpoint, count(*) FILTER (WHERE status = 'ok' AND positive) AS positive,
        count(*) FILTER (WHERE status = 'ok' AND NOT positive) AS negative,
        count(*) FILTER (WHERE status = 'rejected') AS rejected FROM log GROUP BY 1""",
)
def decision_counts(spark: SparkSession, sf: str) -> DataFrame:
    return K.decision_counts(log(spark, sf), ["endpoint"])


_BOUNDS = ", ".join(f"({i}, {b}::DOUBLE)" for i, b in enumerate(K.LATENCY_BUCKETS))


@register(
    "latency_histogram",
    f"""WITH {LOG_SQL}, b(i, le) AS (VALUES {_BOUNDS}, (9, 'Infinity'::DOUBLE))
        SELECT endpoint, CASE WHEN i = 9 THEN '+Inf' ELSE le::VARCHAR END AS le,
          count(*) FILTER (WHERE latency_ms / 1000.0::DOUBLE <= le) AS requests FROM log, b GROUP BY 1, 2""",
)
def latency_histogram(spark: SparkSession, sf: str) -> DataFrame:
    h = K.latency_histogram(log(spark, sf))
    le = F.when(F.col("le") == F.lit(float("inf")), F.lit("+Inf")).otherwise(F.col("le").cast("string"))
    return h.select("endpoint", le.alias("le"), "requests")


@register(
    "slo_report",
    f"""WITH {LOG_SQL}, a AS (
          SELECT endpoint, count(*) AS requests, quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95,
                 count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) AS rps FROM log GROUP BY 1)
        SELECT endpoint, requests, {q6('p50')} AS p50_ms, {q6('p95')} AS p95_ms, {q6('rps')} AS throughput_rps,
               p50 <= 100 AS p50_pass, p95 <= 150 AS p95_pass, rps >= 10 AS throughput_pass FROM a""",
)
def slo_report(spark: SparkSession, sf: str) -> DataFrame:
    out = K.slo_report(log(spark, sf), ["endpoint"])
    return out.select(
        "endpoint", "requests", r6("p50_ms"), r6("p95_ms"), r6("throughput_rps"), "p50_pass", "p95_pass", "throughput_pass"
    )


# Sliding 5-minute windows every minute: each request lies in five of them.
SLIDE_SQL = (
    LOG_SQL
    + """,
sl AS (SELECT log.*, date_trunc('minute', ts) - to_minutes(k) AS window_start,
              date_trunc('minute', ts) - to_minutes(k) + INTERVAL 5 MINUTE AS window_end FROM log, range(5) r(k))
"""
)


def p95_sql(source: str) -> str:
    return f"""
bk(i, lo, hi) AS (VALUES {", ".join(f"({i}, {0.0 if i == 0 else K.LATENCY_BUCKETS[i - 1]}::DOUBLE, {b}::DOUBLE)" for i, b in enumerate(K.LATENCY_BUCKETS))}),
cu AS (SELECT window_end, i, lo, hi, count(*) AS n, count(*) FILTER (WHERE latency_ms / 1000.0::DOUBLE <= hi) AS c,
              CASE WHEN i = 0 THEN 0 ELSE count(*) FILTER (WHERE latency_ms / 1000.0::DOUBLE <= lo) END AS u
       FROM {source}, bk GROUP BY 1, 2, 3, 4),
fi AS (SELECT window_end, max(n) AS n, min(CASE WHEN c >= 0.95::DOUBLE * n THEN i END) AS i FROM cu GROUP BY 1),
p95 AS (SELECT fi.window_end, fi.n AS requests, CASE WHEN fi.i IS NULL THEN 1.0::DOUBLE
          ELSE lo + (hi - lo) * ((0.95::DOUBLE * cu.n - u) / (c - u)::DOUBLE) END AS p95_seconds
        FROM fi LEFT JOIN cu ON cu.window_end = fi.window_end AND cu.i = fi.i)
"""


@register(
    "rejection_rate",
    f"""WITH {SLIDE_SQL} SELECT window_end, count(*) AS requests, count(*) FILTER (WHERE status = 'rejected') AS rejected,
        {q6("count(*) FILTER (WHERE status = 'rejected') / 300.0::DOUBLE")} AS rejected_per_s FROM sl GROUP BY 1""",
)
def rejection_rate(spark: SparkSession, sf: str) -> DataFrame:
    return K.rejection_rate(log(spark, sf)).select(ntz("window_end"), "requests", "rejected", r6("rejected_per_s"))


def p95_series(spark: SparkSession, sf: str) -> DataFrame:
    windows = K.rolling(log(spark, sf).where("endpoint = 'predict'"), "5 minutes", "1 minute")
    counted = K.bucket_counts(windows, ["w"])
    return counted.select(F.col("w.end").alias("window_end"), K.bucket_quantile(0.95).alias("p95_seconds"))


@register(
    "p95_rolling",
    f"""WITH {SLIDE_SQL}, pr AS (SELECT * FROM sl WHERE endpoint = 'predict'), {p95_sql('pr')}
        SELECT window_end, {q6('p95_seconds')} AS p95_seconds FROM p95""",
)
def p95_rolling(spark: SparkSession, sf: str) -> DataFrame:
    return p95_series(spark, sf).select(ntz("window_end"), r6("p95_seconds"))


@register(
    "alerts_hold",
    f"""WITH {SLIDE_SQL}, pr AS (SELECT * FROM sl WHERE endpoint = 'predict'), {p95_sql('pr')},
        m AS (SELECT window_end, p95_seconds > 0.15::DOUBLE AS met,
                coalesce(window_end - lag(window_end) OVER (ORDER BY window_end) > INTERVAL 60 SECOND, false) AS gap FROM p95),
        i AS (SELECT *, sum(CASE WHEN met AND NOT gap THEN 0 ELSE 1 END) OVER (ORDER BY window_end) AS island FROM m),
        s AS (SELECT window_end, min(window_end) OVER (PARTITION BY island) AS since FROM i WHERE met),
        rj AS (SELECT window_end FROM sl GROUP BY 1 HAVING count(*) FILTER (WHERE status = 'rejected') > 0)
        SELECT 'high_latency' AS alert, 'warning' AS severity, window_end AS fired_at FROM s
        WHERE epoch_us(window_end) - epoch_us(since) >= 60000000
        UNION ALL SELECT 'schema_rejections', 'warning', window_end FROM rj""",
)
def alerts_hold(spark: SparkSession, sf: str) -> DataFrame:
    slow = K.alert_islands(
        p95_series(spark, sf), "high_latency", F.col("p95_seconds") > K.P95_ALERT_SECONDS, 60.0, "warning",
        "window_end", step_seconds=60.0,
    )
    rejected = K.alert_islands(
        K.rejection_rate(log(spark, sf)), "schema_rejections", F.col("rejected_per_s") > 0, 0.0, "warning", "window_end",
        step_seconds=60.0,
    )
    return K.alerts([slow, rejected]).select("alert", "severity", ntz("fired_at"))


@register(
    "dashboard_series",
    f"""WITH {LOG_SQL}, sl AS (SELECT *, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end FROM log), {p95_sql('sl')}
        SELECT window_end, 'request_rate' AS series, {q6('requests / 60.0::DOUBLE')} AS value FROM p95
        UNION ALL SELECT window_end, 'p95_seconds', {q6('p95_seconds')} FROM p95""",
)
def dashboard_series(spark: SparkSession, sf: str) -> DataFrame:
    return K.dashboard_series(log(spark, sf)).select(ntz("window_end"), "series", r6("value"))


def history(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = DQ.windows(spark, sf)
    return D.monitor_windows(ref, cur, B.LINES, ["window_id"], DQ.THRESHOLD)


GAUGES = ["drift_share", "realized_recall", "realized_roc_auc"]


@register(
    "latest_gauges",
    f"""WITH {DQ.MONITOR_SQL} SELECT window_id, {DQ.r4_sql('drift_share')} AS drift_share, {DQ.r4_sql('recall')} AS realized_recall,
        {DQ.r4_sql('auc')} AS realized_roc_auc FROM mon WHERE window_id = (SELECT max(window_id) FROM mon)""",
)
def latest_gauges(spark: SparkSession, sf: str) -> DataFrame:
    return K.latest_gauges(history(spark, sf), "window_id", values=GAUGES)


@register(
    "gauge_alerts",
    f"""WITH {DQ.MONITOR_SQL} SELECT 'data_drift' AS alert, 'ticket' AS severity, make_timestamp(window_id, 1, 1, 0, 0, 0) AS fired_at
        FROM mon WHERE {DQ.r4_sql('drift_share')} >= 0.30::DOUBLE
        UNION ALL SELECT 'concept_drift', 'ticket', make_timestamp(window_id, 1, 1, 0, 0, 0)
        FROM mon WHERE {DQ.r4_sql('recall')} < 0.60::DOUBLE""",
)
def gauge_alerts(spark: SparkSession, sf: str) -> DataFrame:
    h = history(spark, sf).withColumn("at", F.make_date("window_id", F.lit(1), F.lit(1)).cast("timestamp"))
    moved = K.alert_islands(h, "data_drift", F.col("drift_share") >= D.DRIFT_SHARE_LIMIT, 0.0, "ticket", "at")
    weak = K.alert_islands(h, "concept_drift", F.col("realized_recall") < D.RECALL_RETRAIN, 0.0, "ticket", "at")
    return K.alerts([moved, weak]).select("alert", "severity", ntz("fired_at"))


@register(
    "gauge_series",
    f"""WITH {DQ.MONITOR_SQL} SELECT window_id, 'drift_share' AS series, {DQ.r4_sql('drift_share')} AS value FROM mon
        UNION ALL SELECT window_id, 'realized_recall', {DQ.r4_sql('recall')} FROM mon
        UNION ALL SELECT window_id, 'realized_roc_auc', {DQ.r4_sql('auc')} FROM mon WHERE auc IS NOT NULL""",
)
def gauge_series(spark: SparkSession, sf: str) -> DataFrame:
    return K.gauge_series(history(spark, sf), "window_id", [], GAUGES)
