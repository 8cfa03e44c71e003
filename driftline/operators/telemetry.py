"""Request-log aggregates: counters, latency histogram, service levels, alerts.

A request log has columns ts, endpoint, status, latency_ms and optionally positive (bool).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.columns import ratio
from driftline.operators.ordered import grouped_quantiles, join_on

# Latency buckets in seconds, service levels, alert limits.
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.15, 0.25, 0.5, 1.0)
P50_MS = 100.0
P95_MS = 150.0
MIN_RPS = 10.0
P95_ALERT_SECONDS = 0.15


def request_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("endpoint", "status").agg(F.count("*").alias("requests"))


def decision_counts(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Positive, negative and rejected answers."""
    ok = F.col("status") == "ok"
    return log.groupBy(*by).agg(
        F.count_if(ok & F.col("positive")).alias("positive"),
        F.count_if(ok & ~F.col("positive")).alias("negative"),
        F.count_if(F.col("status") == "rejected").alias("rejected"),
    )


def bucket_counts(
    log: DataFrame, by: Sequence[str], buckets: Sequence[float] = LATENCY_BUCKETS
) -> DataFrame:
    """Cumulative counts per bound as columns b0..bn (bn = all), plus the latency sum."""
    seconds = F.col("latency_ms") / F.lit(1000.0)
    return log.groupBy(*by).agg(
        *[F.count_if(seconds <= F.lit(float(b))).alias(f"b{i}") for i, b in enumerate(buckets)],
        F.count("latency_ms").alias(f"b{len(buckets)}"),
        F.sum(seconds).alias("latency_sum"),
    )


def latency_histogram(
    log: DataFrame, by: Sequence[str] = ("endpoint",), buckets: Sequence[float] = LATENCY_BUCKETS
) -> DataFrame:
    """Long form (group, le, cumulative count); le is infinite for the open bucket."""
    bounds = [*[float(b) for b in buckets], float("inf")]
    rows = F.array(
        *[F.struct(F.lit(b).alias("le"), F.col(f"b{i}").alias("requests")) for i, b in enumerate(bounds)]
    )
    return bucket_counts(log, by, buckets).select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def bucket_quantile(q: float, buckets: Sequence[float] = LATENCY_BUCKETS) -> Column:
    """Quantile from cumulative bucket columns: linear inside a bucket, the open one gives its
    lower bound, no observation gives null."""
    n = len(buckets)
    total = F.col(f"b{n}")
    rank = F.lit(q) * total.cast("double")
    value = F.lit(float(buckets[-1]))
    for i in range(n - 1, -1, -1):
        low = 0.0 if i == 0 else float(buckets[i - 1])
        under = F.lit(0) if i == 0 else F.col(f"b{i - 1}")
        here = (F.col(f"b{i}") - under).cast("double")
        inside = F.lit(low) + F.lit(float(buckets[i]) - low) * ((rank - under) / F.when(here > 0, here))
        value = F.when(F.col(f"b{i}") >= rank, F.coalesce(inside, F.lit(low))).otherwise(value)
    return F.when(total > 0, value)


def slo_report(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact p50/p95 latency, throughput and pass flags per group."""
    by = list(by)
    q = grouped_quantiles(log, by, "latency_ms", {"p50_ms": 0.5, "p95_ms": 0.95})
    seconds = F.unix_micros(F.max("__ts")) - F.unix_micros(F.min("__ts"))
    rate = (
        log.withColumn("__ts", F.col("ts").cast("timestamp"))
        .groupBy(*by)
        .agg(F.count("*").alias("requests"), (seconds.cast("double") / 1e6).alias("__s"))
        .withColumn("throughput_rps", ratio(F.col("requests"), F.col("__s"), None))
        .drop("__s")
    )
    joined = join_on(q.drop("n"), rate, by) if by else q.drop("n").crossJoin(F.broadcast(rate))
    return joined.select(
        *by,
        "requests",
        "p50_ms",
        "p95_ms",
        "throughput_rps",
        (F.col("p50_ms") <= P50_MS).alias("p50_pass"),
        (F.col("p95_ms") <= P95_MS).alias("p95_pass"),
        (F.col("throughput_rps") >= MIN_RPS).alias("throughput_pass"),
    )


def rolling(log: DataFrame, width: str, slide: str, ts: str = "ts") -> DataFrame:
    """Assign rows to sliding windows (column `w`)."""
    return log.withColumn("w", F.window(F.col(ts).cast("timestamp"), width, slide))


def window_rate(rows: Column, width_seconds: float) -> Column:
    return rows.cast("double") / F.lit(float(width_seconds))


def rejection_rate(log: DataFrame, width: str = "5 minutes", slide: str = "1 minute", seconds: float = 300.0) -> DataFrame:
    """Rejected requests per second over a sliding window."""
    rejected = F.count_if(F.col("status") == "rejected")
    return (
        rolling(log, width, slide)
        .groupBy("w")
        .agg(F.count("*").alias("requests"), rejected.alias("rejected"))
        .select(
            F.col("w.end").alias("window_end"),
            "requests",
            "rejected",
            window_rate(F.col("rejected"), seconds).alias("rejected_per_s"),
        )
    )


def latest_gauges(history: DataFrame, seq: str, by: Sequence[str] = (), values: Sequence[str] = ()) -> DataFrame:
    """Latest value of each gauge; nothing recorded yet stays null."""
    return history.groupBy(*by).agg(
        F.max(seq).alias(seq), *[F.max_by(v, seq).alias(v) for v in values]
    )


def dashboard_series(
    log: DataFrame, width: str = "1 minute", seconds: float = 60.0, buckets: Sequence[float] = LATENCY_BUCKETS
) -> DataFrame:
    """Request rate and p95 per interval, long form (window_end, series, value)."""
    counted = bucket_counts(rolling(log, width, width), ["w"], buckets)
    rows = F.array(
        F.struct(F.lit("request_rate").alias("series"), window_rate(F.col(f"b{len(buckets)}"), seconds).alias("value")),
        F.struct(F.lit("p95_seconds").alias("series"), bucket_quantile(0.95, buckets).alias("value")),
    )
    return counted.select(F.col("w.end").alias("window_end"), F.explode(rows).alias("r")).select("window_end", "r.*")


def gauge_series(history: DataFrame, seq: str, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Monitor history as dashboard series (seq, series, value); missing values are left out."""
    rows = F.array(*[F.struct(F.lit(v).alias("series"), F.col(v).cast("double").alias("value")) for v in values])
    long = history.select(*by, seq, F.explode(rows).alias("r")).select(*by, seq, "r.*")
    return long.where(F.col("value").isNotNull())


def alert_islands(
    series: DataFrame,
    rule: str,
    condition: Column,
    hold_seconds: float,
    severity: str,
    ts: str = "ts",
    by: Sequence[str] = (),
    step_seconds: float | None = None,
) -> DataFrame:
    """Evaluations at which an alert fires: its condition has held for `hold_seconds`.

    Series have one row per evaluation time, so a window per series is bounded by the calendar.
    A null condition counts as not met; with `step_seconds`, so does a longer gap between
    evaluations.
    """
    anchor = list(by) if by else [F.lit(0)]
    line = Window.partitionBy(*anchor).orderBy(ts)
    upto = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = series.withColumn("__met", F.coalesce(condition, F.lit(False)))
    marked = marked.withColumn("__s", F.unix_micros(F.col(ts).cast("timestamp")).cast("double") / 1e6)
    gap = F.lit(False)
    if step_seconds is not None:
        gap = F.coalesce(F.col("__s") - F.lag("__s").over(line) > step_seconds, F.lit(False))
    marked = marked.withColumn("__cut", F.when(F.col("__met") & ~gap, 0).otherwise(1))
    marked = marked.withColumn("__island", F.sum("__cut").over(upto))
    hits = marked.where("__met")
    island = Window.partitionBy(*anchor, "__island")
    start = F.min(ts).over(island)
    held = F.col("__s") - F.min("__s").over(island)
    return (
        hits.withColumn("pending_since", start)
        .withColumn("held_seconds", held)
        .where(F.col("held_seconds") >= hold_seconds)
        .select(
            *by,
            F.lit(rule).alias("alert"),
            F.lit(severity).alias("severity"),
            F.col(ts).alias("fired_at"),
            "pending_since",
            "held_seconds",
        )
    )


def alerts(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
