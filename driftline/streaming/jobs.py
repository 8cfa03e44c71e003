"""The streaming jobs: gate, late rows, scoring, rates, alerts, feedback, drift, retrain trigger, dedup."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from driftline.operators import contract, drift, metrics, models, tally, telemetry
from driftline.spec import TableSpec
from driftline.streaming import core


def gate_stream(
    stream: DataFrame,
    spec: TableSpec,
    accepted: str,
    quarantine: str,
    checkpoint: str,
    require_target: bool = False,
    ts: str | None = None,
    arrivals: str | None = None,
    delay: str = core.WATERMARK,
) -> StreamingQuery:
    """Row gate on a stream: accepted rows and quarantined rows with reasons go to two tables.

    With an event time and a table `arrivals`, each micro-batch also tells how many of its rows are late.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Parsed once for the two writes.
        rows = batch.persist()
        try:
            good, bad = contract.gate_rows(rows, spec, require_target)
            core.write_batch(good, accepted, batch_id)
            core.write_batch(bad, quarantine, batch_id)
            if ts and arrivals:
                count_arrivals(rows, ts, arrivals, batch_id, delay)
        finally:
            rows.unpersist()

    return core.batch_sink(stream, write, checkpoint)


def count_arrivals(
    rows: DataFrame, ts: str, out: str, batch_id: int, delay: str = core.WATERMARK, width: str | None = None
) -> None:
    """Write one row of a micro-batch: its rows, the late ones, and the line that it leaves.

    The line is the highest event time so far less the allowed delay, carried on from the batch before, as the
    watermark is. Late rows lie before the line that the batch found; with `width`, their window ended by then.
    """
    earlier = None
    if batch_id:
        earlier = rows.sparkSession.read.parquet(f"{out}/batch={batch_id - 1}").first()["line"]
    moment = F.col(ts).cast("timestamp")
    late = F.lit(False)
    if earlier is not None:
        late = F.window(moment, width)["end"] <= F.lit(earlier) if width else moment < F.lit(earlier)
    line = F.greatest(F.max(moment) - F.expr(f"INTERVAL {delay}"), F.lit(earlier).cast("timestamp"))
    # one pass; the window of a row is computed before the rows are counted
    flagged = rows.select(moment.alias(ts), late.alias("late"))
    told = flagged.agg(line.alias("line"), F.count("*").alias("n_rows"), F.count_if("late").alias("n_late"))
    core.write_batch(told, out, batch_id)


def arrivals_stream(
    stream: DataFrame, ts: str, out: str, checkpoint: str, delay: str = core.WATERMARK, width: str | None = None
) -> StreamingQuery:
    """Late rows of every micro-batch in a table, beside a stream whose watermark drops them silently."""

    def write(batch: DataFrame, batch_id: int) -> None:
        count_arrivals(batch, ts, out, batch_id, delay, width)

    return core.batch_sink(stream.select(ts), write, checkpoint)


def score_stream(
    stream: DataFrame,
    spec: TableSpec,
    current: Callable[[], models.Version],
    out: str,
    checkpoint: str,
    yes: str,
    no: str,
    keep: Sequence[str],
    rejected: str | None = None,
) -> StreamingQuery:
    """Gate, then score accepted rows; the production version is looked up per micro-batch.

    Rejected requests go to the table `rejected` with their reasons, where one is named.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            accepted, refused = contract.gate_rows(rows, spec)
            scored = models.score_table(accepted, spec, current(), yes, no)
            fields = ["proba", "positive", "action", "threshold", "model_name", "model_version"]
            core.write_batch(scored.select(*keep, *fields), out, batch_id)
            if rejected:
                core.write_batch(refused.select(*keep, "reasons"), rejected, batch_id)
        finally:
            rows.unpersist()

    return core.batch_sink(stream, write, checkpoint)


def rate_stream(
    stream: DataFrame, ts: str, by: Sequence[str] = (), width: str = "5 minutes", slide: str = "1 minute",
    seconds: float = 300.0, delay: str = core.WATERMARK,
) -> DataFrame:
    """Requests per second over a sliding window; a window is emitted once it is closed."""
    timed = core.with_event_time(stream, ts, delay)
    counts = timed.groupBy(F.window(ts, width, slide).alias("w"), *by).agg(F.count("*").alias("requests"))
    return counts.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *by,
        "requests",
        telemetry.window_rate(F.col("requests"), seconds).alias("rate"),
    )


def p95_stream(
    stream: DataFrame, ts: str, by: Sequence[str] = (), width: str = "5 minutes", slide: str = "1 minute",
    buckets: Sequence[float] = telemetry.LATENCY_BUCKETS, delay: str = core.WATERMARK,
) -> DataFrame:
    """p95 latency from bucket counters over a sliding window (bounded state per window)."""
    timed = core.with_event_time(stream, ts, delay)
    timed = timed.withColumn("w", F.window(ts, width, slide))
    counts = telemetry.bucket_counts(timed, ["w", *by], buckets)
    return counts.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *by,
        F.col(f"b{len(buckets)}").alias("requests"),
        telemetry.bucket_quantile(0.95, buckets).alias("p95_seconds"),
    )


def dedup_stream(stream: DataFrame, ts: str, key: Sequence[str], delay: str = core.WATERMARK) -> DataFrame:
    """Drop repeated requests; state is kept only as long as a repeat may still arrive."""
    return core.with_event_time(stream, ts, delay).dropDuplicatesWithinWatermark(list(key))


def alert_stream(
    series: DataFrame,
    rule: str,
    condition: Column,
    hold_seconds: float,
    severity: str,
    ts: str,
    by: Sequence[str] = (),
    step_seconds: float = 60.0,
    delay: str = core.WATERMARK,
) -> DataFrame:
    """Evaluations of a stream of closed windows at which an alert fires, as `telemetry.alert_islands` finds them.

    State of a series is the time since which its condition has held and the last evaluation. An event-time timer
    drops it once the series has been silent for longer than a step, so silent series hold no state. Evaluations
    of a series must arrive in order between micro-batches, as the windows of the rate and p95 sinks do.
    """
    key = list(by) if by else ["__all"]
    told = core.with_event_time(series, ts, delay)
    told = told.withColumn("__all", F.lit(0)) if not by else told
    told = told.select(*key, ts, F.coalesce(condition, F.lit(False)).alias("__met"))
    kinds = {f.name: f.dataType.simpleString() for f in told.schema.fields}
    out = ", ".join(f"`{k}` {kinds[k]}" for k in key) + f", fired_at {kinds[ts]}, pending_since {kinds[ts]}, held_seconds double"

    def run(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(parts).sort_values(ts)
        since, last = state.get if state.exists else (None, None)
        fired = []
        for moment, met in zip(rows[ts], rows["__met"], strict=True):
            at = moment.value // 1000
            if not met:
                since = None
            elif since is None or (at - last) / 1e6 > step_seconds:
                since = at
            last = at
            if since is not None and (at - since) / 1e6 >= hold_seconds:
                fired.append((*group, moment, pd.Timestamp(since, unit="us", tz=moment.tz), (at - since) / 1e6))
        state.update((since, last))
        ends = last // 1000 + int(step_seconds * 1000) + 1
        state.setTimeoutTimestamp(max(ends, state.getCurrentWatermarkMs() + 1))
        if fired:
            yield pd.DataFrame(fired, columns=[*key, "fired_at", "pending_since", "held_seconds"])

    kept = told.groupBy(*key).applyInPandasWithState(
        run, out, "since bigint, last bigint", "append", GroupStateTimeout.EventTimeTimeout
    )
    return kept.select(
        *by, F.lit(rule).alias("alert"), F.lit(severity).alias("severity"), "fired_at", "pending_since", "held_seconds"
    )


def feedback_join(
    predictions: DataFrame,
    labels: DataFrame,
    key: Sequence[str],
    pred_ts: str,
    label_ts: str,
    within: str = "2 days",
    delay: str = core.WATERMARK,
    unmatched: bool = False,
) -> DataFrame:
    """Pair predictions with labels that arrive later; both watermarks and the time bound let
    the state of unmatched rows expire.

    With `unmatched`, a prediction whose label did not come in time is emitted as its state expires, its
    label columns null.
    """
    p = core.with_event_time(predictions, pred_ts, delay)
    l = core.with_event_time(labels, label_ts, delay)
    renamed = l.select(*[F.col(k).alias(f"__l_{k}") for k in key], *[c for c in l.columns if c not in key])
    cond = (F.col(label_ts) >= F.col(pred_ts)) & (F.col(label_ts) <= F.col(pred_ts) + F.expr(f"INTERVAL {within}"))
    for k in key:
        cond = cond & (F.col(k) == F.col(f"__l_{k}"))
    how = "left_outer" if unmatched else "inner"
    return p.join(renamed, cond, how).drop(*[f"__l_{k}" for k in key])


def realized_by_window(pairs: DataFrame, ts: str, width: str, threshold: float) -> DataFrame:
    """Confusion and recall of matched pairs per tumbling window."""
    timed = pairs.withColumn("w", F.window(F.col(ts).cast("timestamp"), width))
    c = metrics.confusion(timed, threshold, ["w"])
    return c.select(
        F.col("w.start").alias("window_start"), "tp", "fp", "fn", "tn", metrics.prf_columns()["recall"].alias("recall")
    )


def coverage_by_window(pairs: DataFrame, ts: str, width: str, label: str = "label") -> DataFrame:
    """Predictions per tumbling window and how many of them got no label in time."""
    timed = pairs.groupBy(F.window(F.col(ts).cast("timestamp"), width).alias("w"))
    counts = timed.agg(F.count("*").alias("predictions"), F.count_if(F.col(label).isNull()).alias("unmatched"))
    return counts.select(F.col("w.start").alias("window_start"), "predictions", "unmatched")


#: What the retrain rule reads of a monitor record.
_TAIL = ["window_start", "drift_share", "realized_recall"]
_TAIL_SCHEMA = "window_start timestamp, drift_share double, realized_recall double"


def drift_stream(
    stream: DataFrame,
    ref: DataFrame,
    spec: TableSpec,
    ts: str,
    width: str,
    threshold: float,
    work: str,
    history: str,
    checkpoint: str,
    delay: str = core.WATERMARK,
    second: bool = False,
    on_report: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Monitor record per closed event-time window of a scored, labelled stream.

    Rows are counted where they arrive (`tally`): the state store holds counters per window, column and bin or
    category, and with the second detector per distinct value, and drops them once the watermark passes the
    window's end; rows are never stored. Each batch gets the counters of the windows it closes and compares them
    with the reference, which is profiled and written once. Later rows of a closed window are dropped;
    `arrivals_stream` with the same width counts them. Folder `work` holds the profile, the counters of the batch
    in hand and the last windows, each in a fixed number of slots.
    `on_report` gets the windows that a batch closed and the few before them that the retrain rule looks back on:
    `retrain_trigger` makes one that starts a retrain run.
    """
    spark = stream.sparkSession

    def keep(part: DataFrame, name: str) -> DataFrame:
        path = f"{work}/profile/{name}"
        part.write.mode("overwrite").parquet(path)
        return spark.read.schema(part.schema).parquet(path)

    known = drift.reference_profile(ref, spec, keep=keep)
    rows = core.with_event_time(stream, ts, delay).withColumn("window", F.window(ts, width))
    counted = tally.tally(rows, known, ["window"], threshold, values=second)
    table = counted.table.withColumn("window_start", F.col("window.start")).drop("window")

    def write(batch: DataFrame, batch_id: int) -> None:
        slot = f"{work}/counters/slot={batch_id % 2}"
        batch.write.mode("overwrite").parquet(slot)
        closed = spark.read.schema(batch.schema).parquet(slot)
        tail = spark.createDataFrame([], _TAIL_SCHEMA)
        if batch_id:
            tail = spark.read.schema(_TAIL_SCHEMA).parquet(f"{work}/tail/slot={(batch_id - 1) % 3}")
        if not closed.isEmpty():
            windows = tally.Tally(closed, ("window_start",), counted.numeric, counted.text)
            report = drift.monitor_windows(known, windows, spec, ["window_start"], threshold, second=second)
            core.write_batch(report, history, batch_id)
            report = spark.read.schema(report.schema).parquet(f"{history}/batch={batch_id}")
            tail = tail.unionByName(report.select(*_TAIL))
            if on_report:
                on_report(tail)
        last = tail.orderBy(F.col("window_start").desc()).limit(drift.RETRAIN_WINDOWS - 1)
        last.write.mode("overwrite").parquet(f"{work}/tail/slot={batch_id % 3}")

    return core.batch_sink(table, write, checkpoint)


def retrain_trigger(start: Callable[[list[str]], None]) -> Callable[[DataFrame], None]:
    """Calls `start(reasons)` when the latest closed window asks for retraining."""

    def check(history: DataFrame) -> None:
        last = retrain_stream(history).orderBy(F.col("window_start").desc()).first()
        if last is not None and last["retrain"]:
            start(last["reasons"])

    return check


def retrain_stream(history: DataFrame, scheduled: bool = False) -> DataFrame:
    """Retrain decision after every closed window of the drift sink."""
    return drift.retrain_decision(history, "window_start", scheduled=scheduled)
