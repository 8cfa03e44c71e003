"""Whole workflows: training run, monitoring exercise, retraining."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.functions import columns as X
from driftline.operators import contract, drift, ingest, models, registry, split
from driftline.session import ensure_checkpoint_dir, scratch_path
from driftline.sources import records, tables
from driftline.spec import TableSpec

RETRAIN_MODEL = "gbt"
MEGABYTE = 1_000_000.0


@dataclass(frozen=True)
class Paths:
    """Tables of one product below a shared root."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, run: str, name: str) -> str:
        return f"{self.root}/runs/{run.replace(':', '_').replace('/', '_')}/{name}"


def train_run(
    spark: SparkSession,
    raw: DataFrame,
    spec: TableSpec,
    paths: Paths,
    run: str,
    event_seq: int,
    code_version: str = "unknown",
    only: list[str] | None = None,
    overrides: dict[str, dict] | None = None,
) -> DataFrame:
    """Raw table to a promoted model, or a hard stop when the contract fails.

    Every stage writes its table once and the next stage reads it. Returns the run summary.
    """
    clean, _ = tables.drop_leaks(raw, spec.leak)
    # Coerced once and stored: later stages read typed columns and can push filters to the scan.
    tables.write_stage(tables.coerce(ingest.dedup_exact(clean), spec), paths.stage(run, "examples"))
    coerced = tables.read_stage(spark, paths.stage(run, "examples"))
    numeric = [c for c in spec.numeric if c in coerced.columns]
    text = [c for c in (*spec.categorical, spec.target) if c in coerced.columns]
    tables.write_stage(ingest.profile_numeric(coerced, numeric), paths.stage(run, "profile_numeric"))
    tables.write_stage(ingest.profile_top_values(coerced, text), paths.stage(run, "profile_values"))
    tables.write_stage(contract.contract_table(spark, spec), paths.stage(run, "contract"))
    # The validated table is the stored one: passing the gate changes no row.
    valid = validate_or_alert(spark, coerced, spec, paths, run, event_seq)
    parts = split.time_split(valid, spec.date, target=spec.target)
    tables.write_stage(parts, paths.stage(run, "split"), ["split"])
    parts = spark.read.parquet(paths.stage(run, "split"))
    info = split.split_info(parts, spec.date, F.col(spec.target) == spec.positive)
    dropped = split.label_counts(coerced, spec.target).select("dropped_unlabeled")
    records.append_record(
        info.crossJoin(F.broadcast(dropped)).withColumn("run_id", F.lit(run)), paths.table("split_info")
    )
    records.append_record(
        data_version(spark, coerced, info, paths.stage(run, "examples")).withColumns(
            {"run_id": F.lit(run), "code_version": F.lit(code_version)}
        ),
        paths.table("data_versions"),
    )
    versions, metric_rows, _ = models.train_candidates(parts, spec, only, overrides=overrides)
    sizes = {}
    for name, v in versions.items():
        target = paths.stage(run, f"model_{name}")
        v.pipeline.write().overwrite().save(target)
        sizes[name] = tables.stored_bytes(spark, target).first()["n_bytes"] / MEGABYTE
    size = F.create_map(*[F.lit(x) for n, mb in sizes.items() for x in (n, mb)])
    cands = metric_rows.withColumns({"run_id": F.lit(run), "model_mb": F.try_element_at(size, "model_name")})
    settings = {n: json.dumps(models.settings(n, **(overrides or {}).get(n, {}))) for n in versions}
    params = F.create_map(*[F.lit(x) for pair in settings.items() for x in pair])
    records.append_record(
        cands.withColumns({"params": F.try_element_at(params, "model_name"), "code_version": F.lit(code_version)})
        .join(F.broadcast(spark.read.parquet(paths.table("data_versions")).where(F.col("run_id") == run).select("run_id", "hash_xor")), "run_id")
        .withColumnRenamed("hash_xor", "data_version"),
        paths.table("experiments"),
    )
    return publish(spark, cands, paths, run, event_seq)


def data_version(spark: SparkSession, rows: DataFrame, info: DataFrame, path: str) -> DataFrame:
    """One row: content fingerprint, stored bytes, rows and end date of each part of the split."""
    wide = info.groupBy().pivot("split", ["train", "val", "test"]).agg(F.max("n_rows").alias("rows"), F.max("end_date").alias("end"))
    whole = ingest.fingerprint(rows)
    return whole.crossJoin(F.broadcast(tables.stored_bytes(spark, path))).crossJoin(F.broadcast(wide))


def validate_or_alert(
    spark: SparkSession, coerced: DataFrame, spec: TableSpec, paths: Paths, run: str, event_seq: int
) -> DataFrame:
    """The table itself, or an alert record and an error. A pass clears the open alert."""
    total, message, failure = 0, None, None
    try:
        contract.gate_batch(coerced, spec)
    except contract.ContractError as exc:
        failure, message, total = exc, str(exc), exc.total_failures
    row = spark.range(1).select(
        F.lit(spec.name).alias("source"),
        F.lit(run).alias("run_id"),
        F.lit(event_seq).cast("bigint").alias("event_seq"),
        F.lit(message).cast("string").alias("message"),
        F.lit(total).cast("bigint").alias("total_failures"),
    )
    records.append_record(records.alert_rows(row, ["source", "run_id", "event_seq"]), paths.table("alerts"))
    if failure is not None:
        raise failure
    return coerced


def seen(spark: SparkSession, paths: Paths, name: str) -> DataFrame | None:
    """Committed rows of a table of the registry."""
    return records.committed(spark, paths.table(name), paths.table("commits"))


def stage_publish(
    spark: SparkSession,
    cands: DataFrame,
    paths: Paths,
    run: str,
    event_seq: int,
    forced_baseline: float | None = None,
    limits: dict[str, float] | None = None,
) -> None:
    """Write what a publication changes, as rows of its event: nothing of it shows before the commit."""
    judged = registry.bless(cands, ["run_id"], forced_baseline, **(limits or {}))
    judged = registry.with_selected(judged, ["run_id"])
    # Candidates of one run are a handful of rows; a written table fixes their numbers.
    numbered = registry.register(judged, ["model_name"], versions=seen(spark, paths, "versions"))
    mine = records.write_event(numbered, paths.table("versions"), event_seq)
    won = mine.where("selected").select(
        "version", "model_name", "run_id", "roc_auc", "threshold", F.lit(event_seq).cast("bigint").alias("event_seq")
    )
    won = records.write_event(won, paths.table("alias_events"), event_seq)
    if won.isEmpty():
        return
    # A promotion joins the history, unless it repeats the version of its last entry.
    both = history(spark, paths).unionByName(won.select("event_seq", "version"))
    state = registry.production_history(both).select("event_seq", "version")
    state = state.withColumn("as_of", F.lit(event_seq).cast("bigint"))
    records.write_event(state, paths.table("production_history"), event_seq)


def publish(
    spark: SparkSession,
    cands: DataFrame,
    paths: Paths,
    run: str,
    event_seq: int,
    forced_baseline: float | None = None,
    limits: dict[str, float] | None = None,
) -> DataFrame:
    """Gate the candidates, register all of them, promote the winner if there is one.

    Versions, alias, history and so the serving metadata change together, with the event's commit. A replay of an
    event that was committed changes nothing; one of an event that was not replaces what the first attempt wrote.
    """
    commits = paths.table("commits")
    if not records.is_committed(spark, commits, event_seq):
        stage_publish(spark, cands, paths, run, event_seq, forced_baseline, limits)
        records.commit(spark, commits, event_seq, run, "publish")
    routed = registry.route(seen(spark, paths, "versions").where(F.col("run_id") == run), ["run_id"])
    events = seen(spark, paths, "alias_events").where(F.col("run_id") == run)
    sizes = records.read_records(spark, paths.table("split_info"))
    if sizes is None:
        return registry.run_summary(routed, events, routed.select("run_id"), ["run_id"])
    wide = sizes.groupBy("run_id").pivot("split", ["train", "val", "test"]).agg(F.max("n_rows"))
    return registry.run_summary(routed, events, wide, ["run_id"])


def serving_auc(spark: SparkSession, paths: Paths) -> float | None:
    """AUC of the version in production, or None."""
    events = seen(spark, paths, "alias_events")
    if events is None:
        return None
    row = events.agg(F.max_by("roc_auc", "event_seq").alias("auc")).first()
    return row["auc"]


def history(spark: SparkSession, paths: Paths) -> DataFrame:
    """Versions that were in production and not left by a rollback: (event_seq, version), latest state."""
    states = seen(spark, paths, "production_history")
    if states is None:
        return spark.createDataFrame([], "event_seq bigint, version bigint")
    last = states.agg(F.max("as_of")).first()[0]
    return states.where(F.col("as_of") == last).select("event_seq", "version")


def rollback(spark: SparkSession, paths: Paths, event_seq: int) -> DataFrame:
    """Point the alias at the fallback version; the move itself is an alias event.

    The version left goes from the history, so the next rollback reaches further back. Committed as a publication is.
    """
    path, commits = paths.table("rollbacks"), paths.table("commits")
    if records.is_committed(spark, commits, event_seq):
        return spark.read.parquet(f"{path}/event={event_seq}").drop("event_seq")
    versions = seen(spark, paths, "versions")
    past = history(spark, paths)
    move = registry.rollback_target(versions, past, registry.production(seen(spark, paths, "alias_events")))
    move = move.withColumn("event_seq", F.lit(event_seq).cast("bigint"))
    move = records.write_event(move, path, event_seq).drop("event_seq")
    trimmed = registry.trim_history(past, move).withColumn("as_of", F.lit(event_seq).cast("bigint"))
    records.write_event(trimmed, paths.table("production_history"), event_seq)
    target = move.join(versions, move.target == versions.version)
    event = target.select(
        "version", "model_name", "run_id", "roc_auc", "threshold", F.lit(event_seq).cast("bigint").alias("event_seq")
    )
    records.write_event(event, paths.table("alias_events"), event_seq)
    records.commit(spark, commits, event_seq, f"rollback-{event_seq}", "rollback")
    return move


def serving_metadata(spark: SparkSession, paths: Paths) -> DataFrame:
    """One row: the version in production with its run, threshold, metrics and the version it was rolled back from."""
    live = registry.production(seen(spark, paths, "alias_events")).select("version")
    row = seen(spark, paths, "versions").join(F.broadcast(live), "version")
    moves = seen(spark, paths, "rollbacks")
    if moves is None:
        return row.withColumn("rolled_back_from", F.lit(None).cast("bigint"))
    last = moves.groupBy(F.col("target").alias("version")).agg(F.max_by("current", "event_seq").alias("rolled_back_from"))
    return row.join(F.broadcast(last), "version", "left")


def serving_version(spark: SparkSession, paths: Paths) -> models.Version:
    """The saved pipeline that the production alias points at, ready to score."""
    row = serving_metadata(spark, paths).first()
    if row is None:
        raise LookupError("no version is in production")
    path = paths.stage(row["run_id"], f"model_{row['model_name']}")
    return models.load_version(path, row["threshold"], row["model_name"], str(row["version"]))


def retrain_recent(
    df: DataFrame,
    spec: TableSpec,
    serving_auc: float | None,
    model_mb: float,
    overrides: dict[str, dict] | None = None,
) -> DataFrame:
    """Fit the retrain family on the latest dates and gate it against the serving model.

    A dry run: the size is given, nothing is saved but the examples in scratch. Duplicates are dropped here as in a
    full run, once: every later pass reads the written table.
    """
    path = scratch_path(df.sparkSession, "retrain-examples")
    tables.write_stage(_coerced(df, spec), path)
    valid = contract.gate_batch(tables.read_stage(df.sparkSession, path), spec)
    _, metric_rows = _fit_recent(valid, spec, overrides)
    cands = metric_rows.withColumn("model_mb", F.lit(model_mb))
    return registry.with_selected(registry.bless(cands, forced=serving_auc))


def _coerced(df: DataFrame, spec: TableSpec) -> DataFrame:
    clean, _ = tables.drop_leaks(df, spec.leak)
    return tables.coerce(ingest.dedup_exact(clean), spec)


def _fit_recent(valid: DataFrame, spec: TableSpec, overrides: dict[str, dict] | None) -> tuple[models.Version, DataFrame]:
    recent = split.recent_window(split.labeled(valid, spec.target), spec.date)
    parts = split.time_split(recent, spec.date)
    versions, metric_rows, _ = models.train_candidates(parts, spec, [RETRAIN_MODEL], overrides=overrides)
    return versions[RETRAIN_MODEL], metric_rows


def retrain_run(
    spark: SparkSession,
    raw: DataFrame,
    spec: TableSpec,
    paths: Paths,
    run: str,
    event_seq: int,
    overrides: dict[str, dict] | None = None,
) -> DataFrame:
    """Retraining to its end: gate with alert, fit on the latest dates, save, measure, register, promote or skip."""
    tables.write_stage(_coerced(raw, spec), paths.stage(run, "examples"))
    valid = validate_or_alert(spark, tables.read_stage(spark, paths.stage(run, "examples")), spec, paths, run, event_seq)
    version, metric_rows = _fit_recent(valid, spec, overrides)
    target = paths.stage(run, f"model_{RETRAIN_MODEL}")
    version.pipeline.write().overwrite().save(target)
    size = tables.stored_bytes(spark, target).first()["n_bytes"] / MEGABYTE
    cands = metric_rows.withColumns({"run_id": F.lit(run), "model_mb": F.lit(size)})
    return publish(spark, cands, paths, run, event_seq, forced_baseline=serving_auc(spark, paths))


def demo_windows(
    test: DataFrame,
    spec: TableSpec,
    recipe: dict[str, drift.Shift],
    size: int = 4000,
    rate: float = 0.45,
) -> tuple[DataFrame, DataFrame]:
    """(reference sample, clean/shifted/two relabelled windows as one table with window_seq)."""

    def sample(df: DataFrame, seed: int) -> DataFrame:
        return split.sample_n(df, size, seed, spec.key)

    def flipped(seed: int, hash_seed: int) -> DataFrame:
        return drift.flip_labels(
            sample(test, seed), spec.target, spec.positive, spec.negative, spec.key, rate, hash_seed
        )

    windows = [
        ("clean", sample(test, 2)),
        ("data_drift", sample(drift.shift_features(test, recipe), 3)),
        ("concept_1", flipped(4, 11)),
        ("concept_2", flipped(5, 12)),
    ]
    tagged = [
        w.withColumns({"window_id": F.lit(name), "window_seq": F.lit(i + 1)}) for i, (name, w) in enumerate(windows)
    ]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.unionByName(t)
    return sample(test, 1), union


def monitor_exercise(
    test: DataFrame,
    spec: TableSpec,
    recipe: dict[str, drift.Shift],
    score,
    threshold: float,
    second: bool = True,
    size: int = 4000,
) -> DataFrame:
    """Monitor record and retrain decision per exercise window.

    `score` adds `proba` to a table (a fitted model or an expression).
    """
    ensure_checkpoint_dir(test.sparkSession)
    ref, windows = demo_windows(test, spec, recipe, size)
    label = X.encode_label(F.col(spec.target), spec.positive, spec.negative)
    # Small samples read by several detectors: sampled and scored once, lineage cut.
    ref = ref.checkpoint()
    scored = score(windows).withColumn("label", label).checkpoint()
    history = drift.monitor_windows(ref, scored, spec, ["window_id", "window_seq"], threshold, second)
    return drift.retrain_decision(history, "window_seq")


#: The windows after which a decision to retrain is expected.
TRIGGERS = ("data_drift", "concept_2")


def cycle_triggers(decisions: DataFrame) -> DataFrame:
    """A row for each trigger window: whether its decision fired, and whether all did, which starts a retraining.

    A trigger window without a decision has not fired.
    """
    fired = decisions.where(F.col("window_id").isin(*TRIGGERS)).groupBy("window_id").agg(F.max("retrain").alias("fired"))
    wanted = decisions.sparkSession.createDataFrame([(w,) for w in TRIGGERS], "window_id string")
    told = wanted.join(fired, "window_id", "left").withColumn("fired", F.coalesce("fired", F.lit(False)))
    return told.withColumn("starts", F.min("fired").over(Window.partitionBy(F.lit(0))))


def retrain_cycle(decisions: DataFrame, start: Callable[[], DataFrame] | None = None) -> bool:
    """True when both triggers fired: after the shifted window and after both relabelled ones.

    `start` (a retrain run) is then called.
    """
    both = cycle_triggers(decisions).first()["starts"]
    if both and start:
        start()
    return both
