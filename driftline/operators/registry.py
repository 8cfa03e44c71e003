"""Promotion gate, versions, production pointer and rollback over plain tables.

Candidate tables hold one row per (run, model), keyed by any run/segment columns, so one job gates
a whole fleet. They are aggregates: their size follows the number of models, not of rows. Version
tables assume a single writer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Promotion limits.
MIN_ROC_AUC = 0.75
MIN_RECALL = 0.70
MIN_IMPROVEMENT = 0.0
MAX_MODEL_MB = 25.0
BASELINE_MODEL = "logreg"
SKIP_REASON = "every candidate failed a check of the gate, so production stays as it is"


def with_baseline(
    cands: DataFrame,
    by: Sequence[str],
    forced: float | Column | None = None,
    baseline_model: str = BASELINE_MODEL,
) -> DataFrame:
    """Add `baseline_auc`: the forced value, else the baseline model's AUC (null for itself)."""
    if forced is not None:
        value = forced if isinstance(forced, Column) else F.lit(float(forced))
        return cands.withColumn("baseline_auc", value)
    is_base = F.col("model_name") == baseline_model
    anchor = list(by) if by else [F.lit(0)]
    base = F.max(F.when(is_base, F.col("roc_auc"))).over(Window.partitionBy(*anchor))
    return cands.withColumn("baseline_auc", F.when(~is_base, base))


def bless(
    cands: DataFrame,
    by: Sequence[str] = (),
    forced: float | Column | None = None,
    baseline_model: str = BASELINE_MODEL,
    min_roc_auc: float = MIN_ROC_AUC,
    min_recall: float = MIN_RECALL,
    min_improvement: float = MIN_IMPROVEMENT,
    max_model_mb: float = MAX_MODEL_MB,
) -> DataFrame:
    """Add every gate check and the verdict; a missing AUC or recall fails its check."""
    df = with_baseline(cands, by, forced, baseline_model)
    df = df.withColumn("improvement", F.col("roc_auc") - F.col("baseline_auc"))
    checks = {
        "floor_ok": F.coalesce(F.col("roc_auc") >= min_roc_auc, F.lit(False)),
        "recall_ok": F.coalesce(F.col("recall") >= min_recall, F.lit(False)),
        "size_ok": F.coalesce(F.col("model_mb") <= max_model_mb, F.lit(False)),
        "improve_ok": F.col("baseline_auc").isNull()
        | F.coalesce(F.col("improvement") >= min_improvement, F.lit(False)),
    }
    df = df.withColumns(checks)
    return df.withColumn(
        "blessed", F.col("floor_ok") & F.col("recall_ok") & F.col("size_ok") & F.col("improve_ok")
    )


def with_selected(blessed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add `selected`: the blessed candidate with the highest AUC, then the smallest size."""
    anchor = list(by) if by else [F.lit(0)]
    order = Window.partitionBy(*anchor).orderBy(
        F.col("blessed").desc(), F.col("roc_auc").desc(), F.col("model_mb"), F.col("model_name")
    )
    return blessed.withColumn("selected", F.col("blessed") & (F.row_number().over(order) == 1))


def pick_winner(blessed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The selected candidate of each run; runs without one are absent."""
    return with_selected(blessed, by).where("selected").drop("selected")


def route(selected: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per run: push the winner or skip with the reason."""
    won = F.max(F.when(F.col("selected"), F.col("model_name")))
    out = selected.groupBy(*by).agg(F.count("*").alias("n_candidates"), won.alias("winner"))
    return out.select(
        *by,
        "n_candidates",
        "winner",
        F.col("winner").isNotNull().alias("blessed"),
        F.when(F.col("winner").isNotNull(), F.lit("push")).otherwise(F.lit("skip")).alias("next"),
        F.when(F.col("winner").isNull(), F.lit(SKIP_REASON)).alias("reason"),
    )


def register(
    cands: DataFrame, order: Sequence[str], by: Sequence[str] = (), versions: DataFrame | None = None
) -> DataFrame:
    """Give every candidate the next version number of its registry, promoted or not."""
    anchor = list(by) if by else [F.lit(0)]
    number = F.row_number().over(Window.partitionBy(*anchor).orderBy(*order)).cast("bigint")
    fresh = cands.withColumn("version", number)
    if versions is None:
        return fresh
    top = versions.groupBy(*by).agg(F.max("version").alias("__top"))
    if by:
        from driftline.operators.ordered import join_on

        joined = join_on(fresh, top, list(by), "left")
    else:
        joined = fresh.crossJoin(F.broadcast(top))
    return joined.withColumn("version", F.col("version") + F.coalesce("__top", F.lit(0))).drop("__top")


def production(events: DataFrame, by: Sequence[str] = (), seq: str = "event_seq") -> DataFrame:
    """Version the production alias points at: the latest alias event per registry."""
    return events.groupBy(*by).agg(
        F.max_by("version", seq).alias("version"), F.max_by("model_name", seq).alias("model_name")
    )


def version_list(versions: DataFrame, current: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Versions in number order, with the alias of the one in production."""
    live = current.select(*by, F.col("version"), F.lit("production").alias("alias"))
    return versions.join(live, [*by, "version"], "left")


def production_history(events: DataFrame, by: Sequence[str] = (), seq: str = "event_seq") -> DataFrame:
    """Alias events that change the version; repeating the last version adds nothing."""
    anchor = list(by) if by else [F.lit(0)]
    before = F.lag("version").over(Window.partitionBy(*anchor).orderBy(seq))
    marked = events.withColumn("__before", before)
    return marked.where(F.col("__before").isNull() | (F.col("__before") != F.col("version"))).drop("__before")


def rollback_target(
    versions: DataFrame, history: DataFrame, current: DataFrame, by: Sequence[str] = (), seq: str = "event_seq"
) -> DataFrame:
    """Version to fall back to, or null with the reason why there is none.

    The latest history entry that is not the current version; without one, the highest version
    below the current one. Needs a current version and at least two versions.
    """
    by = list(by)
    keys = by or ["__k"]

    def keyed(df: DataFrame) -> DataFrame:
        return df if by else df.withColumn("__k", F.lit(0))

    cur = keyed(current).select(*keys, F.col("version").alias("current"))
    vs = keyed(versions).join(cur, keys, "left")
    counts = vs.groupBy(*keys).agg(
        F.max("current").alias("current"),
        F.count("*").alias("n_versions"),
        F.max(F.when(F.col("version") < F.col("current"), F.col("version"))).alias("below"),
    )
    past = (
        keyed(history)
        .join(cur, keys)
        .where(F.col("version") != F.col("current"))
        .groupBy(*keys)
        .agg(F.max_by("version", seq).alias("previous"))
    )
    able = F.col("current").isNotNull() & (F.col("n_versions") >= 2)
    target = F.when(able, F.coalesce("previous", "below"))
    return counts.join(past, keys, "left").select(
        *by,
        "current",
        target.alias("target"),
        F.when(~able, F.lit("rolling back takes two or more versions"))
        .when(target.isNull(), F.lit("no version is older than the one in production"))
        .alias("problem"),
    )


def trim_history(
    history: DataFrame, rollback: DataFrame, by: Sequence[str] = (), seq: str = "event_seq"
) -> DataFrame:
    """History after a rollback: the left version is removed, the target is present."""
    by = list(by)
    keys = by or ["__k"]
    h = history if by else history.withColumn("__k", F.lit(0))
    r = (rollback if by else rollback.withColumn("__k", F.lit(0))).where("target IS NOT NULL")
    r = r.select(*keys, "current", "target")
    joined = h.join(r, keys, "left")
    kept = joined.where(F.col("current").isNull() | (F.col("version") != F.col("current")))
    trimmed = kept.select(*by, seq, "version")
    state = joined.groupBy(*keys).agg(
        F.max(F.when(F.col("version") == F.col("target"), 1).otherwise(0)).alias("has"), F.max(seq).alias("last")
    )
    added = r.join(state, keys, "left").where(F.coalesce("has", F.lit(0)) == 0)
    extra = added.select(
        *by, (F.coalesce("last", F.lit(0)) + 1).cast(history.schema[seq].dataType).alias(seq), F.col("target").alias("version")
    )
    return trimmed.unionByName(extra)


def run_summary(routed: DataFrame, events: DataFrame, split: DataFrame, run: Sequence[str]) -> DataFrame:
    """One row per run: verdict, winner, promoted version and split sizes."""
    pushed = events.groupBy(*run).agg(F.max("version").alias("promoted_version"))
    return (
        routed.join(pushed, list(run), "left")
        .join(split, list(run), "left")
        .withColumn("promoted", F.col("promoted_version").isNotNull())
    )
