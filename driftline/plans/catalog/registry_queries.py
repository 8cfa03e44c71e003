"""Gate, winner, version and rollback queries.

Candidates are real evaluations: three score models per line status (the registry) and ship
quarter (the run), measured over the whole line table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import metrics as M
from driftline.operators import registry as R
from driftline.plans import run as W
from driftline.plans.catalog import base as B
from driftline.plans.catalog.base import q6, r6, register, table
from driftline.plans.catalog.metric_queries import rank_sql
from driftline.session import scratch_path
from driftline.sources.records import append_record

RUN = ["segment", "run_id"]
# Gate limits that separate the three score models on this data; the defaults are in `registry`.
LIMITS = {"min_roc_auc": 0.73, "min_recall": 0.60}

_RUN_ID = "CAST(year(l_shipdate) * 10 + quarter(l_shipdate) AS INTEGER)"
_ROWS = " UNION ALL ".join(
    f"""SELECT l_linestatus AS segment, {_RUN_ID} AS run_id, '{m}' AS model_name, {mb}::DOUBLE AS model_mb,
        CASE WHEN (l_extendedprice > 80000) <> (l_orderkey % 10 = 0) THEN 1 ELSE 0 END AS label,
        {B.blend_sql(a, b)} AS proba FROM lineitem"""
    for m, (a, b, mb) in B.MODELS.items()
)
_KEYS = "segment, run_id, model_name"
CAND_SQL = f"""
cs AS ({_ROWS}),
{rank_sql(_KEYS, 'cs')},
cr AS (SELECT {_KEYS}, max(model_mb) AS model_mb,
         count(*) FILTER (WHERE proba >= {B.MODEL_THRESHOLD}::DOUBLE AND label = 1) / nullif(sum(label), 0)::DOUBLE AS recall
       FROM cs GROUP BY {_KEYS}),
cand AS (SELECT segment, run_id, model_name, model_mb, {q6('roc_auc')} AS roc_auc, {q6('coalesce(recall, 0)')} AS recall
         FROM cr JOIN auc USING (segment, run_id, model_name)),
gate AS (
  SELECT c.*, CASE WHEN c.model_name <> 'logreg' THEN l.roc_auc END AS baseline_auc
  FROM cand c LEFT JOIN cand l ON l.segment = c.segment AND l.run_id = c.run_id AND l.model_name = 'logreg'),
blessed AS (
  SELECT *, roc_auc - baseline_auc AS improvement, coalesce(roc_auc >= 0.73, false) AS floor_ok,
         coalesce(recall >= 0.60, false) AS recall_ok, model_mb <= 25 AS size_ok,
         baseline_auc IS NULL OR coalesce(roc_auc - baseline_auc >= 0, false) AS improve_ok,
         coalesce(roc_auc >= 0.73, false) AND coalesce(recall >= 0.60, false) AND model_mb <= 25
           AND (baseline_auc IS NULL OR coalesce(roc_auc - baseline_auc >= 0, false)) AS blessed
  FROM gate),
sel AS (
  SELECT *, blessed AND row_number() OVER (PARTITION BY segment, run_id
           ORDER BY blessed DESC, roc_auc DESC NULLS LAST, model_mb, model_name) = 1 AS selected FROM blessed),
ver AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY run_id, model_name) AS version FROM sel),
ev AS (SELECT segment, run_id, version, model_name, roc_auc, recall FROM ver WHERE selected),
cur AS (SELECT segment, arg_max(version, run_id) AS version, arg_max(model_name, run_id) AS model_name FROM ev GROUP BY 1)
"""


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Evaluated candidates as a stored record table: everything after it is small."""
    li = table(spark, sf, "lineitem")
    rows = F.array(
        *[
            F.struct(F.lit(m).alias("model_name"), F.lit(mb).alias("model_mb"), B.blend(a, b).alias("proba"))
            for m, (a, b, mb) in B.MODELS.items()
        ]
    )
    scored = li.select(
        F.col("l_linestatus").alias("segment"),
        (F.year("l_shipdate") * 10 + F.quarter("l_shipdate")).alias("run_id"),
        B.noisy_label().cast("int").alias("label"),
        F.inline(rows),
    )
    keys = [*RUN, "model_name", "model_mb"]
    m = M.binary_metrics(scored, B.MODEL_THRESHOLD, keys)
    path = scratch_path(spark, "candidates")
    append_record(m.select(*keys, r6("roc_auc"), r6("recall")), path)
    return spark.read.parquet(path)


def judged(cands: DataFrame) -> DataFrame:
    return R.with_selected(R.bless(cands, RUN, **LIMITS), RUN)


def versions(cands: DataFrame) -> DataFrame:
    return R.register(judged(cands), ["run_id", "model_name"], ["segment"])


def events(cands: DataFrame) -> DataFrame:
    won = versions(cands).where("selected")
    return won.select("segment", "run_id", "version", "model_name", "roc_auc", "recall")


@register(
    "bless_candidates",
    f"""WITH {CAND_SQL} SELECT segment, run_id, model_name, roc_auc, recall, {q6('improvement')} AS improvement,
        floor_ok, recall_ok, size_ok, improve_ok, blessed FROM blessed""",
)
def bless_candidates(spark: SparkSession, sf: str) -> DataFrame:
    out = R.bless(candidates(spark, sf), RUN, **LIMITS)
    return out.select(
        *RUN, "model_name", "roc_auc", "recall", r6("improvement"), "floor_ok", "recall_ok", "size_ok", "improve_ok", "blessed"
    )


@register(
    "bless_forced_baseline",
    f"""WITH {CAND_SQL} SELECT segment, run_id, model_name,
        coalesce(roc_auc >= 0.75, false) AND coalesce(recall >= 0.70, false) AND model_mb <= 25
          AND coalesce(roc_auc - 0.76::DOUBLE >= 0, false) AS blessed FROM cand""",
)
def bless_forced_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return R.bless(candidates(spark, sf), RUN, forced=0.76).select(*RUN, "model_name", "blessed")


@register("pick_winner", f"WITH {CAND_SQL} SELECT segment, run_id, model_name, roc_auc FROM sel WHERE selected")
def pick_winner(spark: SparkSession, sf: str) -> DataFrame:
    return R.pick_winner(R.bless(candidates(spark, sf), RUN, **LIMITS), RUN).select(*RUN, "model_name", "roc_auc")


@register(
    "route_run",
    f"""WITH {CAND_SQL}, w AS (SELECT segment, run_id, count(*) AS n_candidates,
          max(CASE WHEN selected THEN model_name END) AS winner FROM sel GROUP BY 1, 2)
        SELECT *, winner IS NOT NULL AS blessed, CASE WHEN winner IS NULL THEN 'skip' ELSE 'push' END AS next,
          CASE WHEN winner IS NULL THEN '{R.SKIP_REASON}' END AS reason FROM w""",
)
def route_run(spark: SparkSession, sf: str) -> DataFrame:
    return R.route(judged(candidates(spark, sf)), RUN)


@register(
    "register_versions",
    f"""WITH {CAND_SQL}, k AS (SELECT segment, count(*) AS top FROM cand GROUP BY 1)
        SELECT segment, run_id, model_name, version, version + top AS next_version FROM ver JOIN k USING (segment)""",
)
def register_versions(spark: SparkSession, sf: str) -> DataFrame:
    """First registration, and the numbers a second identical batch would get after it."""
    cands = candidates(spark, sf)
    first = versions(cands)
    second = R.register(judged(cands), ["run_id", "model_name"], ["segment"], first)
    again = second.select(*RUN, "model_name", F.col("version").alias("next_version"))
    return first.select(*RUN, "model_name", "version").join(again, [*RUN, "model_name"])


@register(
    "version_list",
    f"""WITH {CAND_SQL} SELECT ver.segment, ver.run_id, ver.model_name, ver.version,
        CASE WHEN cur.version IS NOT NULL THEN 'production' END AS alias
        FROM ver LEFT JOIN cur ON cur.segment = ver.segment AND cur.version = ver.version""",
)
def version_list(spark: SparkSession, sf: str) -> DataFrame:
    cands = candidates(spark, sf)
    live = R.production(events(cands), ["segment"], "run_id")
    out = R.version_list(versions(cands), live, ["segment"])
    return out.select(*RUN, "model_name", "version", "alias")


@register("production_pointer", f"WITH {CAND_SQL} SELECT * FROM cur")
def production_pointer(spark: SparkSession, sf: str) -> DataFrame:
    return R.production(events(candidates(spark, sf)), ["segment"], "run_id")


# A run that picks the same family as the run before publishes the same pointer again.
_POINTER = "CASE model_name WHEN 'logreg' THEN 1 WHEN 'gbt' THEN 2 ELSE 3 END"
HIST_SQL = f"""
pe AS (SELECT segment, run_id, CAST({_POINTER} AS BIGINT) AS version FROM ev),
hist AS (SELECT * FROM (SELECT *, lag(version) OVER (PARTITION BY segment ORDER BY run_id) AS before FROM pe)
         WHERE before IS NULL OR before <> version)
"""


def family_version() -> Column:
    return F.when(F.col("model_name") == "logreg", 1).when(F.col("model_name") == "gbt", 2).otherwise(3).cast("bigint")


def pointer_events(cands: DataFrame) -> DataFrame:
    return events(cands).select("segment", "run_id", "model_name", family_version().alias("version"))


@register("production_history", f"WITH {CAND_SQL}, {HIST_SQL} SELECT segment, run_id, version FROM hist")
def production_history(spark: SparkSession, sf: str) -> DataFrame:
    out = R.production_history(pointer_events(candidates(spark, sf)), ["segment"], "run_id")
    return out.select("segment", "run_id", "version")


ROLL_SQL = (
    HIST_SQL
    + """,
pcur AS (SELECT segment, arg_max(version, run_id) AS current FROM pe GROUP BY 1),
prev AS (SELECT h.segment, arg_max(h.version, h.run_id) AS previous FROM hist h JOIN pcur USING (segment)
         WHERE h.version <> current GROUP BY 1),
roll AS (
  SELECT s.segment, current, coalesce(previous, CASE WHEN current > 1 THEN current - 1 END) AS target
  FROM (SELECT DISTINCT segment FROM cand) s LEFT JOIN pcur USING (segment) LEFT JOIN prev USING (segment))
"""
)


def _rollback(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    cands = candidates(spark, sf)
    e = pointer_events(cands)
    history = R.production_history(e, ["segment"], "run_id")
    live = R.production(e, ["segment"], "run_id")
    known = cands.select("segment", family_version().alias("version")).distinct()
    return history, R.rollback_target(known, history, live, ["segment"], "run_id")


@register("rollback_target", f"WITH {CAND_SQL}, {ROLL_SQL} SELECT segment, current, target FROM roll")
def rollback_target(spark: SparkSession, sf: str) -> DataFrame:
    return _rollback(spark, sf)[1].select("segment", "current", "target")


@register(
    "rollback_history",
    f"""WITH {CAND_SQL}, {ROLL_SQL} SELECT h.segment, h.run_id, h.version FROM hist h LEFT JOIN roll USING (segment)
        WHERE target IS NULL OR h.version <> current
        UNION ALL SELECT r.segment, (SELECT max(run_id) + 1 FROM hist h WHERE h.segment = r.segment), r.target FROM roll r
        WHERE r.target IS NOT NULL AND NOT EXISTS (SELECT 1 FROM hist h WHERE h.segment = r.segment AND h.version = r.target)""",
)
def rollback_history(spark: SparkSession, sf: str) -> DataFrame:
    history, move = _rollback(spark, sf)
    return R.trim_history(history, move, ["segment"], "run_id").select("segment", "run_id", "version")


@register(
    "run_summary",
    f"""WITH {CAND_SQL}, w AS (SELECT segment, run_id, count(*) AS n_candidates,
          max(CASE WHEN selected THEN model_name END) AS winner, max(CASE WHEN selected THEN version END) AS promoted_version
          FROM ver GROUP BY 1, 2),
        n AS (SELECT segment, run_id, count(*) AS n_rows FROM cs WHERE model_name = 'logreg' GROUP BY 1, 2)
        SELECT segment, run_id, n_candidates, winner, promoted_version, promoted_version IS NOT NULL AS promoted, n_rows
        FROM w JOIN n USING (segment, run_id)""",
)
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    run = (F.year("l_shipdate") * 10 + F.quarter("l_shipdate")).alias("run_id")
    sizes = li.groupBy(F.col("l_linestatus").alias("segment"), run).agg(F.count("*").alias("n_rows"))
    cands = candidates(spark, sf)
    out = R.run_summary(R.route(judged(cands), RUN), events(cands), sizes, RUN)
    return out.select(*RUN, "n_candidates", "winner", "promoted_version", "promoted", "n_rows")


@register(
    "publish_commit",
    f"""WITH {CAND_SQL}, first_runs AS (SELECT run_id, row_number() OVER (ORDER BY run_id) AS k FROM (SELECT DISTINCT run_id FROM ver WHERE segment = 'F')),
        v AS (SELECT ver.*, k FROM ver JOIN first_runs USING (run_id) WHERE segment = 'F' AND k <= 3),
        stages AS (SELECT * FROM (VALUES ('published', 1), ('killed', 1), ('replayed', 2), ('replayed again', 2), ('published next', 3)) s(stage, upto))
        SELECT stage, count(*) AS n_versions, max(version) AS last_version, count(*) FILTER (WHERE selected) AS n_promotions,
          arg_max(version, k) FILTER (WHERE selected) AS in_production FROM stages JOIN v ON k <= upto GROUP BY stage""",
)
def publish_commit(spark: SparkSession, sf: str) -> DataFrame:
    """What readers of the registry see when a publication dies before its commit and is replayed twice."""
    cands = candidates(spark, sf).where("segment = 'F'").withColumn("threshold", F.lit(B.MODEL_THRESHOLD))
    runs = [r["run_id"] for r in cands.select("run_id").distinct().orderBy("run_id").limit(3).collect()]
    paths = W.Paths(scratch_path(spark, "registry"))
    told = []

    def publish(event: int, finish: bool = True) -> None:
        mine = cands.where(F.col("run_id") == runs[event - 1]).withColumn("run_id", F.col("run_id").cast("string"))
        step = W.publish if finish else W.stage_publish
        step(spark, mine.drop("segment"), paths, str(runs[event - 1]), event, limits=LIMITS)

    def look(stage: str) -> None:
        versions, events = W.seen(spark, paths, "versions"), W.seen(spark, paths, "alias_events")
        seen = versions.agg(F.count("*").alias("n_versions"), F.max("version").alias("last_version"))
        moves = events.agg(F.count("*").alias("n_promotions"), F.max_by("version", "event_seq").alias("in_production"))
        told.append((stage, *seen.first(), *moves.first()))

    for stage, event, finish in (
        ("published", 1, True), ("killed", 2, False), ("replayed", 2, True), ("replayed again", 2, True), ("published next", 3, True)
    ):
        publish(event, finish)
        look(stage)
    return spark.createDataFrame(told, "stage string, n_versions bigint, last_version bigint, n_promotions bigint, in_production bigint")
