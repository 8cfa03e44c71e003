"""Training and scoring queries (checked by quality and shape, not value by value)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions import columns as X
from driftline.operators import contract, exported, models
from driftline.operators import features as FT
from driftline.plans.catalog import base as B
from driftline.plans.catalog.base import q6, r6, register
from driftline.plans.catalog.feature_queries import NAMES, TRAIN_SQL, parts
from driftline.plans.run import retrain_recent

METRICS = ["model_name", "weight_mode", "n_rows", "roc_auc", "average_precision", "recall", "precision", "f1", "threshold", "cost"]


def _train(spark: SparkSession, sf: str, name: str) -> DataFrame:
    _, rows, _ = models.train_candidates(parts(spark, sf), B.LINES, [name])
    return rows.select(*METRICS)


@register("train_score_logreg")
def train_score_logreg(spark: SparkSession, sf: str) -> DataFrame:
    return _train(spark, sf, "logreg")


@register("train_score_gbt")
def train_score_gbt(spark: SparkSession, sf: str) -> DataFrame:
    return _train(spark, sf, "gbt")


@register("train_score_forest")
def train_score_forest(spark: SparkSession, sf: str) -> DataFrame:
    return _train(spark, sf, "forest")


@register("score_table")
def score_table(spark: SparkSession, sf: str) -> DataFrame:
    """Gate, score and act on the faulty table with a freshly fitted model."""
    versions, _, _ = models.train_candidates(parts(spark, sf), B.LINES, ["logreg"])
    accepted, _ = contract.gate_rows(B.faulty(spark, sf), B.LINES)
    out = models.score_table(accepted, B.LINES, versions["logreg"], "act", "wait")
    return out.groupBy("action", "model_name").agg(
        F.count("*").alias("n_rows"), F.min("proba").alias("min_proba"), F.max("proba").alias("max_proba")
    )


@register("retrain_recent")
def retrain_recent_query(spark: SparkSession, sf: str) -> DataFrame:
    """Recent window, one family, gated against the serving AUC."""
    out = retrain_recent(B.lines(spark, sf), B.LINES, serving_auc=0.5, model_mb=0.6)
    return out.select("model_name", "n_rows", "roc_auc", "recall", "baseline_auc", "improvement", "blessed", "selected")


#: A stated linear model over the scaled numbers and the slots of flag and status, and a stated tree
#: of depth two a round, as an exported fit has them.
WEIGHTS = (0.21, -1.3, 0.4, 0.05, -0.6, 0.3, 0.11, 0.7, -0.2, 0.45, -0.35, 0.25, 0.15)
BIAS = -0.125
#: (tree, node, feature, threshold, left_value, left, right, prediction)
TREES = (
    (0, 0, 1, 0.5, None, 1, 2, 0.0),
    (0, 1, -1, None, None, -1, -1, -0.8),
    (0, 2, 8, None, 0.0, 3, 4, 0.0),
    (0, 3, -1, None, None, -1, -1, 0.9),
    (0, 4, -1, None, None, -1, -1, 0.3),
    (1, 0, 10, None, 1.0, 1, 2, 0.0),
    (1, 1, -1, None, None, -1, -1, 0.25),
    (1, 2, 5, -0.25, None, 3, 4, 0.0),
    (1, 3, -1, None, None, -1, -1, -0.4),
    (1, 4, -1, None, None, -1, -1, 0.6),
)
CUT = 0.45

SLOTS_SQL = (
    TRAIN_SQL
    + f""",
s AS (SELECT {", ".join(f'avg("{n}") AS m_{n}, coalesce(nullif(stddev_pop("{n}"), 0), 1) AS s_{n}' for n in NAMES)} FROM block WHERE in_train),
slot AS (SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY v) - 1 AS k FROM (
  SELECT DISTINCT 'f' AS c, coalesce(l_returnflag, 'Unknown') AS v FROM train
  UNION SELECT DISTINCT 's', coalesce(l_linestatus, 'Unknown') FROM train)),
x AS (SELECT {", ".join(f"(b.{n} - s.m_{n}) / s.s_{n} AS z{i}" for i, n in enumerate(NAMES))}, f.k AS fk, t.k AS sk
  FROM (SELECT block.*, lab.l_returnflag, lab.l_linestatus FROM block JOIN lab USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)) b
  CROSS JOIN s LEFT JOIN slot f ON f.c = 'f' AND f.v = coalesce(l_returnflag, 'Unknown')
  LEFT JOIN slot t ON t.c = 's' AND t.v = coalesce(l_linestatus, 'Unknown'))
"""
)


def _decisions_sql(margin: str) -> str:
    return f"""WITH {SLOTS_SQL}, p AS (SELECT 1 / (1 + exp(-({margin}))) AS proba FROM x)
        SELECT CASE WHEN proba >= {CUT}::DOUBLE THEN 'act' ELSE 'wait' END AS action, count(*) AS n_rows,
          {q6("min(proba)")} AS min_proba, {q6("max(proba)")} AS max_proba, {q6("avg(proba)")} AS mean_proba FROM p GROUP BY 1"""


def _decisions(scored: DataFrame) -> DataFrame:
    acted = scored.withColumn("action", X.action(X.decide(F.col("proba"), CUT), "act", "wait"))
    told = acted.groupBy("action").agg(
        F.count("*").alias("n_rows"), F.min("proba").alias("min_proba"), F.max("proba").alias("max_proba"), F.avg("proba").alias("mean_proba")
    )
    return told.select("action", "n_rows", r6("min_proba"), r6("max_proba"), r6("mean_proba"))


def _inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, FT.FeatureParams, exported.Inputs]:
    """Labelled rows as (label, split, z, slots), beside the rows, their parameters and the place of each feature."""
    rows = parts(spark, sf).where("outcome IS NOT NULL")
    params = FT.fit(rows.where("split = 'train'"), B.LINES)
    label = X.encode_label(F.col("outcome"), B.LINES.positive, B.LINES.negative)
    named = exported.inputs(rows.withColumn("label", label), B.LINES, params, ["label", "split"])
    return rows, named, params, exported.Inputs.of(B.LINES, params)


_LINEAR = " + ".join(f"{w}::DOUBLE * z{i}" for i, w in enumerate(WEIGHTS[:7]))
_SLOT_WEIGHTS = (
    f"coalesce(list_extract({list(WEIGHTS[7:10])}::DOUBLE[], fk + 1), 0) + coalesce(list_extract({list(WEIGHTS[10:])}::DOUBLE[], sk + 1), 0)"
)


@register("score_coefficients", _decisions_sql(f"{BIAS}::DOUBLE + {_LINEAR} + {_SLOT_WEIGHTS}"))
def score_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    """A linear model given as a table, scored by a weighted sum and a join a categorical column."""
    _, rows, _, shape = _inputs(spark, sf)
    table = spark.createDataFrame([(-1, BIAS), *enumerate(WEIGHTS)], "slot int, weight double")
    return _decisions(exported.margin(rows, table, shape).select(exported.logistic(F.col("margin")).alias("proba")))


_FIRST = "CASE WHEN z1 <= 0.5::DOUBLE THEN -0.8 WHEN coalesce(fk = 1, false) THEN 0.3 ELSE 0.9 END::DOUBLE"
_SECOND = "CASE WHEN coalesce(sk = 0, false) THEN 0.25 WHEN z5 <= -0.25::DOUBLE THEN -0.4 ELSE 0.6 END::DOUBLE"


@register("score_trees", _decisions_sql(f"2 * ({_FIRST} + 0.5::DOUBLE * {_SECOND})"))
def score_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees given as a table of nodes, scored level by level."""
    _, rows, _, shape = _inputs(spark, sf)
    schema = "tree int, node int, feature int, threshold double, left_value double, left int, right int, prediction double"
    table = spark.createDataFrame(list(TREES), schema).withColumn("tree_weight", F.when(F.col("tree") == 0, 1.0).otherwise(0.5))
    keyed = rows.withColumn("row", F.monotonically_increasing_id())
    return _decisions(exported.score_boosting(keyed, table, shape, 2, 2, ["row"]))


#: Largest part of the gradient that counts as an optimum; a weighted row's own part is about 1 / rows.
GRADIENT_LIMIT = 1e-4


@register(
    "certificate_logreg",
    f"""WITH {TRAIN_SQL}, c AS (SELECT count(*) FILTER (WHERE outcome = 'Yes') AS p, count(*) FILTER (WHERE outcome = 'No') AS n FROM train),
        k AS (SELECT count(DISTINCT coalesce(l_returnflag, 'Unknown')) + count(DISTINCT coalesce(l_linestatus, 'Unknown')) AS k FROM train)
        SELECT p + n AS n_rows, {q6('(p + n)::DOUBLE')} AS total_weight, k + {len(NAMES)} + 1 AS n_weights, true AS is_optimum FROM c, k""",
)
def certificate_logreg(spark: SparkSession, sf: str) -> DataFrame:
    """The gradient of the fitted candidate's objective, recomputed from the training rows, vanishes."""
    rows, named, params, shape = _inputs(spark, sf)
    versions, _, _ = models.train_candidates(rows, B.LINES, ["logreg"], params)
    weights = exported.coefficients(spark, versions["logreg"].pipeline.stages[-1], B.LINES, params)
    train, _ = FT.with_weight(named.where("split = 'train'"), "label", models.WEIGHT_MODE["logreg"])
    gradient = exported.logreg_gradient(train, weights, shape)
    told = gradient.agg(F.count("*").alias("n_weights"), (F.max(F.abs("gradient")) < GRADIENT_LIMIT).alias("is_optimum"))
    seen = train.agg(F.count("*").alias("n_rows"), F.sum("weight").alias("total_weight"))
    return seen.crossJoin(F.broadcast(told)).select("n_rows", r6("total_weight"), "n_weights", "is_optimum")


def _close(a: str, b: str):
    return F.abs(F.col(a) - F.col(b)) <= 1e-6 * F.greatest(F.abs(F.col(a)), F.lit(1.0))


ROUNDS = 4


@register(
    "certificate_gbt",
    f"""WITH {TRAIN_SQL}, c AS (SELECT count(*) FILTER (WHERE outcome = 'Yes') AS p, count(*) FILTER (WHERE outcome = 'No') AS n FROM train)
        SELECT t::INT AS tree, p + n AS n_rows, {q6('2 * n::DOUBLE')} AS total_weight, 0 AS wrong_nodes, 0 AS wrong_gains
        FROM c, range({ROUNDS}) r(t)""",
)
def certificate_gbt(spark: SparkSession, sf: str) -> DataFrame:
    """Every node that boosting stored holds the statistics, every split the gain, that the training rows give."""
    rows, named, params, shape = _inputs(spark, sf)
    versions, _, _ = models.train_candidates(rows, B.LINES, ["gbt"], params, {"gbt": {"maxIter": ROUNDS}})
    table = exported.nodes(spark, versions["gbt"].pipeline.stages[-1])
    train, _ = FT.with_weight(named.where("split = 'train'"), "label", models.WEIGHT_MODE["gbt"])
    found = exported.boosting_statistics(train, table, shape, models.GBT_DEPTH, ROUNDS)
    stored = table.select("tree", "node", "n_rows", *(F.get("stats", F.lit(k)).alias(f"s{k}") for k in range(3)))
    same = _close("weight", "s0") & _close("total", "s1") & _close("squares", "s2")
    nodes = stored.join(found, ["tree", "node"], "left").groupBy("tree").agg(
        F.max("n_rows").alias("n_rows"), F.max("s0").alias("total_weight"), F.count_if(~F.coalesce(same, F.lit(False))).alias("wrong_nodes")
    )
    gains = exported.split_gains(table, False).groupBy("tree").agg(F.count_if(~_close("gain", "recomputed")).alias("wrong_gains"))
    told = nodes.join(gains, "tree", "left")
    return told.select("tree", "n_rows", r6("total_weight"), "wrong_nodes", F.coalesce("wrong_gains", F.lit(0)).alias("wrong_gains"))


TREES_GROWN = 5


@register(
    "certificate_forest",
    f"""WITH {TRAIN_SQL} SELECT t::INT AS tree, 0 AS wrong_gains, 0 AS lost_rows, true AS same_scores,
          (SELECT count(*) FROM train) AS n_rows FROM range({TREES_GROWN}) r(t)""",
)
def certificate_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Gains follow from the stored statistics, children hold their parent's rows, the plan scores as the library does.

    The rows that a tree drew are not stored, so its statistics are held against themselves.
    """
    rows, named, params, shape = _inputs(spark, sf)
    overrides = {"forest": {"numTrees": TREES_GROWN, "maxDepth": 6}}
    versions, _, _ = models.train_candidates(rows, B.LINES, ["forest"], params, overrides)
    table = exported.nodes(spark, versions["forest"].pipeline.stages[-1])
    gains = exported.split_gains(table, True).groupBy("tree").agg(F.count_if(~_close("gain", "recomputed")).alias("wrong_gains"))
    child = table.select("tree", F.col("node").alias("child"), F.col("n_rows").alias("child_rows"))
    inner = table.where("left >= 0").select("tree", "n_rows", F.explode(F.array("left", "right")).alias("child"), "node")
    lost = inner.join(child, ["tree", "child"]).groupBy("tree", "node").agg((F.max("n_rows") - F.sum("child_rows")).alias("d"))
    lost = lost.groupBy("tree").agg(F.count_if(F.col("d") != 0).alias("lost_rows"))
    train = rows.where("split = 'train'")
    keys = [*B.LINE_KEY]
    sums = [F.count("*").alias("n_rows"), F.sum("proba").alias("s")]
    mine = exported.inputs(train, B.LINES, params, keys).withColumn("row", F.monotonically_increasing_id())
    mine = exported.score_forest(mine, table, shape, 6, TREES_GROWN, ["row", *keys]).agg(*sums)
    library = models.score(train, B.LINES, versions["forest"]).agg(F.sum("proba").alias("want"))
    same = mine.crossJoin(F.broadcast(library)).select("n_rows", _close("s", "want").alias("same_scores"))
    return gains.join(lost, "tree").crossJoin(F.broadcast(same))
