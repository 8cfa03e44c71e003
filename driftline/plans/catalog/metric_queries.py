"""Classification metric queries on a scored line table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import metrics as M
from driftline.plans.catalog import base as B
from driftline.plans.catalog.base import q6, r6, register, table

T = 0.55
CONF_SQL = f"""
conf AS (
  SELECT l_linestatus, l_returnflag,
         count(*) FILTER (WHERE proba >= {T}::DOUBLE AND label = 1) AS tp,
         count(*) FILTER (WHERE proba >= {T}::DOUBLE AND label = 0) AS fp,
         count(*) FILTER (WHERE proba < {T}::DOUBLE AND label = 1) AS fn,
         count(*) FILTER (WHERE proba < {T}::DOUBLE AND label = 0) AS tn
  FROM scored GROUP BY 1, 2)
"""
BY = ["l_linestatus", "l_returnflag"]


def rank_sql(keys: str, source: str = "scored", prefix: str = "") -> str:
    """AUC by average ranks of the positives, average precision by cumulative precision."""
    on = f"PARTITION BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""
{prefix}ranked AS (
  SELECT {lead}label, proba,
         rank() OVER ({on} ORDER BY proba) + (count(*) OVER (PARTITION BY {lead}proba) - 1) / 2.0 AS rk
  FROM {source}),
{prefix}auc AS (
  SELECT {lead}sum(label) AS p, count(*) - sum(label) AS n,
         (sum(CASE WHEN label = 1 THEN rk END) - sum(label) * (sum(label) + 1) / 2.0)
           / nullif(sum(label)::DOUBLE * (count(*) - sum(label))::DOUBLE, 0) AS roc_auc
  FROM {prefix}ranked {group}),
{prefix}steps AS (SELECT {lead}proba, sum(label) AS a, count(*) AS m FROM {source} GROUP BY {lead}proba),
{prefix}cum AS (
  SELECT {lead}a, sum(a) OVER ({on} ORDER BY proba DESC) AS tp, sum(m) OVER ({on} ORDER BY proba DESC) AS pp,
         sum(a) OVER ({on}) AS p FROM {prefix}steps),
{prefix}ap AS (
  SELECT {lead}coalesce(sum(a * (tp / pp::DOUBLE)) / nullif(max(p), 0), 0) AS average_precision FROM {prefix}cum {group})
"""


@register("confusion", f"WITH {B.SCORED_SQL}, {CONF_SQL} SELECT * FROM conf")
def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return M.confusion(B.scored(spark, sf), T, BY)


PRF = (
    f"{q6('coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0)')} AS precision, "
    f"{q6('coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0)')} AS recall, "
    f"{q6('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0)')} AS f1"
)


@register("prf", f"WITH {B.SCORED_SQL}, {CONF_SQL} SELECT l_linestatus, l_returnflag, {PRF} FROM conf")
def prf(spark: SparkSession, sf: str) -> DataFrame:
    out = M.prf(B.scored(spark, sf), T, BY)
    return out.select(*BY, r6("precision"), r6("recall"), r6("f1"))


@register(
    "decision_cost",
    f"""WITH {B.SCORED_SQL}, {CONF_SQL} SELECT l_linestatus, l_returnflag, fp, fn, fp + 5.0::DOUBLE * fn AS cost FROM conf""",
)
def decision_cost(spark: SparkSession, sf: str) -> DataFrame:
    df = B.scored(spark, sf).withColumn("predicted", (F.col("proba") >= T).cast("int"))
    return M.decision_cost(df, "predicted", BY)


@register(
    "pos_rate",
    f"""WITH {B.SCORED_SQL}, {CONF_SQL} SELECT l_linestatus, l_returnflag,
        {q6('(tp + fp) / (tp + fp + fn + tn)::DOUBLE')} AS predicted_positive_rate FROM conf""",
)
def pos_rate(spark: SparkSession, sf: str) -> DataFrame:
    return M.pos_rate(B.scored(spark, sf), T, BY).select(*BY, r6("predicted_positive_rate"))


@register("roc_auc", f"WITH {B.SCORED_SQL}, {rank_sql('l_returnflag')} SELECT l_returnflag, {q6('roc_auc')} AS roc_auc FROM auc")
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return M.roc_auc(B.scored(spark, sf), ["l_returnflag"]).select("l_returnflag", r6("roc_auc"))


@register(
    "average_precision",
    f"""WITH {B.SCORED_SQL}, {rank_sql('l_returnflag')}
        SELECT l_returnflag, {q6('average_precision')} AS average_precision FROM ap""",
)
def average_precision(spark: SparkSession, sf: str) -> DataFrame:
    out = M.average_precision(B.scored(spark, sf), ["l_returnflag"])
    return out.select("l_returnflag", r6("average_precision"))


def _metric_columns() -> list:
    return [
        "n_rows", r6("roc_auc"), r6("average_precision"), r6("recall"), r6("precision"), r6("f1"), "threshold", "cost",
        "tp", "fp", "fn", "tn", r6("predicted_positive_rate"),
    ]


@register(
    "binary_metrics",
    f"""WITH {B.SCORED_SQL}, {rank_sql('')}, {CONF_SQL}, c AS (
          SELECT sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, sum(tn) AS tn FROM conf)
        SELECT (tp + fp + fn + tn)::BIGINT AS n_rows, {q6('roc_auc')} AS roc_auc,
          {q6('average_precision')} AS average_precision, {PRF}, {T}::DOUBLE AS threshold,
          (fp + 5 * fn)::DOUBLE AS cost, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, tn::BIGINT AS tn,
          {q6('(tp + fp) / (tp + fp + fn + tn)::DOUBLE')} AS predicted_positive_rate
        FROM c, auc, ap""",
)
def binary_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return M.binary_metrics(B.scored(spark, sf), T).select(*_metric_columns())


@register(
    "document_quality_metrics",
    f"""WITH s AS (
          SELECT d.lang, l.quality AS label, floor(least(d.n_chars / 4000.0::DOUBLE, 1) * 1e4 + 0.5) / 1e4 AS proba
          FROM labels l JOIN documents d USING (doc_id)),
        {rank_sql('lang', 's')}
        SELECT lang, {q6('roc_auc')} AS roc_auc, {q6('average_precision')} AS average_precision
        FROM auc JOIN ap USING (lang)""",
)
def document_quality_metrics(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    s = table(spark, sf, "labels").join(docs, "doc_id").select(
        "lang",
        F.col("quality").alias("label"),
        (F.floor(F.least(F.col("n_chars") / F.lit(4000.0), F.lit(1.0)) * 1e4 + 0.5).cast("double") / 1e4).alias("proba"),
    )
    return M.binary_metrics(s, 0.5, ["lang"]).select("lang", r6("roc_auc"), r6("average_precision"))


def curve_sql(keys: str) -> str:
    lead = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}, i" if keys else "GROUP BY i"
    return f"""
grid AS (SELECT i, 0.05::DOUBLE + i * ((0.95::DOUBLE - 0.05::DOUBLE) / 90) AS t FROM range(91) r(i)),
sc AS (SELECT {lead}proba, sum(label) AS p, count(*) - sum(label) AS n FROM scored GROUP BY {lead}proba),
curve AS (
  SELECT {lead}i, max(t) AS t, sum(CASE WHEN proba >= t THEN n ELSE 0 END)::BIGINT AS fp,
         sum(CASE WHEN proba < t THEN p ELSE 0 END)::BIGINT AS fn,
         coalesce(sum(CASE WHEN proba >= t THEN p ELSE 0 END) / nullif(sum(p), 0)::DOUBLE, 0) AS recall
  FROM sc, grid {group})
"""


@register(
    "cost_curve",
    f"""WITH {B.SCORED_SQL}, {curve_sql('l_returnflag')} SELECT l_returnflag, CAST(i AS INTEGER) AS grid_index,
        t AS threshold, fp, fn, {q6('recall')} AS recall, fp + 5.0::DOUBLE * fn AS cost FROM curve""",
)
def cost_curve(spark: SparkSession, sf: str) -> DataFrame:
    out = M.cost_curve(B.scored(spark, sf), ["l_returnflag"])
    return out.select("l_returnflag", "grid_index", "threshold", "fp", "fn", r6("recall"), "cost")


@register(
    "choose_threshold",
    f"""WITH {B.SCORED_SQL}, {curve_sql('l_returnflag, l_linestatus')},
        r AS (SELECT *, fp + 5 * fn AS cost, row_number() OVER (PARTITION BY l_returnflag, l_linestatus
                ORDER BY (recall >= 0.72::DOUBLE) DESC, CASE WHEN recall >= 0.72::DOUBLE THEN fp + 5 * fn ELSE -recall END, i) AS k
              FROM curve)
        SELECT l_returnflag, l_linestatus, t AS threshold, cost::DOUBLE AS cost, {q6('recall')} AS recall, fp, fn,
               recall >= 0.72::DOUBLE AS floor_met FROM r WHERE k = 1""",
)
def choose_threshold(spark: SparkSession, sf: str) -> DataFrame:
    by = ["l_returnflag", "l_linestatus"]
    out = M.choose_threshold(B.scored(spark, sf), by=by)
    return out.select(*by, "threshold", "cost", r6("recall"), "fp", "fn", "floor_met")


@register(
    "slice_by_month",
    f"""WITH {B.SCORED_SQL}, {rank_sql('ship_month')}, c AS (
          SELECT ship_month, count(*) AS n_rows, sum(label) AS p,
                 count(*) FILTER (WHERE proba >= {T}::DOUBLE AND label = 1) AS tp FROM scored GROUP BY 1)
        SELECT ship_month, n_rows, floor(roc_auc * 1e4 + 0.5) / 1e4 AS roc_auc,
               floor(coalesce(tp / nullif(c.p, 0)::DOUBLE, 0) * 1e4 + 0.5) / 1e4 AS recall
        FROM c JOIN auc USING (ship_month) WHERE n_rows >= 30 AND roc_auc IS NOT NULL""",
)
def slice_by_month(spark: SparkSession, sf: str) -> DataFrame:
    out = M.slice_metrics(B.scored(spark, sf), T, ["ship_month"])
    return out.select(
        "ship_month", "n_rows", B.rounded(F.col("roc_auc"), 4).alias("roc_auc"), B.rounded(F.col("recall"), 4).alias("recall")
    )


@register(
    "policy_costs",
    f"""WITH {B.SCORED_SQL}, {CONF_SQL} SELECT l_linestatus, l_returnflag, fp + 5.0::DOUBLE * fn AS model_cost,
        5.0::DOUBLE * (tp + fn) AS never_cost, (fp + tn)::DOUBLE AS always_cost FROM conf""",
)
def policy_costs(spark: SparkSession, sf: str) -> DataFrame:
    return M.policy_costs(B.scored(spark, sf), T, BY)
