"""Exact classification metrics, grouped by any keys.

Everything starts from score counts (rows per group and distinct score), so repeated scores and
hot groups collapse before the first shuffle. A row is usable when its label is 0 or 1 and its score a
number; the others take part in no figure, and `binary_metrics` says how many they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.columns import ratio
from driftline.functions.grid import GRID_POINTS, grid_cell, grid_value
from driftline.operators.ordered import range_edges, range_id, running_sums

# Cost of a missed positive and of a false alarm, recall floor of the search.
FN_COST = 5.0
FP_COST = 1.0
RECALL_FLOOR = 0.72
SLICE_MIN_ROWS = 30


def _threshold(threshold: float | str) -> Column:
    return F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))


def _usable(label: str, proba: str) -> Column:
    known = F.col(label).isin(0, 1) & F.col(proba).isNotNull() & ~F.isnan(F.col(proba))
    return F.coalesce(known, F.lit(False))


def _scored(df: DataFrame, label: str, proba: str) -> DataFrame:
    return df.where(_usable(label, proba))


def confusion_aggs(hit: Column, positive: Column) -> list[Column]:
    return [
        F.count_if(hit & positive).alias("tp"),
        F.count_if(hit & ~positive).alias("fp"),
        F.count_if(~hit & positive).alias("fn"),
        F.count_if(~hit & ~positive).alias("tn"),
    ]


def confusion(
    df: DataFrame, threshold: float | str, by: Sequence[str] = (), label: str = "label", proba: str = "proba"
) -> DataFrame:
    """tp, fp, fn, tn per group. `threshold` is a number or the name of a column."""
    hit = F.col(proba) >= _threshold(threshold)
    return _scored(df, label, proba).groupBy(*by).agg(*confusion_aggs(hit, F.col(label) == 1))


def prf_columns() -> dict[str, Column]:
    """precision, recall, f1 from tp/fp/fn columns; an empty denominator gives 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    both = precision + recall
    f1 = F.when(both == 0, F.lit(0.0)).otherwise(2.0 * precision * recall / F.when(both != 0, both))
    return {"precision": precision, "recall": recall, "f1": f1}


def cost_column(fp: Column, fn: Column) -> Column:
    return F.lit(FP_COST) * fp.cast("double") + F.lit(FN_COST) * fn.cast("double")


def prf(
    df: DataFrame, threshold: float | str, by: Sequence[str] = (), label: str = "label", proba: str = "proba"
) -> DataFrame:
    c = confusion(df, threshold, by, label, proba)
    return c.select(*by, *[v.alias(k) for k, v in prf_columns().items()])


def decision_cost(
    df: DataFrame, predicted: str, by: Sequence[str] = (), label: str = "label"
) -> DataFrame:
    """Cost of 0/1 decisions already made."""
    fp = (F.col(predicted) == 1) & (F.col(label) == 0)
    fn = (F.col(predicted) == 0) & (F.col(label) == 1)
    counts = df.groupBy(*by).agg(F.count_if(fp).alias("fp"), F.count_if(fn).alias("fn"))
    return counts.withColumn("cost", cost_column(F.col("fp"), F.col("fn")))


def pos_rate(
    df: DataFrame, threshold: float | str, by: Sequence[str] = (), label: str = "label", proba: str = "proba"
) -> DataFrame:
    hit = (F.col(proba) >= _threshold(threshold)).cast("double")
    return _scored(df, label, proba).groupBy(*by).agg(F.avg(hit).alias("predicted_positive_rate"))


def score_counts(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", proba: str = "proba", weight: str | None = None
) -> DataFrame:
    """pos/neg counts per group and distinct score; unusable rows are counted beside a null score.

    `weight` names a column that says how many rows a row stands for.
    """
    usable = _usable(label, proba)

    def total(condition: Column) -> Column:
        if weight is None:
            return F.count_if(condition)
        return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0))

    return df.groupBy(*by, F.when(usable, F.col(proba)).alias("proba")).agg(
        total(usable & (F.col(label) == 1)).alias("pos"),
        total(usable & (F.col(label) == 0)).alias("neg"),
        total(~usable).alias("unusable"),
    )


def ranked_scores(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", proba: str = "proba", weight: str | None = None
) -> DataFrame:
    """Score counts with cumulative positives/negatives from the highest score down.

    The borders of the score ranges come from a sketch of the scores, so ranges are even however
    closely the scores crowd.
    """
    counts = score_counts(df, by, label, proba, weight)
    edges = range_edges(df, [proba])[proba]
    return running_sums(counts, by, "proba", ["pos", "neg"], range_id("proba", edges), descending=True)


def _rank_aggs() -> list[Column]:
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tp, fp = F.col("pos_cum").cast("double"), F.col("neg_cum").cast("double")
    below = F.col("neg_total").cast("double") - fp
    return [
        F.sum(pos * (below + neg / 2.0)).alias("__wins"),
        F.sum(F.when(pos > 0, pos * tp / (tp + fp)).otherwise(0.0)).alias("__steps"),
        F.max("pos_total").alias("__p"),
        F.max("neg_total").alias("__n"),
    ]


def _auc() -> Column:
    pairs = F.col("__p").cast("double") * F.col("__n").cast("double")
    return ratio(F.col("__wins"), pairs, None)


def _ap() -> Column:
    return ratio(F.col("__steps"), F.col("__p"), 0.0)


def roc_auc(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", proba: str = "proba", weight: str | None = None
) -> DataFrame:
    """Ties count half; a single class gives null."""
    table = ranked_scores(df, by, label, proba, weight).groupBy(*by).agg(*_rank_aggs())
    return table.select(*by, _auc().alias("roc_auc"))


def average_precision(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", proba: str = "proba"
) -> DataFrame:
    """Step sum over distinct scores, highest first."""
    table = ranked_scores(df, by, label, proba).groupBy(*by).agg(*_rank_aggs())
    return table.select(*by, _ap().alias("average_precision"))


def binary_metrics(
    df: DataFrame,
    threshold: float | str,
    by: Sequence[str] = (),
    label: str = "label",
    proba: str = "proba",
) -> DataFrame:
    """All metrics of a group from one ranked score table.

    `threshold` may name a column that is constant within each group.
    """
    keys = list(by)
    if isinstance(threshold, str) and threshold not in keys:
        keys.append(threshold)
    t = _threshold(threshold)
    ranked = ranked_scores(df, keys, label, proba)
    hit = F.col("proba") >= t
    table = ranked.groupBy(*keys).agg(
        *_rank_aggs(),
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~hit, F.col("pos")).otherwise(0)).alias("fn"),
        F.sum(F.when(~hit, F.col("neg")).otherwise(0)).alias("tn"),
        F.sum("unusable").alias("n_unusable"),
    )
    rows = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    score = prf_columns()
    return table.select(
        *by,
        rows.alias("n_rows"),
        _auc().alias("roc_auc"),
        _ap().alias("average_precision"),
        score["recall"].alias("recall"),
        score["precision"].alias("precision"),
        score["f1"].alias("f1"),
        t.alias("threshold"),
        cost_column(F.col("fp"), F.col("fn")).alias("cost"),
        F.col("tp"),
        F.col("fp"),
        F.col("fn"),
        F.col("tn"),
        ratio(F.col("tp") + F.col("fp"), rows).alias("predicted_positive_rate"),
        "n_unusable",
    )


def cost_curve(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", proba: str = "proba"
) -> DataFrame:
    """fp, fn, recall and cost at each grid threshold.

    One aggregation to at most GRID_POINTS+1 cells per group, spread to the whole grid as an
    array, then suffix sums; rows are never paired with thresholds.
    """
    cells = (
        _scored(df, label, proba)
        .groupBy(*by, grid_cell(F.col(proba)).alias("__cell"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    anchor = list(by) if by else [F.lit(0)]
    whole = Window.partitionBy(*anchor)
    above = whole.orderBy(F.col("__cell").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = whole.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    # A cell c is hit by thresholds 0..c-1; between two occupied cells the counts do not change,
    # so each occupied cell emits the thresholds from the previous occupied cell up to its own.
    spread = cells.select(
        *by,
        "__cell",
        F.coalesce(F.max("__cell").over(below), F.lit(0)).alias("__from"),
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(whole).alias("positives"),
        F.sum("neg").over(whole).alias("negatives"),
        F.max("__cell").over(whole).alias("__top"),
    )
    inside = F.when(
        F.col("__from") < F.col("__cell"),
        F.transform(
            F.sequence(F.col("__from"), F.col("__cell") - 1),
            lambda i: F.struct(i.alias("i"), F.col("tp").alias("tp"), F.col("fp").alias("fp")),
        ),
    )
    beyond = F.when(
        (F.col("__cell") == F.col("__top")) & (F.col("__top") < GRID_POINTS),
        F.transform(
            F.sequence(F.col("__top"), F.lit(GRID_POINTS - 1)),
            lambda i: F.struct(i.alias("i"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("fp")),
        ),
    )
    empty = F.array().cast("array<struct<i:int,tp:bigint,fp:bigint>>")
    points = F.concat(F.coalesce(inside, empty), F.coalesce(beyond, empty))
    grid = spread.select(*by, "positives", "negatives", F.explode(points).alias("__g"))
    tp, fp = F.col("__g.tp"), F.col("__g.fp")
    fn = F.col("positives") - tp
    return grid.select(
        *by,
        F.col("__g.i").alias("grid_index"),
        grid_value(F.col("__g.i")).alias("threshold"),
        fp.alias("fp"),
        fn.alias("fn"),
        ratio(tp, F.col("positives")).alias("recall"),
        cost_column(fp, fn).alias("cost"),
    )


def choose_threshold(
    df: DataFrame,
    floor: float = RECALL_FLOOR,
    by: Sequence[str] = (),
    label: str = "label",
    proba: str = "proba",
) -> DataFrame:
    """Cheapest grid threshold whose recall reaches the floor, ties to the lowest.

    Where none reaches it: the first threshold of maximal recall.
    """
    curve = cost_curve(df, by, label, proba)
    ok = F.col("recall") >= F.lit(float(floor))
    point = F.struct("grid_index", "threshold", "cost", "recall", "fp", "fn")
    best = curve.groupBy(*by).agg(
        F.min_by(point, F.when(ok, F.struct(F.col("cost"), F.col("grid_index")))).alias("__best"),
        F.min_by(point, F.struct(-F.col("recall"), F.col("grid_index"))).alias("__fallback"),
    )
    return best.withColumn("__pick", F.coalesce("__best", "__fallback")).select(
        *by,
        F.col("__pick.threshold").alias("threshold"),
        F.col("__pick.cost").alias("cost"),
        F.col("__pick.recall").alias("recall"),
        F.col("__pick.fp").alias("fp"),
        F.col("__pick.fn").alias("fn"),
        F.col("__best").isNotNull().alias("floor_met"),
    )


def slice_metrics(
    df: DataFrame,
    threshold: float | str,
    by: Sequence[str],
    min_rows: int = SLICE_MIN_ROWS,
    label: str = "label",
    proba: str = "proba",
) -> DataFrame:
    """Rows, AUC and recall per slice; small and single-class slices are skipped."""
    m = binary_metrics(df, threshold, by, label, proba)
    return m.where((F.col("n_rows") >= min_rows) & F.col("roc_auc").isNotNull()).select(
        *by, "n_rows", "roc_auc", "recall"
    )


def policy_costs(
    df: DataFrame, threshold: float | str, by: Sequence[str] = (), label: str = "label", proba: str = "proba"
) -> DataFrame:
    """Cost of the model beside never and always acting."""
    c = confusion(df, threshold, by, label, proba)
    return c.select(
        *by,
        cost_column(F.col("fp"), F.col("fn")).alias("model_cost"),
        (F.lit(FN_COST) * (F.col("tp") + F.col("fn")).cast("double")).alias("never_cost"),
        (F.lit(FP_COST) * (F.col("fp") + F.col("tn")).cast("double")).alias("always_cost"),
    )
