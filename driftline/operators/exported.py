"""Fitted models as tables, scored by plans and checked against the rows they were fitted on.

A linear model is a row a feature (slot, feature, value, weight), a tree model a row a node (tree, node, feature,
threshold, left, right, ..). Any engine can read them; here a weighted sum and a join of nodes a level score rows
without the ML library. The certificates recompute from the training rows what a fit claims: the gradient of the
linear model's objective at its coefficients, and the weighted statistics of every node that boosting stored.

Tables of models are bounded by their settings (trees and depth) or by the features' width; sides of joins
are broadcast only when counted and small.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.columns import ratio
from driftline.operators import features as FT
from driftline.session import scratch_path
from driftline.spec import TableSpec

INTERCEPT = "(intercept)"
#: Nodes of a tree model that may be broadcast: 40 trees of depth 12 have fewer.
BROADCAST_NODES = 400_000


@dataclass(frozen=True)
class Inputs:
    """Where each feature lies: numeric ones first, then one block of slots a categorical column."""

    numeric: tuple[str, ...]
    text: tuple[str, ...]
    sizes: tuple[int, ...]

    @staticmethod
    def of(spec: TableSpec, params: FT.FeatureParams) -> Inputs:
        return Inputs(tuple(params.means), spec.categorical, tuple(params.sizes[c] for c in spec.categorical))

    @property
    def offsets(self) -> list[int]:
        out = [len(self.numeric)]
        for n in self.sizes:
            out.append(out[-1] + n)
        return out

    def value(self, number: Column) -> Column:
        """Value of feature `number` of a row with columns z and slots."""
        out = F.when(number < len(self.numeric), F.get("z", number))
        for k, start in enumerate(self.offsets[:-1]):
            here = F.coalesce((F.get("slots", F.lit(k)) == number - start).cast("double"), F.lit(0.0))
            out = out.when((number >= start) & (number < self.offsets[k + 1]), here)
        return out

    def place(self, number: Column) -> tuple[Column, Column]:
        """Which column of slots a feature number belongs to, -1 for the numeric block, and its number in there."""
        kind, local = F.when(number < len(self.numeric), F.lit(-1)), F.when(number < len(self.numeric), number)
        for k, start in enumerate(self.offsets[:-1]):
            here = number < self.offsets[k + 1]
            kind, local = kind.when(here, F.lit(k)), local.when(here, number - start)
        return kind, local


def inputs(df: DataFrame, spec: TableSpec, params: FT.FeatureParams, keep: Sequence[str] = ()) -> DataFrame:
    """Rows with `z`, the scaled numbers, and `slots`, the category of each column; an unseen one has no slot."""
    block = FT.numeric_block(spec, params.medians)
    z = F.array(*((c - F.lit(params.means[n])) / F.lit(params.stds[n]) for n, c in block.items()))
    rows = df.select("*", z.alias("z"))
    slotted = FT.onehot_slots(rows, spec, params, [*keep, "z"])
    slots = F.array(*(F.col(f"{c}_slot") for c in spec.categorical)) if spec.categorical else F.array().cast("array<int>")
    return slotted.select(*keep, "z", slots.alias("slots"))


def coefficients(spark: SparkSession, model, spec: TableSpec, params: FT.FeatureParams) -> DataFrame:
    """(slot, feature, value, weight) of a fitted logistic regression; the intercept has slot -1."""
    shape = Inputs.of(spec, params)
    listed = [(-1, float(model.intercept)), *enumerate(float(x) for x in model.coefficients)]
    weights = spark.createDataFrame(listed, "slot int, weight double")
    starts = [(c, start) for c, start in zip(shape.text, shape.offsets, strict=False)]
    named = [(i, f"z_{n}", None) for i, n in enumerate(shape.numeric)] + [(-1, INTERCEPT, None)]
    names = spark.createDataFrame(named, "slot int, feature string, value string")
    if starts:
        places = F.broadcast(spark.createDataFrame(starts, "column string, start int"))  # a row a column
        seen = spark.read.parquet(params.dictionary).join(places, "column")
        names = names.unionByName(seen.select((F.col("slot") + F.col("start")).cast("int").alias("slot"), F.col("column").alias("feature"), "value"))
    return names.join(weights, "slot").select("slot", "feature", "value", "weight")


def margin(rows: DataFrame, weights: DataFrame, shape: Inputs) -> DataFrame:
    """Rows (.., z, slots) with `margin`, the weighted sum of their features."""
    wide = len(shape.numeric)
    # one row: as many numbers as numeric features
    known = weights.where((F.col("slot") < wide) & (F.col("slot") >= 0)).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("slot", "weight"))), lambda s: s["weight"]).alias("__w")
    )
    base = weights.where(F.col("slot") == -1).agg(F.sum("weight").alias("__b"))
    out = rows.crossJoin(F.broadcast(known)).crossJoin(F.broadcast(base))
    total = F.aggregate(F.zip_with("z", "__w", lambda x, w: x * w), F.col("__b"), lambda s, x: s + x)
    out = out.withColumn("margin", total).drop("__w", "__b")
    for k, (start, size) in enumerate(zip(shape.offsets, shape.sizes, strict=False)):
        block = weights.where((F.col("slot") >= start) & (F.col("slot") < start + size))
        block = block.select((F.col("slot") - start).alias("__slot"), F.col("weight").alias("__part"))
        block = F.broadcast(block) if size <= FT.BROADCAST_VALUES else block
        out = out.withColumn("__slot", F.get("slots", F.lit(k))).join(block, "__slot", "left")
        out = out.withColumn("margin", F.col("margin") + F.coalesce("__part", F.lit(0.0))).drop("__part", "__slot")
    return out


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def logreg_gradient(
    train: DataFrame, weights: DataFrame, shape: Inputs, label: str = "label", weight: str = "weight"
) -> DataFrame:
    """(slot, feature, value, weight, gradient): the gradient of the penalised mean loss at the coefficients.

    Rows are (label, weight, z, slots). The penalty is half the squared coefficients, the intercept apart, against
    the summed weighted loss; the gradient is divided by the total weight.
    """
    miss = F.col(weight) * (logistic(F.col("margin")) - F.col(label))
    scored = margin(train, weights, shape).select(miss.alias("miss"), "z", "slots", F.col(weight).alias("w"))
    numbers = F.transform("z", lambda x, i: F.struct(i.alias("slot"), x.alias("x")))
    parts = [F.array(F.struct(F.lit(-1).alias("slot"), F.lit(1.0).alias("x"))), numbers]
    for k, start in enumerate(shape.offsets[:-1]):
        slot = F.get("slots", F.lit(k)) + start
        parts.append(F.array(F.struct(slot.cast("int").alias("slot"), F.lit(1.0).alias("x"))))
    long = scored.select("miss", "w", F.explode(F.concat(*parts)).alias("e"))
    sums = long.groupBy("e.slot").agg(F.sum(F.col("miss") * F.col("e.x")).alias("s"))
    total = train.agg(F.sum(weight).alias("total"))
    pull = F.when(F.col("slot") == -1, 0.0).otherwise(F.col("weight"))
    told = weights.join(sums, "slot", "left").crossJoin(F.broadcast(total))
    gradient = (F.coalesce("s", F.lit(0.0)) + pull) / F.col("total")
    return told.select("slot", "feature", "value", "weight", gradient.alias("gradient"))


def nodes(spark: SparkSession, model) -> DataFrame:
    """Nodes of a fitted forest or boosting, read from its stored form: no node passes through the driver.

    (tree, node, feature, threshold, left_value, left, right, prediction, stats, gain, n_rows, tree_weight). Leaves
    have left -1. A split on a category goes left where the feature equals left_value.
    """
    path = scratch_path(spark, "model")
    model.write().save(path)
    stored = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "tree_weight").drop("metadata")
    ordered, limit = F.col("split.numCategories") == -1, F.get("split.leftCategoriesOrThreshold", F.lit(0))
    return stored.join(F.broadcast(weights), "treeID").select(  # a row a tree
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.col("split.featureIndex").alias("feature"),
        F.when(ordered, limit).alias("threshold"),
        F.when(~ordered, limit).alias("left_value"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        "prediction",
        F.col("impurityStats").alias("stats"),
        "gain",
        F.col("rawCount").alias("n_rows"),
        "tree_weight",
    )


def rules(table: DataFrame, shape: Inputs) -> DataFrame:
    """What a row needs to know of a node: (tree, node, left, right, kind, local, threshold, left_value, hit, miss).

    A slot is there or not, so for a split on one both outcomes are settled here, not row by row.
    """
    kind, local = shape.place(F.col("feature"))

    def settled(value: float) -> Column:
        return F.coalesce(F.lit(value) <= F.col("threshold"), F.lit(value) == F.col("left_value"))

    return table.select(
        "tree", "node", "left", "right", kind.alias("kind"), local.alias("local"), "threshold", "left_value",
        settled(1.0).alias("hit"), settled(0.0).alias("miss"),
    )


def step(rows: DataFrame, known: DataFrame, small: bool) -> DataFrame:
    """Rows (.., z, slots, tree, node) one level further down by the rules; those in a leaf stay.

    The number is looked up in a lambda, which ends a stage of generated code: fused into one method, the joins of
    all levels took about six times as long.
    """
    joined = rows.join(F.broadcast(known) if small else known, ["tree", "node"])
    number = F.get(F.transform(F.array("local"), lambda k: F.get("z", k)), F.lit(0))
    goes_left = (
        F.when(F.col("kind") < 0, F.coalesce(number <= F.col("threshold"), number == F.col("left_value")))
        .when(F.get("slots", F.col("kind")) == F.col("local"), F.col("hit"))
        .otherwise(F.col("miss"))
    )
    node = F.when(F.col("left") < 0, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
    # never null, or the next join would test it for that and work it out twice
    return joined.withColumn("node", F.coalesce(node, F.lit(-1))).drop(*(c for c in known.columns if c not in ("tree", "node")))


def routed(rows: DataFrame, table: DataFrame, shape: Inputs, depth: int, trees: int) -> DataFrame:
    """Rows (.., z, slots) with `tree` and `node`, the leaf they fall into, one row a tree."""
    small = table.count() <= BROADCAST_NODES
    out = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("node", F.lit(0))
    known = rules(table, shape)
    for _ in range(depth):
        out = step(out, known, small)
    return out


def score_forest(rows: DataFrame, table: DataFrame, shape: Inputs, depth: int, trees: int, key: Sequence[str]) -> DataFrame:
    """(key.., proba): mean share of class 1 in the rows' leaves."""
    leaves = table.select("tree", "node", ratio(F.get("stats", F.lit(1)), F.get("stats", F.lit(0)) + F.get("stats", F.lit(1))).alias("p"))
    told = routed(rows, table, shape, depth, trees).join(F.broadcast(leaves) if table.count() <= BROADCAST_NODES else leaves, ["tree", "node"])
    return told.groupBy(*key).agg((F.sum("p") / trees).alias("proba"))


def score_boosting(rows: DataFrame, table: DataFrame, shape: Inputs, depth: int, trees: int, key: Sequence[str]) -> DataFrame:
    """(key.., proba): logistic of twice the weighted sum of the leaves' predictions."""
    leaves = table.select("tree", "node", (F.col("prediction") * F.col("tree_weight")).alias("p"))
    told = routed(rows, table, shape, depth, trees).join(F.broadcast(leaves) if table.count() <= BROADCAST_NODES else leaves, ["tree", "node"])
    return told.groupBy(*key).agg(logistic(2.0 * F.sum("p")).alias("proba"))


def boosting_statistics(
    train: DataFrame, table: DataFrame, shape: Inputs, depth: int, trees: int, label: str = "label", weight: str = "weight"
) -> DataFrame:
    """(tree, node, weight, total, squares) of every node, from routing the training rows tree by tree.

    Each tree is fitted to what the trees before it leave: the label as -1 or 1 for the first one, then
    4y / (1 + exp(2y * margin so far)). Rows (label, weight, z, slots) keep their margin as they pass.
    """
    spark = train.sparkSession
    small = table.count() <= BROADCAST_NODES
    leaves = table.select("tree", "node", (F.col("prediction") * F.col("tree_weight")).alias("__p"))
    y = 2.0 * F.col(label) - 1.0
    rows = train.select("z", "slots", F.col(weight).alias("w"), y.alias("y"), F.lit(0.0).alias("m"))
    known = rules(table, shape)
    path, sums = scratch_path(spark, "boosting"), scratch_path(spark, "boosting-sums")
    for tree in range(trees):
        want = F.col("y") if tree == 0 else 4.0 * F.col("y") / (1.0 + F.exp(2.0 * F.col("y") * F.col("m")))
        here = rows.withColumns({"t": want, "tree": F.lit(tree), "node": F.lit(0)})
        for _ in range(depth):
            here = step(here, known, small)
        here = here.join(F.broadcast(leaves) if small else leaves, ["tree", "node"])
        here = here.select("z", "slots", "w", "y", (F.col("m") + F.col("__p")).alias("m"), "t", "node")
        # Written tree by tree, in two slots: a plan never holds more than one tree.
        here.write.mode("overwrite").parquet(f"{path}/{tree % 2}")
        rows = spark.read.schema(here.schema).parquet(f"{path}/{tree % 2}")
        w, t = F.col("w"), F.col("t")
        told = rows.groupBy("node").agg(F.sum("w").alias("weight"), F.sum(w * t).alias("total"), F.sum(w * t * t).alias("squares"))
        told.withColumn("tree", F.lit(tree)).write.mode("append").parquet(sums)
        rows = rows.drop("t", "node")
    return _with_ancestors(spark.read.parquet(sums), table, depth)


def _with_ancestors(leaves: DataFrame, table: DataFrame, depth: int) -> DataFrame:
    """Sums (tree, node, weight, total, squares) of every node from those of the leaves: a row passed all nodes above its own."""
    parents = table.where("left >= 0").select("tree", F.col("node").alias("parent"), F.explode(F.array("left", "right")).alias("node"))
    level, found = leaves, leaves
    for _ in range(depth):
        level = level.join(parents, ["tree", "node"]).select("tree", F.col("parent").alias("node"), "weight", "total", "squares")
        found = found.unionByName(level)
    return found.groupBy("tree", "node").agg(*(F.sum(c).alias(c) for c in ("weight", "total", "squares")))


def split_gains(table: DataFrame, classes: bool) -> DataFrame:
    """(tree, node, gain, recomputed) of every split, from the statistics of a node and its children.

    Gini impurity of the class weights for a forest, variance for boosting.
    """
    if classes:
        total = F.get("stats", F.lit(0)) + F.get("stats", F.lit(1))
        impurity = 1.0 - F.pow(F.get("stats", F.lit(0)) / total, 2) - F.pow(F.get("stats", F.lit(1)) / total, 2)
    else:
        total = F.get("stats", F.lit(0))
        impurity = (F.get("stats", F.lit(2)) - F.pow(F.get("stats", F.lit(1)), 2) / total) / total
    told = table.select("tree", "node", "left", "right", "gain", total.alias("w"), impurity.alias("i"))

    def child(name: str) -> DataFrame:
        return told.select("tree", F.col("node").alias(name), F.col("w").alias(f"{name}_w"), F.col("i").alias(f"{name}_i"))

    splits = told.where("left >= 0").join(child("left"), ["tree", "left"]).join(child("right"), ["tree", "right"])
    gain = F.expr("i - left_w / w * left_i - right_w / w * right_i")
    return splits.select("tree", "node", "gain", gain.alias("recomputed"))
