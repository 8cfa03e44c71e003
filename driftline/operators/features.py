"""Features fitted on the training part and applied everywhere with the same parameters.

The fitted numbers are a few hundred, which enter plans as literals. Categories, however many, are a written
table (column, value, n, slot), numbered by a distributed ranking and looked up by a join; none of it passes through
the driver. A row's features never depend on its batch.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions import columns as X
from driftline.operators.ordered import dense_places, exact_quantiles, sql_double
from driftline.session import scratch_path
from driftline.spec import TableSpec

UNKNOWN = "Unknown"  # Fixed value: category that stands for a missing text value.


#: Dictionaries of a column with at most this many values are sent to every task; their size is counted.
BROADCAST_VALUES = 200_000


@dataclass(frozen=True)
class FeatureParams:
    medians: dict[str, float] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)  # categories of each column
    dictionary: str = ""  # path of the written category table

    @property
    def width(self) -> int:
        return len(self.means) + sum(self.sizes.values())

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> FeatureParams:
        return FeatureParams(**json.loads(text))


def _numeric_names(spec: TableSpec) -> list[str]:
    return [*spec.numeric, *[f"{c}_missing" for c in spec.sparse], "month", "day_of_year"]


def numeric_block(spec: TableSpec, medians: dict[str, float]) -> dict[str, Column]:
    """Imputed values, missing flags (taken before imputing) and calendar fields."""
    out = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(medians[c]))) for c in spec.numeric}
    out |= {f"{c}_missing": X.missing_flag(F.col(c)) for c in spec.sparse}
    out["month"] = X.month(F.col(spec.date))
    out["day_of_year"] = X.day_of_year(F.col(spec.date))
    return out


def fit_medians(train: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact medians; a column without values gets 0."""
    q = exact_quantiles(train, cols, [0.5])
    return {c: 0.0 if q[c] is None else q[c][0] for c in cols}


def fit_scaler(
    train: DataFrame, spec: TableSpec, medians: dict[str, float]
) -> tuple[dict[str, float], dict[str, float]]:
    """Mean and population std of the numeric block, one aggregation."""
    block = numeric_block(spec, medians)
    aggs = []
    for i, c in enumerate(block.values()):
        aggs += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    row = train.agg(*aggs).first()
    means = {name: row[f"m{i}"] for i, name in enumerate(block)}
    stds = {name: row[f"s{i}"] or 1.0 for i, name in enumerate(block)}
    return means, stds


def category_table(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n) of every category seen, `Unknown` included where values were missing."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), X.fill_cat(F.col(c), UNKNOWN).alias("value")) for c in cols]
    )
    long = train.select(F.explode(entries).alias("e")).select("e.*")
    return long.groupBy("column", "value").agg(F.count("*").alias("n"))


def category_dictionary(train: DataFrame, cols: Sequence[str], path: str | None = None) -> tuple[str, dict[str, int]]:
    """Write (column, value, n, slot) of all categories, slots in value order from 0; its path and sizes by column."""
    spark = train.sparkSession
    path = path or scratch_path(spark, "categories")
    if cols:
        placed = dense_places(category_table(train, cols), ["column"], ["value"], "category-ranges")
        placed = placed.withColumnRenamed("place", "slot")
    else:
        placed = spark.createDataFrame([], "column string, value string, n bigint, slot bigint")
    placed.write.mode("overwrite").parquet(path)
    sizes = spark.read.parquet(path).groupBy("column").agg(F.count("*").alias("n")).collect()  # a row a column
    return path, {c: 0 for c in cols} | {r["column"]: r["n"] for r in sizes}


def fit_categories(train: DataFrame, cols: Sequence[str], path: str | None = None) -> FeatureParams:
    """Parameters with the categories alone."""
    where, sizes = category_dictionary(train, cols, path)
    return FeatureParams(sizes=sizes, dictionary=where)


def fit(train: DataFrame, spec: TableSpec, dictionary: str | None = None) -> FeatureParams:
    """All parameters; the category table goes to `dictionary`, by default below the shared folder."""
    medians = fit_medians(train, spec.numeric)
    means, stds = fit_scaler(train, spec, medians)
    where, sizes = category_dictionary(train, spec.categorical, dictionary)
    return FeatureParams(medians, means, stds, sizes, where)


def params_table(spark: SparkSession, params: FeatureParams) -> DataFrame:
    """Fitted numeric parameters as a table (feature, median, mean, std)."""
    rows = [(n, params.medians.get(n), params.means[n], params.stds[n]) for n in params.means]
    return spark.createDataFrame(rows, "feature string, median double, mean double, std double")


def scaled(df: DataFrame, spec: TableSpec, params: FeatureParams, keep: Sequence[str] = ()) -> DataFrame:
    """Scaled numeric features as plain columns `z_<feature>`."""
    block = numeric_block(spec, params.medians)
    return df.select(
        *keep,
        *[((c - F.lit(params.means[n])) / F.lit(params.stds[n])).alias(f"z_{n}") for n, c in block.items()],
    )


def _lookup_sql(params: FeatureParams, column: str, value: str, out: str, rows: str) -> str:
    """SQL that adds `out`, the slot of a value; the number of categories for a value unseen in training.

    A plain join beyond BROADCAST_VALUES: adaptive execution splits a partition of frequent values.
    """
    size = params.sizes[column]
    hint = "/*+ BROADCAST(d) */ " if size <= BROADCAST_VALUES else ""
    name = column.replace("'", "\\'")
    listed = f"(SELECT value AS __value, slot AS __slot FROM parquet.`{params.dictionary}` WHERE column = '{name}')"
    return (
        f"SELECT {hint}t.*, CAST(coalesce(d.__slot, {size}) AS DOUBLE) AS `{out}` "
        f"FROM {rows} t LEFT JOIN {listed} d ON t.`{value}` = d.__value"
    )


def onehot_slots(
    df: DataFrame, spec: TableSpec, params: FeatureParams, keep: Sequence[str] = ()
) -> DataFrame:
    """One-hot slot index per categorical column; null for a value unseen in training."""
    rows = df.select(*keep, *[X.fill_cat(F.col(c), UNKNOWN).alias(f"__c_{c}") for c in spec.categorical])
    slots = []
    for c in spec.categorical:
        rows = df.sparkSession.sql(_lookup_sql(params, c, f"__c_{c}", f"__i_{c}", "{rows}"), rows=rows)
        slot = F.col(f"__i_{c}").cast("int")
        slots.append(F.when(slot < params.sizes[c], slot).alias(f"{c}_slot"))
    return rows.select(*keep, *slots)


def feature_pipeline(df: DataFrame, spec: TableSpec, params: FeatureParams) -> PipelineModel:
    """The fitted transform as a saveable pipeline ending in a `features` vector."""

    def numeric_sql() -> list[str]:
        raw = {c: f"coalesce(CAST(`{c}` AS DOUBLE), {sql_double(params.medians[c])})" for c in spec.numeric}
        raw |= {f"{c}_missing": f"CAST(`{c}` IS NULL AS DOUBLE)" for c in spec.sparse}
        raw["month"] = f"CAST(month(`{spec.date}`) AS DOUBLE)"
        raw["day_of_year"] = f"CAST(dayofyear(`{spec.date}`) AS DOUBLE)"
        return [
            f"({expr} - {sql_double(params.means[n])}) / {sql_double(params.stds[n])} AS `z_{n}`"
            for n, expr in raw.items()
        ]

    texts = [f"coalesce(CAST(`{c}` AS STRING), '{UNKNOWN}') AS `c_{c}`" for c in spec.categorical]
    stages = [SQLTransformer(statement="SELECT *, " + ", ".join(numeric_sql() + texts) + " FROM __THIS__")]
    inputs = [f"z_{n}" for n in _numeric_names(spec)]
    if spec.categorical:
        for c in spec.categorical:
            # Without dictionary columns beside the rows: __THIS__ is the table as it came.
            stages.append(SQLTransformer(statement=_lookup_sql(params, c, f"c_{c}", f"i_{c}", "__THIS__")))
        # The extra slot of unseen values is the one dropped, so an unseen value is all zeros.
        encoder = OneHotEncoder(
            inputCols=[f"i_{c}" for c in spec.categorical],
            outputCols=[f"o_{c}" for c in spec.categorical],
            dropLast=True,
        )
        known = [
            F.lit(0.0).alias(f"i_{c}", metadata={"ml_attr": {"type": "nominal", "num_vals": params.sizes[c] + 1}})
            for c in spec.categorical
        ]
        stages.append(encoder.fit(df.sparkSession.range(0).select(*known)))
        inputs += [f"o_{c}" for c in spec.categorical]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return PipelineModel(stages)


def drop_scratch(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Remove the pipeline's intermediate columns."""
    extra = [f"z_{n}" for n in _numeric_names(spec)]
    extra += [f"{p}_{c}" for c in spec.categorical for p in ("c", "i", "o")]
    return df.drop(*extra)


def class_counts(df: DataFrame, label: str) -> tuple[int, int]:
    row = df.agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")
    ).first()
    return row["p"], row["n"]


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """(class, n_rows, balanced, positive) weights, counts floored at 1."""
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")
    )
    p, n = F.greatest("p", F.lit(1)).cast("double"), F.greatest("n", F.lit(1)).cast("double")
    total = (F.col("p") + F.col("n")).cast("double")
    rows = F.array(
        F.struct(
            F.lit(1).alias("label"), F.col("p").alias("n_rows"), (total / (2.0 * p)).alias("balanced"), (n / p).alias("positive")
        ),
        F.struct(
            F.lit(0).alias("label"), F.col("n").alias("n_rows"), (total / (2.0 * n)).alias("balanced"), F.lit(1.0).alias("positive")
        ),
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def class_weights(p: int, n: int, mode: str) -> tuple[float, float]:
    """Weights of class 0 and class 1, given their rows."""
    p1, n1 = max(p, 1), max(n, 1)
    return ((p + n) / (2.0 * n1), (p + n) / (2.0 * p1)) if mode == "balanced" else (1.0, n1 / p1)


def with_weight(df: DataFrame, label: str, mode: str) -> tuple[DataFrame, float]:
    """Add `weight`: `balanced` = n/(2*n_class), `positive` = n_neg/n_pos for positives.

    Also returns the weight total, which follows from the class counts.
    """
    p, n = class_counts(df, label)
    neg, pos = class_weights(p, n, mode)
    weight = F.when(F.col(label) == 1, F.lit(pos)).otherwise(F.lit(neg))
    return df.withColumn("weight", weight), p * pos + n * neg
