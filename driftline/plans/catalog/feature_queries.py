"""Feature fitting and transform queries; parameters come from the train part only."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import features as FT
from driftline.operators import split
from driftline.plans.catalog import base as B
from driftline.plans.catalog.base import q6, r6, register
from driftline.session import scratch_path

TRAIN_SQL = (
    B.LINES_SQL
    + """,
lab AS (SELECT * FROM lines WHERE outcome IS NOT NULL),
d AS (SELECT DISTINCT ship_date AS day FROM lab),
ix AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS i, count(*) OVER () AS n FROM d),
train AS (SELECT * FROM lab WHERE ship_date <= (SELECT day FROM ix WHERE i = floor(n * 0.70::DOUBLE)::INT - 1)),
med AS (SELECT median(l_quantity) AS l_quantity, median(l_extendedprice) AS l_extendedprice,
               median(l_discount) AS l_discount, median(l_tax) AS l_tax FROM train),
block AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         coalesce(b.l_quantity, med.l_quantity) AS l_quantity,
         coalesce(b.l_extendedprice, med.l_extendedprice) AS l_extendedprice,
         coalesce(b.l_discount, med.l_discount) AS l_discount, coalesce(b.l_tax, med.l_tax) AS l_tax,
         (b.l_tax IS NULL)::INT::DOUBLE AS l_tax_missing, month(ship_date)::DOUBLE AS "month",
         dayofyear(ship_date)::DOUBLE AS day_of_year, b.in_train
  FROM (SELECT *, ship_date <= (SELECT max(ship_date) FROM train) AS in_train FROM lab) b, med)
"""
)
NAMES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_tax_missing", "month", "day_of_year"]


def parts(spark: SparkSession, sf: str) -> DataFrame:
    return split.time_split(B.lines(spark, sf), "ship_date", target="outcome")


def train_part(spark: SparkSession, sf: str) -> DataFrame:
    rows = split.labeled(B.lines(spark, sf), "outcome")
    return split.take(rows, "ship_date", split.find_cuts(rows, "ship_date"), "train")


def _param_sql(name: str) -> str:
    median = f"(SELECT {name} FROM med)" if name in B.LINE_NUMERIC else "CAST(NULL AS DOUBLE)"
    std = f"stddev_pop(\"{name}\")"
    return f"""SELECT '{name}' AS feature, {median} AS median, {q6(f'avg("{name}")')} AS mean,
      {q6(f"CASE WHEN {std} = 0 THEN 1 ELSE {std} END")} AS std FROM block WHERE in_train"""


@register("fit_params", f"WITH {TRAIN_SQL} " + " UNION ALL ".join(_param_sql(n) for n in NAMES))
def fit_params(spark: SparkSession, sf: str) -> DataFrame:
    train = train_part(spark, sf)
    medians = FT.fit_medians(train, B.LINES.numeric)
    means, stds = FT.fit_scaler(train, B.LINES, medians)
    table = FT.params_table(spark, FT.FeatureParams(medians, means, stds))
    return table.select("feature", "median", r6("mean"), r6("std"))


def _z(name: str) -> str:
    return f'{q6(f"(b.{name} - s.m_{name}) / CASE WHEN s.s_{name} = 0 THEN 1 ELSE s.s_{name} END")} AS "z_{name}"'


@register(
    "scaled_features",
    f"""WITH {TRAIN_SQL}, s AS (SELECT {", ".join(f'avg("{n}") AS m_{n}, stddev_pop("{n}") AS s_{n}' for n in NAMES)}
          FROM block WHERE in_train)
        SELECT l_orderkey, l_linenumber, {", ".join(_z(n) for n in NAMES)} FROM block b, s""",
)
def scaled_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = parts(spark, sf)
    train = rows.where(F.col("split") == "train")
    medians = FT.fit_medians(train, B.LINES.numeric)
    means, stds = FT.fit_scaler(train, B.LINES, medians)
    out = FT.scaled(rows, B.LINES, FT.FeatureParams(medians, means, stds), ["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", *[r6(f"z_{n}") for n in NAMES])


@register(
    "onehot_categories",
    f"""WITH {TRAIN_SQL}, long AS (
          SELECT 'l_returnflag' AS "column", coalesce(l_returnflag, 'Unknown') AS "value" FROM train
          UNION ALL SELECT 'l_linestatus', coalesce(l_linestatus, 'Unknown') FROM train)
        SELECT "column", "value", count(*) AS n FROM long GROUP BY 1, 2""",
)
def onehot_categories(spark: SparkSession, sf: str) -> DataFrame:
    return FT.category_table(train_part(spark, sf), B.LINES.categorical)


@register(
    "onehot_slots",
    f"""WITH {B.LINES_SQL} SELECT l_orderkey, l_linenumber,
          CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE NULL END AS l_returnflag_slot,
          CASE coalesce(l_linestatus, 'Unknown') WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS l_linestatus_slot
        FROM lines""",
)
def onehot_slots(spark: SparkSession, sf: str) -> DataFrame:
    # Categories are fitted without flag R, so R is an unseen value afterwards.
    rows = B.lines(spark, sf)
    params = FT.fit_categories(rows.where("l_returnflag <> 'R'"), B.LINES.categorical)
    return FT.onehot_slots(rows, B.LINES, params, ["l_orderkey", "l_linenumber"])


@register(
    "category_dictionary",
    """WITH v AS (SELECT 'flag_supplier' AS "column", coalesce(l_returnflag, 'Unknown') || '-' || l_suppkey AS "value" FROM lineitem
         UNION ALL SELECT 'part', CASE WHEN l_partkey % 17 <> 0 THEN l_partkey::VARCHAR ELSE 'Unknown' END FROM lineitem),
       c AS (SELECT "column", "value", count(*) AS n FROM v GROUP BY 1, 2)
       SELECT "column", "value", n, row_number() OVER (PARTITION BY "column" ORDER BY "value") - 1 AS slot FROM c""",
)
def category_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Slots of columns with as many categories as there are keys."""
    rows = B.table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_returnflag", "l_suppkey").alias("flag_supplier"),
        F.when(F.col("l_partkey") % 17 != 0, F.col("l_partkey").cast("string")).alias("part"),
    )
    return spark.read.parquet(FT.category_dictionary(rows, ["flag_supplier", "part"])[0])


@register(
    "class_weights",
    f"""WITH {B.LINES_SQL}, c AS (SELECT count(*) FILTER (WHERE outcome = 'Yes') AS p,
          count(*) FILTER (WHERE outcome = 'No') AS n FROM lines)
        SELECT 1 AS label, p AS n_rows, {q6('(p + n) / (2.0::DOUBLE * p)')} AS balanced, {q6('n / p::DOUBLE')} AS positive FROM c
        UNION ALL SELECT 0, n, {q6('(p + n) / (2.0::DOUBLE * n)')}, 1.0::DOUBLE FROM c""",
)
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    label = (F.col("outcome") == "Yes").cast("int")
    t = FT.class_weight_table(B.lines(spark, sf).withColumn("label", label), "label")
    return t.select("label", "n_rows", r6("balanced"), r6("positive"))


VECTORS_SQL = f"""WITH {TRAIN_SQL}, s AS (SELECT {", ".join(f'avg("{n}") AS m_{n}' for n in NAMES)} FROM block WHERE in_train),
        k AS (SELECT (SELECT count(DISTINCT coalesce(l_returnflag, 'Unknown')) FROM train) + (SELECT count(DISTINCT coalesce(l_linestatus, 'Unknown')) FROM train) AS k),
        v AS (SELECT CASE WHEN l.ship_date <= (SELECT max(ship_date) FROM train) THEN 'train'
                WHEN l.ship_date <= (SELECT day FROM ix WHERE i = floor(n * 0.85::DOUBLE)::INT - 1) THEN 'val' ELSE 'test' END AS split,
              {" + ".join(f"(b.{n} <> s.m_{n})::INT" for n in NAMES)}
              + (coalesce(l_returnflag, 'Unknown') IN (SELECT coalesce(l_returnflag, 'Unknown') FROM train))::INT
              + (coalesce(l_linestatus, 'Unknown') IN (SELECT coalesce(l_linestatus, 'Unknown') FROM train))::INT AS nz
              FROM block b JOIN lab l USING (l_orderkey, l_linenumber, l_partkey, l_suppkey), s)
        SELECT split, count(*) AS n_rows, any_value(k)::INT + {len(NAMES)} AS width, sum(nz)::BIGINT AS non_zeros FROM v, k GROUP BY split"""


@register("feature_vectors", VECTORS_SQL)
def feature_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Assembled vectors summarised per split: rows, width, non-zeros."""
    rows = parts(spark, sf)
    params = FT.fit(rows.where(F.col("split") == "train"), B.LINES)
    return _summary(FT.feature_pipeline(rows, B.LINES, params).transform(rows))


@register("feature_reload", VECTORS_SQL)
def feature_reload(spark: SparkSession, sf: str) -> DataFrame:
    """The same vectors from the pipeline as it was saved and loaded again."""
    rows = parts(spark, sf)
    path = scratch_path(spark, "pipeline")
    FT.feature_pipeline(rows, B.LINES, FT.fit(rows.where(F.col("split") == "train"), B.LINES)).write().overwrite().save(path)
    return _summary(PipelineModel.load(path).transform(rows))


def _summary(vec: DataFrame) -> DataFrame:
    values = vec.select("split", vector_to_array("features").alias("v"))
    return values.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.max(F.size("v")).alias("width"),
        F.sum(F.size(F.filter("v", lambda x: x != 0))).alias("non_zeros"),
    )
