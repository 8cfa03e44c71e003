"""Shared inputs of the catalogue, each as a Spark table and as the same SQL.

The given tables are clean, so nulls, faults and label noise are put in by key arithmetic on the
whole table, identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.columns import rounded
from driftline.operators.contract import inject
from driftline.spec import TableSpec, between, flatten, isin, not_null

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Means of decimal data often end exactly on half a unit of the last compared place, where the
# order of summation decides the rounding. Both sides therefore add a hair more than a half.
HALF = 0.5001


def r6(c: Column | str, name: str | None = None) -> Column:
    """Six compared decimals, from the same double expression as `q6`."""
    col = F.col(c) if isinstance(c, str) else c
    out = F.floor(col * F.lit(1e6) + F.lit(HALF)).cast("double") / F.lit(1e6)
    return out.alias(name or c) if name or isinstance(c, str) else out


def q6(expr: str) -> str:
    """SQL text of the same rounding."""
    return f"floor(({expr}) * 1e6 + {HALF}::DOUBLE) / 1e6"


LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
LINE_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

LINES = TableSpec(
    name="lines",
    key=LINE_KEY,
    date="ship_date",
    numeric=LINE_NUMERIC,
    categorical=("l_returnflag", "l_linestatus"),
    target="outcome",
    leak=("leak",),
    sparse=("l_tax",),
    rules=flatten(
        [
            not_null("ship_date"),
            between("l_quantity", 1, 50),
            between("l_extendedprice", 0, 200000),
            between("l_discount", 0, 1),
            between("l_tax", 0, 1),
            isin("l_linestatus", "O", "F"),
            isin("outcome", "Yes", "No", training=True),
        ]
    ),
)

LINES_SQL = """
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS ship_date,
         l_quantity, l_extendedprice, l_discount,
         CASE WHEN (l_orderkey + l_linenumber) % 11 <> 0 THEN l_tax END AS l_tax,
         l_returnflag,
         CASE WHEN l_partkey % 17 <> 0 THEN l_linestatus END AS l_linestatus,
         CASE WHEN l_orderkey % 13 = 0 THEN NULL
              WHEN (l_extendedprice > 80000) <> (l_orderkey % 10 = 0) THEN 'Yes' ELSE 'No' END AS outcome
  FROM lineitem)
"""


def noisy_label() -> Column:
    """Dear lines, one order in ten inverted."""
    return (F.col("l_extendedprice") > 80000) != (F.col("l_orderkey") % 10 == 0)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        *LINE_KEY,
        F.col("l_shipdate").cast("date").alias("ship_date"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 11 != 0, F.col("l_tax")).alias("l_tax"),
        "l_returnflag",
        F.when(F.col("l_partkey") % 17 != 0, F.col("l_linestatus")).alias("l_linestatus"),
        F.when(F.col("l_orderkey") % 13 == 0, F.lit(None).cast("string"))
        .when(noisy_label(), F.lit("Yes"))
        .otherwise(F.lit("No"))
        .alias("outcome"),
    )


FAULTY_SQL = (
    LINES_SQL
    + """,
faulty AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_orderkey % 107 = 0 THEN NULL ELSE ship_date END AS ship_date,
         CASE WHEN l_orderkey % 97 = 0 THEN -5.0::DOUBLE ELSE l_quantity END AS l_quantity,
         l_extendedprice,
         CASE WHEN l_orderkey % 101 = 0 THEN 1.5::DOUBLE ELSE l_discount END AS l_discount,
         l_tax, l_returnflag,
         CASE WHEN l_orderkey % 109 = 0 THEN 'X' ELSE l_linestatus END AS l_linestatus,
         CASE WHEN l_orderkey % 103 = 0 THEN 'Maybe' ELSE outcome END AS outcome
  FROM lines)
"""
)


def faulty(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("l_orderkey")
    return inject(
        lines(spark, sf),
        {
            "ship_date": (key % 107 == 0, None),
            "l_quantity": (key % 97 == 0, -5.0),
            "l_discount": (key % 101 == 0, 1.5),
            "l_linestatus": (key % 109 == 0, "X"),
            "outcome": (key % 103 == 0, "Maybe"),
        },
    )


# The faults of the table above, long form, written rule by rule for the SQL side.
VIOLATIONS_SQL = (
    FAULTY_SQL
    + """,
viol AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 0 AS ordinal, 'ship_date' AS "column",
         'not_nullable' AS "check", CAST(NULL AS VARCHAR) AS "value", ship_date, outcome FROM faulty WHERE ship_date IS NULL
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 1, 'l_quantity',
         'greater_than_or_equal_to(1)', CAST(l_quantity AS VARCHAR), ship_date, outcome FROM faulty WHERE l_quantity < 1
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 6, 'l_discount',
         'less_than_or_equal_to(1)', CAST(l_discount AS VARCHAR), ship_date, outcome FROM faulty WHERE l_discount > 1
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 9, 'l_linestatus',
         'isin([''O'', ''F''])', l_linestatus, ship_date, outcome FROM faulty WHERE l_linestatus NOT IN ('O', 'F')
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 10, 'outcome',
         'isin([''Yes'', ''No''])', outcome, ship_date, outcome FROM faulty WHERE outcome NOT IN ('Yes', 'No'))
"""
)


def blend(price: float, quantity: float) -> Column:
    """Score in [0, 1] from price and quantity, four decimals."""
    raw = F.lit(price) * F.col("l_extendedprice") / F.lit(105000.0) + F.lit(quantity) * F.col("l_quantity") / F.lit(50.0)
    return rounded(raw, 4)


def blend_sql(price: float, quantity: float) -> str:
    return (
        f"floor((({price}::DOUBLE * l_extendedprice / 105000.0::DOUBLE) + "
        f"({quantity}::DOUBLE * l_quantity / 50.0::DOUBLE)) * 1e4 + 0.5) / 1e4"
    )


SCORED_SQL = f"""
scored AS (
  SELECT l_orderkey, l_linestatus, l_returnflag, CAST(l_shipdate AS DATE) AS ship_date,
         CAST(month(l_shipdate) AS INTEGER) AS ship_month,
         CASE WHEN (l_extendedprice > 80000) <> (l_orderkey % 10 = 0) THEN 1 ELSE 0 END AS label,
         {blend_sql(0.7, 0.3)} AS proba
  FROM lineitem)
"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linestatus",
        "l_returnflag",
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.month("l_shipdate").alias("ship_month"),
        noisy_label().cast("int").alias("label"),
        blend(0.7, 0.3).alias("proba"),
    )


# Candidate models of the registry queries: score weights and stored size in MB.
MODELS = {"logreg": (0.7, 0.3, 0.0072), "gbt": (0.9, 0.1, 0.5793), "forest": (0.4, 0.6, 3.2332)}
MODEL_THRESHOLD = 0.55
