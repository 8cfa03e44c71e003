"""Split, window and sample queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import split
from driftline.plans.catalog.base import q6, r6, register, table

DATES_SQL = """
d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
ix AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS i, count(*) OVER () AS n FROM d),
cut AS (
  SELECT n, greatest(floor(n * 0.70::DOUBLE)::INT, 1) AS tc,
         floor(n * (0.70::DOUBLE + 0.15::DOUBLE))::INT AS raw FROM ix LIMIT 1),
cuts AS (SELECT n, tc, least(greatest(raw, tc + 1), n - 1) AS vc FROM cut),
ends AS (
  SELECT (SELECT day FROM ix, cuts WHERE i = tc - 1) AS train_end,
         (SELECT day FROM ix, cuts WHERE i = vc - 1) AS val_end)
"""
SPLIT_SQL = (
    DATES_SQL
    + """,
parts AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus,
         CASE WHEN CAST(o_orderdate AS DATE) <= train_end THEN 'train'
              WHEN CAST(o_orderdate AS DATE) <= val_end THEN 'val' ELSE 'test' END AS split
  FROM orders, ends)
"""
)


@register("date_index", f"WITH {DATES_SQL} SELECT CAST(i AS INTEGER) AS date_index, day AS date FROM ix")
def date_index(spark: SparkSession, sf: str) -> DataFrame:
    return split.date_index(table(spark, sf, "orders"), "o_orderdate")


@register("cut_dates", f"WITH {DATES_SQL} SELECT CAST(n AS INTEGER) AS n_dates, train_end, val_end FROM cuts, ends")
def cut_dates(spark: SparkSession, sf: str) -> DataFrame:
    return split.cut_dates(table(spark, sf, "orders"), "o_orderdate")


@register("time_split", f"WITH {SPLIT_SQL} SELECT o_orderkey, split FROM parts")
def time_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.time_split(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "split")


@register(
    "split_info",
    f"""WITH {SPLIT_SQL} SELECT split, min(day) AS first_date, max(day) AS end_date, count(*) AS n_rows,
        {q6("avg((o_orderstatus = 'F')::INT)")} AS positive_rate FROM parts GROUP BY 1""",
)
def split_info(spark: SparkSession, sf: str) -> DataFrame:
    parts = split.time_split(table(spark, sf, "orders"), "o_orderdate")
    info = split.split_info(parts, "o_orderdate", F.col("o_orderstatus") == "F")
    return info.select("split", "first_date", "end_date", "n_rows", r6("positive_rate"))


@register(
    "sort_labeled",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus <> 'P' ORDER BY 2, 1",
)
def sort_labeled(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("outcome", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    rows = split.sort_labeled(o, "o_orderdate", ["o_orderkey"], "outcome")
    return rows.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))


@register(
    "split_guards",
    f"""WITH u AS (SELECT o_custkey, CASE WHEN o_orderpriority < '3' AND o_custkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders),
        c AS (SELECT o_custkey, count(day) AS n_rows, count(DISTINCT day)::INT AS n_dates FROM u GROUP BY 1),
        t AS (SELECT *, greatest(floor(n_dates * 0.70::DOUBLE)::INT, 1) AS tc, floor(n_dates * (0.70::DOUBLE + 0.15::DOUBLE))::INT AS raw FROM c),
        v AS (SELECT *, least(greatest(raw, tc + 1), n_dates - 1) AS vc FROM t),
        g AS (SELECT *, CASE WHEN n_dates = 0 THEN '{split.NO_ROWS}' WHEN n_dates < 3 THEN '{split.FEW_DATES}'
                WHEN tc >= vc OR vc >= n_dates THEN '{split.EMPTY_PART}' END AS guard FROM v)
        SELECT o_custkey, n_rows, n_dates, CASE WHEN guard IS NULL THEN tc END AS train_dates,
          CASE WHEN guard IS NULL THEN vc - tc END AS val_dates, CASE WHEN guard IS NULL THEN n_dates - vc END AS test_dates, guard FROM g""",
)
def split_guards(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer's urgent orders as a table of its own; one customer in ten has no label."""
    usable = (F.col("o_orderpriority") < "3") & (F.col("o_custkey") % 10 != 0)
    rows = table(spark, sf, "orders").withColumn("outcome", F.when(usable, F.col("o_orderstatus")))
    return split.split_outcomes(rows, "o_orderdate", ["o_custkey"], "outcome")


@register(
    "recent_window",
    f"""WITH {DATES_SQL} SELECT o_orderkey FROM orders
        WHERE CAST(o_orderdate AS DATE) >= (SELECT day FROM ix WHERE i = floor(n * 0.60::DOUBLE)::INT)""",
)
def recent_window(spark: SparkSession, sf: str) -> DataFrame:
    return split.recent_window(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey")


@register(
    "sample_n",
    """SELECT o_orderkey FROM orders
       ORDER BY ('0x' || substr(md5(o_orderkey::VARCHAR || '|7'), 1, 8))::BIGINT, o_orderkey LIMIT 4000""",
)
def sample_n(spark: SparkSession, sf: str) -> DataFrame:
    return split.sample_n(table(spark, sf, "orders"), 4000, 7, ["o_orderkey"]).select("o_orderkey")
