"""Fixed weather rows from key arithmetic: one row per day, four stations."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.columns import unit_hash
from driftline.plans.weather import BOUNDS, WEATHER

DIRECTIONS = ["N", "E", "S", "W"]
# Low end and width of the values drawn per sensor, well inside the contract.
DRAW = {
    "MinTemp": (5, 15), "MaxTemp": (15, 20), "Rainfall": (0, 16), "Evaporation": (1, 9), "Sunshine": (0, 12),
    "WindGustSpeed": (20, 50), "WindSpeed9am": (2, 28), "WindSpeed3pm": (4, 30), "Humidity9am": (40, 55),
    "Humidity3pm": (25, 65), "Pressure9am": (1002, 24), "Pressure3pm": (1000, 24), "Cloud9am": (0, 8),
    "Cloud3pm": (0, 8), "Temp9am": (8, 18), "Temp3pm": (13, 20),
}


@cache
def _stored(n: int, start: str) -> str:
    path = tempfile.mkdtemp(prefix="weather-") + "/rows"
    _rows(SparkSession.getActiveSession(), n, start).write.parquet(path)
    return path


def weather(spark: SparkSession, n: int, start: str = "2012-01-01") -> DataFrame:
    """The rows as a stored table, as a stage would find them."""
    return spark.read.parquet(_stored(n, start))


def _rows(spark: SparkSession, n: int, start: str) -> DataFrame:
    df = spark.range(n, numPartitions=3)

    def u(name: str) -> Column:
        return unit_hash([F.col("id"), F.lit(name)], 1)

    out = df.select(
        "id",
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("Date"),
        F.element_at(F.array(*[F.lit(s) for s in ("Albury", "Cobar", "Hobart", "Perth")]), (F.col("id") % 4 + 1).cast("int")).alias("Location"),
        *[
            F.when(
                F.lit(c not in WEATHER.sparse) | (u(c + "?") >= 0.25),
                F.round(F.lit(float(DRAW[c][0])) + F.lit(float(DRAW[c][1])) * u(c), 1),
            ).alias(c)
            for c in BOUNDS
        ],
        *[
            F.element_at(F.array(*[F.lit(d) for d in DIRECTIONS]), (F.floor(u(c) * 4) + 1).cast("int")).alias(c)
            for c in ("WindGustDir", "WindDir9am", "WindDir3pm")
        ],
    )
    wet = (F.col("Humidity3pm") > 72) | (F.col("Rainfall") > 12)
    flip = unit_hash([F.col("id"), F.lit("flip")], 1) < 0.04
    return out.select(
        *[c for c in out.columns if c != "id"],
        F.when(F.col("Rainfall") > 1, F.lit("Yes")).otherwise(F.lit("No")).alias("RainToday"),
        F.when(wet != flip, F.lit("Yes")).otherwise(F.lit("No")).alias("RainTomorrow"),
    )
