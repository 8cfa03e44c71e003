import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F
from weather_rows import weather

from driftline.operators import features as FT
from driftline.plans.weather import WEATHER
from driftline.spec import TableSpec

TINY = TableSpec("tiny", ("k",), "d", ("x", "y"), ("c",), "t", sparse=("y",))


def tiny(spark, rows):
    df = spark.createDataFrame(rows, "k int, x double, y double, c string")
    return df.withColumn("d", F.lit("2024-03-01").cast("date"))


def values(spark, p):
    """{column: its categories in slot order}"""
    out = {}
    for r in spark.read.parquet(p.dictionary).orderBy("column", "slot").collect():
        assert r.slot == len(out.setdefault(r.column, []))
        out[r.column].append(r.value)
    return out


def test_population_scaling_and_constant_columns(spark):
    train = tiny(spark, [(1, 1.0, None, "b"), (2, 3.0, None, "a"), (3, None, None, None)])
    p = FT.fit(train, TINY)
    assert p.medians == {"x": 2.0, "y": 0.0}
    assert p.means["x"] == 2.0 and math.isclose(p.stds["x"], math.sqrt(2 / 3))
    assert p.stds["y"] == p.stds["month"] == p.stds["y_missing"] == 1.0
    assert values(spark, p) == {"c": ["Unknown", "a", "b"]} and p.width == 5 + 3
    z = {r["k"]: r["z_x"] for r in FT.scaled(train, TINY, p, ["k"]).collect()}
    assert math.isclose(z[1], -1 / math.sqrt(2 / 3)) and z[3] == 0.0


def test_unseen_category_is_all_zeros_and_row_equals_batch(spark, tmp_path):
    train = tiny(spark, [(1, 1.0, 2.0, "b"), (2, 3.0, None, "a")])
    p = FT.fit(train, TINY)
    pipe = FT.feature_pipeline(train, TINY, p)
    pipe.write().overwrite().save(str(tmp_path / "m"))
    pipe = PipelineModel.load(str(tmp_path / "m"))
    new = tiny(spark, [(1, 1.0, 2.0, "zzz"), (2, 2.0, 2.0, "b"), (3, 5.0, None, None)])
    vec = lambda df: {r["k"]: list(r["v"]) for r in pipe.transform(df).select("k", vector_to_array("features").alias("v")).collect()}
    batch = vec(new)
    assert len(batch[1]) == p.width == 7
    assert batch[1][-2:] == [0.0, 0.0] and batch[2][-2:] == [0.0, 1.0] and batch[3][-2:] == [0.0, 0.0]
    for k in (1, 2, 3):
        assert vec(new.where(F.col("k") == k))[k] == batch[k]
    slots = {r["k"]: r["c_slot"] for r in FT.onehot_slots(new, TINY, p, ["k"]).collect()}
    assert slots == {1: None, 2: 1, 3: None}


def test_weather_width(spark):
    p = FT.fit(weather(spark, 80), WEATHER)
    assert len(p.means) == 22
    assert p.width == 22 + sum(len(v) for v in values(spark, p).values())
    assert FT.FeatureParams.from_json(p.to_json()) == p


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_any_number_of_categories(spark, monkeypatch, limit):
    monkeypatch.setattr(FT, "BROADCAST_VALUES", limit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    # Half of the rows hold one value.
    df = tiny(spark, [(1, 1.0, 1.0, "v0")]).crossJoin(spark.range(300_000))
    df = df.withColumn("c", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("v"), "id")))
    p = FT.fit_categories(df, ["c"])
    assert p.sizes == {"c": 150_001}
    table = spark.read.parquet(p.dictionary)
    assert table.agg(F.min("slot"), F.max("slot"), F.count_distinct("slot")).first()[:] == (0, 150_000, 150_001)
    order = Window.partitionBy(F.lit(0)).orderBy("value")
    assert table.withColumn("want", F.row_number().over(order) - 1).where("want <> slot").isEmpty()
    slots = FT.onehot_slots(df.unionByName(df.limit(1).withColumn("c", F.lit("new"))), TINY, p, ["id"])
    told = slots.groupBy("c_slot").agg(F.count("*").alias("n"))
    assert told.where("c_slot = 0").first()["n"] == 150_000 and told.where("c_slot IS NULL").first()["n"] == 1
    assert told.count() == 150_002
    joins = slots._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("BroadcastHashJoin" in joins) == (limit > 150_001)


def test_no_categories(spark):
    p = FT.fit_categories(tiny(spark, [(1, 1.0, 1.0, "a")]).limit(0), ["c"])
    assert p.sizes == {"c": 0} and p.width == 0
    assert FT.onehot_slots(tiny(spark, [(1, 1.0, 1.0, "a")]), TINY, p, ["k"]).first()["c_slot"] is None


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")
    got = {r["label"]: r for r in FT.class_weight_table(df, "label").collect()}
    assert got[1]["balanced"] == 2.0 and math.isclose(got[0]["balanced"], 2 / 3)
    assert got[1]["positive"] == 3.0 and got[0]["positive"] == 1.0
    w = {r["label"]: r["weight"] for r in FT.with_weight(df, "label", "positive")[0].collect()}
    assert w == {1: 3.0, 0: 1.0}
