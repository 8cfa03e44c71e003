import math

import pytest
from pyspark.sql import functions as F

from driftline.functions import columns as X
from driftline.functions.grid import GRID_POINTS, grid_cell, grid_value


def values(spark, data, expr, ddl="v string"):
    return [r[0] for r in spark.createDataFrame([(x,) for x in data], ddl).select(expr(F.col("v"))).collect()]


def test_to_double(spark):
    data = ["0x1p3", "1f", "1.5", " -2e3 ", "abc", "", "NaN", "nan", "1.0d", "inf", "-inf", "1_0", None, ".5", "5."]
    got = values(spark, data, X.to_double)
    assert got == [None, None, 1.5, -2000.0, None, None, None, None, None, math.inf, -math.inf, None, None, 0.5, 5.0]


def test_to_date(spark):
    got = values(spark, ["2016-11-01", "2016-11", "01/11/2016", "x", None, " 2016-02-30"], X.to_date)
    assert [str(v) for v in got] == ["2016-11-01", "None", "None", "None", "None", "None"]


def test_norm_text(spark):
    got = values(spark, ["", " NA ", "nan", "None", "\tW\n", "none", None], X.norm_text)
    assert got == [None, None, None, None, "W", "none", None]


def test_clip_keeps_null(spark):
    assert values(spark, [None, -1.0, 5.0, 20.0], lambda c: X.clip(c, 0, 10), "v double") == [None, 0.0, 5.0, 10.0]


def test_encode_label(spark):
    enc = lambda c: X.encode_label(c, "Yes", "No")
    assert values(spark, ["Yes", "No", None], enc) == [1, 0, None]
    with pytest.raises(Exception, match="labels must be"):
        values(spark, ["Maybe"], enc)


def test_grid_matches_even_spacing(spark):
    import numpy as np

    want = np.linspace(0.05, 0.95, 91)
    got = [r[0] for r in spark.range(GRID_POINTS).orderBy("id").select(grid_value(F.col("id"))).collect()]
    assert got[:90] == list(want[:90]) and abs(got[90] - 0.95) < 1e-15
    probes = sorted([*want, 0.0, 1.0, 0.05 - 1e-17, 0.3, 0.39, 0.7, *np.nextafter(want, 0), *np.nextafter(want, 1)])
    df = spark.createDataFrame([(float(x),) for x in probes], "v double")
    for r in df.select("v", grid_cell(F.col("v")).alias("k")).collect():
        assert r["k"] == int((np.array(got) <= r["v"]).sum())


def test_profile_takes_nan_for_missing(spark):
    from driftline.operators import ingest

    df = spark.createDataFrame([(1.0, 1), (float("nan"), None), (3.0, 3)], "x double, k int")
    got = {r["column"]: r for r in ingest.profile_numeric(df, ["x", "k"]).collect()}
    for r in got.values():
        assert (r["min"], r["max"], r["mean"]) == (1.0, 3.0, 2.0) and abs(r["missing_ratio"] - 1 / 3) < 1e-15
