import pytest
from pyspark.sql import functions as F
from weather_rows import weather

from driftline.operators import contract as C
from driftline.plans.weather import WEATHER
from driftline.sources import records, tables


def faulty(spark):
    """Four faults in forty rows; the date tells which row."""
    day = lambda i: F.col("Date") == F.date_add(F.lit("2012-01-01").cast("date"), i)
    return C.inject(
        weather(spark, 40),
        {
            "Rainfall": (day(0), -5.0),
            "Humidity3pm": (day(1), 150.0),
            "RainTomorrow": (day(2), "Maybe"),
            "Location": (day(3), None),
        },
    )


def test_normal_days_pass(spark):
    df = weather(spark, 12)
    assert C.gate_batch(df, WEATHER).count() == 12


def test_report_lists_every_fault_in_schema_order(spark):
    with pytest.raises(C.ContractError) as err:
        C.gate_batch(faulty(spark), WEATHER)
    assert str(err.value).splitlines() == [
        "validation failed",
        "- column=Location check=not_nullable row=2012-01-04/None value=None",
        "- column=Rainfall check=greater_than_or_equal_to(0) row=2012-01-01/Albury value=-5.0",
        "- column=Humidity3pm check=less_than_or_equal_to(100) row=2012-01-02/Cobar value=150.0",
        "- column=RainTomorrow check=isin(['Yes', 'No']) row=2012-01-03/Hobart value=Maybe",
        "total_failures=4",
    ]


def test_serving_rules_ignore_the_target(spark):
    assert C.violations(faulty(spark), WEATHER, require_target=False).count() == 3


def test_bounds_and_nulls_are_accepted(spark):
    df = weather(spark, 4)
    df = df.withColumns({"Humidity3pm": F.lit(100.0), "Rainfall": F.lit(0.0), "MinTemp": F.lit(None).cast("double")})
    assert C.violations(df, WEATHER).isEmpty()


def test_infinite_reading_fails_its_range(spark):
    df = weather(spark, 1).withColumn("Rainfall", F.lit("inf"))
    assert [r["check"] for r in C.violations(tables.coerce(df, WEATHER), WEATHER).collect()] == ["less_than_or_equal_to(500)"]


def test_missing_column_is_reported(spark):
    found = C.violations(weather(spark, 3).drop("Cloud9am"), WEATHER).collect()
    assert [(r["column"], r["check"]) for r in found] == [("Cloud9am", "column_in_dataframe")]


def test_report_keeps_twenty_and_counts_all(spark):
    df = weather(spark, 90).withColumn("Sunshine", F.lit(25.0))
    report = C.failure_report(C.violations(df, WEATHER), WEATHER.key).collect()
    assert len(report) == 20 and {r["total_failures"] for r in report} == {90}


def test_row_gate_partitions_the_input(spark):
    df = faulty(spark)
    good, bad = C.gate_rows(df, WEATHER)
    assert good.count() + bad.count() == df.count() and bad.count() == 3


def test_requests(spark):
    full = '{"Date":"2016-11-01","Location":"Albury","Rainfall":0.2,"Humidity3pm":82,"RainToday":"No"}'
    bad = '{"Date":"2016-11-01","Location":"Albury","MinTemp":12.4,"Rainfall":-5,"Humidity3pm":82,"RainToday":"No"}'
    df = spark.createDataFrame([(1, full), (2, bad), (3, "not json")], "id int, body string")
    rows = tables.parse_requests(df, "body", WEATHER, ["id"])
    assert set(WEATHER.features) <= set(rows.columns)
    got = {r["id"]: r["reasons"] for r in C.with_reasons(rows, WEATHER).collect()}
    assert got[1] == [] and got[2] == ["Rainfall greater_than_or_equal_to(0)"]
    assert got[3] == ["Date not_nullable", "Location not_nullable"]


def test_contract_table(spark):
    rows = C.contract_table(spark, WEATHER).collect()
    assert len(rows) == 2 + 2 * 16 + 2
    assert [r["column"] for r in rows if r["training_only"]] == ["RainTomorrow"]


def test_csv_leak_and_null_tokens(spark, tmp_path):
    df = weather(spark, 15).withColumns({"RISK_MM": F.lit(99), "Sunshine": F.lit("NA"), "WindGustDir": F.lit(" nan ")})
    df.unionAll(df.limit(3)).write.option("header", True).csv(str(tmp_path / "raw"))
    got = tables.read_table(spark, str(tmp_path / "raw"), WEATHER)
    assert "RISK_MM" not in got.columns
    assert got.where("Sunshine IS NOT NULL OR WindGustDir IS NOT NULL").isEmpty()
    assert got.dropDuplicates().count() == 15
    assert C.violations(got, WEATHER).isEmpty()


def test_alert_is_cleared_by_a_pass(spark, tmp_path):
    def row(seq, total):
        return spark.createDataFrame([("w", seq, total, "validation failed")], "source string, seq int, total_failures bigint, message string")

    path = str(tmp_path / "alerts")
    records.append_record(records.alert_rows(row(1, 4), ["source", "seq"]), path)
    assert records.open_alerts(records.read_records(spark, path), ["source"], "seq").count() == 1
    records.append_record(records.alert_rows(row(2, 0), ["source", "seq"]), path)
    assert records.open_alerts(records.read_records(spark, path), ["source"], "seq").isEmpty()


def test_a_batch_without_a_declared_column_is_rejected(spark):
    df = weather(spark, 12).drop("Rainfall").withColumn("batch", F.col("Location"))
    verdicts = C.gate_batches(df, WEATHER, ["batch"]).collect()
    assert verdicts and all(not r["accepted"] and r["total_failures"] == 1 for r in verdicts)
    found = {(r["column"], r["check"]): r["failures"] for r in C.violation_summary(df, WEATHER).collect()}
    assert found["Rainfall", C.ABSENT] == 1 and sum(found.values()) == 1
    with pytest.raises(C.ContractError) as err:
        C.gate_batch(df, WEATHER)
    assert err.value.total_failures == 1


def test_document_counts_what_each_rule_judged(spark):
    df = faulty(spark)
    training = {(r["column"], r["check"]): r for r in C.contract_document(df, WEATHER).collect()}
    assert len(training) == len(WEATHER.rules)
    summary = {(r["column"], r["check"]): r["failures"] for r in C.violation_summary(df, WEATHER).collect()}
    assert {k: r["failures"] for k, r in training.items()} == summary and sum(summary.values()) == 4
    for (column, _), r in training.items():
        judged = df.count() if r["kind"] == "not_null" else df.where(F.col(column).isNotNull()).count()
        assert r["n_judged"] == judged
    serving = C.contract_document(df.drop("Rainfall"), WEATHER, require_target=False).collect()
    for r in serving:
        assert (r["failures"] is None) == (r["training_only"] or r["column"] == "Rainfall")
