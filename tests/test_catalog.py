"""A cross-section of the catalogue against DuckDB; `check_catalog.py` runs all of it."""

import os

import pytest
from check_catalog import compare, connect

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SECTION = [
    "csv_scan", "dedup_count", "data_version", "request_parse", "alert_status", "coerce_numeric", "norm_text",
    "contract_violations", "violation_summary", "failure_report", "quarantine_rows", "profile_numeric",
    "profile_top_values", "time_split", "split_info", "sample_n", "fit_params", "onehot_slots", "class_weights",
    "binary_metrics", "choose_threshold", "cost_curve", "slice_by_month", "pick_winner", "rollback_target", "psi",
    "total_variation", "drift_second", "profile_nan", "gate_missing_column", "drift_empty_window", "slo_report", "alerts_hold", "stream_gate", "stream_rate",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are absent")


@pytest.fixture(scope="module")
def con():
    c = connect(SF)
    c.execute("SET TimeZone='UTC'")
    return c


def test_every_sql_has_its_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry(spark):
    assert E.entry(spark).count() == 6


@pytest.mark.parametrize("name", SECTION)
def test_query(spark, con, name):
    assert compare(spark, con, name, SF).startswith("ok")
