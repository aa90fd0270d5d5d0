"""Every registered query against DuckDB on the same tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from barograph.plans.catalog import QUERIES
from barograph.plans.oracle import ORACLE_SQL as ORACLE

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS FROM read_parquet('{path}')")
    return connection


def normalised(columns, rows):
    """Columns by name, rows in one order, NULL and NaN apart from values."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float) and math.isnan(v):
            return (2, "nan")
        return (0, "") if v is None else (1, type(v).__name__, repr(v))

    return [columns[i] for i in order], sorted([cell(r[i]) for i in order] for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    ours = normalised(result.columns, [tuple(r) for r in result.collect()])
    expected = duck.execute(ORACLE[name])
    theirs = normalised([d[0] for d in expected.description], expected.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]
    assert ours[1]


# §2.7: the order of each report, and whether it falls.
ORDERS = {
    "month_rows": [("record_time", False), ("id", False)],
    "month_all_rows": [("record_time", False), ("id", False)],
    "hour_band_rows": [("record_time", False), ("id", False)],
    "over_temperature": [("channel1_temperature", True)],
    "over_humidity": [("channel2_humidity", True)],
    "high_uv": [("channel3_uv", True)],
    "missing_rows": [("record_time", False)],
    "export_month": [("記錄時間", False)],
    "daily_averages": [("date", False)],
    "daily_extremes": [("date", False)],
    "daily_trend": [("date", False)],
    "uv_daily": [("date", False)],
    "lux_daily": [("date", False)],
    "export_daily": [("日期", False)],
    "hourly_temperature": [("hour", False)],
    "temp_humidity_histogram": [("temp_range", False), ("humidity_range", False)],
    "latest_rows": [("record_time", True), ("id", True)],
    "latest_rows_stored": [("record_time", True), ("id", True)],
    "records_by_month": [("year", False), ("month", False)],
    "verify_months": [("year", False), ("month", False)],
    "verify_months_ch5": [("year", False), ("month", False)],
    "import_month_report": [("year", False), ("month", False)],
    "device_temp_months": [("year", False), ("month", False)],
    "device_temp_quality": [("year", False), ("month", False)],
    "device_temp_sample": [("record_time", False)],
    "daily_recent": [("date", True)],
    "daily_temp_trend": [("date", False)],
    "view_latest": [("record_time", True), ("id", True)],
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_order(spark, duck, name):
    """The collected rows by their keys, against DuckDB's rows sorted by the same."""
    keys = [k for k, _ in ORDERS[name]]
    order = ", ".join(f'"{k}" {"DESC" if falls else "ASC"} NULLS {"LAST" if falls else "FIRST"}' for k, falls in ORDERS[name])
    ours = [tuple(r[k] for k in keys) for r in QUERIES[name](spark, SF_DIR).collect()]
    columns = ", ".join(f'"{k}"' for k in keys)
    assert ours == duck.execute(f"SELECT {columns} FROM ({ORACLE[name]}) ORDER BY {order}").fetchall()


def test_entry_point(spark):
    assert entry_point.entry(spark).count() > 0
