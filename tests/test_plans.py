"""Physical plans: what is read, shuffled and broadcast."""

import re
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from barograph.operators import loading, quality, select_rows, summaries
from barograph.plans.catalog import QUERIES
from barograph.plans.imports import list_files, only_months
from barograph.schema import CHANNELS, READINGS
from barograph.session import WorkArea
from barograph.sources.tables import SensorTables

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_tables(spark, tmp_path_factory):
    tables = SensorTables(spark, str(tmp_path_factory.mktemp("tables")))
    rows = [
        (i, 2024, 1 + i % 3, datetime(2024, 1, 1) + timedelta(hours=i), *[Decimal(i)] * len(CHANNELS), None)
        for i in range(90)
    ]
    tables.replace_readings(spark.createDataFrame(rows, READINGS), 90)
    return tables


@pytest.fixture(scope="module")
def stored(stored_tables):
    return stored_tables.readings()


def test_month_reports_prune_partitions_and_columns(stored):
    text = plan(summaries.hourly_temperature(stored, 2024, 1))
    assert re.search(r"PartitionFilters: \[[^\]]*year[^\]]*= 2024[^\]]*month[^\]]*= 1\)", text)
    assert re.search(r"ReadSchema: struct<record_time:timestamp_ntz,channel1_temperature:decimal\(10,2\)>", text)


def test_stored_months_are_known_without_a_scan(spark, stored_tables, tmp_path):
    assert stored_tables.months() == [(2024, 1), (2024, 2), (2024, 3)]
    assert "FileScan" not in plan(loading.existing_months(stored_tables.month_frame()))
    (tmp_path / "LOGGER RAWDATA_2402.xlsx").write_bytes(b"x")
    status = list_files(stored_tables, str(tmp_path))
    assert "parquet" not in plan(status) and status.first()["already_loaded"]
    assert "ReadSchema: struct<>" in plan(loading.existing_months(stored_tables.readings()))


def test_an_append_shuffles_the_samples_once(spark):
    """Ids need a join with a row per file; the only exchange is the one that sizes the files."""
    samples = spark.createDataFrame([("f", 2024, 1, 5, datetime(2024, 1, 1))], "file string, year int, month int, sheet_row long, record_time timestamp_ntz")
    offsets = loading.id_offsets(WorkArea(spark), samples)
    written = loading.number_readings(samples, offsets, 0).hint("rebalance", "year", "month")
    text = plan(written)
    assert len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", text)) == 1
    assert "BroadcastHashJoin" in text and "Window" not in text


def test_import_summary_reads_the_events_twice_at_most(spark):
    text = plan(QUERIES["import_summary"](spark, SF_DIR))
    assert text.count("events.parquet") <= 2


def test_threshold_reaches_the_scan(stored):
    text = plan(select_rows.over_temperature(stored, 2024, 1))
    assert "GreaterThan(channel1_temperature,35.00)" in text


def test_extreme_is_computed_once_and_pushed(stored):
    text = plan(select_rows.hottest_rows(stored, 2024, 1))
    assert "Subquery" in text and "Join" not in text
    assert [r["id"] for r in select_rows.hottest_rows(stored, 2024, 1).collect()] == [87]


def test_month_literals_prune_partitions(stored):
    text = plan(only_months(stored, {(2024, 1), (2024, 3), (2025, 2)}))
    assert "PartitionFilters: [((" in text
    assert only_months(stored, {(2024, 1), (2024, 3), (2025, 2)}).count() == 60
    assert only_months(stored, []).count() == 0


def test_top_k_does_not_sort_everything(stored):
    for df in (select_rows.latest_rows(stored), quality.device_temp_sample(stored, 2024, 1)):
        assert "TakeOrderedAndProject" in plan(df)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_gathers_or_multiplies_rows(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"Window .*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", text)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInArrow", "MapInPandas", "ScanExistingRDD", "Scan ExistingRDD"):
        assert node not in text
