"""Imports from workbooks into the stored tables, end to end."""

import os
import re
from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from xlsx_files import write_logger

from barograph.operators import daily, loading
from barograph.plans import imports
from barograph.schema import CHANNELS, DAILY, READINGS
from barograph.sources.tables import FIRST_KEYED, LAST_LOAD, SensorTables
from barograph.sources.workbooks import scan_workbooks
from barograph.streaming.watch import watch_folder

pytestmark = pytest.mark.usefixtures("interpreted")

START = datetime(2025, 7, 1)


def samples(start, count, base=20.0, minutes=60):
    return [
        [(start + timedelta(minutes=minutes * i)), base + i % 5, 50 + i % 7, None if i % 3 else 0.5, 1000.25, base]
        for i in range(count)
    ]


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "workbooks"
    path.mkdir()
    july = samples(START, 30)
    july[4][1] = "+++++"
    july[5][0] = None
    write_logger(path, "LOGGER RAWDATA_2507.xlsx", july)
    write_logger(path, "LOGGER RAWDATA_2508.xlsx", samples(datetime(2025, 8, 1), 20), preamble=5)
    return path


@pytest.fixture
def tables(spark, tmp_path):
    return SensorTables(spark, str(tmp_path / "tables"), key_buckets=4)


def counts(tables):
    return {(r["year"], r["month"]): r["n"] for r in tables.readings().groupBy("year", "month").count().withColumnRenamed("count", "n").collect()}


def by_name(summary):
    return {r["file"].rsplit("_", 1)[1]: r for r in summary.collect()}


def test_created_tables_are_empty_and_typed(tables):
    tables.create()
    tables.create()
    assert tables.readings().schema == READINGS and tables.readings().count() == 0
    assert tables.daily_statistics().schema == DAILY and tables.daily_statistics().count() == 0


def test_import_all(tables, folder):
    summary = by_name(imports.import_all(tables, str(folder)))
    july = summary["2507.xlsx"]
    assert (july["parsed"], july["rejected"], july["blank"], july["inserted"], july["skipped"]) == (28, 1, 1, 28, 0)
    assert summary["2508.xlsx"]["inserted"] == 20
    rows = tables.readings().orderBy("id").collect()
    assert len({r["id"] for r in rows}) == 48 and rows[0]["id"] == 1
    assert [r["record_time"] for r in rows] == sorted(r["record_time"] for r in rows)
    first = rows[0]
    assert (first["year"], first["month"], first["record_time"]) == (2025, 7, START)
    assert [first[c] for c in CHANNELS] == [Decimal(v) for v in ("20.00", "50.00", "0.50", "1000.25", "20.00")]
    assert first["created_at"] is not None
    refused = tables.rejects(1).collect()
    assert [(r["sheet_row"], r["reason"]) for r in refused] == [(9, "channel not a number in range")]


    # A second run doubles the rows, and the ids go on.
    imports.import_all(tables, str(folder))
    assert counts(tables) == {(2025, 7): 56, (2025, 8): 40}
    ids = [r["id"] for r in tables.readings().select("id").collect()]
    assert len(set(ids)) == 96 and sorted(ids)[48] > rows[-1]["id"]

    imports.rebuild(tables, str(folder))
    assert counts(tables) == {(2025, 7): 28, (2025, 8): 20}
    assert sorted(r["id"] for r in tables.readings().collect()) == [r["id"] for r in rows]
    daily = {r["date"]: r for r in tables.daily_statistics().collect()}
    assert sorted(daily) == [date(2025, 7, 1), date(2025, 7, 2), date(2025, 8, 1)]
    assert daily[date(2025, 7, 1)]["record_count"] == 22
    assert daily[date(2025, 8, 1)]["avg_temperature"] == Decimal("22.00")


def test_import_new_skips_loaded_months(tables, folder):
    (folder / "LOGGER RAWDATA_2506.xlsx").write_bytes(b"broken")
    write_logger(folder, "LOGGER RAWDATA_ab12.xlsx", samples(START, 2))
    summary = by_name(imports.import_new(tables, str(folder)))
    assert summary["2506.xlsx"]["problem"].startswith("BadZipFile")
    assert summary["ab12.xlsx"]["problem"] == "month in the name is not a number"
    (folder / "LOGGER RAWDATA_2506.xlsx").unlink()
    assert counts(tables) == {(2025, 7): 28, (2025, 8): 20}
    summary = by_name(imports.import_new(tables, str(folder)))
    assert {k: r["problem"] for k, r in summary.items() if k != "ab12.xlsx"} == dict.fromkeys(["2507.xlsx", "2508.xlsx"], imports.ALREADY_LOADED)
    write_logger(folder, "LOGGER RAWDATA_2509.xlsx", samples(datetime(2025, 9, 1), 10))
    write_logger(folder, "LOGGER RAWDATA_2509_b.xlsx", samples(datetime(2025, 9, 2), 10))
    status = {r["file"].rsplit("/", 1)[1]: r["already_loaded"] for r in imports.list_files(tables, str(folder)).collect()}
    assert list(status.values()) == [True, True, False, False, False]
    summary = imports.import_new(tables, str(folder)).collect()
    assert [r["inserted"] for r in summary] == [0, 0, 10, 10, 0]
    assert counts(tables)[(2025, 9)] == 20


def test_import_new_opens_what_it_lists(tables, folder):
    """The listing reads the month after the first underscore, wherever else digits stand."""
    write_logger(folder, "LOGGER RAWDATA_2507_b[1].xlsx", samples(datetime(2025, 7, 9), 5))
    write_logger(folder, "X_2410_RAWDATA_2509.xlsx", samples(datetime(2024, 10, 1), 7))
    summary = {r["file"].rsplit("/", 1)[1]: r["inserted"] for r in imports.import_new(tables, str(folder)).collect()}
    assert summary == {"LOGGER RAWDATA_2507.xlsx": 28, "LOGGER RAWDATA_2507_b[1].xlsx": 5, "LOGGER RAWDATA_2508.xlsx": 20, "X_2410_RAWDATA_2509.xlsx": 7}
    assert counts(tables) == {(2025, 7): 33, (2025, 8): 20, (2024, 10): 7}


def test_only_current_loads_are_read(tables, folder):
    """Partitions of replaced months are pruned by the table of current loads, and a state that broke off doesn't count."""
    imports.import_all(tables, str(folder))
    imports.import_selected(tables, str(folder), [2], on_existing="replace")
    rows = sorted(map(tuple, tables.readings().drop("created_at").collect()))
    readings = tables.readings()
    assert len(readings.collect()) == 48
    plan = readings._jdf.queryExecution().explainString(readings._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended"))
    assert "dynamicpruning" in plan
    assert {p.name for p in (Path(tables.root) / "readings").iterdir() if p.is_dir()} == {"load=000001", "load=000002"}
    state = max((Path(tables.root) / "state").iterdir())
    broken = state.with_name(f"v{int(state.name[1:]) + 1:010d}")
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"cut off")
    assert sorted(map(tuple, tables.readings().drop("created_at").collect())) == rows
    imports.import_selected(tables, str(folder), [1], on_existing="append")
    assert counts(tables) == {(2025, 7): 56, (2025, 8): 20}


def test_long_listing(tables, folder):
    """Of 50,000 names only those of new months are read, chosen while the scan is planned."""
    tables.create()
    imports.import_selected(tables, str(folder), [1])
    for k in range(50_000):
        (folder / f"LOGGER RAWDATA_2507_{k}.xlsx").write_bytes(b"x")
    (folder / "LOGGER RAWDATA_25x7.xlsx").write_bytes(b"x")
    new, others = imports.new_and_others(tables, str(folder))
    assert [r["path"].rsplit("_", 1)[1] for r in new.select("path").collect()] == ["2508.xlsx"]
    read = new.select("path", "content")
    assert len(read.collect()) == 1
    scan = read._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1
    reasons = {r["problem"]: r["count"] for r in others.groupBy("problem").count().collect()}
    assert reasons == {imports.ALREADY_LOADED: 50_001, "month in the name is not a number": 1}


def test_first_file_per_month_only(tables, folder):
    write_logger(folder, "LOGGER RAWDATA_2507_b.xlsx", samples(datetime(2025, 7, 9), 5))
    summary = imports.import_new(tables, str(folder), first_file_per_month_only=True)
    skipped = {r["file"].rsplit("/", 1)[1]: r["skipped"] for r in summary.collect()}
    assert skipped == {"LOGGER RAWDATA_2507.xlsx": 0, "LOGGER RAWDATA_2507_b.xlsx": 5, "LOGGER RAWDATA_2508.xlsx": 0}
    assert counts(tables) == {(2025, 7): 28, (2025, 8): 20}


def test_first_file_must_have_samples(tables, folder):
    bad = samples(datetime(2025, 10, 1), 4)
    for row in bad:
        row[1] = "+++++"
    write_logger(folder, "LOGGER RAWDATA_2510_a.xlsx", bad)
    write_logger(folder, "LOGGER RAWDATA_2510_b.xlsx", samples(datetime(2025, 10, 1), 6))
    imports.import_new(tables, str(folder), first_file_per_month_only=True)
    assert counts(tables)[(2025, 10)] == 6


def test_chosen_workbooks_count_once(tables, folder):
    write_logger(folder, "LOGGER RAWDATA_2508_b[1].xlsx", samples(datetime(2025, 8, 9), 5))
    _, invalid = imports.import_selected(tables, str(folder), [1, 1, 9, 9])
    assert invalid == [9, 9] and counts(tables) == {(2025, 7): 28}
    imports.import_selected(tables, str(folder), [2, 3])  # the second of a month that is loaded by then
    assert counts(tables) == {(2025, 7): 28, (2025, 8): 20}
    tables.clear()
    imports.import_selected(tables, str(folder), [2, 3], first_file_per_month_only=False)
    assert counts(tables) == {(2025, 8): 25}


def test_import_selected(tables, folder):
    summary, invalid = imports.import_selected(tables, str(folder), [2, 7, 0])
    assert invalid == [7, 0]
    assert list(by_name(summary)) == ["2508.xlsx"]
    imports.import_selected(tables, str(folder), [2], on_existing="append")
    assert counts(tables) == {(2025, 8): 40}
    imports.import_selected(tables, str(folder), [1, 2], on_existing="skip_existing")
    assert counts(tables) == {(2025, 7): 28, (2025, 8): 40}
    imports.import_selected(tables, str(folder), [1, 2], on_existing="replace")
    assert counts(tables) == {(2025, 7): 28, (2025, 8): 20}
    assert imports.import_selected(tables, str(folder), [9]) == (None, [9])


def test_dedupe_is_idempotent(tables, folder):
    tables.create()
    write_logger(folder, "LOGGER RAWDATA_2508_more.xlsx", samples(datetime(2025, 8, 1), 25, base=30.0))
    for _ in range(2):
        imports.load_raw_rows(tables, scan_workbooks(tables.spark, str(folder)), "dedupe")
        assert counts(tables) == {(2025, 7): 28, (2025, 8): 25}
    # The first file of a repeated sample wins.
    kept = {r["record_time"].hour: r["channel5_device_temp"] for r in tables.readings().where("month = 8 AND day(record_time) = 1").collect()}
    assert kept[0] == Decimal("20.00") and kept[22] == Decimal("30.00")


def test_dedupe_reads_keys_of_current_loads(spark, folder, tmp_path):
    """The loaded side is neither read whole nor shuffled; replaced, cleared and earlier loads are no keys."""
    tables = SensorTables(spark, str(tmp_path / "it's"), key_buckets=5)
    imports.import_all(tables, str(folder))
    keys, buckets = tables.sample_keys()
    assert (keys.count(), keys.distinct().count(), buckets) == (48, 48, 5)
    write_logger(folder, "LOGGER RAWDATA_2508.xlsx", samples(datetime(2025, 8, 1), 3, base=1.0))
    imports.import_selected(tables, str(folder), [2], on_existing="replace")
    assert tables.sample_keys()[0].count() == 31

    # Of the samples, only those that arrive are shuffled, also by a session with more partitions than buckets.
    arriving = tables.readings().withColumn("id", F.col("id") + 1000)
    keys, buckets = tables.sample_keys()
    new = loading.in_new_samples(keys, arriving, ["id"], buckets)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        text = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    left, right = text.split("SelectedBucketsCount: 5 out of 5")[0].split("Scan parquet", 1)
    by_key = re.findall(r"Exchange hashpartitioning\(year#\d+, month#\d+, record_time#\d+, (\d+)\)", left + right)
    assert "SortMergeJoin" in text and sorted(by_key) == ["20", "5"]
    assert new.isEmpty()

    write_logger(folder, "LOGGER RAWDATA_2508.xlsx", samples(datetime(2025, 8, 1), 20))
    imports.load_raw_rows(tables, scan_workbooks(spark, str(folder)), "dedupe")
    assert counts(tables) == {(2025, 7): 28, (2025, 8): 20}
    again = SensorTables(spark, tables.root, key_buckets=9)
    assert again.sample_keys()[1] == 5 and again.sample_keys()[0].count() == 48
    tables.clear()
    assert tables.sample_keys()[0].isEmpty()
    imports.load_raw_rows(tables, scan_workbooks(spark, str(folder)), "dedupe")
    assert counts(tables) == {(2025, 7): 28, (2025, 8): 20}
    # A table from before there were keys gives those of its readings.
    tables._enter({FIRST_KEYED: 1 + tables._counters()[LAST_LOAD]})
    assert tables.sample_keys()[1] is None and tables.sample_keys()[0].count() == 48


def test_latest_rows_open_the_last_months_only(tables, folder):
    assert imports.latest_rows(tables).isEmpty()
    imports.import_all(tables, str(folder))
    write_logger(folder, "LOGGER RAWDATA_2509.xlsx", samples(datetime(2025, 9, 1), 30))
    imports.import_new(tables, str(folder))
    everything = tables.readings().orderBy(F.desc("record_time"), F.desc("id")).collect()
    for limit in (1, 6, 7, 30, 31, 45, 78, 79, 500):
        assert imports.latest_rows(tables, limit).collect() == everything[:limit]
    assert imports.latest_readings(tables, 6).count() == 6 and imports.latest_readings(tables, 7).count() == 30
    for path in (Path(tables.root) / "readings").rglob("month=[78]/part-*"):
        path.write_bytes(b"not to be read")
    assert imports.latest_rows(tables, 30).collect() == everything[:30]


def test_replace_leaves_other_months_alone(tables, folder):
    imports.import_all(tables, str(folder))
    before = {r["id"]: r for r in tables.readings().where("month = 7").collect()}
    write_logger(folder, "LOGGER RAWDATA_2508.xlsx", samples(datetime(2025, 8, 1), 3, base=1.0))
    imports.import_selected(tables, str(folder), [2], on_existing="replace", refresh_stats=True)
    assert {r["id"]: r for r in tables.readings().where("month = 7").collect()} == before
    assert counts(tables)[(2025, 8)] == 3
    assert tables.daily_statistics().where("date = '2025-08-01'").first()["record_count"] == 3


def test_failed_rebuild_and_clear(tables, folder, monkeypatch):
    imports.import_all(tables, str(folder))

    def fail(*_):
        raise RuntimeError("disk full")

    write = SensorTables._write_months

    def fail_midway(self, readings, path):
        write(self, readings.where("month = 7"), path)
        raise RuntimeError("disk full")

    before = tables.readings().orderBy("id").collect()
    for broken in (fail, fail_midway):
        with monkeypatch.context() as patch:
            patch.setattr(SensorTables, "_write_months", broken)
            with pytest.raises(RuntimeError):
                imports.rebuild(tables, str(folder))
            for mode in ("append", "replace"):
                with pytest.raises(RuntimeError):
                    imports.import_selected(tables, str(folder), [1, 2], on_existing=mode)
        assert tables.readings().orderBy("id").collect() == before
    imports.import_selected(tables, str(folder), [1], on_existing="append")
    assert counts(tables) == {(2025, 7): 56, (2025, 8): 20}
    imports.import_selected(tables, str(folder), [1], on_existing="replace")
    assert counts(tables) == {(2025, 7): 28, (2025, 8): 20}

    # Clearing keeps the structure, and the daily statistics.
    imports.refresh_daily(tables)
    tables.clear()
    assert tables.readings().count() == 0 and tables.readings().schema == READINGS
    assert tables.daily_statistics().count() == 3


def test_partial_refresh_equals_full_refresh(spark, tables, folder):
    # August's file starts on the last July date, so one date has two file months.
    write_logger(folder, "LOGGER RAWDATA_2508.xlsx", samples(datetime(2025, 7, 2, 3), 40))
    imports.import_selected(tables, str(folder), [2], refresh_stats=True)
    imports.import_selected(tables, str(folder), [1], refresh_stats=True)
    shown = [c for c in DAILY.names if c not in ("created_at", "updated_at", "year", "month")]
    partial = tables.daily_statistics().select(shown).orderBy("date").collect()
    imports.refresh_daily(tables)
    assert tables.daily_statistics().select(shown).orderBy("date").collect() == partial
    collision = tables.daily_statistics().where("date = '2025-07-02'").first()
    assert collision["record_count"] == 21


def test_refresh_reads_no_readings(tables, folder):
    """Statistics come from the partials of current loads, also where months are appended to, replaced or cleared."""
    imports.import_all(tables, str(folder))
    imports.import_selected(tables, str(folder), [1], on_existing="append")
    write_logger(folder, "LOGGER RAWDATA_2508.xlsx", samples(datetime(2025, 7, 2, 3), 40, base=7.0))
    imports.import_selected(tables, str(folder), [2], on_existing="replace")
    for collision in ("last_file", "merge"):
        found = daily.statistics_of_partials(tables.daily_partials(), collision).orderBy("date").collect()
        assert found == daily.daily_statistics(tables.readings(), collision).orderBy("date").collect()
    for path in (Path(tables.root) / "readings").rglob("part-*"):
        path.write_bytes(b"not to be read")
    imports.refresh_daily(tables)
    assert tables.daily_statistics().where("date = '2025-07-01'").first()["record_count"] == 44
    assert tables.daily_statistics().where("date = '2025-08-01'").isEmpty()
    tables.clear()
    assert tables.daily_partials().isEmpty()


def test_corrected_workbooks(tables, folder):
    """What changed in place is taken in once; what is untouched, or only touched, gives no load."""

    def loads():
        return len(list((Path(tables.root) / "readings").glob("load=*")))

    def names(summary):
        return {r["file"].rsplit("/", 1)[1]: r["inserted"] for r in summary.collect()}

    july, august = "LOGGER RAWDATA_2507.xlsx", "LOGGER RAWDATA_2508.xlsx"
    assert names(imports.import_changed(tables, str(folder))) == {july: 28, august: 20}
    assert imports.import_changed(tables, str(folder)) is None and loads() == 1
    ids = sorted(r["id"] for r in tables.readings().where("month = 7").collect())

    os.utime(folder / july, (2e9, 2e9))
    assert imports.import_changed(tables, str(folder)) is None and loads() == 1
    assert tables.taken_in().where("modified > '2033-01-01'").count() == 1

    write_logger(folder, august, samples(datetime(2025, 8, 1), 20, base=9.0))
    os.utime(folder / august, (2e9 + 5, 2e9 + 5))
    assert names(imports.import_changed(tables, str(folder))) == {august: 20}
    assert loads() == 2 and counts(tables) == {(2025, 7): 28, (2025, 8): 20}
    assert tables.readings().where("month = 8").agg({"channel5_device_temp": "max"}).first()[0] == Decimal("9.00")
    assert tables.daily_statistics().where("date = '2025-08-01'").first()["avg_device_temp"] == Decimal("9.00")
    assert sorted(r["id"] for r in tables.readings().where("month = 7").collect()) == ids

    # A second workbook of a month, later gone again; a broken one and one without a month.
    more = "LOGGER RAWDATA_2508_more.xlsx"
    write_logger(folder, more, samples(datetime(2025, 8, 5), 7))
    assert names(imports.import_changed(tables, str(folder))) == {august: 20, more: 7}
    (folder / more).unlink()
    (folder / "LOGGER RAWDATA_2506.xlsx").write_bytes(b"broken")
    (folder / "LOGGER RAWDATA_25x7.xlsx").write_bytes(b"no month")
    summary = {r["file"].rsplit("_", 1)[1]: r for r in imports.import_changed(tables, str(folder)).collect()}
    assert set(summary) == {"2506.xlsx", "2508.xlsx"} and summary["2506.xlsx"]["problem"].startswith("BadZipFile")
    assert counts(tables) == {(2025, 7): 28, (2025, 8): 20}

    # A month keeps its readings where its only workbook is gone.
    (folder / july).unlink()
    assert imports.import_changed(tables, str(folder)) is None
    assert counts(tables) == {(2025, 7): 28, (2025, 8): 20}


def test_an_import_of_changes_that_breaks_off(tables, folder, monkeypatch):
    imports.import_changed(tables, str(folder))
    before = tables.readings().orderBy("id").collect()
    write_logger(folder, "LOGGER RAWDATA_2508.xlsx", samples(datetime(2025, 8, 1), 3, base=1.0))

    def fail(*_):
        raise RuntimeError("disk full")

    for step in ("_write_months", "replace_taken_in"):
        with monkeypatch.context() as patch:
            patch.setattr(SensorTables, step, fail)
            with pytest.raises(RuntimeError):
                imports.import_changed(tables, str(folder))
        if step == "_write_months":
            assert tables.readings().orderBy("id").collect() == before
    assert imports.import_changed(tables, str(folder)).first()["inserted"] == 3
    assert counts(tables) == {(2025, 7): 28, (2025, 8): 3}
    assert imports.import_changed(tables, str(folder)) is None


def test_updated_at_moves_only_on_change(tables, folder):
    imports.import_all(tables, str(folder), refresh_stats=True)
    first = {r["date"]: r for r in tables.daily_statistics().collect()}
    imports.import_selected(tables, str(folder), [2], on_existing="append", refresh_stats=True)
    second = {r["date"]: r for r in tables.daily_statistics().collect()}
    july, august = date(2025, 7, 1), date(2025, 8, 1)
    assert second[july] == first[july]
    assert second[august]["updated_at"] > first[august]["updated_at"]
    assert second[august]["created_at"] == first[august]["created_at"]


def test_watch_folder(tables, folder, tmp_path):
    def run():
        query = watch_folder(tables, str(folder), str(tmp_path / "checkpoint"), files_per_batch=1)
        query.awaitTermination(120)
        assert query.exception() is None

    run()
    assert counts(tables) == {(2025, 7): 28, (2025, 8): 20}
    run()
    write_logger(folder, "LOGGER RAWDATA_2509.xlsx", samples(datetime(2025, 9, 1), 10))
    run()
    assert counts(tables) == {(2025, 7): 28, (2025, 8): 20, (2025, 9): 10}
    assert tables.daily_statistics().count() == 4
    for mode in ("append", "skip_existing", "replace", "rebuild"):
        with pytest.raises(ValueError):
            watch_folder(tables, str(folder), str(tmp_path / "other"), mode=mode)


def test_batches_do_not_matter(spark, folder, tmp_path):
    """Workbooks of one month that repeat each other's samples, one by one or all at once."""
    names = ["LOGGER RAWDATA_2507_z.xlsx", "LOGGER RAWDATA_2507_m.xlsx", "LOGGER RAWDATA_2507_a.xlsx"]
    for i, name in enumerate(names):
        write_logger(folder, name, samples(datetime(2025, 7, 1 + i), 40, base=30.0 + i))
        os.utime(folder / name, (2e9 + i, 2e9 + i))  # the last by name came first
    found = []
    for size in (1, 1000):
        tables = SensorTables(spark, str(tmp_path / f"tables-{size}"))
        query = watch_folder(tables, str(folder), str(tmp_path / f"checkpoint-{size}"), files_per_batch=size, refresh_stats=False)
        query.awaitTermination(120)
        assert query.exception() is None
        found.append(sorted(map(str, tables.readings().drop("id", "created_at").collect())))
    assert found[0] == found[1]
    hours = {datetime(2025, 7, 1 + i) + timedelta(hours=h) for i in range(3) for h in range(40)}
    assert len(found[0]) == 20 + len(hours)


def test_unknown_mode(tables):
    with pytest.raises(ValueError):
        imports.load_raw_rows(tables, None, "merge")
