"""Header and sample rules on small `raw_rows` frames."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from barograph.operators import ingest
from barograph.schema import CHANNELS, RAW_ROWS
from barograph.sources.filenames import file_year_month

FILE = "LOGGER RAWDATA_2508.xlsx"
N = None

# Unit row -> positions of time and channels 1 to 5.
HEADERS = {
    "H01": (["NO.", "Time", "degC", "%", "W/m2", "lux", "degC"], (1, 2, 3, 4, 5, 6)),
    "H02": (["NO.", "Time", "degC", "%", "lux"], (1, 2, 3, N, 4, N)),
    "H03": (["NO.", "Time", "degC", "degC"], (1, 2, N, N, N, 3)),
    "H04": (["NO.", "Time", "degC", "degC", "degC"], (1, 2, N, N, N, 4)),
    "H05": (["NO.", "Time", "degC", "DEGC"], (1, 2, N, N, N, 3)),
    "H06": (["NO.", "Time", "W/m2", "W/m2"], (1, N, N, 2, N, N)),
    "H07": (["NO.", "Time", "W/m2", "W/m2", "W/m2"], (1, N, N, 4, N, N)),
    "H08": (["NO.", "Time", "lux", "lux"], (1, N, N, N, 3, N)),
    "H09": (["NO.", "Time", "%", "%RH"], (1, N, 3, N, N, N)),
    "H10": (["Number", "Time", "時間", "degC"], (2, 3, N, N, N, N)),
    "H11": (["NO.", "Time", "", "degC", "rh"], (1, 3, 4, N, N, N)),
    "H12": (["NO.", "Time", "degC.1"], (1, N, N, N, N, 2)),
    "H13": (["NO.", "Time", "1.1 degC", "degC"], (1, 3, N, N, N, N)),
    "H14": (["NO.", "degC", "%"], (N, 1, 2, N, N, N)),
    "H15": (["NO.", "Time", "degC", "degC.1", "degC"], (1, 2, N, N, N, 4)),
    "H16": (["NO.", "Time", "degC", "degC "], (1, 2, N, N, N, 3)),
    # A repeat skips a suffix that another header spells out: W/m2, W/m2.1, W/m2.2.
    "H17": (["NO.", "Time", "W/m2", "W/m2.1", "W/m2"], (1, N, N, 4, N, N)),
    "H18": (["NO.", "Time", "degC %", "%", None], (1, 2, 3, N, N, N)),
    "H19": ([" NO.", "Number\n", "Time", "degC"], (2, 3, N, N, N, N)),
}


def raw_frame(spark, rows):
    return spark.createDataFrame([(f, n, c[0], c) for f, n, c in rows], RAW_ROWS)


def classify(spark, rows):
    raw = raw_frame(spark, rows)
    tops = ingest.sheet_tops(raw)
    layouts = ingest.sheet_layouts(tops, ingest.header_roles(raw, tops))
    return layouts, ingest.classify_samples(raw, layouts)


def test_header_roles(spark):
    rows = []
    for case, (units, _) in HEADERS.items():
        rows += [(case, 0, ["Model", "x"]), (case, 3, ["Data"]), (case, 4, ["Number"]), (case, 5, units)]
        rows += [(case, 9, ["Data"]), (case, 11, ["Time", "degC"])]
    raw = raw_frame(spark, rows)
    region = ingest.data_region(raw)
    assert {tuple(r)[1:] for r in region.collect()} == {(3, 5, 6)}
    found = {r["file"]: tuple(r)[1:] for r in ingest.header_roles(raw, region).collect()}
    assert found == {case: positions for case, (_, positions) in HEADERS.items()}


def test_long_preambles_leave_other_scans_alone(spark):
    files = {f"f{i:02}": 5 for i in range(30)} | {"deep": 500, "deeper": 900}
    raw = spark.createDataFrame(
        [
            (f, n, c, [c, "Time", "degC"])
            for f, unit in files.items()
            for n in range(1000)
            for c in ["Data" if n == unit - 2 else "NO." if n == unit else "x"]
        ],
        RAW_ROWS,
    )
    tops = ingest.sheet_tops(raw)
    read = {r["file"]: r["count"] for r in ingest.down_to_unit_rows(raw, tops).groupBy("file").count().collect()}
    assert read == {f: 7 if unit > 5 else 6 for f, unit in files.items()}
    assert {tuple(r)[1:4] for r in ingest.header_roles(raw, tops).collect()} == {(1, 2, None)}
    assert ingest.down_to_unit_rows(raw.where("lead = 'x'"), ingest.sheet_tops(raw.where("lead = 'x'"))).isEmpty()


def test_marker_is_exact(spark):
    raw = raw_frame(spark, [("a", 0, ["data"]), ("b", 0, [" Data"]), ("c", 0, [None, "Data"]), ("d", 7, ["Data"])])
    assert [r["file"] for r in ingest.data_region(raw).collect()] == ["d"]


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("LOGGER RAWDATA_2508.xlsx", (2025, 8)),
        ("file:/some/folder/LOGGER RAWDATA_2508.xlsx", (2025, 8)),
        ("file:/folder_2401/LOGGER RAWDATA_2508.xlsx", (2025, 8)),
        ("LOGGER RAWDATA_2508_v2.xlsx", (2025, 8)),
        ("LOGGER RAWDATA_202508.xlsx", (None, None)),
        ("LOGGER RAWDATA_2500.xlsx", (None, None)),
        ("LOGGER RAWDATA_2513.xlsx", (2025, 13)),
        ("LOGGER RAWDATA_ab12.xlsx", (None, None)),
        ("LOGGER RAWDATA.xlsx", (None, None)),
    ],
)
def test_file_year_month(spark, name, expected):
    row = file_year_month(spark.createDataFrame([Row(file=name)])).first()
    assert (row["year"], row["month"]) == expected
    assert (row["name_problem"] is None) == (expected[0] is not None)


def test_strict_months(spark):
    row = file_year_month(spark.createDataFrame([Row(file="X_2513.xlsx")]), strict=True).first()
    assert (row["year"], row["name_problem"]) == (None, "no such month")


# (time, ch1, ch2) -> outcome, stored time, ch1, ch2
NOON = datetime(2025, 8, 1, 0, 10)
SAMPLES = [
    (("2025-08-01 00:10:00", "25.345", "60"), (ingest.ACCEPTED, NOON, "25.35", "60.00")),
    ((None, "25", "60"), (ingest.BLANK_TIME, None, "25.00", "60.00")),
    (("", "+++++", "60"), (ingest.BLANK_TIME, None, None, "60.00")),
    (("2025/08/01 00:10:00", None, "60"), (ingest.ACCEPTED, NOON, None, "60.00")),
    (("2025-08-01 00:10:00", "+++++", "60"), (ingest.BAD_CHANNEL, NOON, None, "60.00")),
    (("2025-08-01 00:10:00", "BURNOUT", "60"), (ingest.BAD_CHANNEL, NOON, None, "60.00")),
    (("not a time", "25", "60"), (ingest.BAD_TIME, None, "25.00", "60.00")),
    (("45870.5", "25", "60"), (ingest.BAD_TIME, None, "25.00", "60.00")),
    (("2025-08-01 00:10:00", "NA", "60"), (ingest.ACCEPTED, NOON, None, "60.00")),
    (("2025-08-01 00:10:00", "nan", "#N/A"), (ingest.ACCEPTED, NOON, None, None)),
    (("2025-08-01 00:10:00", " ", "60"), (ingest.BAD_CHANNEL, NOON, None, "60.00")),
    (("2025-08-01 00:10:00", "12d", "60"), (ingest.BAD_CHANNEL, NOON, None, "60.00")),
    (("2025-08-01 00:10:00", "inf", "60"), (ingest.BAD_CHANNEL, NOON, None, "60.00")),
    (("2025-08-01 00:10:00", "0x1p3", "60"), (ingest.BAD_CHANNEL, NOON, None, "60.00")),
    (("2025-08-01 00:10:00", "1e12", "60"), (ingest.BAD_CHANNEL, NOON, None, "60.00")),
    (("2025-08-01 00:10:00", " -1.005 ", "+.5"), (ingest.ACCEPTED, NOON, "-1.01", "0.50")),
    (("2025-08-01 00:10:00", "25.344999999999999", "60.004999999999995"), (ingest.ACCEPTED, NOON, "25.35", "60.00")),
    (("2025-08-01 00:10:00", "1000000000000000000", "60"), (ingest.BAD_CHANNEL, NOON, None, "60.00")),
    (("2025-08-01 00:10:00", "99999999.994", "-99999999.99"), (ingest.ACCEPTED, NOON, "99999999.99", "-99999999.99")),
    (("2025-08-01 00:10:00", "99999999.995", "60"), (ingest.BAD_CHANNEL, NOON, None, "60.00")),
    (("2025-08-01 00:10:00", "12345678901234567d", "60"), (ingest.BAD_CHANNEL, NOON, None, "60.00")),
    (("2025-8-1 0:10:0", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    ((" 2025-08-01 00:10:00 ", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("2025/08/01 23:59:59.9", "25", "60"), (ingest.ACCEPTED, datetime(2025, 8, 2), "25.00", "60.00")),
    (("2025-08-01 00:10:00", "2.5e1", "60."), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("2025-08-01T00:10", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("2025-08-01 00:09:59.5", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("2025-08-01 00:10:00.499999", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("8/1/2025 0:10:00", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("13/01/2025", "25", "60"), (ingest.ACCEPTED, datetime(2025, 1, 13), "25.00", "60.00")),
    (("2025-02-30 00:10:00", "25", "60"), (ingest.BAD_TIME, None, "25.00", "60.00")),
    (("2025-08-01 00:10:00+08:00", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("2025-08-01T00:10:00Z", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("08/01/2025 12:10 AM", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("08/01/2025 1:10:05pm", "25", "60"), (ingest.ACCEPTED, datetime(2025, 8, 1, 13, 10, 5), "25.00", "60.00")),
    (("2025-08-01 12:10 p.m.", "25", "60"), (ingest.ACCEPTED, datetime(2025, 8, 1, 12, 10), "25.00", "60.00")),
    (("2025-08-01 13:10 PM", "25", "60"), (ingest.BAD_TIME, None, "25.00", "60.00")),
    (("Aug 1, 2025 00:10", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("August 1 2025 00:10", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("1-Aug-2025 00:10", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("01 Sept 2025", "25", "60"), (ingest.ACCEPTED, datetime(2025, 9, 1), "25.00", "60.00")),
    (("1-Foo-2025 00:10", "25", "60"), (ingest.BAD_TIME, None, "25.00", "60.00")),
    (("2025.08.01 00:10:00", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("2025.8.1 0:9:59.75", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("20250801 001000", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("20250801", "25", "60"), (ingest.BAD_TIME, None, "25.00", "60.00")),
    (("2025-08-01   00:10:00", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("2025-08-01 24:10:00", "25", "60"), (ingest.BAD_TIME, None, "25.00", "60.00")),
    (("20250801   001000", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("7/31/2025 11:59:59.6 PM", "25", "60"), (ingest.ACCEPTED, datetime(2025, 8, 1), "25.00", "60.00")),
    (("AUG. 1, 2025  12:10 a.m. UTC", "25", "60"), (ingest.ACCEPTED, NOON, "25.00", "60.00")),
    (("31 july, 2025 12:10 PM", "25", "60"), (ingest.ACCEPTED, datetime(2025, 7, 31, 12, 10), "25.00", "60.00")),
    (("2025-08-01 0:10 am", "25", "60"), (ingest.BAD_TIME, None, "25.00", "60.00")),
    (("2025-08-01 00:10:00 Mars", "25", "60"), (ingest.BAD_TIME, None, "25.00", "60.00")),
    (("2025-13-01 00:10:00", "25", "60"), (ingest.BAD_TIME, None, "25.00", "60.00")),
    (("13/13/2025", "25", "60"), (ingest.BAD_TIME, None, "25.00", "60.00")),
    (("Marchy 1, 2025", "25", "60"), (ingest.BAD_TIME, None, "25.00", "60.00")),
    (("2025-08-01 00:10.7", "25", "60"), (ingest.BAD_TIME, None, "25.00", "60.00")),
]


def test_samples(spark):
    rows = [(FILE, 0, ["Data"]), (FILE, 2, ["NO.", "Time", "degC", "%"])]
    rows += [(FILE, 3 + i, [str(i), *cells]) for i, (cells, _) in enumerate(SAMPLES)]
    _, classified = classify(spark, rows)
    found = {r["sheet_row"] - 3: r for r in classified.collect()}
    assert len(found) == len(SAMPLES)
    for i, (cells, (outcome, time, ch1, ch2)) in enumerate(SAMPLES):
        row = found[i]
        stored = [None if v is None else Decimal(v) for v in (ch1, ch2)]
        assert (row["outcome"], row["record_time"]) == (outcome, time), cells
        assert [row[c] for c in CHANNELS[:2]] == stored, cells
        assert (row["year"], row["month"]) == (2025, 8)
    outcomes = [expected[0] for _, expected in SAMPLES]
    counts = ingest.sample_counts(classified).first()
    assert counts["parsed"] == outcomes.count(ingest.ACCEPTED) == ingest.decode_samples(classified).count()
    assert counts["blank"] == outcomes.count(ingest.BLANK_TIME)
    assert counts["rejected"] == ingest.rejects(classified).count()
    assert counts["parsed"] + counts["blank"] + counts["rejected"] == len(SAMPLES)


def test_short_rows_and_problem_files(spark):
    good, no_marker, no_time = "a_2501.xlsx", "b_2502.xlsx", "c_2503.xlsx"
    broken, bad_name = "d_2504.xlsx", "e.xlsx"
    head = ["NO.", "Time", "degC", "%"]
    rows = []
    for file, marker, units in [
        (good, "Data", head),
        (no_marker, "data", head),
        (no_time, "Data", ["NO.", "degC"]),
        (broken, "Data", head),
        (bad_name, "Data", head),
    ]:
        rows += [(file, 0, [marker]), (file, 2, units), (file, 3, ["1", "2025-01-01 00:00:00"])]
    rows.append((broken, -1, ["BadZipFile: cut off"]))
    layouts, classified = classify(spark, rows)
    problems = {r["file"]: r["problem"] for r in layouts.collect()}
    assert problems == {
        good: None,
        no_marker: "no data region",
        no_time: "no time column",
        broken: "BadZipFile: cut off",
        bad_name: "no four-character month in the name",
    }
    accepted = ingest.decode_samples(classified).collect()
    assert [r["file"] for r in accepted] == [good]
    assert [accepted[0][c] for c in CHANNELS] == [None] * 5


def test_header_scan_names_no_samples(spark):
    """The name of a sample row's file is not worked out; here that would fail."""
    tops = spark.createDataFrame([(f"f{i}", 4 + i) for i in range(20)], "file string, unit_row long")
    named = F.expr("concat('f', file_number + 0 * (1 div if(sheet_row > 30, 0, 1)))")
    cells = spark.range(20_000).selectExpr("id % 20 AS file_number", "id div 20 AS sheet_row")
    near = ingest.down_to_unit_rows(cells.select(named.alias("file"), "sheet_row"), tops)
    assert {(r.file, r.sheet_row) for r in near.collect()} >= {(f"f{i}", 4 + i) for i in range(20)}
