"""The worksheet scan, on generated files."""

import os
import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pytest
from xlsx_files import Sheet, write_xlsx

from barograph.sources.workbooks import list_workbooks, scan_workbooks
from barograph.sources.xlsx import date_text, first_sheet_rows, shows_date

MORNING = datetime(2025, 8, 1, 0, 10)


def read(path):
    return list(first_sheet_rows(path.read_bytes()))


@pytest.mark.parametrize("shared", [True, False])
@pytest.mark.parametrize("references", [True, False])
def test_cells(tmp_path, shared, references):
    rows = [(0, ["Data"]), (1, ["a&b", None, " degC ", 25.345]), (2, [None, MORNING, ("b", 1), ("e", "#N/A"), ("str", "x")])]
    write_xlsx(tmp_path / "f.xlsx", [Sheet(rows, shared, references=references), Sheet([(0, ["other"])])])
    assert read(tmp_path / "f.xlsx") == [
        (0, ["Data"]),
        (1, ["a&b", None, " degC ", "25.345"]),
        (2, [None, "2025-08-01 00:10:00", "1", None, "x"]),
    ]


def test_gaps_keep_row_numbers(tmp_path):
    write_xlsx(tmp_path / "f.xlsx", [Sheet([(4, ["Data"]), (5, [None, None]), (9, [None] * 27 + ["far"])])])
    assert read(tmp_path / "f.xlsx") == [(4, ["Data"]), (9, [None] * 27 + ["far"])]


def test_1904_calendar(tmp_path):
    sheet = Sheet([(0, [MORNING])], epoch=datetime(1904, 1, 1))
    write_xlsx(tmp_path / "f.xlsx", [sheet], epoch_1904=True)
    assert read(tmp_path / "f.xlsx") == [(0, ["2025-08-01 00:10:00"])]


def test_number_format_decides(tmp_path):
    write_xlsx(tmp_path / "f.xlsx", [Sheet([(0, [MORNING])])], format_code="0.00")
    assert float(read(tmp_path / "f.xlsx")[0][1][0]) == pytest.approx(45870.0069444)


@pytest.mark.parametrize(
    ("code", "expected"),
    [
        ("General", False),
        ("0.00", False),
        ("yyyy-mm-dd", True),
        ("h:mm AM/PM", True),
        ('0.0" days"', False),
        ("[Red]0.00", False),
        ("[$-404]yyyy/m/d", True),
        ("[h]:mm:ss", False),
        (r"0\d", False),
    ],
)
def test_shows_date(code, expected):
    assert shows_date(code) is expected


def test_date_text():
    assert date_text(1.0, False) == "1900-01-01 00:00:00"
    assert date_text(61.0, False) == "1900-03-01 00:00:00"
    assert date_text(0.5, False) == "12:00:00"
    assert date_text(45870.00694444445, False) == "2025-08-01 00:10:00"
    assert date_text(0.0, True) == "00:00:00"


def test_scan_folder(spark, tmp_path):
    write_xlsx(tmp_path / "LOGGER RAWDATA_2507.xlsx", [Sheet([(0, ["Data"]), (2, [1.5])])])
    write_xlsx(tmp_path / "LOGGER RAWDATA_2508_v2.xlsx", [Sheet([(0, ["Model"])])])
    write_xlsx(tmp_path / "LOGGER RAWDATA_2509.xlsx", [Sheet([])])
    write_xlsx(tmp_path / "~$LOGGER RAWDATA_2507.xlsx", [Sheet([(0, ["lock"])])])
    write_xlsx(tmp_path / "other.xlsx", [Sheet([(0, ["other"])])])
    (tmp_path / "LOGGER RAWDATA_2510.xlsx").write_bytes(b"no zip at all")
    (tmp_path / "sub").mkdir()
    write_xlsx(tmp_path / "sub" / "LOGGER RAWDATA_2401.xlsx", [Sheet([(0, ["deep"])])])

    def names(frame):
        return sorted({r["file"].rsplit("/", 1)[1] for r in frame.collect()})

    listed = names(list_workbooks(spark, str(tmp_path)))
    assert listed == [f"LOGGER RAWDATA_{m}.xlsx" for m in ("2507", "2508_v2", "2509", "2510")]
    raw = scan_workbooks(spark, str(tmp_path))
    cells = sorted((r["sheet_row"], r["lead"], r["cells"]) for r in raw.collect() if r["sheet_row"] >= 0)
    assert cells == [(0, "Data", ["Data"]), (0, "Model", ["Model"]), (2, "1.5", ["1.5"])]
    assert names(raw.where("sheet_row = -1")) == ["LOGGER RAWDATA_2509.xlsx", "LOGGER RAWDATA_2510.xlsx"]

    only = scan_workbooks(spark, [r["file"] for r in list_workbooks(spark, str(tmp_path)).collect() if "_250" in r["file"]])
    assert names(only) == ["LOGGER RAWDATA_2507.xlsx", "LOGGER RAWDATA_2508_v2.xlsx", "LOGGER RAWDATA_2509.xlsx"]
    assert scan_workbooks(spark, []).count() == 0


def test_names_are_no_patterns(spark, tmp_path):
    for name in ("v[1]", "v1", "{a,b}", "a"):
        write_xlsx(tmp_path / f"LOGGER RAWDATA_2507_{name}.xlsx", [Sheet([(0, ["Data"])])])
    listed = [r["file"] for r in list_workbooks(spark, str(tmp_path)).collect()]
    assert len(listed) == 4
    for file in listed:
        assert [r["file"] for r in scan_workbooks(spark, [file]).collect()] == [file]


def test_more_rows_than_a_batch(spark, tmp_path):
    rows = [(i, [i, f"text {i}"]) for i in range(20_000)]
    write_xlsx(tmp_path / "LOGGER RAWDATA_2507.xlsx", [Sheet(rows, shared=False)])
    raw = scan_workbooks(spark, str(tmp_path))
    assert raw.count() == 20_000
    assert raw.where("lead <> sheet_row OR cells[1] <> concat('text ', sheet_row)").count() == 0


def test_broken_off_sheet(spark, tmp_path):
    path = tmp_path / "LOGGER RAWDATA_2507.xlsx"

    class Cut(Sheet):
        def xml(self, strings):
            return super().xml(strings)[:-30]

    write_xlsx(path, [Cut([(0, ["Data"]), (1, ["x"])])])
    errors = scan_workbooks(spark, str(tmp_path)).where("sheet_row = -1").collect()
    assert len(errors) == 1 and "ExpatError" in errors[0]["lead"]


def test_scan_from_another_folder(tmp_path):
    """A scan runs wherever the driver was started, as long as the package is on the workers' path."""
    write_xlsx(tmp_path / "LOGGER RAWDATA_2507.xlsx", [Sheet([(0, ["Data"])])])
    root = Path(__file__).resolve().parent.parent
    code = f"""
from barograph.session import build_session
from barograph.sources.workbooks import scan_workbooks
spark = build_session("away", **{{"spark.master": "local[1]", "spark.ui.enabled": "false", "spark.checkpoint.dir": {str(tmp_path / "work")!r}}})
print("rows:", scan_workbooks(spark, {str(tmp_path)!r}).count())
"""
    away = tmp_path / "elsewhere"
    away.mkdir()
    env = {**os.environ, "PYTHONPATH": str(root)}
    done = subprocess.run([sys.executable, "-c", code], cwd=away, env=env, capture_output=True, text=True, timeout=180)
    assert "rows: 1" in done.stdout, done.stderr[-2000:]
