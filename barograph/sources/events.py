"""Sensor readings and worksheet rows derived from the supplied `events` table.

The supplied tables hold no sensor data, so every reading is computed from one event:
the same arithmetic in any SQL engine gives the same reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.functions.calendar import floor_second
from barograph.schema import CHANNEL, CHANNELS, DEVICE_TEMP, HUMIDITY, LUX, RAW_ROWS, TEMPERATURE, UV

YEAR = 2024
FILE = "LOGGER RAWDATA_{yymm}.xlsx"

# Month -> (marker row, units, channels in sheet order).
LAYOUTS = {
    1: (2, ["NO.", "Time", "degC", "%", "W/m2", "lux", "degC"], [TEMPERATURE, HUMIDITY, UV, LUX, DEVICE_TEMP]),
    2: (3, ["NO.", "Time", "lux", "degC", "degC", "%", "W/m2"], [LUX, TEMPERATURE, DEVICE_TEMP, HUMIDITY, UV]),
    3: (4, ["NO.", "Time", "degC", "%", "W/m2", "lux"], [TEMPERATURE, HUMIDITY, UV, LUX]),
}


def from_hundredths(expression: str) -> Column:
    """Multiplying keeps the decimal exact and avoids the far slower decimal division."""
    return F.expr(f"({expression}) * 0.01BD").cast(CHANNEL)


def readings_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event, over three file months whose dates overlap at the edges."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("e"),
        F.col("user_id").alias("u"),
        (F.col("event_id") % 3).cast("int").alias("k"),
        F.rint(F.col("value") * 100).cast("bigint").alias("v"),
        floor_second(F.col("ts")).alias("t"),
    )

    def unless(missing: str, expression: str) -> Column:
        return F.when(~F.expr(missing), from_hundredths(expression))

    return events.select(
        (F.col("e") + 1).alias("id"),
        F.lit(YEAR).alias("year"),
        (F.col("k") + 1).alias("month"),
        F.timestamp_add("DAY", F.col("k") * 29, F.col("t")).alias("record_time"),
        unless("e % 41 = 0", "(v + 37 * u) % 4500 - 500").alias(TEMPERATURE),
        unless("e % 37 = 0", "(v * 7 + 11 * e) % 7000 + 3000").alias(HUMIDITY),
        unless("e % 5 = 0", "v % 150").alias(UV),
        unless("e % 7 = 0", "v * 1300 % 10000000").alias(LUX),
        unless("k = 2 OR (k = 0 AND e % 9 < 3)", "(v + 1234) % 5000").alias(DEVICE_TEMP),
    )


def loaded_and_incoming(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A table that holds month 1 and half of month 2, and a delivery of months 2 and 3 in
    which a tenth of month 3 comes twice."""
    month = F.col("month")
    loaded = readings.where((month == 1) | ((month == 2) & (F.col("id") % 2 == 0)))
    repeated = readings.where((month == 3) & (F.col("id") % 10 == 0))
    return loaded, readings.where(month.isin(2, 3)).unionByName(repeated)


def file_name(month: Column) -> Column:
    prefix, suffix = FILE.split("{yymm}")
    return F.concat(F.lit(f"{prefix}{YEAR % 100:02d}"), F.lpad(month.cast("string"), 2, "0"), F.lit(suffix))


# Time texts of the derived worksheet rows; all others are in the logger's own form.
TIME_FORMS = {
    4: "MM/dd/yyyy h:mm:ss a",
    5: "MMM d, yyyy HH:mm:ss",
    6: "d-MMM-yyyy HH:mm:ss",
    7: "yyyy.MM.dd HH:mm:ss",
    8: "yyyyMMdd HHmmss",
    9: "yyyy-MM-dd'T'HH:mm:ss'Z'",
    10: "yyyy-MM-dd  HH:mm:ss",
}


def time_text() -> Column:
    """The sample time in one of many forms, to the second."""
    text = F.col("record_time").cast("string")
    for form, pattern in TIME_FORMS.items():
        text = F.when(F.col("id") % 11 == form, F.date_format("record_time", pattern)).otherwise(text)
    return text


# Unit rows of the derived workbooks, one per date and group of readings, in turn; each with
# the position of the time column. Two more workbooks of a turn have no marker.
UNIT_ROWS = [
    (["NO.", "Time", "degC", "%", "W/m2", "lux", "degC"], 1),
    (["NO.", "Time", "degC", "%", "lux"], 1),
    (["NO.", "Time", "degC", "degC"], 1),
    (["NO.", "Time", "degC", "degC", "degC"], 1),
    (["NO.", "Time", "degC", "DEGC"], 1),
    (["NO.", "Time", "W/m2", "W/m2"], 1),
    (["NO.", "Time", "W/m2", "W/m2", "W/m2"], 1),
    (["NO.", "Time", "lux", "lux"], 1),
    (["NO.", "Time", "%", "%RH"], 1),
    (["Number", "Time", "時間", "degC"], 2),
    (["NO.", "Time", "", "degC", "rh"], 1),
    (["NO.", "Time", "degC.1"], 1),
    (["NO.", "Time", "1.1 degC", "degC"], 1),
    (["NO.", "degC", "%"], None),
    (["NO.", "Time", "degC", "degC.1", "degC"], 1),
    (["NO.", "Time", "degC", "degC "], 1),
]
CASES = len(UNIT_ROWS) + 2
GROUPS = 4


def workbooks_from_readings(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """Worksheet rows of one workbook per date and group of readings.

    Every second group has a broken first channel in all of its samples, so the workbook gives none.
    """
    day = F.datediff(F.to_date("record_time"), F.lit("2024-01-01").cast("date"))
    own = readings.select(
        "id",
        (F.col("id") % GROUPS).alias("team"),
        F.date_format("record_time", "yyMM_dd").alias("dated"),
        time_text().alias("time"),
        day.alias("day"),
    )
    case = F.pmod(F.col("day") * GROUPS + F.col("team"), F.lit(CASES)).cast("int")
    own = own.select(
        "id",
        "time",
        "team",
        case.alias("case"),
        F.concat(F.lit("LOGGER RAWDATA_"), "dated", F.lit("_"), "team", F.lit(".xlsx")).alias("file"),
    )
    values, samples = F.when(F.col("team") % 2 == 0, F.lit("+++++")).otherwise(F.lit("1.5")), F.lit(None)
    tops = []
    for number, (units, at) in enumerate(UNIT_ROWS):
        cells = [F.col("id").cast("string"), *[F.col("time") if i == at else values for i in range(1, len(units))]]
        samples = F.when(F.col("case") == number, F.array(*cells)).otherwise(samples)
        tops += [(number, 0, ["Model"]), (number, 1, ["Data"]), (number, 2, ["Number"]), (number, 3, units)]
    for number in range(len(UNIT_ROWS), CASES):
        tops += [(number, 0, ["Model"]), (number, 1, ["data"]), (number, 3, UNIT_ROWS[0][0])]
    marker = F.col("team") + 1  # the workbooks of a turn begin at different rows
    below = own.select("file", (marker + 2 + F.col("id")).alias("sheet_row"), F.col("id").cast("string").alias("lead"), samples.alias("cells"))
    rows = [f"({number}, {line}, array('{"', '".join(cells)}'))" for number, line, cells in tops]
    top = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS top(case, line, cells)")
    heads = F.broadcast(top).join(own.select("file", "case", "team").distinct(), "case")
    row = F.when(F.col("line") == 0, F.lit(0).cast("long")).otherwise(F.col("team") + F.col("line"))
    heads = heads.select("file", row.alias("sheet_row"), F.get("cells", F.lit(0)).alias("lead"), "cells")
    return below.unionByName(heads).select(*RAW_ROWS.names)


def raw_rows_from_readings(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """Worksheet rows of one workbook per month: preamble, marker, field names, units and
    one sample row per reading, some with a blank time or an over-range temperature."""
    broken = F.when(F.col("id") % 101 == 0, F.lit("+++++"))
    texts = readings.select(
        "id",
        "month",
        F.col("id").cast("string").alias("lead"),
        F.when(F.col("id") % 103 != 0, time_text()).alias("time"),
        F.coalesce(broken, F.col(TEMPERATURE).cast("string")).alias(TEMPERATURE),
        *[F.col(c).cast("string").alias(c) for c in CHANNELS if c != TEMPERATURE],
    )
    cells, first_row = F.lit(None), F.lit(None)
    for month, (marker, _, channels) in LAYOUTS.items():
        here = F.col("month") == month
        cells = F.when(here, F.array("lead", "time", *channels)).otherwise(cells)
        first_row = F.when(here, marker + 2).otherwise(first_row)
    samples = texts.select(
        file_name(F.col("month")).alias("file"),
        (first_row + F.col("id")).alias("sheet_row"),
        "lead",
        cells.alias("cells"),
    )

    tops = []
    for month, (marker, units, _) in LAYOUTS.items():
        names = ["Number", "Date&Time", *[f"CH{i}" for i in range(1, len(units) - 1)]]
        rows = {0: ["Model"], marker: ["Data"], marker + 1: names, marker + 2: units}
        tops += [f"({month}, {row}L, array('{"', '".join(cells)}'))" for row, cells in rows.items()]
    top = spark.sql(f"SELECT * FROM VALUES {', '.join(tops)} AS top(month, sheet_row, cells)")
    tops_of_files = readings.select("month").distinct().join(top, "month").select(
        file_name(F.col("month")).alias("file"),
        "sheet_row",
        F.get("cells", F.lit(0)).alias("lead"),
        "cells",
    )
    return samples.unionByName(tops_of_files).select(*RAW_ROWS.names)


def names_from_readings(readings: DataFrame) -> DataFrame:
    """A workbook name per reading, in every shape the naming rule has to tell apart."""
    dated = readings.select("id", (F.col("id") % 7).alias("shape"), F.date_format("record_time", "yyMM").alias("yymm"))
    yy, shape = F.substring("yymm", 1, 2), F.col("shape")
    after = {
        0: F.concat(F.lit("_"), "yymm"),
        1: F.concat(F.lit("_"), "yymm", F.lit("_v2")),
        2: F.concat(F.lit("_20"), "yymm"),
        3: F.concat(F.lit("_"), yy, F.lit("00")),
        4: F.concat(F.lit("_"), yy, F.lit("13")),
        5: F.concat(F.lit("_ab"), yy),
    }
    ending = F.concat(F.lit(" "), "yymm")
    for number, text in after.items():
        ending = F.when(shape == number, text).otherwise(ending)
    return dated.select("id", F.concat(F.lit("LOGGER RAWDATA"), ending, F.lit(".xlsx")).alias("file"))
