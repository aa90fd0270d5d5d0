"""Schemas of the fact table, the daily table and the ingest frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEMPERATURE = "channel1_temperature"
HUMIDITY = "channel2_humidity"
UV = "channel3_uv"
LUX = "channel4_lux"
DEVICE_TEMP = "channel5_device_temp"
CHANNELS = [TEMPERATURE, HUMIDITY, UV, LUX, DEVICE_TEMP]

MONTH_KEYS = ["year", "month"]
SAMPLE_KEYS = ["year", "month", "record_time"]

CHANNEL = T.DecimalType(10, 2)
MEAN = T.DecimalType(14, 6)
STATISTIC = T.DecimalType(5, 2)

READINGS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("record_time", T.TimestampNTZType()),
        *[T.StructField(name, CHANNEL) for name in CHANNELS],
        T.StructField("created_at", T.TimestampType()),
    ]
)

STATISTICS = [
    "avg_temperature",
    "avg_humidity",
    "avg_device_temp",
    "max_temperature",
    "max_humidity",
    "min_temperature",
    "min_humidity",
    "temperature_delta",
    "humidity_delta",
]

DAILY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        *[T.StructField(name, STATISTIC) for name in STATISTICS],
        T.StructField("record_count", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

#: What the daily statistics of several loads are put together from, one row per date and file month of a load.
PARTIAL_OF = {"temperature": TEMPERATURE, "humidity": HUMIDITY, "device_temp": DEVICE_TEMP}
PARTIALS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        *[
            T.StructField(f"{name}_{part}", kind)
            for name in PARTIAL_OF
            for part, kind in (("total", T.LongType()), ("count", T.LongType()), ("max", CHANNEL), ("min", CHANNEL))
        ],
        T.StructField("record_count", T.LongType()),
    ]
)

#: Workbooks as they were when they were last compared with the stored months.
TAKEN_IN = "file string, year int, month int, modified timestamp, size long, fingerprint string"

# One row per worksheet row. `lead` repeats the first cell so that the search for the
# data marker reads flat columns only. A workbook that cannot be read has a row numbered
# UNREADABLE with the error as its `lead`.
UNREADABLE = -1
RAW_ROWS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("sheet_row", T.LongType()),
        T.StructField("lead", T.StringType()),
        T.StructField("cells", T.ArrayType(T.StringType())),
    ]
)


def as_readings(df: DataFrame) -> DataFrame:
    """The fact columns in order and with their types; a missing load time becomes NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in READINGS
        ]
    )
