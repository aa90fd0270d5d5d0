"""The view with short column names and the reports on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.functions.calendar import sample_date
from barograph.operators.select_rows import in_month
from barograph.schema import DEVICE_TEMP, HUMIDITY, LUX, TEMPERATURE, UV


def complete_view(readings: DataFrame) -> DataFrame:
    return readings.select(
        "id",
        "year",
        "month",
        sample_date().alias("date"),
        "record_time",
        F.col(TEMPERATURE).alias("temperature"),
        F.col(HUMIDITY).alias("humidity"),
        F.col(UV).alias("uv"),
        F.col(LUX).alias("lux"),
        F.col(DEVICE_TEMP).alias("device_temperature"),
    )


def register_complete_view(readings: DataFrame, name: str = "complete_view") -> None:
    """Make the view available to ``spark.sql``, replacing an older one."""
    complete_view(readings).createOrReplaceTempView(name)


def view_latest(view: DataFrame, year: int, month: int, limit: int = 100) -> DataFrame:
    return in_month(view, year, month).orderBy(F.desc("record_time"), F.desc("id")).limit(limit)


def view_month_rows(view: DataFrame, year: int, month: int) -> DataFrame:
    """Sorted by a column that is not shown."""
    rows_of_month = in_month(view, year, month).orderBy("record_time", "id")
    return rows_of_month.select("date", "temperature", "humidity", "device_temperature")
