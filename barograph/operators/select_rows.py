"""Reports that return single readings.

Sorted results end with `id`: ties come out the same every time, and a value shared by a
great part of the rows cannot fill one range partition of the sort.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph import fixed
from barograph.functions.calendar import sample_hour
from barograph.schema import CHANNELS, DEVICE_TEMP, HUMIDITY, LUX, TEMPERATURE, UV


def in_month(readings: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of one file month; prunes partitions of a stored table."""
    return readings.where((F.col("year") == year) & (F.col("month") == month))


def month_rows(readings: DataFrame, year: int, month: int, limit: int = 100) -> DataFrame:
    return in_month(readings, year, month).orderBy("record_time", "id").limit(limit)


def month_all_rows(readings: DataFrame, year: int, month: int) -> DataFrame:
    return in_month(readings, year, month)


def latest_rows(readings: DataFrame, limit: int = 10) -> DataFrame:
    return readings.orderBy(F.desc("record_time"), F.desc("id")).limit(limit)


def hour_band_rows(
    readings: DataFrame, year: int, month: int, hours: tuple[int, int] = fixed.MIDDAY_HOURS
) -> DataFrame:
    """Both hours are included whole: 12 to 14 keeps samples up to 14:59:59."""
    return in_month(readings, year, month).where(sample_hour().between(*hours)).orderBy("record_time", "id")


def extreme_rows(readings: DataFrame, year: int, month: int, channel: str, extreme) -> DataFrame:
    """Every row of the month that reaches the month's extreme."""
    rows = in_month(readings, year, month)
    reached = rows.agg(extreme(channel)).scalar()
    return rows.where(F.col(channel) == reached)


def hottest_rows(readings: DataFrame, year: int, month: int) -> DataFrame:
    return extreme_rows(readings, year, month, TEMPERATURE, F.max)


def coldest_rows(readings: DataFrame, year: int, month: int) -> DataFrame:
    return extreme_rows(readings, year, month, TEMPERATURE, F.min)


def rows_above(
    readings: DataFrame, year: int, month: int, channel: str, limit: Column, columns: list[str]
) -> DataFrame:
    return (
        in_month(readings, year, month)
        .where(F.col(channel) > limit)
        .orderBy(F.desc(channel), "record_time", "id")
        .select(*columns)
    )


def over_temperature(
    readings: DataFrame, year: int, month: int, limit: float | str = fixed.HIGH_TEMPERATURE
) -> DataFrame:
    shown = ["record_time", TEMPERATURE, HUMIDITY, DEVICE_TEMP]
    return rows_above(readings, year, month, TEMPERATURE, decimal(limit), shown)


def over_humidity(
    readings: DataFrame, year: int, month: int, limit: float | str = fixed.HIGH_HUMIDITY
) -> DataFrame:
    return rows_above(readings, year, month, HUMIDITY, decimal(limit), ["record_time", TEMPERATURE, HUMIDITY])


def high_uv(readings: DataFrame, year: int, month: int, limit: float | str = fixed.HIGH_UV) -> DataFrame:
    return rows_above(readings, year, month, UV, decimal(limit), ["record_time", UV, TEMPERATURE, LUX])


def decimal(limit: float | str) -> Column:
    """The limit as it is written: 0.8 as a double is not 0.80."""
    return F.lit(Decimal(str(limit)))


def missing_rows(readings: DataFrame, year: int, month: int, limit: int = 50) -> DataFrame:
    """Earliest rows of the month that lack a channel, with a flag per channel."""
    names = dict(zip(CHANNELS, ["temp", "humidity", "uv", "lux", "device_temp"], strict=True))
    lacks_any = F.lit(False)
    for channel in CHANNELS:
        lacks_any = lacks_any | F.col(channel).isNull()
    flags = [
        F.when(F.col(channel).isNull(), fixed.MISSING).otherwise(fixed.PRESENT).alias(name)
        for channel, name in names.items()
    ]
    earliest = in_month(readings, year, month).where(lacks_any).orderBy("record_time", "id").limit(limit)
    return earliest.select("record_time", *flags)


def all_rows(readings: DataFrame) -> DataFrame:
    return readings


def with_device_temp(readings: DataFrame) -> DataFrame:
    return readings.where(F.col(DEVICE_TEMP).isNotNull())


def export_month(readings: DataFrame, year: int, month: int) -> DataFrame:
    """A month under its published headings, the time as text."""
    as_text = {"record_time": F.date_format("record_time", "yyyy-MM-dd HH:mm:ss")}
    shown = [as_text.get(c, F.col(c)).alias(h) for c, h in fixed.EXPORT_MONTH_HEADINGS.items()]
    return in_month(readings, year, month).orderBy("record_time", "id").select(*shown)
