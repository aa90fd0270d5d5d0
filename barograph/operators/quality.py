"""Completeness and verification reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.functions.calendar import sample_date
from barograph.functions.measures import highest, lowest, mean, percentage, rows
from barograph.operators.select_rows import in_month
from barograph.schema import CHANNELS, DEVICE_TEMP, HUMIDITY, TEMPERATURE, UV


def count_or_null(channel: str) -> Column:
    """Non-null values; NULL rather than 0 where there is no row at all."""
    return F.sum(F.col(channel).isNotNull().cast("int"))


def completeness_month(readings: DataFrame, year: int, month: int) -> DataFrame:
    """One row, also for a month without readings."""
    names = ["temp", "humidity", "uv", "lux", "device_temp"]
    counts = [count_or_null(c).alias(f"{n}_count") for c, n in zip(CHANNELS, names, strict=True)]
    shares = [
        percentage(F.col(f"{n}_count"), F.col("total_records")).alias(f"{n}_percentage")
        for n in ["temp", "uv", "lux"]
    ]
    counted = in_month(readings, year, month).agg(rows().alias("total_records"), *counts)
    return counted.select("*", *shares)


def completeness_all(readings: DataFrame) -> DataFrame:
    """Whole-table completeness, percentages to one decimal; NULL for an empty table."""
    counts = [count_or_null(c).alias(f"ch{i}_count") for i, c in enumerate(CHANNELS, 1)]
    counted = readings.agg(rows().alias("total"), *counts)
    shares = [
        percentage(F.col(f"ch{i}_count"), F.col("total"), 1).alias(f"ch{i}_percentage")
        for i in range(1, len(CHANNELS) + 1)
    ]
    return counted.select("*", *shares)


def by_file_month(readings: DataFrame, *measures: Column) -> DataFrame:
    return readings.groupBy("year", "month").agg(*measures).orderBy("year", "month")


def verify_months(readings: DataFrame) -> DataFrame:
    return by_file_month(
        readings,
        rows().alias("record_count"),
        F.min("record_time").alias("first_record"),
        F.max("record_time").alias("last_record"),
    )


def verify_months_ch5(readings: DataFrame) -> DataFrame:
    return by_file_month(
        readings,
        rows().alias("record_count"),
        F.min("record_time").alias("first_record"),
        F.max("record_time").alias("last_record"),
        F.count(DEVICE_TEMP).alias("ch5_count"),
    )


def import_month_report(readings: DataFrame) -> DataFrame:
    return by_file_month(
        readings,
        rows().alias("total"),
        F.min("record_time").alias("first_time"),
        F.max("record_time").alias("last_time"),
        mean(TEMPERATURE, 2).alias("avg_temp"),
        mean(HUMIDITY, 2).alias("avg_humidity"),
    )


def climate_range(readings: DataFrame) -> DataFrame:
    """Humidity too is taken only from rows that have a temperature."""
    return readings.where(F.col(TEMPERATURE).isNotNull()).agg(
        lowest(TEMPERATURE).alias("min_temp"),
        highest(TEMPERATURE).alias("max_temp"),
        lowest(HUMIDITY).alias("min_humidity"),
        highest(HUMIDITY).alias("max_humidity"),
    )


def uv_coverage(readings: DataFrame) -> DataFrame:
    """First UV sample and number of dates with UV.

    Grouping by date first leaves one row per date for the final count, instead of the
    wider two-level plan of a distinct count.
    """
    dates = (
        readings.where(F.col(UV).isNotNull())
        .groupBy(sample_date().alias("date"))
        .agg(F.min("record_time").alias("first"))
    )
    return dates.agg(F.min("first").alias("first_uv_time"), rows().alias("days_with_uv"))


def device_temp_months(readings: DataFrame) -> DataFrame:
    """Months without any device temperature are left out."""
    return readings.where(F.col(DEVICE_TEMP).isNotNull()).groupBy("year", "month").agg(rows().alias("count"))


def device_temp_quality(readings: DataFrame) -> DataFrame:
    counted = by_file_month(
        readings,
        rows().alias("total_records"),
        F.count(DEVICE_TEMP).alias("ch5_records"),
        lowest(DEVICE_TEMP).alias("min_temp"),
        highest(DEVICE_TEMP).alias("max_temp"),
        mean(DEVICE_TEMP, 2).alias("avg_temp"),
    )
    share = percentage(F.col("ch5_records"), F.col("total_records")).alias("percentage")
    return counted.select(
        "year", "month", "total_records", "ch5_records", share, "min_temp", "max_temp", "avg_temp"
    )


def device_temp_sample(readings: DataFrame, year: int, month: int, limit: int = 10) -> DataFrame:
    return (
        in_month(readings, year, month)
        .where(F.col(DEVICE_TEMP).isNotNull())
        .orderBy("record_time", "id")
        .limit(limit)
        .select("record_time", TEMPERATURE, DEVICE_TEMP)
    )
