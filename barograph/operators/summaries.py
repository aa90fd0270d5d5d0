"""Grouped reports. Each is one partial and one final hash aggregate over a few groups,
so that a group holding most of the rows costs no more than any other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph import fixed
from barograph.functions.calendar import day_period, day_type, sample_date, sample_hour
from barograph.functions.measures import highest, hundredths, lowest, mean, percentage, rows, spread
from barograph.operators.select_rows import in_month
from barograph.schema import HUMIDITY, LUX, TEMPERATURE, UV


def total_records(readings: DataFrame) -> DataFrame:
    return readings.agg(rows().alias("total_records"))


def records_by_month(readings: DataFrame) -> DataFrame:
    return readings.groupBy("year", "month").agg(rows().alias("record_count")).orderBy("year", "month")


def by_date(readings: DataFrame, year: int, month: int, *measures: Column) -> DataFrame:
    """One row per date of a file month, in date order."""
    dates = in_month(readings, year, month).groupBy(sample_date().alias("date"))
    return dates.agg(*measures).orderBy("date")


def daily_averages(readings: DataFrame, year: int, month: int) -> DataFrame:
    return by_date(
        readings,
        year,
        month,
        mean(TEMPERATURE).alias("avg_temp"),
        mean(HUMIDITY).alias("avg_humidity"),
        mean(UV).alias("avg_uv"),
        mean(LUX).alias("avg_lux"),
    )


def daily_extremes(readings: DataFrame, year: int, month: int) -> DataFrame:
    return by_date(
        readings,
        year,
        month,
        highest(TEMPERATURE).alias("max_temp"),
        lowest(TEMPERATURE).alias("min_temp"),
        highest(HUMIDITY).alias("max_humidity"),
        lowest(HUMIDITY).alias("min_humidity"),
        highest(UV).alias("max_uv"),
        highest(LUX).alias("max_lux"),
    )


def daily_trend(readings: DataFrame, year: int, month: int) -> DataFrame:
    return by_date(
        readings,
        year,
        month,
        lowest(TEMPERATURE).alias("min_temp"),
        mean(TEMPERATURE).alias("avg_temp"),
        highest(TEMPERATURE).alias("max_temp"),
        spread(TEMPERATURE).alias("temp_range"),
    )


def uv_daily(readings: DataFrame, year: int, month: int) -> DataFrame:
    return by_date(
        readings,
        year,
        month,
        rows().alias("total_records"),
        F.count(UV).alias("uv_records"),
        mean(UV).alias("avg_uv"),
        highest(UV).alias("max_uv"),
    )


def lux_daily(readings: DataFrame, year: int, month: int) -> DataFrame:
    """Dates without any lux value are left out."""
    return by_date(
        readings.where(F.col(LUX).isNotNull()),
        year,
        month,
        mean(LUX).alias("avg_lux"),
        highest(LUX).alias("max_lux"),
        F.count(LUX).alias("lux_record_count"),
    )


def export_daily(readings: DataFrame, year: int, month: int) -> DataFrame:
    """The daily summary under its published headings."""
    measures = {
        "record_count": rows(),
        "avg_temperature": mean(TEMPERATURE, 2),
        "max_temperature": highest(TEMPERATURE),
        "min_temperature": lowest(TEMPERATURE),
        "avg_humidity": mean(HUMIDITY, 2),
        "max_humidity": highest(HUMIDITY),
        "min_humidity": lowest(HUMIDITY),
        "avg_uv": mean(UV, 2),
        "max_lux": highest(LUX),
    }
    daily = by_date(readings, year, month, *[m.alias(name) for name, m in measures.items()])
    return daily.withColumnsRenamed(fixed.EXPORT_DAILY_HEADINGS)


def monthly_summary(readings: DataFrame, year: int, month: int) -> DataFrame:
    return (
        in_month(readings, year, month)
        .groupBy("year", "month")
        .agg(
            rows().alias("record_count"),
            mean(TEMPERATURE).alias("avg_temp"),
            highest(TEMPERATURE).alias("max_temp"),
            lowest(TEMPERATURE).alias("min_temp"),
            mean(HUMIDITY).alias("avg_humidity"),
            highest(HUMIDITY).alias("max_humidity"),
            lowest(HUMIDITY).alias("min_humidity"),
        )
    )


def hourly_temperature(readings: DataFrame, year: int, month: int) -> DataFrame:
    return (
        in_month(readings, year, month)
        .groupBy(sample_hour().alias("hour"))
        .agg(mean(TEMPERATURE).alias("avg_temp"), rows().alias("record_count"))
        .orderBy("hour")
    )


def climate_by(readings: DataFrame, year: int, month: int, label: Column) -> DataFrame:
    return (
        in_month(readings, year, month)
        .groupBy(label)
        .agg(
            mean(TEMPERATURE).alias("avg_temp"),
            mean(HUMIDITY).alias("avg_humidity"),
            rows().alias("record_count"),
        )
    )


def day_night(
    readings: DataFrame, year: int, month: int, day_hours: tuple[int, int] = fixed.DAY_HOURS
) -> DataFrame:
    return climate_by(readings, year, month, day_period(day_hours).alias("time_period"))


def weekday_weekend(readings: DataFrame, year: int, month: int) -> DataFrame:
    return climate_by(readings, year, month, day_type().alias("day_type"))


def bucket(channel: str, width: int) -> Column:
    """Lower edge of the value's bucket; floors go towards minus infinity, NULL stays NULL."""
    return (F.floor(hundredths(channel) / (width * 100)) * width).cast("int")


def temp_humidity_histogram(
    readings: DataFrame,
    year: int,
    month: int,
    temperature_width: int = fixed.TEMPERATURE_BUCKET,
    humidity_width: int = fixed.HUMIDITY_BUCKET,
) -> DataFrame:
    return (
        in_month(readings, year, month)
        .groupBy(
            bucket(TEMPERATURE, temperature_width).alias("temp_range"),
            bucket(HUMIDITY, humidity_width).alias("humidity_range"),
        )
        .agg(rows().alias("count"))
        .orderBy("temp_range", "humidity_range")
    )


def comfort_level(
    temperature: tuple[int, int] = fixed.COMFORT_TEMPERATURE,
    humidity: tuple[int, int] = fixed.COMFORT_HUMIDITY,
) -> Column:
    """The first class that fits; a NULL channel fits no comparison."""
    warm, damp = F.col(TEMPERATURE), F.col(HUMIDITY)
    return (
        F.when(warm.between(*temperature) & damp.between(*humidity), fixed.COMFORTABLE)
        .when(warm > temperature[1], fixed.HOT)
        .when(warm < temperature[0], fixed.COLD)
        .when(damp > humidity[1], fixed.HUMID)
        .when(damp < humidity[0], fixed.DRY)
        .otherwise(fixed.OTHER)
    )


def comfort_levels(readings: DataFrame, year: int, month: int) -> DataFrame:
    """Count and share per comfort class.

    The month is read once: the total is the sum of the class counts, of which there are
    at most six.
    """
    classes = (
        in_month(readings, year, month)
        .groupBy(comfort_level().alias("comfort_level"))
        .agg(rows().alias("record_count"))
    )
    month_total = classes.agg(
        F.sum("record_count").alias("total"),
        F.collect_list(F.struct("comfort_level", "record_count")).alias("classes"),
    )
    return month_total.select("total", F.inline("classes")).select(
        "comfort_level",
        "record_count",
        percentage(F.col("record_count"), F.col("total")).alias("percentage"),
    )
