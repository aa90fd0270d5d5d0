"""The daily statistics table: grouping, same-date collisions, upsert and its reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.functions.calendar import sample_date
from barograph.functions.measures import highest, hundredths, lowest, mean, mean_of, rows, spread
from barograph.operators.select_rows import in_month
from barograph.schema import CHANNEL, DAILY, DEVICE_TEMP, HUMIDITY, PARTIAL_OF, PARTIALS, STATISTIC, STATISTICS, TEMPERATURE

MEASURES = [*STATISTICS, "record_count"]
FIRST_SEEN = ["year", "month", "day"]


def measures():
    by_name = {
        "avg_temperature": mean(TEMPERATURE, 2),
        "avg_humidity": mean(HUMIDITY, 2),
        "avg_device_temp": mean(DEVICE_TEMP, 2),
        "max_temperature": highest(TEMPERATURE),
        "max_humidity": highest(HUMIDITY),
        "min_temperature": lowest(TEMPERATURE),
        "min_humidity": lowest(HUMIDITY),
        "temperature_delta": spread(TEMPERATURE),
        "humidity_delta": spread(HUMIDITY),
    }
    return [*[by_name[n].cast(STATISTIC).alias(n) for n in STATISTICS], rows().alias("record_count")]


def daily_partials(readings: DataFrame) -> DataFrame:
    """Sums of hundredths, counts and extremes per date and file month.

    Those of several loads give the statistics of all their rows, exactly, so a load is read for them once.
    """
    parts = []
    for name, channel in PARTIAL_OF.items():
        parts += [
            F.sum(hundredths(channel)).alias(f"{name}_total"),
            F.count(channel).alias(f"{name}_count"),
            highest(channel).alias(f"{name}_max"),
            lowest(channel).alias(f"{name}_min"),
        ]
    groups = readings.groupBy(sample_date().alias("date"), "year", "month").agg(*parts, rows().alias("record_count"))
    return groups.select(PARTIALS.names)


def measures_of_partials():
    by_name = {}
    for name in PARTIAL_OF:
        by_name[f"avg_{name}"] = mean_of(F.sum(f"{name}_total"), F.sum(f"{name}_count"), 2)
        by_name[f"max_{name}"] = highest(f"{name}_max")
        by_name[f"min_{name}"] = lowest(f"{name}_min")
        by_name[f"{name}_delta"] = (F.max(f"{name}_max") - F.min(f"{name}_min")).cast(CHANNEL)
    return [*[by_name[n].cast(STATISTIC).alias(n) for n in STATISTICS], F.sum("record_count").alias("record_count")]


def daily_statistics_groups(readings: DataFrame) -> DataFrame:
    """One row per date and file month; a date can occur in more than one file."""
    groups = readings.groupBy(sample_date().alias("date"), "year", "month").agg(*measures())
    return groups.select("date", "year", "month", F.dayofmonth("date").alias("day"), *MEASURES)


def daily_statistics(readings: DataFrame, collision: str = "last_file") -> DataFrame:
    """One row per date.

    ``last_file``: where a date occurs in several file months, the statistics are those of
    the latest file month alone, while year and month stay those of the earliest, as
    repeated upserts in file order leave them. ``merge``: statistics over all rows of the
    date.
    """
    return by_date(readings.withColumn("date", sample_date()), measures(), collision)


def statistics_of_partials(partials: DataFrame, collision: str = "last_file") -> DataFrame:
    """``daily_statistics`` of the readings that the partials stand for."""
    return by_date(partials, measures_of_partials(), collision)


def by_date(parts: DataFrame, measured: list[Column], collision: str) -> DataFrame:
    file_month = F.col("year") * 100 + F.col("month")
    if collision == "merge":
        merged = parts.groupBy("date").agg(F.min(file_month).alias("first_month"), *measured)
    elif collision == "last_file":
        # A second aggregate over the few rows per date that the first one leaves.
        merged = (
            parts.groupBy("date", "year", "month")
            .agg(*measured)
            .groupBy("date")
            .agg(
                F.min(file_month).alias("first_month"),
                F.max_by(F.struct(*MEASURES), file_month).alias("last"),
            )
            .select("date", "first_month", "last.*")
        )
    else:
        raise ValueError(f"unknown collision rule: {collision}")
    return merged.select(
        "date",
        F.floor(F.col("first_month") / 100).cast("int").alias("year"),
        (F.col("first_month") % 100).alias("month"),
        F.dayofmonth("date").alias("day"),
        *MEASURES,
    )


def upsert_daily(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """`existing` after inserting new dates and updating the measures of known ones.

    Year, month and day of a known date are left alone, dates missing from `fresh` stay,
    and `updated_at` moves only where a measure changed. The key of a row is its day
    number, which needs no running counter.
    """
    old, new = existing.alias("old"), fresh.alias("new")
    is_new = F.col("old.date").isNull()
    is_fresh = F.col("new.date").isNotNull()
    changed = F.lit(False)
    for name in MEASURES:
        changed = changed | ~F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    now = F.current_timestamp()
    date = F.coalesce("old.date", "new.date")
    columns = {
        "id": F.coalesce("old.id", F.unix_date(date)),
        "date": date,
        **{n: F.coalesce(f"old.{n}", f"new.{n}") for n in FIRST_SEEN},
        **{n: F.when(is_fresh, F.col(f"new.{n}")).otherwise(F.col(f"old.{n}")) for n in MEASURES},
        "created_at": F.when(is_new, now).otherwise(F.col("old.created_at")),
        "updated_at": F.when(is_new | (is_fresh & changed), now).otherwise(F.col("old.updated_at")),
    }
    joined = old.join(new, F.col("old.date") == F.col("new.date"), "full_outer")
    return joined.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in DAILY])


def daily_recent(daily: DataFrame, limit: int = 10) -> DataFrame:
    return (
        daily.orderBy(F.desc("date"))
        .limit(limit)
        .select(
            "date",
            "avg_temperature",
            "avg_humidity",
            "avg_device_temp",
            "max_temperature",
            "min_temperature",
            "temperature_delta",
            "humidity_delta",
            "record_count",
        )
    )


def daily_month(daily: DataFrame, year: int, month: int, newest_first: bool = True) -> DataFrame:
    rows_of_month = in_month(daily, year, month)
    return rows_of_month.orderBy(F.desc("date")) if newest_first else rows_of_month


def daily_temp_trend(daily: DataFrame, year: int, month: int) -> DataFrame:
    shown = ["date", "avg_temperature", "max_temperature", "min_temperature"]
    return in_month(daily, year, month).select(*shown).orderBy("date")
