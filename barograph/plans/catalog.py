"""Every report and operator by name, on readings derived from the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.operators import daily, ingest, loading, quality, select_rows, summaries, views
from barograph.plans import imports
from barograph.session import WorkArea
from barograph.sources.events import (
    loaded_and_incoming,
    names_from_readings,
    raw_rows_from_readings,
    readings_from_events,
    workbooks_from_readings,
)
from barograph.sources.filenames import file_year_month
from barograph.sources.tables import SensorTables

YEAR, MONTH = 2024, 1

Query = Callable[[SparkSession, str], DataFrame]

OF_A_MONTH = [
    select_rows.month_rows,
    select_rows.month_all_rows,
    select_rows.hour_band_rows,
    select_rows.hottest_rows,
    select_rows.coldest_rows,
    select_rows.over_temperature,
    select_rows.over_humidity,
    select_rows.high_uv,
    select_rows.missing_rows,
    select_rows.export_month,
    summaries.daily_averages,
    summaries.daily_extremes,
    summaries.daily_trend,
    summaries.uv_daily,
    summaries.lux_daily,
    summaries.export_daily,
    summaries.monthly_summary,
    summaries.hourly_temperature,
    summaries.day_night,
    summaries.weekday_weekend,
    summaries.temp_humidity_histogram,
    summaries.comfort_levels,
    quality.completeness_month,
    quality.device_temp_sample,
]

OF_ALL_READINGS = [
    select_rows.latest_rows,
    select_rows.all_rows,
    select_rows.with_device_temp,
    summaries.total_records,
    summaries.records_by_month,
    quality.completeness_all,
    quality.verify_months,
    quality.verify_months_ch5,
    quality.import_month_report,
    quality.climate_range,
    quality.uv_coverage,
    quality.device_temp_months,
    quality.device_temp_quality,
    daily.daily_statistics_groups,
    daily.daily_statistics,
    views.complete_view,
    loading.existing_months,
]


def comparable(result: DataFrame) -> DataFrame:
    """Decimals as doubles, so that engines with different decimal rules agree on types."""
    return result.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f"`{f.name}`"
            for f in result.schema
        ]
    )


def staged_layouts(spark: SparkSession, raw_rows: DataFrame) -> DataFrame:
    """One row per file, staged as in an import, so that the joins know its size."""
    area = WorkArea(spark)
    tops = area.stage(ingest.sheet_tops(raw_rows), "tops")
    return area.stage(ingest.sheet_layouts(tops, ingest.header_roles(raw_rows, tops)), "layouts")


def classified_samples(spark: SparkSession, raw_rows: DataFrame) -> DataFrame:
    return ingest.classify_samples(raw_rows, staged_layouts(spark, raw_rows))


def data_region(spark: SparkSession, readings: DataFrame) -> DataFrame:
    return ingest.data_region(workbooks_from_readings(spark, readings))


def header_roles(spark: SparkSession, readings: DataFrame) -> DataFrame:
    raw_rows = workbooks_from_readings(spark, readings)
    tops = WorkArea(spark).stage(ingest.sheet_tops(raw_rows), "tops")
    return ingest.header_roles(raw_rows, tops)


def first_files(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """The workbook that each month takes, and its samples, if a month takes one only."""
    raw_rows = workbooks_from_readings(spark, readings)
    layouts = staged_layouts(spark, raw_rows)
    counts = WorkArea(spark).stage(ingest.sample_counts(ingest.classify_samples(raw_rows, layouts)), "counts")
    first = loading.first_files(loading.files_with_samples(layouts, counts))
    return first.join(counts.select("file", "parsed"), "file").select("year", "month", "file", "parsed")


def numbered_samples(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """Ids of the samples of many workbooks."""
    area = WorkArea(spark)
    samples = classified_samples(spark, workbooks_from_readings(spark, readings))
    samples = area.stage(ingest.decode_samples(samples).select("file", "sheet_row", "year", "month"), "samples")
    return loading.number_readings(samples, loading.id_offsets(area, samples), 100).select("file", "sheet_row", "id")


def decode_samples(spark: SparkSession, readings: DataFrame) -> DataFrame:
    return ingest.decode_samples(classified_samples(spark, raw_rows_from_readings(spark, readings)))


def rejects(spark: SparkSession, readings: DataFrame) -> DataFrame:
    return ingest.rejects(classified_samples(spark, raw_rows_from_readings(spark, readings)))


def import_summary(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """An import that skips the months already loaded: whole files, so their counts are enough."""
    raw_rows = WorkArea(spark).stage(raw_rows_from_readings(spark, readings), "raw_rows")
    layouts = staged_layouts(spark, raw_rows)
    counts = ingest.sample_counts(ingest.classify_samples(raw_rows, layouts))
    loaded, _ = loaded_and_incoming(readings)
    new = loading.in_new_months(loaded, layouts.select("file", "year", "month")).select("file", F.lit(True).alias("new"))
    counts = counts.join(new, "file", "left").withColumn("inserted", F.when(F.col("new"), F.col("parsed")).otherwise(0))
    return loading.import_summary(layouts, counts.drop("new", "inserted"), counts.select("file", "inserted"))


def rebuild(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """Worksheet rows to daily statistics."""
    return daily.daily_statistics(decode_samples(spark, readings))


def names(_: SparkSession, readings: DataFrame) -> DataFrame:
    return file_year_month(names_from_readings(readings)).select("id", "file", "year", "month")


def file_status(_: SparkSession, readings: DataFrame) -> DataFrame:
    loaded, _incoming = loaded_and_incoming(readings)
    files = names_from_readings(readings).select("file").distinct()
    return loading.file_status(files, loaded)


def daily_upsert(_: SparkSession, readings: DataFrame) -> DataFrame:
    """A first run on the loaded rows, a second one on the delivery."""
    loaded, incoming = loaded_and_incoming(readings)
    first_run = daily.daily_statistics(loaded).select(
        F.unix_date("date").alias("id"),
        "*",
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
    )
    second_run = daily.upsert_daily(first_run, daily.daily_statistics(incoming))
    return second_run.drop("id", "created_at", "updated_at")


def daily_of_loads(_: SparkSession, readings: DataFrame) -> DataFrame:
    """The statistics of two loads from the partials of each."""
    loaded, incoming = loaded_and_incoming(readings)
    return daily.statistics_of_partials(daily.daily_partials(loaded).unionByName(daily.daily_partials(incoming)))


def stored(spark: SparkSession, *loads: DataFrame) -> SensorTables:
    """Tables that hold the given readings, a load each, for as long as the driver runs."""
    tables = SensorTables(spark, f"{WorkArea(spark).path}/tables")
    for load in loads:
        tables.append_readings(load)
    return tables


def dedupe_stored(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """``load_dedupe`` against stored tables: the loaded side is read by its bucketed keys."""
    loaded, incoming = loaded_and_incoming(readings)
    keys, buckets = stored(spark, loaded).sample_keys()
    return loaded.unionByName(loading.in_new_samples(keys, incoming, ["id"], buckets))


def latest_stored(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """The latest rows of two loads, read from the end."""
    return imports.latest_rows(stored(spark, *loaded_and_incoming(readings))).select(readings.columns)


def with_load(mode) -> Callable[[SparkSession, DataFrame], DataFrame]:
    return lambda _, readings: mode(*loaded_and_incoming(readings))


ON_READINGS: dict[str, Callable[[SparkSession, DataFrame], DataFrame]] = {
    **{f.__name__: (lambda _, r, f=f: f(r, YEAR, MONTH)) for f in OF_A_MONTH},
    **{f.__name__: (lambda _, r, f=f: f(r)) for f in OF_ALL_READINGS},
    "daily_statistics_merged": lambda _, r: daily.daily_statistics(r, "merge"),
    "daily_statistics_upsert": daily_upsert,
    "daily_statistics_of_loads": daily_of_loads,
    "daily_recent": lambda _, r: daily.daily_recent(daily.daily_statistics(r)),
    "daily_month": lambda _, r: daily.daily_month(daily.daily_statistics(r), YEAR, MONTH),
    "daily_temp_trend": lambda _, r: daily.daily_temp_trend(daily.daily_statistics(r), YEAR, MONTH),
    "view_latest": lambda _, r: views.view_latest(views.complete_view(r), YEAR, MONTH),
    "view_month_rows": lambda _, r: views.view_month_rows(views.complete_view(r), YEAR, MONTH),
    "load_append": with_load(loading.load_append),
    "load_skip_existing": with_load(loading.load_skip_existing),
    "load_dedupe": with_load(lambda loaded, incoming: loading.load_dedupe(loaded, incoming, ["id"])),
    "load_dedupe_stored": dedupe_stored,
    "latest_rows_stored": latest_stored,
    "load_replace_month": with_load(loading.load_replace_month),
    "file_year_month": names,
    "file_status": file_status,
    "data_region": data_region,
    "header_roles": header_roles,
    "load_first_files": first_files,
    "number_readings": numbered_samples,
    "decode_samples": decode_samples,
    "rejects": rejects,
    "import_summary": import_summary,
    "rebuild": rebuild,
}


def on_events(operator: Callable[[SparkSession, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(operator(spark, readings_from_events(spark, sf_dir)))


QUERIES: dict[str, Query] = {name: on_events(operator) for name, operator in ON_READINGS.items()}
