"""Load modes: which incoming samples a table takes, and what it holds afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barograph import fixed
from barograph.operators.prefix import prefix_sums
from barograph.schema import MONTH_KEYS, SAMPLE_KEYS
from barograph.session import WorkArea
from barograph.sources.filenames import file_year_month


def existing_months(readings: DataFrame) -> DataFrame:
    """The file months that have at least one row.

    This reads every row of a frame; a stored table answers from its ledger, see
    ``SensorTables.months``.
    """
    return readings.select(*MONTH_KEYS).distinct()


def month_list(readings: DataFrame) -> DataFrame:
    """The file months as a broadcast side of proven size.

    Two year digits and two month digits make at most 100 x 99 pairs; a row outside that
    range fails the query rather than enlarge the list. Joining on a month without the
    broadcast would send a whole month, perhaps a third of all rows, to one task.
    """
    in_range = F.col("year").between(fixed.CENTURY, fixed.CENTURY + 99) & F.col("month").between(1, 99)
    checked = F.when(in_range, F.col("year")).otherwise(F.raise_error(F.lit("file month out of range")))
    return F.broadcast(readings.select(checked.alias("year"), "month").distinct())


def in_new_months(loaded: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows of months that are not loaded yet."""
    return incoming.join(month_list(loaded), MONTH_KEYS, "left_anti")


def files_with_samples(layouts: DataFrame, counts: DataFrame) -> DataFrame:
    """The readable files with at least one accepted sample."""
    readable = layouts.where(F.col("problem").isNull())
    return readable.join(counts.where(F.col("parsed") > 0).select("file"), "file", "left_semi")


def first_files(files: DataFrame) -> DataFrame:
    """The first file, in path order, of each month."""
    return files.groupBy(*MONTH_KEYS).agg(F.min("file").alias("file"))


def in_new_samples(loaded: DataFrame, incoming: DataFrame, order: list[str], buckets: int | None = None) -> DataFrame:
    """Incoming rows whose (year, month, record_time) is new, the first of each in `order`.

    Repeats are dropped before the shuffle on both sides: the row number limit keeps one
    row per key and map task, and the loaded keys are made distinct, so that no key is
    hot by the time the join sees it. Of the loaded table only the incoming months are
    read. Where ``loaded`` is stored in ``buckets`` by key, the first of each key goes to
    those buckets, and the loaded rows are not shuffled.
    """
    by_key = Window.partitionBy(*SAMPLE_KEYS).orderBy(*order)
    first = incoming.withColumn("copy", F.row_number().over(by_key)).where(F.col("copy") == 1).drop("copy")
    concerned = loaded.join(month_list(incoming), MONTH_KEYS, "left_semi").select(*SAMPLE_KEYS).distinct()
    if not buckets:
        return first.join(concerned, SAMPLE_KEYS, "left_anti").select(*incoming.columns)
    # An anti join would be moved below the repartition, and then be shuffled on both sides.
    known = concerned.withColumn("known", F.lit(True))
    placed = first.repartition(buckets, *SAMPLE_KEYS).join(known, SAMPLE_KEYS, "left")
    return placed.where(F.col("known").isNull()).select(*incoming.columns)


def load_append(loaded: DataFrame, incoming: DataFrame) -> DataFrame:
    """Everything is kept: loading a month twice doubles it."""
    return loaded.unionByName(incoming)


def load_skip_existing(loaded: DataFrame, incoming: DataFrame) -> DataFrame:
    return loaded.unionByName(in_new_months(loaded, incoming).select(*loaded.columns))


def load_dedupe(loaded: DataFrame, incoming: DataFrame, order: list[str]) -> DataFrame:
    return loaded.unionByName(in_new_samples(loaded, incoming, order))


def load_replace_month(loaded: DataFrame, incoming: DataFrame) -> DataFrame:
    """Months that arrive take the place of those months; others stay as they are."""
    kept = loaded.join(month_list(incoming), MONTH_KEYS, "left_anti").select(*loaded.columns)
    return kept.unionByName(incoming)


def file_status(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files with their month and whether that month is loaded; no month means not loaded."""
    months = month_list(loaded).withColumn("loaded", F.lit(True))
    listed = file_year_month(files.select("file")).join(months, MONTH_KEYS, "left")
    return listed.select("file", "year", "month", F.coalesce("loaded", F.lit(False)).alias("already_loaded"))


def import_summary(layouts: DataFrame, counts: DataFrame, taken: DataFrame) -> DataFrame:
    """Parsed, inserted and skipped samples per file, with the reason a file gave none.

    `counts` comes from the decoded rows and `taken` (file, inserted) from the load mode.
    """
    per_file = layouts.select("file", "year", "month", "problem").join(counts, "file", "left")
    per_file = per_file.join(taken, "file", "left").fillna(0, ["parsed", "rejected", "blank", "inserted"])
    return per_file.select(
        "file",
        "year",
        "month",
        "parsed",
        "rejected",
        "blank",
        "inserted",
        (F.col("parsed") - F.col("inserted")).alias("skipped"),
        "problem",
    )


def id_offsets(area: WorkArea, samples: DataFrame) -> DataFrame:
    """Per file: its lowest worksheet row, how many ids its rows span, and how many come before.

    One row per file and task is shuffled, no samples; the running sum over the files, in
    order of file month and name, goes range by range.
    """
    rows = (F.max("sheet_row") - F.min("sheet_row") + 1).alias("span")
    per_file = samples.groupBy(*MONTH_KEYS, "file").agg(F.min("sheet_row").alias("lowest"), rows)
    order = [F.col(c).asc_nulls_last() for c in (*MONTH_KEYS, "file")]
    placed = prefix_sums(area, per_file, [], order, "span", "offsets")
    return area.stage(placed.select("file", "lowest", "span", F.col("_before").alias("offset")), "ids")


def number_readings(samples: DataFrame, offsets: DataFrame, last_id: int) -> DataFrame:
    """Add `id`, rising in load order: file month, file, worksheet row.

    A sample's place in its file is its worksheet row, so rows that were refused leave gaps and
    no window over the samples is needed.
    """
    numbered = samples.join(offsets.select("file", "lowest", "offset"), "file")
    place = F.col("sheet_row") - F.col("lowest") + 1
    return numbered.withColumn("id", F.lit(last_id) + F.col("offset") + place).drop("lowest", "offset")
