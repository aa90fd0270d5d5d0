"""Imports from a folder of workbooks into the stored tables, end to end."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barograph.operators import daily, ingest, loading, select_rows
from barograph.schema import MONTH_KEYS
from barograph.session import WorkArea, work_area
from barograph.sources.filenames import month_in_name
from barograph.sources.tables import SensorTables
from barograph.sources.workbooks import list_workbooks, scan_files, scan_workbooks, workbook_files

MODES = ("append", "skip_existing", "dedupe", "replace", "rebuild")
MONTH_LIMIT = 9_900
ALREADY_LOADED = "month already loaded"


def read_samples(area: WorkArea, raw_rows: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(layouts, classified samples) of worksheet rows, both staged.

    The rows are written once, since every workbook is costly to open and they are read
    several times: the marker search reads the flat columns, the unit rows come from a join
    on one row per file, and only the decoding reads the samples whole.
    """
    staged = area.stage(raw_rows, "raw_rows")
    tops = area.stage(ingest.sheet_tops(staged), "tops")
    roles = ingest.header_roles(staged, tops)
    layouts = area.stage(ingest.sheet_layouts(tops, roles, strict), "layouts")
    return layouts, area.stage(ingest.classify_samples(staged, layouts), "classified")


def months_in(df: DataFrame) -> list[tuple[int, int]]:
    """The distinct file months as values; four digits allow 9,900 of them."""
    found = df.select(*MONTH_KEYS).distinct().limit(MONTH_LIMIT + 1).collect()
    if len(found) > MONTH_LIMIT:
        raise ValueError("more file months than a file name can tell apart")
    return [(r["year"], r["month"]) for r in found]


def only_months(readings: DataFrame, months: Iterable[tuple[int, int]]) -> DataFrame:
    """Rows of the given months, as literal predicates that prune partitions."""
    by_year: dict[int, list[int]] = {}
    for year, month in months:
        by_year.setdefault(year, []).append(month)
    wanted = F.lit(False)
    for year, in_year in by_year.items():
        wanted = wanted | ((F.col("year") == year) & F.col("month").isin(in_year))
    return readings.where(wanted)


def admit(
    area: WorkArea,
    tables: SensorTables,
    layouts: DataFrame,
    samples: DataFrame,
    mode: str,
    arrivals: DataFrame | None = None,
) -> DataFrame:
    """The samples that the load mode lets in."""
    if mode not in ("skip_existing", "dedupe"):
        return samples
    incoming = months_in(layouts.where(F.col("problem").isNull()))
    if mode == "skip_existing":
        return only_months(samples, set(incoming) - set(tables.months()))
    keys, buckets = tables.sample_keys()
    concerned = only_months(keys, incoming)
    order = ["file", "sheet_row"]
    if arrivals is not None:
        samples, order = samples.join(area.stage(arrivals, "arrivals"), "file"), ["arrived", *order]
    return area.stage(loading.in_new_samples(concerned, samples, order, buckets).drop("arrived"), "admitted")


def load_raw_rows(
    tables: SensorTables,
    raw_rows: DataFrame,
    mode: str = "skip_existing",
    first_file_per_month_only: bool = False,
    strict: bool = False,
    refresh_stats: bool = False,
    left_out: DataFrame | None = None,
    arrivals: DataFrame | None = None,
) -> DataFrame:
    """Decode worksheet rows, store what the mode admits and return the import summary.

    ``append`` keeps everything, also repeats. ``skip_existing`` takes months that are not
    loaded yet. ``dedupe`` takes samples whose (year, month, record_time) is new, of repeats
    the one of the first file by name, or by ``arrivals`` (file, arrived). ``replace``
    overwrites the months that arrive, ``rebuild`` the whole table. All files are stored by
    one job, so a failure stores none. With ``first_file_per_month_only``, a month takes its
    first file that has any sample. ``left_out`` (file, year, month, problem) are files that
    were not read; they are named in the summary.
    """
    if mode not in MODES:
        raise ValueError(f"unknown load mode: {mode}")
    with work_area(tables.spark) as area:
        layouts, classified = read_samples(area, raw_rows, strict)
        samples = ingest.decode_samples(classified)
        counts = area.stage(ingest.sample_counts(classified), "counts")
        if first_file_per_month_only:
            first = loading.first_files(loading.files_with_samples(layouts, counts))
            samples = samples.join(area.stage(first, "first").select("file"), "file", "left_semi")
        admitted = admit(area, tables, layouts, samples, mode, arrivals)
        per_file = admitted.groupBy("file").agg(
            F.count(F.lit(1)).alias("inserted"),
            F.min("record_time").alias("first_time"),
            F.max("record_time").alias("last_time"),
        )
        taken = area.stage(per_file, "taken")
        total = taken.agg(
            F.coalesce(F.sum("inserted"), F.lit(0)).alias("rows"),
            F.to_date(F.min("first_time")).alias("first_date"),
            F.to_date(F.max("last_time")).alias("last_date"),
        ).first()

        offsets = loading.id_offsets(area, admitted)
        ids = offsets.agg(F.coalesce(F.sum("span"), F.lit(0))).first()[0]
        if mode == "rebuild":
            tables.replace_readings(loading.number_readings(admitted, offsets, 0), ids)
        elif total["rows"]:
            numbered = loading.number_readings(admitted, offsets, tables.reserve_ids(ids))
            store = tables.replace_months if mode == "replace" else tables.append_readings
            store(numbered)
        if refresh_stats and total["rows"]:
            whole = mode in ("replace", "rebuild")
            refresh_daily(tables, *([] if whole else [total["first_date"], total["last_date"]]))

        if left_out is not None:
            layouts = layouts.unionByName(left_out, allowMissingColumns=True)
        summary = loading.import_summary(layouts, counts, taken.select("file", "inserted"))
        number = tables.record_import(summary, ingest.rejects(classified))
    return tables.import_summary(number).orderBy("file")


def refresh_daily(tables: SensorTables, first_date=None, last_date=None, collision: str = "last_file") -> None:
    """Upsert the daily statistics, of all dates or of a range.

    They are put together from the partials that every load has written, a row per date and
    file month; no readings are read. A range takes all file months of its dates, so that
    same-date collisions come out as in a full run.
    """
    partials = tables.daily_partials()
    if first_date is not None:
        partials = partials.where(F.col("date") >= F.lit(first_date))
    if last_date is not None:
        partials = partials.where(F.col("date") <= F.lit(last_date))
    fresh = daily.statistics_of_partials(partials, collision)
    tables.replace_daily(daily.upsert_daily(tables.daily_statistics(), fresh))


def latest_readings(tables: SensorTables, limit: int = 10) -> DataFrame:
    """The readings of the last dates that hold ``limit`` rows between them, whole; the latest ``limit`` are among them.

    The partials of the loads tell how many rows each date and file month has, so no other month is opened and, files
    being sorted by time, little of those months. A table that holds fewer rows is read whole, as are rows without a time. One
    task sums the rows of dates, of which a calendar has few.
    """
    per_date = tables.daily_partials().groupBy("date").agg(F.sum("record_count").alias("rows"))
    later = Window.orderBy(F.desc_nulls_last("date")).rowsBetween(Window.unboundedPreceding, -1)
    needed = per_date.withColumn("later", F.coalesce(F.sum("rows").over(later), F.lit(0))).where(F.col("later") < limit)
    first, rows, undated = needed.agg(F.min("date"), F.sum("rows"), F.count_if(F.col("date").isNull())).first()
    if undated or (rows or 0) < limit:
        return tables.readings()
    months = months_in(tables.daily_partials().where(F.col("date") >= F.lit(first)))
    return only_months(tables.readings(), months).where(F.col("record_time") >= F.lit(first).cast("timestamp_ntz"))


def latest_rows(tables: SensorTables, limit: int = 10) -> DataFrame:
    """``select_rows.latest_rows`` of the stored readings, read from the end."""
    return select_rows.latest_rows(latest_readings(tables, limit), limit)


def import_all(tables: SensorTables, folder: str, refresh_stats: bool = False) -> DataFrame:
    """Append every workbook of a folder."""
    tables.create()
    return load_raw_rows(tables, scan_workbooks(tables.spark, folder), "append", refresh_stats=refresh_stats)


def list_files(tables: SensorTables, folder: str) -> DataFrame:
    """The folder's workbooks with their month and whether that month is loaded."""
    return loading.file_status(list_workbooks(tables.spark, folder), tables.month_frame()).orderBy("file")


def new_and_others(tables: SensorTables, folder: str) -> tuple[DataFrame, DataFrame]:
    """The workbooks of months that are not loaded, as binary files; the others (file, year, month, problem).

    One listing serves both. The months that are loaded, at most ``MONTH_LIMIT``, are a condition on the name, which Spark
    holds against the listing when it plans the scan; names are neither collected nor passed on.
    """
    files = workbook_files(tables.spark, folder)
    year, month, problem = month_in_name(F.col("_metadata.file_name"))
    loaded = (year * 100 + month).isin([y * 100 + m for y, m in tables.months()])
    new = F.coalesce(problem.isNull() & ~loaded, F.lit(False))
    reason = F.coalesce(problem, F.lit(ALREADY_LOADED)).alias("problem")
    others = files.where(~new).select(F.col("path").alias("file"), year.alias("year"), month.alias("month"), reason)
    return files.where(new), others


def import_new(
    tables: SensorTables, folder: str, first_file_per_month_only: bool = False, refresh_stats: bool = False
) -> DataFrame:
    """Import the workbooks of months that are not loaded.

    Exactly the files listed as new are opened; the summary names the others too, with the
    reason why they were left out. With ``first_file_per_month_only``, a second workbook of a
    new month gives nothing, as its month is loaded by then.
    """
    tables.create()
    new, left_out = new_and_others(tables, folder)
    return load_raw_rows(
        tables,
        scan_files(new),
        "skip_existing",
        first_file_per_month_only,
        refresh_stats=refresh_stats,
        left_out=left_out,
    )


def import_selected(
    tables: SensorTables,
    folder: str,
    positions: list[int],
    on_existing: str = "skip_existing",
    refresh_stats: bool = False,
    first_file_per_month_only: bool | None = None,
) -> tuple[DataFrame | None, list[int]]:
    """Import the workbooks at the given 1-based positions of the sorted listing.

    Positions outside the listing are returned; the others are imported all the same, each
    once. Where months that are loaded are skipped, a month is loaded after its first chosen
    workbook that has samples, so the others of that month give nothing, unless
    ``first_file_per_month_only`` is False.
    """
    tables.create()
    chosen = sorted(set(positions))
    listing = list_workbooks(tables.spark, folder).orderBy("file").limit(max(0, *chosen, 0))
    names = [row["file"] for row in listing.collect()]
    invalid = [p for p in positions if not 1 <= p <= len(names)]
    found = [names[p - 1] for p in chosen if 1 <= p <= len(names)]
    if not found:
        return None, invalid
    if first_file_per_month_only is None:
        first_file_per_month_only = on_existing == "skip_existing"
    raw_rows = scan_workbooks(tables.spark, found)
    return load_raw_rows(tables, raw_rows, on_existing, first_file_per_month_only, refresh_stats=refresh_stats), invalid


def of_months(year: Column, month: Column, months: Iterable[tuple[int, int]]) -> Column:
    """Whether a month is one of the given; at most ``MONTH_LIMIT`` literals, which a listing can be held against."""
    return F.coalesce((year * 100 + month).isin([y * 100 + m for y, m in months]), F.lit(False))


def import_changed(tables: SensorTables, folder: str, refresh_stats: bool = True) -> DataFrame | None:
    """Bring the stored months up to date with a folder whose workbooks are corrected in place.

    A workbook is opened if its time or size differs from when it was last seen here, or if another one of its file month
    does. Months in which a workbook is new, gone or has another content (by SHA-256) are replaced by what their workbooks
    hold now; the import summary is returned, or None where nothing has changed. Workbooks that were only touched are
    remembered with their new time and give no load.

    Cases: the first run takes in every month, also those that another import has loaded; a month keeps its readings where all
    its workbooks are gone, or none of them has a sample; a workbook that cannot be read is named in the summary and opened
    again when it changes; names without a month are passed over. A run that breaks off is repeated by the next one, to
    the same result.
    """
    tables.create()
    files = workbook_files(tables.spark, folder)
    year, month, problem = month_in_name(F.col("_metadata.file_name"))
    seen = [
        F.col("path").alias("file"),
        year.alias("year"),
        month.alias("month"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("size"),
    ]
    with work_area(tables.spark) as area:
        known = tables.taken_in()
        listed = area.stage(files.where(problem.isNull()).select(*seen), "listed")
        altered = listed.join(known, ["file", "modified", "size"], "left_anti").select(*MONTH_KEYS)
        gone = known.join(listed, "file", "left_anti").join(loading.month_list(listed), MONTH_KEYS, "left_semi")
        suspect = months_in(altered.union(gone.select(*MONTH_KEYS)))
        if not suspect:
            return None
        opened = files.where(of_months(year, month, suspect))
        prints = area.stage(opened.select(*seen, F.sha2("content", 256).alias("fingerprint")), "prints")
        other = prints.join(known, ["file", "fingerprint"], "left_anti").select(*MONTH_KEYS)
        changed = months_in(other.union(gone.select(*MONTH_KEYS)))
        summary = None
        if changed:
            raw_rows = scan_files(files.where(of_months(year, month, changed)))
            summary = load_raw_rows(tables, raw_rows, "replace", refresh_stats=refresh_stats)
        rest = known.where(~of_months(F.col("year"), F.col("month"), suspect))
        tables.replace_taken_in(rest.unionByName(prints))
    return summary


def rebuild(tables: SensorTables, folder: str) -> DataFrame:
    """Load a folder from scratch and bring the statistics up to date.

    The new readings are stored beside the old ones and take their place once complete,
    so a failed rebuild leaves the table as it was.
    """
    tables.create()
    return load_raw_rows(tables, scan_workbooks(tables.spark, folder), "rebuild", refresh_stats=True)
