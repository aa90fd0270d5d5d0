"""Worksheet rows to typed samples.

Three steps on a `raw_rows` frame: find each file's data region, read the channel
positions off its unit row, and decode the rows below. The results of the first two hold
one row per file; callers stage them (`WorkArea.stage`), so that the joins here are
broadcast exactly when their true size allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph import fixed
from barograph.functions.cells import channel_value, present, sample_time
from barograph.schema import CHANNELS, UNREADABLE
from barograph.sources.filenames import file_year_month

ACCEPTED = "accepted"
BLANK_TIME = "blank time"
BAD_TIME = "time not readable"
BAD_CHANNEL = "channel not a number in range"

DEEP_FILES = 16

POSITIONS = [f"ch{i}_pos" for i in range(1, len(CHANNELS) + 1)]


def sheet_tops(raw_rows: DataFrame) -> DataFrame:
    """Per file: marker row, unit row and first sample row, NULL without a marker, and the
    error of a workbook that could not be read. One pass over the narrow columns."""
    lead, row = F.col("lead"), F.col("sheet_row")
    tops = raw_rows.groupBy("file").agg(
        F.min(F.when(lead == fixed.DATA_MARKER, row)).alias("marker_row"),
        F.max(F.when(row == UNREADABLE, lead)).alias("error"),
    )
    return tops.select(
        "file",
        "marker_row",
        (F.col("marker_row") + fixed.UNITS_AFTER_MARKER).alias("unit_row"),
        (F.col("marker_row") + fixed.SAMPLES_AFTER_MARKER).alias("first_sample_row"),
        "error",
    )


def data_region(raw_rows: DataFrame) -> DataFrame:
    """Marker row, unit row and first sample row per file that has a marker."""
    return sheet_tops(raw_rows).where(F.col("marker_row").isNotNull()).drop("error")


# Names of the columns under a header row, as pandas would give them: a blank header becomes
# `Unnamed: <position>`, and the k-th repeat of a name takes the k-th suffix `.1`, `.2`, … that
# no header already spells out. Worked out inside the row: a header row holds some tens of cells.
HEADER_TEXTS = f"transform(cells, (c, i) -> coalesce(nullif(c, ''), concat('{fixed.BLANK_HEADER}: ', i))) AS texts"
HEADER_NAMES = """
transform(texts, (t, i) ->
  CASE WHEN array_contains(slice(texts, 1, i), t)
       THEN concat(t, '.', get(
         filter(sequence(1, 2 * size(texts)), s -> NOT array_contains(texts, concat(t, '.', s))),
         size(filter(slice(texts, 1, i), earlier -> earlier = t)) - 1))
       ELSE t END) AS names"""


def names_one_of(words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(name), '{word}')" for word in words) + ")"


IS_REPEAT = f"contains(name, '{fixed.FIRST_REPEAT}')"
BARE_NAME = r"trim(BOTH ' \t\r\n' FROM name)"
COUNTERS = ", ".join(f"'{name}'" for name in fixed.COUNTER_HEADERS)
KIND = f"""
CASE WHEN {names_one_of(fixed.TIME_HEADERS)} THEN 'time'
     WHEN {BARE_NAME} IN ({COUNTERS}) OR startswith({BARE_NAME}, '{fixed.BLANK_HEADER}') THEN 'none'
     WHEN {names_one_of(fixed.TEMPERATURE_UNITS)} THEN 'temperature'
     ELSE 'other' END AS kind"""
FIRST_TEMPERATURE = f"min(if(kind = 'temperature' AND NOT {IS_REPEAT}, pos, NULL)) OVER (PARTITION BY file) AS first"
TEMPERATURES = "count_if(kind = 'temperature') OVER (PARTITION BY file) AS temperatures"
REPEATED_TEMPERATURE = [unit + fixed.FIRST_REPEAT for unit in fixed.TEMPERATURE_UNITS]
# Position of a column in the result: 0 is the time, 1 to 5 are the channels.
ROLE = f"""
CASE kind
  WHEN 'none' THEN NULL
  WHEN 'time' THEN 0
  ELSE coalesce(
    if(pos = first, 1, NULL),
    if({names_one_of(fixed.HUMIDITY_UNITS)}, 2, NULL),
    if({names_one_of(fixed.UV_UNITS)} AND NOT {IS_REPEAT}, 3, NULL),
    if({names_one_of(fixed.LUX_UNITS)}, 4, NULL),
    if({names_one_of(REPEATED_TEMPERATURE)}, 5, NULL),
    if(kind = 'temperature' AND temperatures >= 2 AND pos > first, 5, NULL))
END AS role"""


def down_to_unit_rows(raw_rows: DataFrame, tops: DataFrame) -> DataFrame:
    """Rows down to where unit rows lie: the scan passes over nearly all samples, and their cells.

    The ``DEEP_FILES`` files with the lowest unit rows have a bound of their own, so a worksheet with a long
    preamble opens no samples of others; the next lowest one bounds all other files.
    """
    row, file = F.col("sheet_row"), F.col("file")
    by_depth = tops.where(F.col("unit_row").isNotNull()).orderBy(F.desc("unit_row"), "file")
    deep = by_depth.select("file", "unit_row").limit(DEEP_FILES + 1).collect()
    near = row <= (deep[-1]["unit_row"] if deep else -1)
    for d in deep[:-1]:
        # The row comes first: it rules out nearly all rows, and a name may be costly where the scan computes it.
        near = near | ((row == d["unit_row"]) & (file == d["file"]))
    return raw_rows.where(near)


def header_roles(raw_rows: DataFrame, tops: DataFrame) -> DataFrame:
    """Zero-based positions of the time column and of channels 1 to 5 per file.

    Time: the last column that names a time. Channel 1: the first temperature without a
    repeat suffix. Humidity, UV and illuminance: the last column with their unit, where UV
    passes over `.1` repeats. Channel 5: the last column that is a repeated temperature,
    or a further one after channel 1.
    """
    unit_rows = down_to_unit_rows(raw_rows, tops).join(
        tops.select("file", F.col("unit_row").alias("sheet_row")), ["file", "sheet_row"]
    )
    # The outer form keeps Catalyst from inferring a filter on the names, which it would push
    # below the join and so name the columns of every sample row.
    headers = (
        unit_rows.selectExpr("file", HEADER_TEXTS)
        .selectExpr("file", HEADER_NAMES)
        .selectExpr("file", "posexplode_outer(names) AS (pos, name)")
        .selectExpr("*", KIND)
    )
    # The window and the aggregate share one shuffle of a few rows per file.
    placed = headers.selectExpr("*", FIRST_TEMPERATURE, TEMPERATURES)
    positions = [
        f"max(pos) FILTER (WHERE role = {role}) AS {name}" for role, name in enumerate(["time_pos", *POSITIONS])
    ]
    roles = placed.selectExpr("file", "pos", ROLE).groupBy("file")
    return roles.agg(*[F.expr(position) for position in positions])


def sheet_layouts(tops: DataFrame, roles: DataFrame, strict: bool = False) -> DataFrame:
    """Per file: its month, where its samples start, where its channels are, and the reason
    why it cannot be read, if any."""
    known = file_year_month(tops, strict).join(roles, "file", "left")
    problem = F.coalesce(
        "name_problem",
        "error",
        F.when(F.col("marker_row").isNull(), "no data region"),
        F.when(F.col("time_pos").isNull(), "no time column"),
    )
    return known.select(
        "file", "year", "month", "first_sample_row", "time_pos", *POSITIONS, problem.alias("problem")
    )


def classify_samples(raw_rows: DataFrame, layouts: DataFrame) -> DataFrame:
    """Every row below the unit row, decoded, with its `outcome`.

    One cell that is neither a number nor missing rejects the whole row, as does a time
    that cannot be read; a row without a time is skipped.
    """
    readable = layouts.where(F.col("problem").isNull()).drop("problem")
    below = raw_rows.join(readable, "file").where(F.col("sheet_row") >= F.col("first_sample_row"))

    def cell(position: str) -> Column:
        return present(F.get("cells", F.col(position)))

    texts = below.select(
        "file",
        "sheet_row",
        "year",
        "month",
        cell("time_pos").alias("time_text"),
        *[cell(p).alias(f"{c}_text") for c, p in zip(CHANNELS, POSITIONS, strict=True)],
    )
    # Decoded inside a generator: a filter on the outcome would otherwise be pushed below
    # and decode every cell a second time.
    decoded = F.struct(
        sample_time(F.col("time_text")).alias("record_time"),
        *[channel_value(F.col(f"{c}_text")).alias(c) for c in CHANNELS],
    )
    values = texts.select("*", F.inline(F.array(decoded)))
    bad_channel = F.lit(False)
    for c in CHANNELS:
        bad_channel = bad_channel | (F.col(f"{c}_text").isNotNull() & F.col(c).isNull())
    outcome = (
        F.when(F.col("time_text").isNull(), BLANK_TIME)
        .when(F.col("record_time").isNull(), BAD_TIME)
        .when(bad_channel, BAD_CHANNEL)
        .otherwise(ACCEPTED)
    )
    return values.select("file", "sheet_row", "year", "month", "record_time", *CHANNELS, outcome.alias("outcome"))


def decode_samples(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("outcome") == ACCEPTED).drop("outcome")


def rejects(classified: DataFrame) -> DataFrame:
    """Rows refused for a reason; rows without a time are no rejects."""
    refused = ~F.col("outcome").isin(ACCEPTED, BLANK_TIME)
    return classified.where(refused).select("file", "sheet_row", F.col("outcome").alias("reason"))


def sample_counts(classified: DataFrame) -> DataFrame:
    """Parsed, rejected and skipped rows per file."""
    outcome = F.col("outcome")
    return classified.groupBy("file").agg(
        F.count_if(outcome == ACCEPTED).alias("parsed"),
        F.count_if(~outcome.isin(ACCEPTED, BLANK_TIME)).alias("rejected"),
        F.count_if(outcome == BLANK_TIME).alias("blank"),
    )
