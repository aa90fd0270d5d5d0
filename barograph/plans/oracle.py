"""The same results in DuckDB SQL, worked out independently of the Spark operators."""

from __future__ import annotations

from barograph import fixed
from barograph.schema import CHANNELS, DEVICE_TEMP, HUMIDITY, LUX, TEMPERATURE, UV

READINGS = """
WITH base AS (
  SELECT event_id AS e, user_id AS u, CAST(event_id % 3 AS INTEGER) AS k,
         CAST(round(value * 100) AS BIGINT) AS v, date_trunc('second', ts) AS t
  FROM events),
hundredths AS (
  SELECT e + 1 AS id, CAST(2024 AS INTEGER) AS year, 1 + k AS month, t + to_days(29 * k) AS record_time,
         if(e % 41 = 0, NULL, (v + 37 * u) % 4500 - 500) AS h1,
         if(e % 37 = 0, NULL, (v * 7 + 11 * e) % 7000 + 3000) AS h2,
         if(e % 5 = 0, NULL, v % 150) AS h3,
         if(e % 7 = 0, NULL, v * 1300 % 10000000) AS h4,
         if(k = 2 OR (k = 0 AND e % 9 < 3), NULL, (v + 1234) % 5000) AS h5
  FROM base),
readings AS (
  SELECT id, year, month, record_time,
         CAST(h1 * 0.01 AS DECIMAL(10,2)) AS channel1_temperature,
         CAST(h2 * 0.01 AS DECIMAL(10,2)) AS channel2_humidity,
         CAST(h3 * 0.01 AS DECIMAL(10,2)) AS channel3_uv,
         CAST(h4 * 0.01 AS DECIMAL(10,2)) AS channel4_lux,
         CAST(h5 * 0.01 AS DECIMAL(10,2)) AS channel5_device_temp
  FROM hundredths),
of_month AS (FROM readings WHERE year = 2024 AND month = 1),
loaded AS (FROM readings WHERE month = 1 OR (month = 2 AND id % 2 = 0)),
incoming AS (
  FROM readings WHERE month >= 2
  UNION ALL BY NAME
  FROM readings WHERE month = 3 AND id % 10 = 0)
"""

DATE = "CAST(record_time AS DATE)"


def number(expression: str, name: str) -> str:
    return f'CAST({expression} AS DOUBLE) AS "{name}"'


def mean(channel: str, name: str, places: int = 6) -> str:
    """Half away from zero in whole numbers, so that no rounding depends on a double."""
    total = f"CAST(sum({channel} * 100) AS HUGEINT)"
    count = f"CAST(count({channel}) AS HUGEINT)"
    scaled = f"(2 * abs({total}) * {10 ** (places - 2)} + {count}) // (2 * {count})"
    return f'sign({total}) * CAST({scaled} AS DOUBLE) / 1e{places} AS "{name}"'


def share(part: str, whole: str, name: str, places: int = 2) -> str:
    return f'CAST((2 * {part} * {10 ** (places + 2)} + {whole}) // (2 * {whole}) AS DOUBLE) / 1e{places} AS "{name}"'


def channels(*wanted: str) -> str:
    return ", ".join(number(c, c) for c in (wanted or CHANNELS))


ROW = f"id, year, month, record_time, {channels()}"


def by_date(*measures: str, source: str = "of_month", date: str = "date") -> str:
    return f'SELECT {DATE} AS "{date}", {", ".join(measures)} FROM {source} GROUP BY 1'


def highest(channel: str, name: str) -> str:
    return number(f"max({channel})", name)


def lowest(channel: str, name: str) -> str:
    return number(f"min({channel})", name)


CLIMATE = ", ".join([mean(TEMPERATURE, "avg_temp"), mean(HUMIDITY, "avg_humidity"), "count(*) AS record_count"])

STATISTICS = ", ".join(
    [
        mean(TEMPERATURE, "avg_temperature", 2),
        mean(HUMIDITY, "avg_humidity", 2),
        mean(DEVICE_TEMP, "avg_device_temp", 2),
        highest(TEMPERATURE, "max_temperature"),
        highest(HUMIDITY, "max_humidity"),
        lowest(TEMPERATURE, "min_temperature"),
        lowest(HUMIDITY, "min_humidity"),
        number(f"max({TEMPERATURE}) - min({TEMPERATURE})", "temperature_delta"),
        number(f"max({HUMIDITY}) - min({HUMIDITY})", "humidity_delta"),
        "count(*) AS record_count",
    ]
)
DAY = "CAST(day(date) AS INTEGER) AS day"


def groups(source: str) -> str:
    inner = f"SELECT {DATE} AS date, year, month, {STATISTICS} FROM {source} GROUP BY 1, 2, 3"
    return f"SELECT date, year, month, {DAY}, * EXCLUDE (date, year, month) FROM ({inner})"


def daily(source: str) -> str:
    """The last file month's group per date, under the first one's year and month."""
    return f"""
    SELECT * REPLACE (first_value(year) OVER in_order AS year, first_value(month) OVER in_order AS month)
    FROM ({groups(source)})
    WINDOW in_order AS (PARTITION BY date ORDER BY year, month
                        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    QUALIFY (year, month) = (last_value(year) OVER in_order, last_value(month) OVER in_order)"""


def extreme(channel: str, direction: str) -> str:
    ranked = f"rank() OVER (ORDER BY {channel} {direction} NULLS LAST)"
    return f"SELECT {ROW} FROM of_month WHERE {channel} IS NOT NULL QUALIFY {ranked} = 1"


def flag(channel: str, name: str) -> str:
    return f"if({channel} IS NULL, '{fixed.MISSING}', '{fixed.PRESENT}') AS {name}"


def export_heading(column: str, heading: str) -> str:
    if column == "record_time":
        return f"strftime(record_time, '%Y-%m-%d %H:%M:%S') AS \"{heading}\""
    return number(column, heading) if column in CHANNELS else f'{column} AS "{heading}"'


H = fixed.EXPORT_DAILY_HEADINGS

COMFORT = f"""
SELECT comfort_level, count(*) AS record_count,
       {share("count(*)", "(SELECT count(*) FROM of_month)", "percentage")}
FROM (
  SELECT coalesce(
    if(t >= 20 AND t <= 28 AND h >= 40 AND h <= 70, '{fixed.COMFORTABLE}', NULL),
    if(t > 28, '{fixed.HOT}', if(t < 20, '{fixed.COLD}', NULL)),
    if(h > 70, '{fixed.HUMID}', if(h < 40, '{fixed.DRY}', NULL)),
    '{fixed.OTHER}') AS comfort_level
  FROM (SELECT {TEMPERATURE} AS t, {HUMIDITY} AS h FROM of_month))
GROUP BY 1"""

# Worksheet rows: month, marker row and channel positions of the three derived workbooks.
LAYOUTS = """(VALUES (1, 2, 1, 2, 3, 4, 5, 6), (2, 3, 1, 3, 5, 6, 2, 4), (3, 4, 1, 2, 3, 4, 5, NULL))
  AS layout(month, marker, time_pos, ch1_pos, ch2_pos, ch3_pos, ch4_pos, ch5_pos)"""
FILE = "'LOGGER RAWDATA_240' || month || '.xlsx' AS file"

# One workbook per date and group of readings; the kind is the header case, 16 and 17 have no marker.
WORKBOOK = "'LOGGER RAWDATA_' || strftime(record_time, '%y%m_%d') || '_' || (id % 4) || '.xlsx'"
WORKBOOKS = f"""SELECT {WORKBOOK} AS file, any_value(id % 4) AS team, count(*) AS n,
    any_value(date_diff('day', DATE '2024-01-01', record_time::DATE) * 4 + id % 4) % 18 AS kind,
    any_value(id % 4) + 3 + min(id) AS low, any_value(id % 4) + 3 + max(id) AS high
    FROM readings GROUP BY 1"""
GIVES_SAMPLES = "kind < 16 AND kind <> 13 AND team % 2 = 1"
HEADERS = """(VALUES (0, 1, 2, 3, 4, 5, 6), (1, 1, 2, 3, NULL, 4, NULL), (2, 1, 2, NULL, NULL, NULL, 3),
    (3, 1, 2, NULL, NULL, NULL, 4), (4, 1, 2, NULL, NULL, NULL, 3), (5, 1, NULL, NULL, 2, NULL, NULL),
    (6, 1, NULL, NULL, 4, NULL, NULL), (7, 1, NULL, NULL, NULL, 3, NULL), (8, 1, NULL, 3, NULL, NULL, NULL),
    (9, 2, 3, NULL, NULL, NULL, NULL), (10, 1, 3, 4, NULL, NULL, NULL), (11, 1, NULL, NULL, NULL, NULL, 2),
    (12, 1, 3, NULL, NULL, NULL, NULL), (13, NULL, 1, 2, NULL, NULL, NULL), (14, 1, 2, NULL, NULL, NULL, 4),
    (15, 1, 2, NULL, NULL, NULL, 3)) AS h(kind, time_pos, ch1_pos, ch2_pos, ch3_pos, ch4_pos, ch5_pos)"""
GOOD = "id % 101 <> 0 AND id % 103 <> 0"
VIEW = f"""SELECT id, year, month, {DATE} AS date, record_time, {number(TEMPERATURE, "temperature")},
  {number(HUMIDITY, "humidity")}, {number(UV, "uv")}, {number(LUX, "lux")},
  {number(DEVICE_TEMP, "device_temperature")} FROM readings"""

NAMES = """SELECT id, CAST(id % 7 AS INTEGER) AS shape, strftime(record_time, '%y%m') AS yymm,
  CAST(strftime(record_time, '%y') AS INTEGER) AS yy, CAST(month(record_time) AS INTEGER) AS mm,
  CASE id % 7
    WHEN 0 THEN 'LOGGER RAWDATA_' || yymm || '.xlsx'
    WHEN 1 THEN 'LOGGER RAWDATA_' || yymm || '_v2.xlsx'
    WHEN 2 THEN 'LOGGER RAWDATA_20' || yymm || '.xlsx'
    WHEN 3 THEN 'LOGGER RAWDATA_' || yy || '00.xlsx'
    WHEN 4 THEN 'LOGGER RAWDATA_' || yy || '13.xlsx'
    WHEN 5 THEN 'LOGGER RAWDATA_ab' || yy || '.xlsx'
    ELSE 'LOGGER RAWDATA ' || yymm || '.xlsx' END AS file,
  CAST(if(shape IN (0, 1, 4), 2000 + yy, NULL) AS INTEGER) AS year,
  CAST(CASE WHEN shape IN (0, 1) THEN mm WHEN shape = 4 THEN 13 END AS INTEGER) AS month
  FROM readings"""

TAKEN_NEW = "FROM incoming ANTI JOIN loaded USING (year, month)"

UPSERT_VALUES = ", ".join(
    f"if(n.date IS NULL, o.{c}, n.{c}) AS {c}"
    for c in [
        "avg_temperature",
        "avg_humidity",
        "avg_device_temp",
        "max_temperature",
        "max_humidity",
        "min_temperature",
        "min_humidity",
        "temperature_delta",
        "humidity_delta",
        "record_count",
    ]
)

BODIES = {
    "month_rows": f"SELECT {ROW} FROM of_month ORDER BY record_time, id LIMIT 100",
    "month_all_rows": f"SELECT {ROW} FROM of_month",
    "hour_band_rows": f"SELECT {ROW} FROM of_month WHERE hour(record_time) IN (12, 13, 14)",
    "hottest_rows": extreme(TEMPERATURE, "DESC"),
    "coldest_rows": extreme(TEMPERATURE, "ASC"),
    "over_temperature": f"SELECT record_time, {channels(TEMPERATURE, HUMIDITY, DEVICE_TEMP)} FROM of_month WHERE {TEMPERATURE} > 35",
    "over_humidity": f"SELECT record_time, {channels(TEMPERATURE, HUMIDITY)} FROM of_month WHERE {HUMIDITY} > 95",
    "high_uv": f"SELECT record_time, {channels(UV, TEMPERATURE, LUX)} FROM of_month WHERE {UV} > 0.8",
    "missing_rows": f"""SELECT record_time, {flag(TEMPERATURE, "temp")}, {flag(HUMIDITY, "humidity")}, {flag(UV, "uv")},
        {flag(LUX, "lux")}, {flag(DEVICE_TEMP, "device_temp")}
        FROM of_month WHERE {" + ".join(CHANNELS)} IS NULL ORDER BY record_time, id LIMIT 50""",
    "export_month": "SELECT "
    + ", ".join(export_heading(c, h) for c, h in fixed.EXPORT_MONTH_HEADINGS.items())
    + " FROM of_month",
    "daily_averages": by_date(
        mean(TEMPERATURE, "avg_temp"), mean(HUMIDITY, "avg_humidity"), mean(UV, "avg_uv"), mean(LUX, "avg_lux")
    ),
    "daily_extremes": by_date(
        highest(TEMPERATURE, "max_temp"),
        lowest(TEMPERATURE, "min_temp"),
        highest(HUMIDITY, "max_humidity"),
        lowest(HUMIDITY, "min_humidity"),
        highest(UV, "max_uv"),
        highest(LUX, "max_lux"),
    ),
    "daily_trend": by_date(
        lowest(TEMPERATURE, "min_temp"),
        mean(TEMPERATURE, "avg_temp"),
        highest(TEMPERATURE, "max_temp"),
        number(f"max({TEMPERATURE}) - min({TEMPERATURE})", "temp_range"),
    ),
    "uv_daily": by_date(
        "count(*) AS total_records",
        f"count(*) FILTER ({UV} IS NOT NULL) AS uv_records",
        mean(UV, "avg_uv"),
        highest(UV, "max_uv"),
    ),
    "lux_daily": by_date(mean(LUX, "avg_lux"), highest(LUX, "max_lux"), f"count({LUX}) AS lux_record_count")
    + f" HAVING count({LUX}) > 0",
    "export_daily": by_date(
        f'count(*) AS "{H["record_count"]}"',
        mean(TEMPERATURE, H["avg_temperature"], 2),
        highest(TEMPERATURE, H["max_temperature"]),
        lowest(TEMPERATURE, H["min_temperature"]),
        mean(HUMIDITY, H["avg_humidity"], 2),
        highest(HUMIDITY, H["max_humidity"]),
        lowest(HUMIDITY, H["min_humidity"]),
        mean(UV, H["avg_uv"], 2),
        highest(LUX, H["max_lux"]),
        date=H["date"],
    ),
    "monthly_summary": f"""SELECT year, month, {CLIMATE}, {highest(TEMPERATURE, "max_temp")}, {lowest(TEMPERATURE, "min_temp")},
        {highest(HUMIDITY, "max_humidity")}, {lowest(HUMIDITY, "min_humidity")} FROM of_month GROUP BY ALL""",
    "hourly_temperature": f"""SELECT CAST(hour(record_time) AS INTEGER) AS hour, {mean(TEMPERATURE, "avg_temp")},
        count(*) AS record_count FROM of_month GROUP BY 1""",
    "day_night": f"""SELECT if(hour(record_time) >= 6 AND hour(record_time) < 18, '{fixed.DAYTIME}', '{fixed.NIGHT}') AS time_period,
        {CLIMATE} FROM of_month GROUP BY 1""",
    "weekday_weekend": f"""SELECT if(dayofweek(record_time) IN (0, 6), '{fixed.WEEKEND}', '{fixed.WEEKDAY}') AS day_type,
        {CLIMATE} FROM of_month GROUP BY 1""",
    "temp_humidity_histogram": f"""SELECT CAST(floor({TEMPERATURE} / 5) * 5 AS INTEGER) AS temp_range,
        CAST(floor({HUMIDITY} / 10) * 10 AS INTEGER) AS humidity_range, count(*) AS count FROM of_month GROUP BY 1, 2""",
    "comfort_levels": COMFORT,
    "completeness_month": "SELECT total_records, temp_count, humidity_count, uv_count, lux_count, device_temp_count, "
    + ", ".join(share(f"{n}_count", "total_records", f"{n}_percentage") for n in ("temp", "uv", "lux"))
    + f""" FROM (SELECT count(*) AS total_records, count({TEMPERATURE}) AS temp_count, count({HUMIDITY}) AS humidity_count,
        count({UV}) AS uv_count, count({LUX}) AS lux_count, count({DEVICE_TEMP}) AS device_temp_count FROM of_month)""",
    "device_temp_sample": f"""SELECT record_time, {channels(TEMPERATURE, DEVICE_TEMP)} FROM of_month
        WHERE {DEVICE_TEMP} IS NOT NULL ORDER BY record_time, id LIMIT 10""",
    "latest_rows": f"SELECT {ROW} FROM readings ORDER BY record_time DESC, id DESC LIMIT 10",
    "all_rows": f"SELECT {ROW} FROM readings",
    "with_device_temp": f"SELECT {ROW} FROM readings WHERE {DEVICE_TEMP} IS NOT NULL",
    "total_records": "SELECT count(*) AS total_records FROM readings",
    "records_by_month": "SELECT year, month, count(*) AS record_count FROM readings GROUP BY ALL",
    "completeness_all": "SELECT *, "
    + ", ".join(share(f"ch{i}_count", "total", f"ch{i}_percentage", 1) for i in range(1, 6))
    + " FROM (SELECT count(*) AS total, "
    + ", ".join(f"count({c}) AS ch{i}_count" for i, c in enumerate(CHANNELS, 1))
    + " FROM readings)",
    "verify_months": """SELECT year, month, count(*) AS record_count, min(record_time) AS first_record,
        max(record_time) AS last_record FROM readings GROUP BY ALL""",
    "verify_months_ch5": f"""SELECT year, month, count(*) AS record_count, min(record_time) AS first_record,
        max(record_time) AS last_record, count({DEVICE_TEMP}) AS ch5_count FROM readings GROUP BY ALL""",
    "import_month_report": f"""SELECT year, month, count(*) AS total, min(record_time) AS first_time,
        max(record_time) AS last_time, {mean(TEMPERATURE, "avg_temp", 2)}, {mean(HUMIDITY, "avg_humidity", 2)}
        FROM readings GROUP BY ALL""",
    "climate_range": f"""SELECT {lowest(TEMPERATURE, "min_temp")}, {highest(TEMPERATURE, "max_temp")},
        {lowest(HUMIDITY, "min_humidity")}, {highest(HUMIDITY, "max_humidity")}
        FROM readings WHERE {TEMPERATURE} IS NOT NULL""",
    "uv_coverage": f"""SELECT min(record_time) AS first_uv_time, count(DISTINCT {DATE}) AS days_with_uv
        FROM readings WHERE {UV} IS NOT NULL""",
    "device_temp_months": f"""SELECT year, month, count({DEVICE_TEMP}) AS count FROM readings
        GROUP BY ALL HAVING count({DEVICE_TEMP}) > 0""",
    "device_temp_quality": f"""SELECT year, month, count(*) AS total_records, count({DEVICE_TEMP}) AS ch5_records,
        {share(f"count({DEVICE_TEMP})", "count(*)", "percentage")}, {lowest(DEVICE_TEMP, "min_temp")},
        {highest(DEVICE_TEMP, "max_temp")}, {mean(DEVICE_TEMP, "avg_temp", 2)} FROM readings GROUP BY year, month""",
    "daily_statistics_groups": groups("readings"),
    "daily_statistics": daily("readings"),
    "daily_statistics_merged": f"""SELECT date, file_month // 100 AS year, file_month % 100 AS month, {DAY},
        * EXCLUDE (date, file_month)
        FROM (SELECT {DATE} AS date, min(year * 100 + month) AS file_month, {STATISTICS} FROM readings GROUP BY 1)""",
    "daily_statistics_upsert": f"""SELECT date, coalesce(o.year, n.year) AS year, coalesce(o.month, n.month) AS month,
        coalesce(o.day, n.day) AS day, {UPSERT_VALUES}
        FROM ({daily("loaded")}) o FULL JOIN ({daily("incoming")}) n USING (date)""",
    "daily_statistics_of_loads": daily("(SELECT * FROM loaded UNION ALL SELECT * FROM incoming)"),
    "daily_recent": f"""SELECT date, avg_temperature, avg_humidity, avg_device_temp, max_temperature, min_temperature,
        temperature_delta, humidity_delta, record_count FROM ({daily("readings")}) ORDER BY date DESC LIMIT 10""",
    "daily_month": f"SELECT * FROM ({daily('readings')}) WHERE year = 2024 AND month = 1",
    "daily_temp_trend": f"""SELECT date, avg_temperature, max_temperature, min_temperature FROM ({daily("readings")})
        WHERE year = 2024 AND month = 1""",
    "complete_view": VIEW,
    "view_latest": f"SELECT * FROM ({VIEW}) WHERE year = 2024 AND month = 1 ORDER BY record_time DESC, id DESC LIMIT 100",
    "view_month_rows": f"SELECT date, temperature, humidity, device_temperature FROM ({VIEW}) WHERE year = 2024 AND month = 1",
    "existing_months": "SELECT DISTINCT year, month FROM readings",
    "load_append": f"SELECT {ROW} FROM (FROM loaded UNION ALL FROM incoming)",
    "load_skip_existing": f"SELECT {ROW} FROM (FROM loaded UNION ALL {TAKEN_NEW})",
    "load_dedupe": f"""SELECT {ROW} FROM (
        FROM loaded UNION ALL
        SELECT DISTINCT i.* FROM incoming i ANTI JOIN loaded l USING (year, month, record_time)
        QUALIFY row_number() OVER (PARTITION BY i.year, i.month, i.record_time ORDER BY i.id) = 1)""",
    "load_dedupe_stored": f"""SELECT {ROW} FROM (
        FROM loaded UNION ALL
        SELECT DISTINCT i.* FROM incoming i ANTI JOIN loaded l USING (year, month, record_time)
        QUALIFY row_number() OVER (PARTITION BY i.year, i.month, i.record_time ORDER BY i.id) = 1)""",
    "latest_rows_stored": f"""SELECT {ROW} FROM (FROM loaded UNION ALL FROM incoming)
        ORDER BY record_time DESC, id DESC LIMIT 10""",
    "load_replace_month": f"SELECT {ROW} FROM (FROM loaded ANTI JOIN incoming USING (year, month) UNION ALL FROM incoming)",
    "file_year_month": f"SELECT id, file, year, month FROM ({NAMES})",
    "file_status": f"""SELECT DISTINCT file, year, month,
        coalesce((year, month) IN (SELECT (year, month) FROM loaded), false) AS already_loaded FROM ({NAMES})""",
    "data_region": f"""SELECT file, team + 1 AS marker_row, team + 3 AS unit_row, team + 4 AS first_sample_row
        FROM ({WORKBOOKS}) WHERE kind < 16""",
    "header_roles": f"SELECT file, h.* EXCLUDE (kind) FROM ({WORKBOOKS}) JOIN {HEADERS} USING (kind)",
    "load_first_files": f"""SELECT CAST('20' || file[16:17] AS INTEGER) AS year, CAST(file[18:19] AS INTEGER) AS month,
        file, n AS parsed
        FROM ({WORKBOOKS}) WHERE {GIVES_SAMPLES} QUALIFY row_number() OVER (PARTITION BY file[16:19] ORDER BY file) = 1""",
    "number_readings": f"""SELECT file, sheet_row, CAST(100 + sheet_row - low + 1 + coalesce(
          before, 0) AS BIGINT) AS id
        FROM (SELECT *, sum(high - low + 1) OVER (ORDER BY file[16:19], file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
              FROM ({WORKBOOKS}) WHERE {GIVES_SAMPLES})
        JOIN (SELECT {WORKBOOK} AS file, id % 4 + 3 + id AS sheet_row FROM readings) USING (file)""",
    "decode_samples": f"""SELECT {FILE}, CAST(marker + 2 + id AS BIGINT) AS sheet_row, year, month, record_time, {channels()}
        FROM readings JOIN {LAYOUTS} USING (month) WHERE {GOOD}""",
    "rejects": f"""SELECT {FILE}, CAST(marker + 2 + id AS BIGINT) AS sheet_row, 'channel not a number in range' AS reason
        FROM readings JOIN {LAYOUTS} USING (month) WHERE id % 101 = 0 AND id % 103 <> 0""",
    "import_summary": f"""SELECT {FILE}, year, month, count(*) FILTER ({GOOD}) AS parsed,
        count(*) FILTER (id % 101 = 0 AND id % 103 <> 0) AS rejected, count(*) FILTER (id % 103 = 0) AS blank,
        if(month = 3, parsed, 0) AS inserted, if(month = 3, 0, parsed) AS skipped, CAST(NULL AS VARCHAR) AS problem
        FROM readings GROUP BY year, month""",
    "rebuild": daily(f"(FROM readings WHERE {GOOD})"),
}

ORACLE_SQL = {name: f"{READINGS}{body}" for name, body in BODIES.items()}
