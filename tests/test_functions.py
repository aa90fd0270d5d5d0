"""Exact measures, load modes and the daily upsert against brute force in Python."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from barograph import fixed
from barograph.functions.calendar import floor_second, nearest_second
from barograph.functions.cells import channel_value
from barograph.functions.measures import mean, percentage
from barograph.operators import daily, loading, quality, select_rows, summaries
from barograph.operators.prefix import prefix_sums
from barograph.schema import CHANNELS, READINGS, SAMPLE_KEYS, TEMPERATURE
from barograph.session import WorkArea
from barograph.sources.exports import write_csv, write_csv_parts


def exact(value, places):
    return value.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)


def readings_frame(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], READINGS).drop("created_at")


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        time = datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(60 * 24 * 60))
        values = [None if rng.random() < 0.1 else Decimal(rng.randrange(-4000, 12000)).scaleb(-2) for _ in CHANNELS]
        # One date holds a third of all rows.
        if i % 3 == 0:
            time = time.replace(month=1, day=15)
        rows.append((i, 2024, 1 + (i % 2 if time.day == 31 else time.month - 1), time, *values))
    return rows


@pytest.fixture(scope="module")
def random_readings(spark, random_rows):
    return readings_frame(spark, random_rows)


def test_means_are_exact(random_readings, random_rows):
    by_date = defaultdict(list)
    for row in random_rows:
        if row[4] is not None:
            by_date[row[3].date()].append(row[4])
    found = random_readings.groupBy(F.to_date("record_time").alias("d")).agg(
        mean(TEMPERATURE).alias("six"), mean(TEMPERATURE, 2).alias("two")
    )
    for row in found.collect():
        true = sum(by_date[row["d"]]) / len(by_date[row["d"]])
        assert (row["six"], row["two"]) == (exact(true, 6), exact(true, 2))


@pytest.mark.parametrize(
    ("values", "six", "two"),
    [
        (["0.01", "0.02"], "0.015000", "0.02"),
        (["-0.01", "-0.02"], "-0.015000", "-0.02"),
        (["0.00", "0.00", "0.01"], "0.003333", "0.00"),
        (["99999999.99"] * 3, "99999999.990000", "99999999.99"),
        ([None], None, None),
        ([], None, None),
    ],
)
def test_mean_edges(spark, values, six, two):
    data = [(None if v is None else Decimal(v),) for v in values]
    frame = spark.createDataFrame(data, "x decimal(10,2)")
    row = frame.agg(mean("x").alias("six"), mean("x", 2).alias("two")).first()
    assert (row["six"], row["two"]) == tuple(None if v is None else Decimal(v) for v in (six, two))


def test_percentage(spark):
    frame = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (1, 16), (0, 5), (5, 5), (0, 0)], "a long, b long")
    found = [r["p"] for r in frame.select(percentage(F.col("a"), F.col("b")).alias("p")).collect()]
    assert found == [*map(Decimal, ("33.33", "66.67", "12.50", "6.25", "0.00", "100.00")), None]


def test_seconds(spark):
    texts = ["2024-03-31 02:30:00.5", "2024-03-31 02:30:00.499999", "2023-12-31 23:59:59.75", "1969-12-31 23:59:58.2"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        # An hour that does not exist in the session zone must survive.
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        t = F.col("t").cast("timestamp_ntz")
        rows = spark.createDataFrame([(x,) for x in texts], "t string").select(nearest_second(t), floor_second(t)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r[0] for r in rows] == [
        datetime(2024, 3, 31, 2, 30, 1),
        datetime(2024, 3, 31, 2, 30),
        datetime(2024, 1, 1),
        datetime(1969, 12, 31, 23, 59, 58),
    ]
    assert [r[1] for r in rows] == [datetime.fromisoformat(x.split(".")[0]) for x in texts]


def test_histogram_floors_towards_minus_infinity(spark):
    rows = [(i, 2024, 1, datetime(2024, 1, 1), t, h, None, None, None) for i, (t, h) in enumerate(
        [(Decimal("-0.01"), Decimal("9.99")), (Decimal("-5.00"), Decimal("10.00")), (None, Decimal("0.00")), (Decimal("4.99"), None)]
    )]
    found = summaries.temp_humidity_histogram(readings_frame(spark, rows), 2024, 1).collect()
    assert [tuple(r) for r in found] == [(None, 0, 1), (-5, 0, 1), (-5, 10, 1), (0, None, 1)]


def test_invariants(random_readings, random_rows):
    total = sum(1 for r in random_rows if r[2] == 1)
    classes = summaries.comfort_levels(random_readings, 2024, 1).collect()
    assert sum(r["record_count"] for r in classes) == total
    for r in summaries.daily_trend(random_readings, 2024, 1).collect():
        assert r["min_temp"] <= r["avg_temp"] <= r["max_temp"]
        assert r["temp_range"] == r["max_temp"] - r["min_temp"]
    assert {r["comfort_level"] for r in classes} <= {
        fixed.COMFORTABLE, fixed.HOT, fixed.COLD, fixed.HUMID, fixed.DRY, fixed.OTHER
    }


@pytest.mark.parametrize(("limit", "kept"), [(35, 3), (35.5, 2), ("35.555", 1), (35.56, 0), (-1, 4)])
def test_limits_are_taken_as_written(spark, limit, kept):
    values = ["35.00", "35.01", "35.51", "35.56"]
    rows = [(i, 2024, 1, datetime(2024, 1, 1), Decimal(v), *[None] * 4) for i, v in enumerate(values)]
    assert select_rows.over_temperature(readings_frame(spark, rows), 2024, 1, limit).count() == kept


def test_empty_month(spark, random_readings):
    row = quality.completeness_month(random_readings, 2030, 1).first()
    assert (row["total_records"], row["temp_count"], row["temp_percentage"]) == (0, None, None)
    assert summaries.comfort_levels(random_readings, 2030, 1).count() == 0
    assert select_rows.hottest_rows(random_readings, 2030, 1).count() == 0
    assert quality.completeness_all(random_readings.where("false")).first()["ch1_percentage"] is None


def test_dedupe_with_a_hot_key(spark):
    hot = datetime(2024, 2, 1)
    loaded = [(i, 2024, 1, hot, *[None] * 5) for i in range(50)]
    incoming = [(100 + i, 2024, 1 + i % 2, hot if i % 3 == 0 else hot + timedelta(minutes=i % 7), *[None] * 5) for i in range(300)]
    existing, delivery = readings_frame(spark, loaded), readings_frame(spark, incoming)
    taken = loading.in_new_samples(existing, delivery, ["id"]).collect()
    first = {}
    for row in incoming:
        first.setdefault(row[1:4], row[0])
    for row in loaded:
        first.pop(row[1:4], None)
    assert {tuple(r[k] for k in SAMPLE_KEYS): r["id"] for r in taken} == first
    once = loading.load_dedupe(existing, delivery, ["id"])
    assert loading.in_new_samples(once, delivery, ["id"]).count() == 0
    assert once.count() == len(loaded) + len(first)


def test_month_out_of_range_fails(spark):
    rows = [(1, 24, 1, datetime(2024, 1, 1), *[None] * 5)]
    with pytest.raises(Exception, match="file month out of range"):
        loading.month_list(readings_frame(spark, rows)).collect()


def test_numbering(spark):
    files = [("b_2402.xlsx", 2024, 2, 3), ("a_2402.xlsx", 2024, 2, 4), ("z_2401.xlsx", 2024, 1, 5), ("a_2501.xlsx", 2025, 1, 2)]
    rows = [(f, y, m, 10 + 3 * i) for f, y, m, n in files for i in range(n)]
    random.Random(3).shuffle(rows)
    frame = spark.createDataFrame(rows, "file string, year int, month int, sheet_row long")
    offsets = loading.id_offsets(WorkArea(spark), frame)
    numbered = loading.number_readings(frame, offsets, 100)
    found = {(r["year"], r["month"], r["file"], r["sheet_row"]): r["id"] for r in numbered.collect()}
    ids = [found[key] for key in sorted((y, m, f, row) for f, y, m, row in rows)]
    assert ids == sorted(set(ids)) and len(ids) == len(rows)
    assert ids[0] == 101 and ids[-1] <= 100 + offsets.agg(F.sum("span")).first()[0]
    assert loading.number_readings(frame.limit(0), loading.id_offsets(WorkArea(spark), frame.limit(0)), 100).count() == 0


def test_prefix_sums_in_many_ranges(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", None]), i, rng.randrange(5), rng.randrange(100)) for i in range(2000)]
    frame = spark.createDataFrame(rows, "g string, i long, k int, v long")
    for group in ([], ["g"]):
        got = {r.i: r["_before"] for r in prefix_sums(WorkArea(spark), frame, group, [F.col("k"), F.col("i")], "v", "sums").collect()}
        so_far = Counter()
        for g, i, _, v in sorted(rows, key=lambda r: (r[2], r[1])):
            key = g if group else None
            assert got[i] == so_far[key]
            so_far[key] += v


def test_two_parsers_of_numbers_agree(spark):
    """Short texts go straight to decimals, long ones by way of doubles."""
    rng = random.Random(9)
    texts = ["0", "-0", "1e3", "+.5", "5.", "99999999.99", "-99999999.994", "0.005", "-0.005", "1e-20", "123456789012345"]
    texts += [f"{rng.choice(['', '-', '+'])}{rng.randrange(10 ** rng.randrange(1, 9))}.{rng.randrange(10 ** rng.randrange(1, 7))}" for _ in range(500)]
    frame = spark.createDataFrame([(t,) for t in texts if len(t) <= 16], "t string")
    padded = F.rpad("t", 20, " ")  # the same number in a text that is too long for the short way
    apart = frame.select("t", channel_value(F.col("t")).alias("short"), channel_value(padded).alias("long"))
    assert apart.where("NOT (short <=> long)").collect() == []


def test_daily_collisions(random_readings, random_rows):
    groups = defaultdict(Counter)
    for row in random_rows:
        groups[row[3].date()][(row[1], row[2])] += 1
    last = {r["date"]: r for r in daily.daily_statistics(random_readings).collect()}
    merged = {r["date"]: r for r in daily.daily_statistics(random_readings, "merge").collect()}
    assert any(len(g) > 1 for g in groups.values())
    for day, months in groups.items():
        assert (last[day]["year"], last[day]["month"]) == min(months)
        assert last[day]["record_count"] == months[max(months)]
        assert merged[day]["record_count"] == sum(months.values())
        assert (merged[day]["year"], merged[day]["month"], merged[day]["day"]) == (*min(months), day.day)
    with pytest.raises(ValueError):
        daily.daily_statistics(random_readings, "none")


@pytest.mark.parametrize("collision", ["last_file", "merge"])
def test_partials_give_the_statistics_of_all_rows(random_readings, collision):
    """Three loads that share dates and file months."""
    loads = [random_readings.where(F.abs(F.hash("id")) % 3 == i) for i in range(3)]
    parts = [daily.daily_partials(load) for load in loads]
    found = daily.statistics_of_partials(parts[0].unionByName(parts[1]).unionByName(parts[2]), collision)
    whole = daily.daily_statistics(random_readings, collision)
    assert found.dtypes == whole.dtypes
    assert found.orderBy("date").collect() == whole.orderBy("date").collect()
    assert parts[0].join(parts[1], ["date", "year", "month"]).count()


def test_upsert_keeps_and_overwrites(spark):
    def day(d, month, temperature):
        return (1, 2024, month, datetime(2024, 1, d), temperature, *[None] * 4)

    first = daily.daily_statistics(readings_frame(spark, [day(1, 1, Decimal("1.00")), day(2, 1, Decimal("2.00"))]))
    stored = first.select(
        F.unix_date("date").cast("long").alias("id"), "*", F.lit(datetime(2024, 5, 1)).alias("created_at"),
        F.lit(datetime(2024, 5, 1)).alias("updated_at"),
    )
    second = daily.daily_statistics(readings_frame(spark, [day(2, 2, None), day(3, 2, Decimal("3.00"))]))
    found = {r["date"]: r for r in daily.upsert_daily(stored, second).collect()}
    assert sorted(found) == [date(2024, 1, d) for d in (1, 2, 3)]
    kept, updated, new = (found[date(2024, 1, d)] for d in (1, 2, 3))
    assert (kept["avg_temperature"], kept["updated_at"]) == (Decimal("1.00"), datetime(2024, 5, 1))
    # NULL measures overwrite too; the month of the first run stays.
    assert (updated["avg_temperature"], updated["month"]) == (None, 1)
    assert updated["updated_at"] > updated["created_at"]
    assert (new["month"], new["avg_temperature"]) == (2, Decimal("3.00"))
    assert new["id"] == (date(2024, 1, 3) - date(1970, 1, 1)).days


def test_csv_export(spark, random_readings, tmp_path):
    result = select_rows.export_month(random_readings, 2024, 1)
    write_csv(result, str(tmp_path / "month"), single_file=True)
    (part,) = (tmp_path / "month").glob("part-*.csv")
    lines = part.read_text(encoding="utf-8").splitlines()
    assert lines[0] == ",".join(fixed.EXPORT_MONTH_HEADINGS.values())
    assert len(lines) == 1 + result.count()
    times = [line.split(",")[2] for line in lines[1:]]
    assert times == sorted(times)


def test_csv_in_parts_is_the_file_of_one_task(spark, random_readings, tmp_path):
    odd = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "a,\n\"b\"").otherwise("")
    result = random_readings.select("id", "record_time", TEMPERATURE, odd.alias("odd, name"))
    manifest = write_csv_parts(result, str(tmp_path / "parts"), ["record_time", "id"], 5).orderBy("part").collect()
    write_csv(result.orderBy("record_time", "id"), str(tmp_path / "one"), single_file=True)
    parts = sorted((tmp_path / "parts").glob("part-*"))
    (one,) = (tmp_path / "one").glob("part-*")
    assert b"".join(p.read_bytes() for p in parts) == one.read_bytes()
    assert [r["part"] for r in manifest] == [p.name for p in parts] and len(parts) == 6
    ids = [int(r["id"]) for r in result.orderBy("record_time", "id").collect()]
    for row, path in list(zip(manifest, parts, strict=True))[1:]:
        written = spark.read.option("multiLine", True).csv(str(path)).collect()
        assert [int(r[0]) for r in written] == ids[row["rows_before"] :][: row["rows"]]
    assert sum(r["rows"] for r in manifest) == len(ids) and manifest[0]["rows"] == 0
    empty = write_csv_parts(result.limit(0), str(tmp_path / "none"), ["id"], 3).collect()
    assert [(r["rows"], r["rows_before"]) for r in empty] == [(0, 0)]
    assert b"".join(p.read_bytes() for p in (tmp_path / "none").glob("part-*")).startswith(b"id,record_time")
