"""The stored tables: readings partitioned by load and file month, and daily statistics.

Every load writes its readings to partitions of its own, and beside them what its daily statistics are put together from
(`daily_partials`), which later refreshes read in place of the readings, and the keys of its samples, bucketed by key
(`sample_keys`), which deduplication reads. Every rewrite of another table goes to a new version. What is current is a small Parquet table: a row per load and file month whose rows
count, and a row per counter. It is written by Spark, whole, to a new folder for every change; the last
folder that Spark has marked as complete (`_SUCCESS`) holds. A failure before that leaves the tables as they were. Readings are
read by a join with the current loads and months, which prunes their partitions. One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.operators.daily import daily_partials
from barograph.schema import DAILY, MONTH_KEYS, PARTIALS, READINGS, SAMPLE_KEYS, TAKEN_IN, as_readings
from barograph.sources import storage

Month = tuple[int, int]
STATES_KEPT = 200
#: `name` is ``LOADED`` for loads and names a counter otherwise: the last id and load handed out, and versions of tables.
STATE = "load string, year int, month int, name string, number long"
LOADED = "loaded"
LOAD_KEYS = ["load", *MONTH_KEYS]
LAST_ID, LAST_LOAD, DAILY_TABLE, FILE_TABLE = "last id", "last load", "daily_statistics", "taken_in"
#: The first load that has its sample keys stored, and the number of their buckets.
FIRST_KEYED, KEY_BUCKETS = "first load with sample keys", "buckets of sample keys"


class SensorTables:
    def __init__(self, spark: SparkSession, root: str, key_buckets: int = 64):
        """``key_buckets`` is what the sample keys are dealt to; the number that a table was begun with stays."""
        self.spark = spark
        self._buckets = key_buckets
        self.root = root.rstrip("/")
        self._known: tuple[int, dict[str, int]] = (0, {})
        self._single: tuple[int, str | None] = (0, None)

    # What is current

    def _state_number(self) -> int:
        """The last complete state; 0 before the first."""
        begun = reversed(storage.matching(self.spark, f"{self.root}/state/v*"))
        last = next((path for path in begun if storage.matching(self.spark, f"{path}/_SUCCESS")), "/v0")
        return int(last.rsplit("/v", 1)[1])

    def _state(self) -> DataFrame:
        number = self._state_number()
        if not number:
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(self._path("state", number))

    def _current(self) -> DataFrame:
        """`load`, `year` and `month` of the readings that count.

        The comparison tells Spark that the table is worth pruning the readings' partitions by.
        """
        return self._state().where(F.col("name") == LOADED).select(*LOAD_KEYS)

    def _only_load(self) -> str | None:
        """The one load that is current, as after a rebuild, or None; read once per state.

        All its months count then: a month is taken from a load only by a later load that holds it and is current.
        """
        number = self._state_number()
        if self._single[0] != number:
            loads = self._current().select("load").distinct().limit(2).collect()
            self._single = (number, loads[0]["load"] if len(loads) == 1 else None)
        return self._single[1]

    def _counters(self) -> dict[str, int]:
        """The counters by name; read once per state."""
        number = self._state_number()
        if self._known[0] != number:
            rows = self._state().where(F.col("name") != LOADED).select("name", "number").collect()
            self._known = (number, {r["name"]: r["number"] for r in rows})
        return dict(self._known[1])

    def _enter(self, counters: dict[str, int], loads: DataFrame | None = None) -> None:
        """Change counters, and make ``loads`` current or leave those that are."""
        counted = {**self._counters(), **counters}
        rows = [(None, None, None, name, n) for name, n in counted.items()]
        known = (self._current() if loads is None else loads).select(*LOAD_KEYS)
        state = known.selectExpr("*", f"'{LOADED}' AS name", "CAST(NULL AS bigint) AS number")
        last = self._state_number()
        begun = storage.matching(self.spark, f"{self.root}/state/v*")
        number = 1 + (int(begun[-1].rsplit("/v", 1)[1]) if begun else 0)  # a broken off one is not written to again
        state.unionByName(self.spark.createDataFrame(rows, STATE)).coalesce(1).write.parquet(self._path("state", number))
        if last > STATES_KEPT:
            storage.delete(self.spark, self._path("state", last - STATES_KEPT))

    def _version(self, table: str) -> int:
        return self._counters().get(f"version of {table}", 0)

    def _enter_version(self, table: str, version: int) -> None:
        self._enter({f"version of {table}": version})

    def _path(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/v{version:010d}"

    # Readings

    def create(self) -> None:
        """Create the tables that do not exist yet, empty."""
        if self._version(DAILY_TABLE) == 0:
            self.replace_daily(self.spark.createDataFrame([], DAILY))

    def _load_path(self, load: str) -> str:
        return f"{self.root}/readings/load={load}"

    def _of_loads(self, table: str, schema: T.StructType) -> DataFrame:
        """The rows of the current loads and months; where one load is all, that load's folder, without a join."""
        if not storage.matching(self.spark, f"{self.root}/{table}"):
            return self.spark.createDataFrame([], schema)
        only = self._only_load()
        if only is not None:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/load={only}")
        stored = T.StructType([*schema, T.StructField("load", T.StringType())])
        rows = self.spark.read.schema(stored).parquet(f"{self.root}/{table}")
        return rows.join(self._current(), LOAD_KEYS).select(schema.names)

    def readings(self) -> DataFrame:
        return as_readings(self._of_loads("readings", READINGS))

    def daily_partials(self) -> DataFrame:
        """What the daily statistics of all readings are put together from: a row per date, file month and load."""
        return self._of_loads("daily_partials", PARTIALS)

    def months(self) -> list[Month]:
        """The file months that have rows, from the state alone; at most 9,900."""
        found = self._current().select(*MONTH_KEYS).distinct().orderBy(*MONTH_KEYS).collect()
        return [(r["year"], r["month"]) for r in found]

    def month_frame(self) -> DataFrame:
        """``months`` as a frame of values, which plans hold without reading the state again."""
        return self.spark.createDataFrame(self.months(), "year int, month int")

    def reserve_ids(self, count: int) -> int:
        """The id before the first of `count` new ones; a failed load leaves a gap."""
        last = self._counters().get(LAST_ID, 0)
        self._enter({LAST_ID: last + count})
        return last

    def append_readings(self, readings: DataFrame) -> None:
        stored = self._store(readings)
        self._enter({}, self._current().unionByName(stored))

    def replace_months(self, readings: DataFrame) -> None:
        """Let `readings` stand for the file months that occur in them and for no others."""
        stored = self._store(readings)
        self._enter({}, self._current().join(stored, MONTH_KEYS, "left_anti").unionByName(stored))

    def replace_readings(self, readings: DataFrame, last_id: int = 0) -> None:
        """Make `readings`, numbered up to ``last_id``, the whole table."""
        stored = self._store(readings)
        self._enter({LAST_ID: last_id}, stored)

    def clear(self) -> None:
        """Empty the readings, keep their structure; ids start over, daily statistics stay."""
        self._enter({LAST_ID: 0}, self._current().limit(0))

    def _store(self, readings: DataFrame) -> DataFrame:
        """Write a load and its partial statistics; its number with each file month that it holds.

        The number is taken before the rows are written, so what a failed load leaves behind
        is never written to again.
        """
        known = self._counters()
        number = known.get(LAST_LOAD, 0) + 1
        keyed = {FIRST_KEYED: known.get(FIRST_KEYED, number), KEY_BUCKETS: known.get(KEY_BUCKETS, self._buckets)}
        self._enter({LAST_LOAD: number, **keyed})
        load = f"{number:06d}"
        self._write_months(readings, self._load_path(load))
        written = self.spark.read.schema(READINGS).parquet(self._load_path(load))
        parts = daily_partials(written).hint("rebalance", *MONTH_KEYS)
        parts.write.partitionBy(*MONTH_KEYS).parquet(f"{self.root}/daily_partials/load={load}")
        keys = written.select(F.lit(load).alias("load"), *SAMPLE_KEYS).distinct()
        with self._key_table() as name:
            keys.repartition(keyed[KEY_BUCKETS], *SAMPLE_KEYS).write.insertInto(name)
        folders = storage.matching(self.spark, f"{self._load_path(load)}/year=*/month=*")
        months = [[int(part.partition("=")[2]) for part in folder.split("/")[-2:]] for folder in folders]
        return self.spark.createDataFrame([(load, *month) for month in months], "load string, year int, month int")

    def _write_months(self, readings: DataFrame, path: str) -> None:
        """Files of one month each, sorted by time.

        Rebalancing gathers the rows of a small month into one file and splits those of a
        large one by size; within a file, row groups then cover narrow time ranges.
        """
        (
            as_readings(readings)
            .withColumn("created_at", F.coalesce("created_at", F.current_timestamp()))
            .hint("rebalance", *MONTH_KEYS)
            .sortWithinPartitions(*MONTH_KEYS, "record_time")
            .write.mode("errorifexists")
            .partitionBy(*MONTH_KEYS)
            .parquet(path)
        )

    # Sample keys

    @contextmanager
    def _key_table(self) -> Iterator[str]:
        """A name under which the catalogue knows the sample keys, for as long as it is needed: only named tables can have
        buckets. The files, beside the readings, stay; the session must be allowed to create tables."""
        name = f"barograph_keys_{uuid.uuid4().hex}"
        keys, place = ", ".join(SAMPLE_KEYS), f"{self.root}/sample_keys".replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {name} (load STRING, year INT, month INT, record_time TIMESTAMP_NTZ) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self._counters()[KEY_BUCKETS]} BUCKETS LOCATION '{place}'"
        )
        try:
            yield name
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def sample_keys(self) -> tuple[DataFrame, int | None]:
        """The keys of the current readings and the number of buckets that they are dealt to.

        A key can stand there once per load. Tables with current loads that were stored before there were keys
        give those of the readings themselves, which are not bucketed.
        """
        first = self._counters().get(FIRST_KEYED)
        oldest = self._current().agg(F.min(F.col("load").cast("long"))).first()[0]
        if first is None or (oldest is not None and oldest < first):
            return self.readings().select(*SAMPLE_KEYS), None
        with self._key_table() as name:
            stored = self.spark.table(name)
            stored.schema  # noqa: B018  the plan holds the files from here on
        return stored.join(self._current(), LOAD_KEYS).select(*SAMPLE_KEYS), self._counters()[KEY_BUCKETS]

    # Daily statistics

    def daily_statistics(self) -> DataFrame:
        return self.spark.read.schema(DAILY).parquet(self._path(DAILY_TABLE, self._version(DAILY_TABLE)))

    def replace_daily(self, daily: DataFrame) -> None:
        version = self._version(DAILY_TABLE) + 1
        daily.write.mode("overwrite").parquet(self._path(DAILY_TABLE, version))
        self._enter_version(DAILY_TABLE, version)

    # Workbooks

    def taken_in(self) -> DataFrame:
        """The workbooks that the stored months were last compared with."""
        version = self._version(FILE_TABLE)
        if not version:
            return self.spark.createDataFrame([], TAKEN_IN)
        return self.spark.read.schema(TAKEN_IN).parquet(self._path(FILE_TABLE, version))

    def replace_taken_in(self, files: DataFrame) -> None:
        version = self._version(FILE_TABLE) + 1
        files.write.mode("overwrite").parquet(self._path(FILE_TABLE, version))
        self._enter_version(FILE_TABLE, version)

    # Import reports

    def record_import(self, summary: DataFrame, rejects: DataFrame) -> int:
        """Keep what an import did with each file and the rows it refused; returns its number."""
        version = self._version("imports") + 1
        summary.write.mode("overwrite").parquet(self._path("imports", version))
        rejects.write.mode("overwrite").parquet(self._path("rejects", version))
        self._enter_version("imports", version)
        return version

    def import_summary(self, number: int) -> DataFrame:
        return self.spark.read.parquet(self._path("imports", number))

    def rejects(self, number: int) -> DataFrame:
        return self.spark.read.parquet(self._path("rejects", number))
