"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "barograph", **overrides: str) -> SparkSession:
    """A session with the settings the library relies on.

    Shuffle partition counts and the advisory size are left to adaptive execution and
    to the cluster; callers pass ``overrides`` for anything else.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in overrides.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only in local mode."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="barograph-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


class WorkArea:
    """Tables written once to the shared folder, so that later stages neither repeat the
    work before them nor depend on executors that may be lost.

    A staged table also gives the planner its true size: joins against it are broadcast
    only below ``spark.sql.autoBroadcastJoinThreshold`` and shuffled above it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{work_dir(spark)}/barograph-{uuid.uuid4().hex}"
        # Held here, since a stopped session gives neither any more.
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        _areas.add(self)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        _areas.discard(self)
        folder = self._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self._conf).delete(folder, True)


#: Work areas of queries that are lazy, and so may still be read; they go when the driver ends.
_areas: set[WorkArea] = set()


@atexit.register
def _drop_areas() -> None:
    for area in list(_areas):
        area.drop()


@contextmanager
def work_area(spark: SparkSession) -> Iterator[WorkArea]:
    """A work area for one action; its own folder is dropped afterwards."""
    area = WorkArea(spark)
    try:
        yield area
    finally:
        area.drop()
