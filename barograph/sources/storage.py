"""Folders in whatever store Spark writes to."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, sorted; none where its folder doesn't exist."""
    place, store = _open(spark, pattern)
    return sorted(status.getPath().toString() for status in store.globStatus(place) or [])


def delete(spark: SparkSession, path: str) -> None:
    place, store = _open(spark, path)
    store.delete(place, True)
