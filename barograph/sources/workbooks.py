"""Monthly workbooks: listing a folder and scanning first worksheets as a Spark job."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from barograph import fixed
from barograph.schema import RAW_ROWS, UNREADABLE
from barograph.sources.filenames import base_name
from barograph.sources.xlsx import first_sheet_rows

ROWS_PER_BATCH = 8192
SOURCE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def workbook_glob(prefix: str = fixed.WORKBOOK_PREFIX) -> str:
    """Name pattern of the workbooks."""
    return f"{prefix}*{fixed.WORKBOOK_SUFFIX}"


def literal_path(path: str) -> str:
    """A path as a pattern that matches it alone."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def is_lock_file() -> F.Column:
    return base_name(F.col("path")).startswith(fixed.LOCK_FILE_PREFIX)


def workbook_files(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """The workbooks of one folder as binary files, as they are listed now.

    A condition on `_metadata.file_name` alone chooses files before any is opened: Spark holds it against its listing.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern or workbook_glob())
    return reader.load(folder).where(~is_lock_file())


def list_workbooks(
    spark: SparkSession, folder: str, prefix: str = fixed.WORKBOOK_PREFIX, pattern: str | None = None
) -> DataFrame:
    """`file` per workbook of one folder, without opening any."""
    return workbook_files(spark, folder, pattern or workbook_glob(prefix=prefix)).select(F.col("path").alias("file"))


def raw_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, content) to worksheet rows, a few thousand at a time.

    A workbook that cannot be opened, breaks off midway or has no rows gives a row numbered
    -1, which keeps whatever rows it had out of the import.
    """
    schema = to_arrow_schema(RAW_ROWS)

    def batch(rows: Sequence[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(values, f.type) for values, f in zip(columns, schema, strict=True)], schema=schema
        )

    for incoming in batches:
        for path, content in zip(*(incoming.column(i) for i in range(2)), strict=True):
            file, rows, empty = path.as_py(), [], True
            try:
                for number, cells in first_sheet_rows(content.as_py()):
                    empty = False
                    rows.append((file, number, cells[0], cells))
                    if len(rows) == ROWS_PER_BATCH:
                        yield batch(rows)
                        rows = []
            except Exception as error:
                rows.append((file, UNREADABLE, f"{type(error).__name__}: {error}", None))
                empty = False
            if empty:
                rows.append((file, UNREADABLE, "worksheet without rows", None))
            if rows:
                yield batch(rows)


def scan_files(files: DataFrame) -> DataFrame:
    """`raw_rows` of a frame of binary files. A worksheet is at most 1,048,576 rows by its
    format, and is streamed; a task holds the compressed workbooks of one input batch, which
    the size of a scan partition bounds, and one batch of rows."""
    contents = files.where(~is_lock_file()).select("path", "content")
    return contents.mapInArrow(raw_batches, RAW_ROWS)


def scan_workbooks(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """`raw_rows` of all workbooks of a folder, or of exactly the given files."""
    if isinstance(paths, str):
        return scan_files(workbook_files(spark, paths))
    if not paths:
        return spark.createDataFrame([], RAW_ROWS)
    return scan_files(spark.read.format("binaryFile").load([literal_path(path) for path in paths]))
