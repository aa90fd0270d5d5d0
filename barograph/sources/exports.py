"""Sinks for report results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MANIFEST = "_manifest"


def write_csv(result: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header line; a sorted result keeps its order over the part files.

    ``single_file`` writes through one task and is meant for small reports only.
    """
    frame = result.coalesce(1) if single_file else result
    frame.write.mode("overwrite").option("header", True).csv(path)


def write_csv_parts(result: DataFrame, path: str, order: list[str | Column], parts: int) -> DataFrame:
    """CSV of a large result in ``order``, by ``parts`` tasks; returns the manifest: part, rows and rows_before.

    The part files, laid end to end by name, are what one task would write: the first one has the header and nothing else. The
    manifest is kept beside them as JSON in the folder ``_manifest``, which Spark passes over when it reads ``path``.

    Cases: rows that tie in ``order`` are in no fixed order, and rows alike in all its columns share a part, so it should end
    with an id; no rows give the header alone; texts with line breaks, quotes or commas are quoted, and may span lines; a
    null in a result of one column is an empty line, which the manifest doesn't count.
    """
    spark = result.sparkSession
    lines = result.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # A struct without values would be an empty line; the heading is quoted like any text.
    heading = spark.range(1, numPartitions=1).select(F.struct(*[F.lit(name).alias(f"c{i}") for i, name in enumerate(result.columns)]).alias("h"))
    text = lines.select(F.to_csv(F.struct(*[F.col(f"`{name}`") for name in result.columns])).alias("line"))
    heading.select(F.to_csv("h").alias("line")).union(text).write.mode("overwrite").text(path)

    quoted = spark.read.option("multiLine", True).option("header", False).schema(result.schema).csv(path)
    per_part = quoted.groupBy(F.col("_metadata.file_name").alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    first = per_part.agg(F.min("part")).scalar()
    per_part = per_part.withColumn("rows", F.col("rows") - F.when(F.col("part") == first, 1).otherwise(0))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    manifest = per_part.select("part", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"))
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/{MANIFEST}")
    return spark.read.schema(manifest.schema).json(f"{path}/{MANIFEST}")


def write_jdbc(
    result: DataFrame, url: str, table: str, batch_size: int = 10_000, connections: int = 16, **properties: str
) -> None:
    """Append to a database table, in batches, over at most ``connections`` connections."""
    writer = result.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
    writer.option("batchsize", batch_size).option("numPartitions", connections).options(**properties).save()
