"""Import workbooks as they arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from barograph.plans.imports import load_raw_rows
from barograph.sources.tables import SensorTables
from barograph.sources.workbooks import SOURCE_SCHEMA, scan_files, workbook_glob


def watch_folder(
    tables: SensorTables,
    folder: str,
    checkpoint: str,
    mode: str = "dedupe",
    files_per_batch: int = 1000,
    interval: str | None = None,
    refresh_stats: bool = True,
) -> StreamingQuery:
    """Load new workbooks batch by batch; without an ``interval``, all that are there now.

    The checkpoint remembers paths: a corrected workbook under its old name is not read
    again, ``imports.import_changed`` takes it in. Only ``dedupe`` is accepted: it stores the same
    samples however the workbooks are spread over batches, also when a batch is repeated
    after a failure. Of samples that repeat, the workbook that was there first keeps its own.
    The other modes would double, refuse or overwrite what an earlier batch of the same month
    has stored.
    """
    if mode != "dedupe":
        raise ValueError("only dedupe gives the same table for any size of batch")
    tables.create()
    files = (
        tables.spark.readStream.format("binaryFile")
        .schema(SOURCE_SCHEMA)
        .option("pathGlobFilter", workbook_glob())
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )

    def load(batch: DataFrame, _: int) -> None:
        arrivals = batch.selectExpr("path AS file", "modificationTime AS arrived")
        load_raw_rows(tables, scan_files(batch), mode, refresh_stats=refresh_stats, arrivals=arrivals)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()
