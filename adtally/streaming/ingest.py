"""Event files as they arrive: incremental append, bounded dedup, and upsert.

A checkpoint remembers which files were read, in place of row counts and offsets kept
by hand.  Every job runs over what is there and stops; run it again for new files.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import time as tm
from ..sources.readers import LATE_TIME, PIXEL_COLUMNS, pixel_csv, pixel_events, unreadable_event_files
from ..sources.writers import MONTH, upsert_events, with_month


def event_stream(spark: SparkSession, folder: str, brands: Mapping[int, str], until: tm.Day | None = None,
                 files_per_trigger: int = 1000, columns: Mapping[str, str] = PIXEL_COLUMNS) -> DataFrame:
    """Pixel CSV files below ``folder`` as a typed stream; ``columns`` gives the headers in the order of the export.

    A stream of rows needs its layout up front: all those columns and the event's own time.
    A file with another header stops it with an error that shows it, and its rows are not
    taken for something else; :func:`upsert_files` takes files of any layouts.
    """
    headers = [*columns, *([] if LATE_TIME in columns else [LATE_TIME])]
    layout = T.StructType([T.StructField(h, T.StringType()) for h in headers])
    raw = (spark.readStream.schema(layout).option("header", True).option("enforceSchema", False)
           .option("maxFilesPerTrigger", files_per_trigger).csv(folder))
    return pixel_events(raw, brands, until, columns)


def without_repeats(events: DataFrame, horizon: str = "7 days") -> DataFrame:
    """Drop repeats of an event id whose times lie within ``horizon`` of each other.

    State is kept for that horizon only.  The exact rule over all time is
    :func:`upsert_stream`.
    """
    return events.withWatermark("event_date", horizon).dropDuplicatesWithinWatermark(["event_id"])


def append_stream(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all files not read yet to the event table, then stop."""
    return (with_month(events).writeStream.format("parquet").partitionBy(MONTH)
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def upsert_stream(events: DataFrame, path: str, checkpoint: str, since_month: str | None = None) -> StreamingQuery:
    """Merge all files not read yet into the event table by event id, then stop.

    A batch that is repeated after a failure gives the same table.  ``since_month`` promises
    that no older month holds an id of the new rows, which spares a scan of all ids per batch.
    """
    return (events.writeStream.foreachBatch(lambda batch, _: upsert_events(batch, path, since_month=since_month))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def upsert_files(spark: SparkSession, folder: str, brands: Mapping[int, str], table: str, quarantine: str, checkpoint: str,
                 until: tm.Day | None = None, files_per_trigger: int = 1000, columns: Mapping[str, str] = PIXEL_COLUMNS,
                 since_month: str | None = None, indexed: bool = False) -> StreamingQuery:
    """Merge all pixel files not read yet into the event table, each by its own header, then stop.

    The stream is of file names; each batch of them is read like any export, so layouts may
    change from file to file and cells may go over lines.  Files that cannot be read do not
    stop the stream: they are listed at ``quarantine`` (file_path, reason) by batch, and
    nothing of them is stored.  A batch that is repeated after a failure gives the same
    table and list.
    """
    layout = "path string, modificationTime timestamp, length bigint, content binary"  # of which only the name is read
    names = (spark.readStream.format("binaryFile").schema(layout).option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", True)
             .load(folder).select(F.col("_metadata.file_path").alias("file_path")))

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        files = sorted(r[0] for r in batch.collect())  # bounded by files_per_trigger
        bad = unreadable_event_files(session, folder, files, columns)
        good = [f for f in files if f not in bad]
        if good:
            upsert_events(pixel_csv(session, folder, brands, until, columns=columns, files=good), table, since_month=since_month, indexed=indexed)
        if bad:
            rows = session.createDataFrame([(f, why, number) for f, why in sorted(bad.items())], "file_path string, reason string, batch bigint")
            rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(quarantine)

    return names.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
