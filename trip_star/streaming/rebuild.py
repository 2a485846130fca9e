"""Keep the star up with its folder when new trip files land.

The reference is a batch job triggered by hand. Here a file-source stream over
the trips folder stands in for the manual trigger: each micro-batch that
brings new files refreshes the star (``plans/refresh.py``). Where the new files
sort behind all others, only they are read and appended; else, as ids are numbered
by first appearance over all trips, the star is built anew. The stream only
decides *when*: its checkpoint records which files were seen, and the star records
which files it holds, so a trigger that is repeated after a failure finds nothing
left to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trip_star.plans.refresh import refresh_star
from trip_star.sources.parquet import LISTING

# The binary-file source's fixed columns (a streaming source needs them declared).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def rebuild_on_new_files(
    spark: SparkSession,
    trips_dir: str,
    zones_raw: DataFrame,
    database: str,
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    **build_options,
) -> StreamingQuery:
    """Start the trigger stream; returns the running query.

    ``available_now`` processes the files present now and stops (a scheduled
    run); otherwise the query polls every ``processing_time``.
    """
    # Only the arrival of files matters here, so the stream lists them as
    # binary files and reads their paths alone (no content, no schema: an
    # empty landing folder is fine).
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .options(**LISTING)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    arrivals = reader.load(trips_dir).select("path")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        # Build on the caller's session, not the stream's clone, so the
        # caller's catalog sees the overwritten tables (no stale file lists).
        refresh_star(spark, trips_dir, zones_raw, database, **build_options)

    writer = arrivals.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
