"""Incremental drop-folder ingest with Structured Streaming.

The file source of Structured Streaming remembers which files it has seen
(in the query's checkpoint), so each micro-batch lists only new files; the
batch is handed to the same gated, idempotent ingest as the batch path.
Because the ingest also skips files whose hash already has a successful
ledger row, a lost checkpoint or a replayed batch loads nothing twice.

The ledger is the archive mark: processed files are those with a ledger
row (``processed_files``); nothing is moved on disk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import ingest_listing
from ..plans.outcomes import processed
from ..plans.store import Store

# The fixed schema of Spark's binaryFile source (streaming sources need it).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def start_drop_folder(spark: SparkSession, folder: str, store_root: str, checkpoint_location: str,
                      available_now: bool = True, processing_time: str | None = None,
                      max_files_per_trigger: int | None = None, **ingest_kw) -> StreamingQuery:
    """Start the stream. ``available_now`` processes what is there and stops;
    otherwise it polls every ``processing_time`` (e.g. ``'1 minute'``)."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    listing = reader.load(folder).select("path", "modificationTime", "length")

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        ingest_listing(batch.sparkSession, batch, store_root, **ingest_kw)

    w = listing.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def run_drop_folder_once(spark: SparkSession, folder: str, store_root: str, checkpoint_location: str,
                         **ingest_kw) -> None:
    """Process every file not yet seen, then return."""
    q = start_drop_folder(spark, folder, store_root, checkpoint_location, available_now=True, **ingest_kw)
    q.awaitTermination()


def processed_files(spark: SparkSession, store_root: str) -> DataFrame:
    """Files that were loaded successfully (the archive mark), latest first."""
    return processed(Store(spark, store_root).ledger())
