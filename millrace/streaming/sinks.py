"""Stream sources and sinks whose writes can be repeated."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators import aggregates, idempotent
from millrace.session import temporary
from millrace.sources.buckets import BucketTable
from millrace.streaming.logs import LeveledLog, newest

BatchWriter = Callable[[DataFrame, int], None]


def file_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "json", max_files: int | None = None
) -> DataFrame:
    """Files as they arrive, under a declared schema."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def file_stream_ingest(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "json", max_files: int | None = None
) -> DataFrame:
    """Arriving files with their ingestion time and file name.

    Columns added later enter with a wider ``schema``; a restart on the same
    checkpoint picks them up and older rows read as NULL.
    """
    return file_stream(spark, path, schema, fmt, max_files).withColumns(
        {"ingestion_time": F.current_timestamp(), "file_name": F.col("_metadata.file_path")}
    )


def stream_file_sink(
    df: DataFrame, path: str, checkpoint: str, processing_time: str | None = "10 seconds", partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append to Parquet under a checkpoint; without a trigger time, drain and stop."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if processing_time is None else {"processingTime": processing_time}
    return writer.partitionBy(*partition_by).trigger(**trigger).start(path)


def foreach_batch_sink(
    df: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "update", processing_time: str | None = "10 seconds"
) -> StreamingQuery:
    """Hand every micro-batch to ``write``; without a trigger time, drain and stop."""
    trigger = {"availableNow": True} if processing_time is None else {"processingTime": processing_time}
    writer = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def upsert_writer(table: BucketTable) -> BatchWriter:
    """Merge every batch into a table of buckets; only the buckets its keys fall in are rewritten."""
    return lambda batch, batch_id: table.upsert(batch, batch_id)


def items_writer(log: LeveledLog, ts: str, user: str, item: str, event: str, size: str, keep: int) -> BatchWriter:
    """Log every batch's item count and first ``keep`` items per window and user.

    What accumulates is in the log and not in the stream's state, where the
    list of a hot user would be one value; merges keep ``keep`` items of it.
    """
    return lambda batch, batch_id: log.write(aggregates.first_entries(batch, ts, user, item, event, size, keep), batch_id)


def cdc_log(spark: SparkSession, path: str, order: Sequence[str], fan_in: int = 8) -> LeveledLog:
    """A log of changes of which merges keep the last per key, deletes included."""
    return LeveledLog(spark, path, newest(["_key"], [*order, "batch_id"]), fan_in)


def cdc_writer(log: LeveledLog, key: str, order: Sequence[str]) -> BatchWriter:
    """Log the last change of every key in the batch."""
    return lambda batch, batch_id: log.write(idempotent.latest_changes(batch, key, order), batch_id)


def cdc_current(log: LeveledLog) -> DataFrame:
    """The table the logged changes add up to."""
    return log.current().filter(F.col("op") != "d").select("after.*")


def offset_writer(log: LeveledLog, event_key: str, offset_keys: Sequence[str] = idempotent.OFFSET_KEYS) -> BatchWriter:
    """Log the unseen messages that ``views.unseen_messages`` marks; data and offsets are the same rows.

    A batch reads nothing but itself: what was seen is in the stream's state.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        with temporary(batch, "unseen-messages") as marked:
            log.write(idempotent.inserted_once(marked, event_key, offset_keys), batch_id)

    return write
