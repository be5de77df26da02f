"""Arriving files: ledgers by path and by content."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators import joins
from millrace.session import has_data
from millrace.sources.batch import CORRUPT, parse_json_lines

LEDGER = "source_file string, run int, rows_ok bigint, rows_bad bigint"


@dataclass(frozen=True)
class Inbox:
    """Where arriving files lie, and where their rows and the ledger go."""

    incoming: str
    output: str
    ledger: str

    @property
    def checkpoint(self) -> str:
        """Which files have been read: the file source's own log."""
        return f"{self.ledger}/_checkpoint"


def batch_file_ingest(
    spark: SparkSession, inbox: Inbox, schema: StructType, ingested_at: Column,
    max_files: int | None = None, max_age: str = "3650d",
) -> DataFrame:
    """Ingest new files; return the ledger rows of this call, one per file.

    A stream over the inbox that drains what is there and ends. Its checkpoint
    knows the files that were read, so old ones are not opened and no list of
    files is handled here. A run is a micro-batch (of ``max_files``; all new files
    without it) and a folder: one write separates good rows (``state=ok``) from malformed ones
    (``state=error``), and the run's part of the ledger follows it. A run that
    died in between is repeated under its number, whole, on whatever date. Files
    without rows enter the ledger too. Files whose
    time lies ``max_age`` behind the newest are passed over; the source remembers names as long.
    """
    reader = spark.readStream.format("text").option("maxFileAge", max_age)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(inbox.incoming).select("value", F.col("_metadata.file_path").alias("source_file"))
    runs: list[int] = []

    def write(batch: DataFrame, run: int) -> None:
        bad = F.col(CORRUPT).isNotNull()
        rows = parse_json_lines(batch, schema, keep=["source_file"]).withColumns({
            "ingestion_time": ingested_at, "state": F.when(bad, "error").otherwise("ok"), "ingestion_date": ingested_at.cast("date")
        })
        own = f"{inbox.output}/run={run}"
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("state", "ingestion_date").parquet(own)
        counts = spark.createDataFrame([], "source_file string, rows_ok bigint, rows_bad bigint")
        if has_data(spark, own):
            counts = spark.read.parquet(own).groupBy("source_file").agg(
                F.count_if(F.col("state") == "ok").alias("rows_ok"), F.count_if(F.col("state") == "error").alias("rows_bad")
            )
        read = batch.select("source_file").distinct().join(counts, "source_file", "left")  # files of blank lines, too
        _ledger_part(read).write.mode("overwrite").parquet(f"{inbox.ledger}/run={run}")
        runs.append(run)

    query = lines.writeStream.foreachBatch(write).option("checkpointLocation", inbox.checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    empty = _empty_files(spark, inbox)
    if runs and not empty.isEmpty():
        _ledger_part(empty).write.mode("append").parquet(f"{inbox.ledger}/run={runs[-1]}")
    if not runs:
        return spark.createDataFrame([], LEDGER)
    return read_ledger(spark, inbox).filter(F.col("run").isin(runs))


def _ledger_part(counts: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return counts.select("source_file", F.coalesce("rows_ok", zero).alias("rows_ok"), F.coalesce("rows_bad", zero).alias("rows_bad"))


def read_ledger(spark: SparkSession, inbox: Inbox) -> DataFrame:
    """All files ingested so far: ``source_file``, ``run``, ``rows_ok``, ``rows_bad``."""
    return spark.read.parquet(inbox.ledger).select("source_file", F.col("run").cast("int").alias("run"), "rows_ok", "rows_bad")


def _empty_files(spark: SparkSession, inbox: Inbox) -> DataFrame:
    """Files of no bytes that the ledger lacks: a stream of lines does not see them."""
    listed = spark.read.format("binaryFile").load(inbox.incoming).filter(F.col("length") == 0)
    names = listed.select(F.col("_metadata.file_path").alias("source_file"), F.lit(0).cast("bigint").alias("rows_ok"), F.lit(0).cast("bigint").alias("rows_bad"))
    return joins.anti_join_ledger(names, read_ledger(spark, inbox), ["source_file"]) if has_data(spark, inbox.ledger) else names


def file_hashes(spark: SparkSession, incoming: str) -> DataFrame:
    """Path and content digest of every file.

    Files of any size take the same way: Spark's own reader, on the file
    systems the session is configured for, and a digest inside the JVM. A file
    is one value there, so 2 GB is the most it can hold.
    """
    return spark.read.format("binaryFile").load(incoming).select("path", F.sha2("content", 256).alias("file_hash"))


def file_hash_ingest(spark: SparkSession, incoming: str, ledger: DataFrame | None) -> DataFrame:
    """Status of every file by path and SHA-256 of its content.

    ``processed`` files are new or changed, ``already_processed`` ones are in
    the ledger, a table of ``(path, file_hash)``. Only the digest leaves the
    scan.
    """
    files = file_hashes(spark, incoming)
    if ledger is None:
        return files.withColumn("status", F.lit("processed"))
    seen = ledger.select("path", "file_hash").distinct().withColumn("_seen", F.lit(True))
    status = F.when(F.col("_seen").isNotNull(), "already_processed").otherwise("processed")
    return files.join(seen, ["path", "file_hash"], "left").withColumn("status", status).drop("_seen")
