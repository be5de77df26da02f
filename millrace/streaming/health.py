"""Health of running streams, from the progress Spark reports."""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryProgress,
)
from pyspark.sql.types import StructType

from millrace.streaming.logs import LeveledLog

PROGRESS = (
    "name string, batch_id bigint, at timestamp_ntz, input_rows bigint, rows_per_second double,"
    " batch_seconds double, watermark timestamp_ntz, watermark_lag_seconds double, state_rows bigint"
)


def _utc(text: str | None) -> datetime | None:
    return None if not text else datetime.fromisoformat(text.replace("Z", "+00:00")).replace(tzinfo=None)


def _row(progress: StreamingQueryProgress) -> tuple:
    times = progress.eventTime or {}
    mark, latest = _utc(times.get("watermark")), _utc(times.get("max"))
    return (
        progress.name,
        progress.batchId,
        _utc(progress.timestamp),
        progress.numInputRows,
        progress.processedRowsPerSecond,
        progress.batchDuration / 1000.0,
        mark,
        (latest - mark).total_seconds() if mark and latest else None,
        sum(operator.numRowsTotal for operator in progress.stateOperators),
    )


def stream_progress(query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch: throughput, duration, watermark lag, state.

    The lag is the latest event time minus the watermark; it grows past the
    configured delay when one branch of a join goes quiet and holds the
    watermark back. Spark keeps a bounded number of recent batches; a ``ProgressLog`` keeps all.
    """
    return SparkSession.active().createDataFrame([_row(progress) for progress in query.recentProgress], PROGRESS)


class ProgressLog(StreamingQueryListener):
    """Writes the progress of every micro-batch of every query of a session to a log that merges itself.

    Spark tells a listener of each batch as it ends, so the history has no
    holes however many batches a query runs or restarts it has. Rows are written ``every`` so many batches and
    when a query ends; a driver that dies loses those not written yet. Batches without
    input report too. Register with ``spark.streams.addListener``; one listener per log.
    """

    def __init__(self, log: LeveledLog, every: int = 20):
        self.log, self.every = log, every
        self.rows: list[tuple] = []
        self.lock = threading.RLock()
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        self._end(event)

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        with self.lock:
            self.rows.append(_row(event.progress))
            if len(self.rows) >= self.every:
                self.flush()

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self.flush()
        self._end(event).set()

    def _end(self, event: QueryStartedEvent | QueryTerminatedEvent) -> threading.Event:
        return self.ended.setdefault(str(event.runId), threading.Event())

    def flush(self) -> None:
        """Write what has come in."""
        with self.lock:
            if self.rows:
                segments = self.log.segments()
                self.log.write(self.log.spark.createDataFrame(self.rows, PROGRESS).coalesce(1), segments[-1].last + 1 if segments else 0)
                self.rows = []

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        """Wait until all progress of a query that has ended is written; Spark reports it a little later."""
        return self.ended.setdefault(str(query.runId), threading.Event()).wait(seconds)

    def history(self) -> DataFrame:
        """One row per micro-batch, as ``stream_progress`` gives them."""
        return self.log.read().select(*[field.name for field in StructType.fromDDL(PROGRESS)])
