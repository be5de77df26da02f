"""Batch plus speed views, and the one-stream alternative."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import columns as C
from millrace.operators import aggregates, ranking
from millrace.sources.tables import partition_overwrite
from millrace.streaming import sinks, views
from millrace.streaming.logs import LeveledLog, newest


def write_batch_view(events: DataFrame, path: str, user: str, date: Column, revenue: str, event: str) -> None:
    """Recompute the days the events cover, by date partition."""
    partition_overwrite(aggregates.user_day_metrics(events, user, date, revenue, event), path, ["date"])


def speed_log(spark: SparkSession, path: str, fan_in: int = 8) -> LeveledLog:
    """A log of windows and users of which merges keep the newest state."""
    return LeveledLog(spark, path, newest(["window_start", "user_id"]), fan_in)


def start_speed_layer(
    stream: DataFrame,
    log: LeveledLog,
    checkpoint: str,
    ts: str,
    user: str,
    revenue: str,
    event: str,
    delay: str = "10 minutes",
    processing_time: str | None = "10 seconds",
) -> StreamingQuery:
    """Keep the recent windows of a stream in a log that merges itself (update mode)."""
    windows = views.speed_layer_view(views.watermark(stream, ts, delay), ts, user, revenue, event)
    return sinks.foreach_batch_sink(views.window_columns(windows), log.write, checkpoint, "update", processing_time)


def speed_view(log: LeveledLog) -> DataFrame:
    return log.current().drop("batch_id")


def serve(batch_view: DataFrame, log: LeveledLog, cutoff: Column) -> DataFrame:
    """Totals of every user from history before the cutoff and the stream after."""
    return aggregates.serve_merged_view(batch_view, speed_view(log), cutoff)


def start_replay(
    stream: DataFrame, log: LeveledLog, checkpoint: str, ts: str, user: str, revenue: str, event: str
) -> StreamingQuery:
    """Everything as one stream: replay the source from its start and drain it.

    A new log and checkpoint rebuild the served view with changed logic while
    the old one keeps serving.
    """
    return start_speed_layer(stream, log, checkpoint, ts, user, revenue, event, processing_time=None)


def replayed_totals(log: LeveledLog) -> DataFrame:
    return speed_view(log).groupBy("user_id").agg(
        C.money_sum("total_revenue").alias("total_revenue"), F.sum("event_count").alias("total_events")
    )


def activity_log(spark: SparkSession, path: str, fan_in: int = 8) -> LeveledLog:
    return LeveledLog(spark, path, newest(["window_start"]), fan_in)


def pages_log(spark: SparkSession, path: str, fan_in: int = 8) -> LeveledLog:
    return LeveledLog(spark, path, newest(["window_start", "page"]), fan_in)


def start_dashboard(
    stream: DataFrame,
    activity: LeveledLog,
    pages: LeveledLog,
    checkpoints: str,
    ts: str,
    user: str,
    page: str,
    delay: str = "1 minute",
    slide: str = "10 seconds",
    processing_time: str | None = "1 second",
) -> tuple[StreamingQuery, StreamingQuery]:
    """User activity per pane and page views per window, two queries in update mode.

    The watermark closes panes and windows, so state holds the open ones, and a
    trigger logs what it changed. Sliding windows are merged from panes when read.
    """
    timed = views.watermark(stream, ts, delay)
    panes = views.window_columns(views.activity_panes(timed, ts, user, slide))
    counted = views.window_columns(views.page_views(timed, ts, page))
    return (
        sinks.foreach_batch_sink(panes, activity.write, f"{checkpoints}/activity", "update", processing_time),
        sinks.foreach_batch_sink(counted, pages.write, f"{checkpoints}/pages", "update", processing_time),
    )


def dashboard_activity(activity: LeveledLog, size: str = "1 minute", slide: str = "10 seconds") -> DataFrame:
    """Events and distinct users per sliding window."""
    return views.activity_of_panes(activity.current(), size, slide)


def dashboard_pages(pages: LeveledLog, limit: int | None = None) -> DataFrame:
    """Page views per window, most viewed first."""
    ordered = pages.current().drop("batch_id").orderBy(F.desc("page_views"), "window_start", "page")
    return ordered if limit is None else ordered.limit(limit)


def items_log(spark: SparkSession, path: str, keep: int = 5, fan_in: int = 8) -> LeveledLog:
    """A log of item counts and first items of which merges keep ``keep`` per window and user."""
    return LeveledLog(spark, path, lambda parts: aggregates.merge_entries(parts, keep), fan_in)


def start_recommendations(
    stream: DataFrame,
    log: LeveledLog,
    checkpoint: str,
    ts: str,
    user: str,
    item: str,
    event: str,
    size: str = "30 minutes",
    processing_time: str | None = "10 seconds",
    keep: int = 5,
) -> StreamingQuery:
    """Log the item counts and first items per window and user as they arrive, late ones included; ``keep`` as the log's."""
    write = sinks.items_writer(log, ts, user, item, event, size, keep)
    return sinks.foreach_batch_sink(stream, write, checkpoint, "append", processing_time)


def served_recommendations(log: LeveledLog, limit: int = 5) -> DataFrame:
    """Item count and recommendations per window and user, over all batches; ``limit`` is what the log keeps at most."""
    items = F.transform(F.slice("entries", 1, limit), lambda entry: entry["item"])
    found = log.current().select("window_start", "user_id", "interaction_count", items.alias("items"))
    return found.withColumn("recommended_items", C.similar_items("items", limit)).drop("items")


def online_features(features: DataFrame, key: str, version: str) -> DataFrame:
    """The newest feature row of every key, for serving."""
    return ranking.dedup_keep_latest(features, [key], [version])
