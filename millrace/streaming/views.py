"""Event-time views: builders from a DataFrame, streaming or bounded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import columns as C

SKETCH_BITS = 12


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Give a wall-clock column the zoned type that watermarks require."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def watermark(df: DataFrame, ts: str, delay: str) -> DataFrame:
    return event_time(df, ts).withWatermark(ts, delay)


def window_columns(df: DataFrame) -> DataFrame:
    """Replace a ``window`` struct by plain ``window_start``/``window_end``."""
    rest = [name for name in df.columns if name != "window"]
    return df.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *rest,
    )


def tumbling_velocity(df: DataFrame, ts: str, user: str, amount: str, size: str = "5 minutes") -> DataFrame:
    """Rows and amount per user and window."""
    return df.groupBy(F.window(ts, size), F.col(user).alias("user_id")).agg(
        F.count("*").alias("txn_count"), C.money_sum(amount).alias("total_amount")
    )


def sliding_activity(df: DataFrame, ts: str, user: str, size: str = "1 minute", slide: str = "10 seconds") -> DataFrame:
    """Events and distinct users per sliding window.

    A bounded table counts users exactly: rows shrink to one per pane (one
    slide) and user before they are copied into the windows covering the pane.
    A stream cannot count distinct values exactly and approximates them.
    """
    if df.isStreaming:
        return df.groupBy(F.window(ts, size, slide)).agg(
            F.count("*").alias("event_count"), F.approx_count_distinct(user).alias("unique_users")
        )
    panes = df.groupBy(F.window(ts, slide)["start"].alias("_pane"), F.col(user).alias("_user")).agg(
        F.count("*").alias("_n")
    )
    return (
        panes.groupBy(F.window("_pane", size, slide), "_user")
        .agg(F.sum("_n").alias("_n"))
        .groupBy("window")
        .agg(F.sum("_n").alias("event_count"), F.count("_user").alias("unique_users"))
    )


def activity_panes(df: DataFrame, ts: str, user: str, slide: str = "10 seconds") -> DataFrame:
    """Events and a sketch of the users per pane, one slide long: the state of a stream is a row per open pane.

    The sketch (HLL, ``2 ** SKETCH_BITS`` registers) has a standard error of 1.6 %; few values are counted nearly exactly.
    """
    return df.groupBy(F.window(ts, slide)).agg(F.count("*").alias("event_count"), F.hll_sketch_agg(user, F.lit(SKETCH_BITS)).alias("users"))


def activity_of_panes(panes: DataFrame, size: str = "1 minute", slide: str = "10 seconds") -> DataFrame:
    """Events and distinct users of every sliding window from its panes (``window_start``, ``event_count``, ``users``)."""
    merged = panes.groupBy(F.window("window_start", size, slide)).agg(
        F.sum("event_count").alias("event_count"), F.hll_sketch_estimate(F.hll_union_agg("users")).alias("unique_users")
    )
    return window_columns(merged)


def page_views(df: DataFrame, ts: str, page: str, size: str = "5 minutes") -> DataFrame:
    """Views per window and page; order it when reading."""
    return df.groupBy(F.window(ts, size), F.col(page).alias("page")).agg(F.count("*").alias("page_views"))


def speed_layer_view(df: DataFrame, ts: str, user: str, revenue: str, event: str, size: str = "1 day") -> DataFrame:
    """Recent revenue and events per user and window."""
    return df.groupBy(F.window(ts, size), F.col(user).alias("user_id")).agg(
        C.money_sum(revenue).alias("total_revenue"), F.count(event).alias("event_count")
    )


def fraud_alerts(
    stream: DataFrame, suspicious: Column, ts: str, user: str, amount: str, size: str = "5 minutes", min_count: int = 5
) -> DataFrame:
    """Suspicious rows of users above ``min_count`` rows in the row's window.

    The input carries its watermark. The window side is joined on the time the
    window closes, a single event-time column, which bounds the state of both
    sides; bounds are half-open.
    """
    velocity = tumbling_velocity(stream, ts, user, amount, size).filter(F.col("txn_count") > min_count).select(
        F.col("user_id").alias("_user"),
        F.window_time("window").alias("_closes"),
        F.col("txn_count").alias("recent_txn_count"),
        F.col("total_amount").alias("recent_amount"),
    )
    flagged = stream.filter(suspicious)
    inside = (
        (F.col(user) == F.col("_user"))
        & (F.col(ts) <= F.col("_closes"))
        & (F.col(ts) > F.col("_closes") - F.expr(f"interval {size}"))
    )
    return flagged.join(velocity, inside).drop("_user", "_closes")


def stream_dedup(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop retries that arrive within the watermark of the first delivery."""
    return df.dropDuplicatesWithinWatermark(keys)


def unseen_messages(
    stream: DataFrame, event_key: str, offset_keys: Sequence[str], ts: str | None = None, delay: str = "1 day"
) -> DataFrame:
    """Messages of unseen offsets, and once more, with ``_new``, the first of each unseen event.

    The seen offsets and events are keyed state of the stream, so a batch looks
    up its own keys and no history. With ``ts``, the time a message entered its topic, state older than
    ``delay`` behind the newest message is dropped, and so are messages that come later than
    that: choose a delay longer than any redelivery. Without it the state keeps every key.
    """
    def once(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return df.dropDuplicates(list(keys)) if ts is None else df.dropDuplicatesWithinWatermark(list(keys))

    fresh = once(stream if ts is None else watermark(stream, ts, delay), offset_keys)
    return fresh.withColumn("_new", F.lit(False)).unionByName(once(fresh, [event_key]).withColumn("_new", F.lit(True)))
