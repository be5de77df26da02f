"""Grouped aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import segments, skew


def daily_sales_summary(
    sales: DataFrame,
    keys: Sequence[str] = ("store_id", "product_category"),
    amount: str = "amount",
    transaction: str = "transaction_id",
    customer: str = "customer_id",
) -> DataFrame:
    """Sales per store and category.

    The one distinct count makes Spark group by (keys, customer) first, so the
    first exchange already spreads a hot store over its customers.
    """
    return sales.groupBy(*keys).agg(
        C.money_sum(amount).alias("total_sales"),
        F.count(transaction).alias("num_transactions"),
        C.money_avg(amount).alias("avg_transaction_value"),
        F.countDistinct(customer).alias("unique_customers"),
        F.max(amount).alias("max_transaction"),
        F.min(amount).alias("min_transaction"),
    )


def cohort_retention(transactions: DataFrame, customer: str, date: str, amount: str) -> DataFrame:
    """Retention by month of first purchase and whole months since.

    Rows collapse to one per customer and calendar month before anything else,
    so "customers active in a month" is a plain count, the first month is a
    window over a handful of rows, and the cohort size is the cohort's month
    zero: no join back to the transactions and no distinct count.
    """
    per_month = transactions.groupBy(
        F.col(customer).alias("_customer"), F.trunc(F.col(date), "month").alias("_month")
    ).agg(F.sum(F.col(amount).cast(C.MONEY)).alias("_revenue"), F.count("*").alias("_transactions"))
    cohort = F.min("_month").over(Window.partitionBy("_customer"))
    cells = (
        per_month.withColumn("cohort_month", cohort)
        .groupBy("cohort_month", C.whole_months_between(F.col("_month"), F.col("cohort_month")).alias("months_since"))
        .agg(
            F.count("*").alias("active_customers"),
            F.sum("_revenue").cast("double").alias("total_revenue"),
            F.sum("_transactions").alias("transactions"),
        )
    )
    at_start = F.max(F.when(F.col("months_since") == 0, F.col("active_customers")))
    return cells.withColumn("cohort_size", at_start.over(Window.partitionBy("cohort_month"))).select(
        "cohort_month",
        "months_since",
        "active_customers",
        "total_revenue",
        F.try_divide("total_revenue", "transactions").alias("avg_transaction"),
        F.try_divide("total_revenue", "active_customers").alias("avg_revenue_per_customer"),
        "cohort_size",
        C.percent(F.col("active_customers"), F.col("cohort_size")).alias("retention_rate"),
    )


def user_day_metrics(events: DataFrame, user: str, date: Column, revenue: str, event: str) -> DataFrame:
    """Batch view: revenue and events per user and day."""
    return events.groupBy(F.col(user).alias("user_id"), date.alias("date")).agg(
        C.money_sum(revenue).alias("total_revenue"), F.count(event).alias("event_count")
    )


def serve_merged_view(batch_view: DataFrame, speed_view: DataFrame, cutoff: Column) -> DataFrame:
    """Totals per user: batch days before the cutoff plus speed windows from it.

    Both views carry ``total_revenue`` and ``event_count``; the batch view has
    ``date``, the speed view ``window_start``.
    """
    wanted = ["user_id", "total_revenue", "event_count"]
    history = batch_view.filter(F.col("date") < cutoff).select(*wanted)
    recent = speed_view.filter(F.col("window_start") >= cutoff).select(*wanted)
    return (
        history.unionByName(recent)
        .groupBy("user_id")
        .agg(
            F.coalesce(C.money_sum("total_revenue"), F.lit(0.0)).alias("total_revenue"),
            F.coalesce(F.sum("event_count"), F.lit(0)).alias("total_events"),
        )
    )


def table_profile(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Mean, sample deviation, bounds and count of several columns in one pass."""
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.round(F.avg(name), digits).alias("mean"),
            F.round(F.stddev(name), digits).alias("stddev"),
            F.min(name).cast("double").alias("min"),
            F.max(name).cast("double").alias("max"),
            F.count(name).alias("count"),
        )
        for name in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).selectExpr("inline(rows)")


def distinct_row_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct().agg(F.count("*").alias("distinct_rows"))


def max_event_time(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("max_event_time"))


def item_entries(
    events: DataFrame, ts: str, user: str, item: str, event: str, size: str = "30 minutes", part_rows: int = 10_000
) -> DataFrame:
    """``(ts, event, item)`` entries per window and user, in parts numbered from 0 in event order.

    A part holds ``part_rows`` entries, the last one fewer: contiguous, so the
    recent ones are in the highest parts, and of a grain that does not change
    with the group's size. A group without items has one empty part. Runs a job
    that writes the ranged entries to the session's shared folder.
    """
    entry = F.struct(F.col(ts).alias("ts"), F.col(event).alias("event"), F.col(item).cast("string").alias("item"))
    windowed = events.select(
        F.window(ts, size)["start"].alias("window_start"),
        F.col(user).alias("user_id"),
        F.when(F.col(item).isNotNull(), entry).alias("_entry"),
    )
    group = ["window_start", "user_id"]
    counts = windowed.groupBy(*group).agg(F.count("_entry").alias("interaction_count"))
    cut = segments.cut_segments(windowed.where("_entry IS NOT NULL"), group, ["_entry"], part_rows, "item-entries")
    listed = cut.groupBy(*group, F.col("_segment").alias("part")).agg(F.array_sort(F.collect_list("_entry")).alias("entries"))
    joined = skew.keyed_join(counts, listed, group, "left", null_safe=True)
    nothing = F.array().cast(listed.schema["entries"].dataType)
    return joined.select(
        *group, F.coalesce("part", F.lit(0).cast("bigint")).alias("part"), F.coalesce("entries", nothing).alias("entries"), "interaction_count"
    )


def collect_recent_items(
    events: DataFrame, ts: str, user: str, item: str, event: str, size: str = "30 minutes", part_rows: int = 10_000
) -> DataFrame:
    """Items per window and user in parts, with the group's item count."""
    parts = item_entries(events, ts, user, item, event, size, part_rows)
    items = F.transform("entries", lambda entry: entry["item"])
    return parts.withColumn("entries", items).withColumnRenamed("entries", "recent_items")


def first_entries(events: DataFrame, ts: str, user: str, item: str, event: str, size: str, keep: int) -> DataFrame:
    """Item count and the first ``keep`` ``(ts, event, item)`` entries per window and user.

    Ranking stops at ``keep`` before the exchange, so a hot group ships at most
    ``keep`` rows per task. A group without items has none.
    """
    entry = F.struct(F.col(ts).alias("ts"), F.col(event).alias("event"), F.col(item).cast("string").alias("item"))
    group = ["window_start", "user_id"]
    windowed = events.select(
        F.window(ts, size)["start"].alias("window_start"), F.col(user).alias("user_id"), F.when(F.col(item).isNotNull(), entry).alias("_entry")
    )
    counts = windowed.groupBy(*group).agg(F.count("_entry").alias("interaction_count"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("_entry"))
    kept = windowed.where("_entry IS NOT NULL").withColumn("_rank", rank).filter(F.col("_rank") <= keep)
    listed = kept.groupBy(*group).agg(F.array_sort(F.collect_list("_entry")).alias("entries"))
    joined = skew.keyed_join(counts, listed, group, "left", null_safe=True)
    return joined.withColumn("entries", F.coalesce("entries", F.array().cast(listed.schema["entries"].dataType)))


def merge_entries(parts: DataFrame, keep: int) -> DataFrame:
    """Total count and first ``keep`` entries of the parts of each window and user.

    A part holds ``keep`` entries at most, so a group gathers ``keep`` per part that it is in.
    """
    together = F.array_sort(F.flatten(F.collect_list("entries")))
    return parts.groupBy("window_start", "user_id").agg(
        F.sum("interaction_count").alias("interaction_count"), F.slice(together, 1, keep).alias("entries"), F.max("batch_id").alias("batch_id")
    )


def first_items(events: DataFrame, ts: str, user: str, item: str, event: str, size: str, limit: int = 5) -> DataFrame:
    """The first ``limit`` items per window and user, in event order.

    Ranking stops at ``limit`` before the exchange, so a hot group ships at
    most ``limit`` rows per task.
    """
    windowed = events.select(
        F.window(ts, size)["start"].alias("window_start"),
        F.col(user).alias("user_id"),
        F.col(ts).alias("_ts"),
        F.col(event).alias("_event"),
        F.col(item).cast("string").alias("_item"),
    ).filter(F.col("_item").isNotNull())
    rank = F.row_number().over(Window.partitionBy("window_start", "user_id").orderBy("_ts", "_event"))
    return (
        windowed.withColumn("_rank", rank)
        .filter(F.col("_rank") <= limit)
        .groupBy("window_start", "user_id")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "_item"))), lambda e: e["_item"]).alias("items"))
    )
