"""Deduplication, ranking, set comparison and gaps."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024  # of the fingerprints tables are compared by

def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    ``row_number() = 1`` lets Spark drop all but one row per key and task
    before the exchange, so a hot key costs one row per task. The order must
    end in a unique column for the result to be repeatable.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def dedup_keep_latest(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(name).desc_nulls_last() for name in latest_by])


def dedup_keep_first(df: DataFrame, keys: Sequence[str], first_by: Sequence[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(name).asc_nulls_last() for name in first_by])


def top_pages(events: DataFrame, ts: str, page: str, size: str = "5 minutes", limit: int | None = None) -> DataFrame:
    """Page views per window, most viewed first; ``limit`` makes it a top-k."""
    ranked = (
        events.groupBy(F.window(ts, size)["start"].alias("window_start"), F.col(page).alias("page"))
        .agg(F.count("*").alias("page_views"))
        .orderBy(F.desc("page_views"), "window_start", "page")
    )
    return ranked if limit is None else ranked.limit(limit)


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("row_count"))
        .filter(F.col("row_count") > 1)
        .orderBy(F.desc("row_count"), *keys)
    )


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs, with ``surplus`` = left minus right.

    One signed count over the union: it combines map-side, so many copies of
    one row never meet in one task.
    """
    signed = left.withColumn("_sign", F.lit(1)).unionByName(right.withColumn("_sign", F.lit(-1)))
    return signed.groupBy(*left.columns).agg(F.sum("_sign").alias("surplus")).filter(F.col("surplus") != 0)


def _hashed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns, two hashes of the row that tell NULLs apart, and the bucket."""
    parts = [part for name in columns for part in (F.isnull(name), F.col(name))]
    hashes = {f"_h{seed}": F.xxhash64(F.lit(seed), *parts) for seed in range(2)}
    return df.select(*columns).withColumns(hashes).withColumn("_bucket", F.pmod("_h0", F.lit(BUCKETS)))


def bucket_fingerprints(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``bucket``, ``row_count``, ``low`` and ``high``: sums of row hashes, which no order of rows changes.

    Sums add up over tasks, so a task sends at most ``BUCKETS`` rows on, and
    fingerprints of parts of a table add up to the table's.
    """
    total = [F.sum(F.col(mine).cast("decimal(20,0)")).alias(name) for mine, name in (("_h0", "low"), ("_h1", "high"))]
    return _hashed(df, columns or df.columns).groupBy(F.col("_bucket").alias("bucket")).agg(F.count("*").alias("row_count"), *total)


def differing_buckets(*tables: DataFrame) -> DataFrame:
    """``bucket`` of the rows in which the tables are not the same, ``BUCKETS`` at most."""
    columns = tables[0].columns
    combined = None
    for df in tables:
        mine = bucket_fingerprints(df, columns)
        combined = mine if combined is None else combined.unionByName(mine)
    same = (F.count("*") == len(tables)) & (F.count_distinct("row_count", "low", "high") == 1)
    return combined.groupBy("bucket").agg(same.alias("same")).filter(~F.col("same")).select("bucket")


def tables_equal(*tables: DataFrame) -> DataFrame:
    """One row: whether all tables hold the same rows the same number of times.

    Tables are compared by fingerprints of buckets first: 128 bits of row hashes
    and a count each, which protects against chance, not against rows made to
    collide. Only rows of buckets that differ are exchanged and counted. Without
    such a bucket adaptive execution leaves the row comparison out, so equal
    tables are read once each.
    """
    columns = tables[0].columns
    differing = F.broadcast(differing_buckets(*tables))
    marks = [f"_t{i}" for i in range(len(tables))]
    combined = None
    for mine, df in zip(marks, tables, strict=True):
        marked = _hashed(df, columns).select("_bucket", *columns, *[F.lit(int(mark == mine)).alias(mark) for mark in marks])
        marked = marked.join(differing, F.col("_bucket") == F.col("bucket"), "left_semi").drop("_bucket")
        combined = marked if combined is None else combined.unionByName(marked)
    counts = combined.groupBy(*columns).agg(*[F.sum(mark).alias(mark) for mark in marks])
    differs = F.greatest(*[F.abs(F.col(mark) - F.col(marks[0])) for mark in marks]) > 0
    return counts.agg(F.count_if(differs).alias("differing_rows"), (F.count_if(differs) == 0).alias("equal"))


def runs_agree(job: Callable[[], DataFrame], folder: str, runs: int = 3) -> DataFrame:
    """Run a job several times, keep every result below ``folder``, compare them.

    Results are written before they are compared, so that each is a run of its
    own and not one plan evaluated lazily at the end.
    """
    results = []
    for number in range(runs):
        result = job()
        result.write.mode("overwrite").parquet(f"{folder}/run={number}")
        results.append(result.sparkSession.read.parquet(f"{folder}/run={number}"))
    return tables_equal(*results)


def missing_dates(df: DataFrame, date: Column) -> DataFrame:
    """Days between the first and the last date that have no row."""
    present = df.select(date.cast("date").alias("date")).filter(F.col("date").isNotNull()).distinct()
    expected = present.agg(F.sequence(F.min("date"), F.max("date")).alias("days")).select(
        F.explode("days").alias("date")
    )
    return expected.join(present, "date", "left_anti")
