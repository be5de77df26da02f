"""Ranks and contiguous segments of bounded size, for folds over the rows of a key in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import all_of
from millrace.session import materialize


def rank_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str], label: str) -> DataFrame:
    """Add ``_rank``, a row's place in its key's order, counted from 0. Runs a job.

    Rows are dealt into ranges of (key, order), so a key that holds a third of
    the table spans many of them, and are counted off inside each range. What
    a key has in earlier ranges is added; as only the first key of a range can
    have any, that is one row per range at most, and is broadcast. The ranged
    rows are written to the session's shared folder, which keeps ranks the same
    when a task is repeated.
    """
    ranged = rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    written = materialize(ranged, label)
    counts = written.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    names = {key: f"_key_{i}" for i, key in enumerate(keys)}
    before = counts.withColumn("_before", F.sum("_n").over(earlier)).where("_before > 0")
    before = before.select(*[F.col(key).alias(name) for key, name in names.items()], F.col("_range").alias("_in"), "_before")
    same = all_of([F.col(key).eqNullSafe(F.col(name)) for key, name in names.items()]) & (F.col("_range") == F.col("_in"))
    place = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order)) - 1
    joined = written.withColumn("_place", place).join(F.broadcast(before), same, "left")
    rank = F.coalesce("_before", F.lit(0).cast("bigint")) + F.col("_place")
    return joined.withColumn("_rank", rank).drop(*names.values(), "_range", "_in", "_before", "_place")


def cut_segments(rows: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int, label: str) -> DataFrame:
    """Add ``_segment``, numbered from 0 inside a key: ``max_rows`` rows each in order, the last one fewer.

    The cut is by rank: gaps and outliers in ``order`` make no difference.
    """
    ranked = rank_rows(rows, keys, order, label)
    return ranked.withColumn("_segment", F.floor(F.col("_rank") / max_rows)).drop("_rank")
