"""Bronze, silver and gold tables, each derived from the one before."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from millrace.operators.deadletter import Failure, dead_letter_split
from millrace.operators.ranking import dedup_keep_latest
from millrace.operators.transform import add_audit_columns


@dataclass(frozen=True)
class Medallion:
    bronze: DataFrame
    silver: DataFrame
    rejected: DataFrame
    gold: DataFrame


def medallion_tables(
    raw: DataFrame,
    failures: Sequence[Failure],
    keys: Sequence[str],
    latest_by: Sequence[str],
    summarize: Callable[[DataFrame], DataFrame],
    run_at: Column,
    run_date: Column,
) -> Medallion:
    """Raw rows as they came; valid and unique ones; their summary."""
    bronze = add_audit_columns(raw, run_at, run_date)
    valid, rejected = dead_letter_split(raw, failures, run_at)
    silver = dedup_keep_latest(valid, keys, latest_by)
    return Medallion(bronze, silver, rejected, summarize(silver))


def write_medallion(spark: SparkSession, tables: Medallion, path: str) -> None:
    """Write the layers below a folder."""
    for name in ("bronze", "silver", "rejected", "gold"):
        getattr(tables, name).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
