"""Row-level projections, filters and change routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import columns as C


def add_audit_columns(df: DataFrame, run_at: Column, processing_date: Column) -> DataFrame:
    """Stamp rows with the run's clock, which the caller passes in."""
    return df.withColumns({"processing_date": processing_date, "processed_at": run_at})


def deterministic_projection(df: DataFrame, as_of: Column, with_created_date: bool = False) -> DataFrame:
    """Person records to name, e-mail domain, age and account type."""
    projected = [
        F.col("id").alias("user_id"),
        C.full_name("first_name", "last_name").alias("full_name"),
        C.email_domain("email").alias("email_domain"),
        C.age_in_years("birth_year", as_of).alias("age"),
        C.account_type("is_premium").alias("account_type"),
    ]
    if with_created_date:
        projected.append(C.date_part_of_iso("created_at").alias("created_date"))
    return df.select(*projected)


def is_suspicious(amount: str, location: str, limit: float = 10000.0, pattern: str = "high_risk_country") -> Column:
    return (F.col(amount) > limit) | F.col(location).rlike(pattern)


def suspicious_filter(
    df: DataFrame, amount: str, location: str, limit: float = 10000.0, pattern: str = "high_risk_country"
) -> DataFrame:
    """Keep large amounts and risky locations."""
    return df.filter(is_suspicious(amount, location, limit, pattern))


def recent_window_filter(df: DataFrame, column: str, as_of: Column, days: int) -> DataFrame:
    """Keep the last ``days`` days before ``as_of``; stays a pushable range."""
    return df.filter(F.col(column) >= F.date_sub(as_of, days).cast("timestamp_ntz"))


def split_by_operation(
    changes: DataFrame, key: str = "id", upsert_ops: Sequence[str] = ("c", "u", "r"), delete_op: str = "d"
) -> tuple[DataFrame, DataFrame]:
    """Route change events: new row images, and keys to delete."""
    upserts = changes.filter(F.col("op").isin(*upsert_ops)).select("after.*")
    deletes = changes.filter(F.col("op") == delete_op).select(F.col(f"before.{key}").alias(key))
    return upserts, deletes


def record_transform(df: DataFrame, constants: Mapping[str, Column]) -> DataFrame:
    """Merge constant fields into every record."""
    return df.withColumns(dict(constants))


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))
