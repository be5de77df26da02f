"""Dead letters and fallbacks as data operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions import values as V


@dataclass(frozen=True)
class Failure:
    """A row fails when ``condition`` is true; the first match decides."""

    condition: Column
    error: Column
    error_type: str
    category: str = V.UNKNOWN_ERRORS
    metadata: tuple[tuple[str, str], ...] = ()


def _first_match(failures: Sequence[Failure], pick: Callable[[Failure], Column]) -> Column:
    return F.coalesce(*[F.when(f.condition, pick(f)) for f in failures])


def dead_letter_split(
    df: DataFrame, failures: Sequence[Failure], as_of: Column, metadata: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and one dead-letter entry per row that fails."""
    shared = {key: F.lit(value) for key, value in (metadata or {}).items()}

    def described(failure: Failure) -> Column:
        entries = {**shared, **{key: F.lit(value) for key, value in failure.metadata}}
        pairs = [part for key, value in entries.items() for part in (F.lit(key), value)]
        return F.create_map(*pairs) if pairs else F.expr("cast(map() as map<string,string>)")

    category = _first_match(failures, lambda f: F.lit(f.category))
    entries = df.filter(category.isNotNull()).select(
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("message"),
        _first_match(failures, lambda f: f.error).alias("error"),
        _first_match(failures, lambda f: F.lit(f.error_type)).alias("error_type"),
        category.alias("category"),
        as_of.alias("timestamp"),
        _first_match(failures, described).alias("metadata"),
    )
    return df.filter(category.isNull()), entries


def write_dead_letters(entries: DataFrame, path: str) -> None:
    """Append entries, one folder per category."""
    entries.write.mode("append").partitionBy("category").parquet(path)


def dead_letter_reprocess(
    entries: DataFrame,
    category: str,
    schema: StructType | str,
    repair: Callable[[DataFrame], DataFrame],
    failures: Sequence[Failure],
    as_of: Column,
) -> tuple[DataFrame, DataFrame]:
    """Parse a category's messages, repair them and check them again."""
    messages = (
        entries.filter(F.col("category") == category)
        .select(F.from_json("message", schema).alias("record"))
        .select("record.*")
    )
    return dead_letter_split(repair(messages), failures, as_of)


def reprocess_counts(fixed: DataFrame, still_failing: DataFrame) -> DataFrame:
    """One row: how many messages were reprocessed and how many failed again."""
    return (
        fixed.select(F.lit(1).alias("ok"), F.lit(0).alias("bad"))
        .unionByName(still_failing.select(F.lit(0).alias("ok"), F.lit(1).alias("bad")))
        .agg(
            F.coalesce(F.sum("ok"), F.lit(0)).alias("reprocessed"), F.coalesce(F.sum("bad"), F.lit(0)).alias("failed")
        )
    )


def required_field_failures(fields: Sequence[str], metadata: tuple[tuple[str, str], ...] = ()) -> list[Failure]:
    """A validation failure for each required field that is absent."""
    # The message and the kind of error.
    return [
        Failure(F.col(name).isNull(), F.lit(f"Missing required field: {name}"), "ValueError", V.VALIDATION_ERRORS, metadata)
        for name in fields
    ]


def run_summary(df: DataFrame, failures: Sequence[Failure], source: str) -> DataFrame:
    """Loaded and rejected rows per source and rejection category, one pass."""
    category = _first_match(failures, lambda f: F.lit(f.category))
    return df.groupBy(source).agg(
        F.count_if(category.isNull()).alias("success"),
        F.count_if(category.isNotNull()).alias("failed"),
        F.count_if(category == V.VALIDATION_ERRORS).alias("failed_validation"),
        F.count_if(category == V.PROCESSING_ERRORS).alias("failed_processing"),
    )


def popular_items(events: DataFrame, item: str, limit: int = 3) -> DataFrame:
    """One row holding the ``limit`` most frequent items, ties by item."""
    top = events.groupBy(F.col(item).alias("item")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "item").limit(limit)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("rank"), "item")))
    return top.agg(F.transform(ordered, lambda entry: entry["item"]).alias("items"))


def top_items_per_user(events: DataFrame, user: str, item: str, limit: int = 3) -> DataFrame:
    """Each user's most frequent items as an array of at most ``limit``."""
    counts = events.groupBy(F.col(user).alias("user_id"), F.col(item).alias("item")).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("n"), "item"))
    return (
        counts.withColumn("_rank", rank)
        .filter(F.col("_rank") <= limit)
        .groupBy("user_id")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "item"))), lambda e: e["item"]).alias("items"))
    )


def recommend_with_fallback(
    users: DataFrame, model: DataFrame, rules: DataFrame, popular: DataFrame, user: str = "user_id"
) -> DataFrame:
    """First available of model, rules and popular items for every user.

    ``model`` and ``rules`` hold one ``(user, items)`` row per user they cover;
    ``popular`` is a single row, read as a scalar subquery.
    """
    covered = users.join(model.select(user, F.col("items").alias("_model")), user, "left").join(
        rules.select(user, F.col("items").alias("_rules")), user, "left"
    )
    level = F.when(F.col("_model").isNotNull(), "model").when(F.col("_rules").isNotNull(), "rules").otherwise("popular")
    return covered.select(
        *users.columns,
        F.coalesce("_model", "_rules", popular.select("items").scalar()).alias("recommendations"),
        level.alias("source_level"),
    )
