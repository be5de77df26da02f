"""Column expressions shared by the operators; all run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
SCALE = 9  # decimals kept by exact sums of columns that need not be money


def as_column(value: Column | str) -> Column:
    """Accept a column name or a Column."""
    return F.col(value) if isinstance(value, str) else value


def money_sum(value: Column | str) -> Column:
    """Sum amounts exactly, so the result does not depend on row order."""
    return F.sum(as_column(value).cast(MONEY)).cast("double")


def exact(value: Column | str, scale: int = SCALE) -> Column:
    """A number as a decimal, so that its sums do not depend on row order."""
    return as_column(value).cast(f"decimal(28,{scale})")


def money_avg(value: Column | str) -> Column:
    """Mean of amounts from an exact sum."""
    column = as_column(value)
    return F.try_divide(money_sum(column), F.count(column).cast("double"))


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / whole * 100``; NULL instead of an error on an empty whole."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)
    return ratio if digits is None else F.round(ratio, digits)


def hash_bucket(key: Column | str, buckets: int | Column) -> Column:
    """Stable bucket number of a key, the same in every engine with SHA-256."""
    digest = F.sha2(as_column(key).cast("string"), 256)
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(buckets) if isinstance(buckets, int) else buckets).cast("bigint")


def content_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over a row's content in sorted column order, NULLs included."""
    ordered = F.struct(*[F.col(name) for name in sorted(columns)])
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)


def full_name(first: Column | str, last: Column | str) -> Column:
    return F.concat_ws(" ", as_column(first), as_column(last))


def email_domain(email: Column | str) -> Column:
    """Text after the first ``@``; NULL when there is none."""
    return F.get(F.split(as_column(email), "@", -1), 1)


def age_in_years(birth_year: Column | str, as_of: Column) -> Column:
    return F.year(as_of) - as_column(birth_year)


def account_type(is_premium: Column | str) -> Column:
    return F.when(as_column(is_premium), "premium").otherwise("basic")


def date_part_of_iso(text: Column | str) -> Column:
    """Date part of an ISO-8601 timestamp string."""
    return F.get(F.split(as_column(text), "T", -1), 0)


def similar_items(items: Column | str, limit: int = 5, prefix: str = "rec_") -> Column:
    """Turn the first ``limit`` items into recommendation ids."""
    return F.transform(F.slice(as_column(items), 1, limit), lambda item: F.concat(F.lit(prefix), item))


def whole_months_between(later: Column, earlier: Column) -> Column:
    """Calendar months between the months two dates fall in."""
    return F.months_between(F.trunc(later, "month"), F.trunc(earlier, "month")).cast("int")


def all_of(conditions: Sequence[Column]) -> Column:
    combined = F.lit(True)
    for condition in conditions:
        combined = combined & condition
    return combined


def any_of(conditions: Sequence[Column]) -> Column:
    combined = F.lit(False)
    for condition in conditions:
        combined = combined | condition
    return combined
