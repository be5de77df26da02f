"""Joins of rows with a per-key lookup when a few keys hold most rows.

AQE splits a skewed join partition only where both sides come straight from an
exchange. A lookup that was grouped or ranked by the join key does not: its
exchange lies below the aggregation. These joins spread hot keys themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.columns import all_of

# A key is hot from this share of the rows on, so there are at most 1 / share
# hot keys, and from this many rows on, so small inputs have none.
HOT_SHARE = 1e-4
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, min_rows: int = HOT_ROWS) -> DataFrame | None:
    """Hashes of the hot keys and the parts to spread each over, or None.

    One pass over the key columns into a sketch of bounded size: no exchange
    of the keys, and at most ``1 / share`` entries come to the driver. Which
    keys are found decides only where rows are processed, never the result.
    """
    limit = round(1 / share)
    found = (
        df.select(F.xxhash64(*keys).alias("_hash"))
        .agg(F.expr(f"approx_top_k(_hash, {limit}, {limit * 10})").alias("top"), F.count("*").alias("n"))
        .first()
    )
    size = max(found.n * share, min_rows)
    hot = [(entry["item"], -(-entry["count"] // int(size))) for entry in found.top if entry["count"] > size]
    return df.sparkSession.createDataFrame(hot, "_hash bigint, _parts bigint") if hot else None


def add_salt(df: DataFrame, keys: Sequence[str], hot: DataFrame | None) -> DataFrame:
    """Number rows of hot keys with one of the key's parts, others with zero.

    The number hashes the row and the partition it is read in, so that equal
    rows spread too and a repeated task gives the same numbers.
    """
    if hot is None:
        return df.withColumn("_salt", F.lit(0).cast("bigint"))
    part = F.pmod(F.xxhash64(*_hashable(df), F.spark_partition_id()), F.col("_parts"))
    marked = df.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(hot), "_hash", "left")
    return marked.withColumn("_salt", F.coalesce(part, F.lit(0).cast("bigint"))).drop("_hash", "_parts")


def add_all_salts(
    lookup: DataFrame, keys: Sequence[str], hot: DataFrame | None, types: StructType | None = None
) -> DataFrame:
    """Repeat lookup rows of hot keys once per part.

    ``types`` is the schema of the rows where the lookup's key types may
    differ: equal numbers of different types have different hashes.
    """
    if hot is None:
        return lookup.withColumn("_salt", F.lit(0).cast("bigint"))
    alike = [F.col(name) if types is None else F.col(name).try_cast(types[name].dataType) for name in keys]
    marked = lookup.withColumn("_hash", F.xxhash64(*alike)).join(F.broadcast(hot), "_hash", "left")
    parts = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1).cast("bigint")) - 1)
    return marked.withColumn("_salt", F.explode(parts)).drop("_hash", "_parts")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join rows with a lookup (inner, left, left_semi or left_anti).

    ``null_safe`` lets a NULL key meet a NULL key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread the rows of a {how} join")
    keys = list(keys)
    hot = hot_keys(rows, keys, share, min_rows)
    if hot is None:
        return keyed_join(rows, lookup, keys, how, null_safe)
    salted, repeated = add_salt(rows, keys, hot), add_all_salts(lookup, keys, hot, rows.schema)
    return keyed_join(salted, repeated, [*keys, "_salt"], how, null_safe).drop("_salt")


def keyed_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Join on equal names, keeping the left side's key columns."""
    if not null_safe:
        return left.join(right, list(keys), how)
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for name in keys})
    condition = all_of([F.col(name).eqNullSafe(F.col(f"_right_{name}")) for name in keys])
    return left.join(renamed, condition, how).drop(*[f"_right_{name}" for name in keys])


def _hashable(df: DataFrame) -> list[str]:
    """Columns Spark can hash: all but those holding maps or variants."""
    return [f.name for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
