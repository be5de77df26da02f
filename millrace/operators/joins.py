"""Joins against lookups, parents and ledgers.

A hot key only swells the left side of these joins. Where both sides are read
as they are, AQE splits the left side's partition at run time; where the right
side is an aggregate of the join key, ``skew.lookup_join`` spreads hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import skew


def join_back_aggregate(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Attach each key's aggregates to its rows. Runs a job: a sketch over the keys finds hot ones.

    A join and not a window: the aggregate combines map-side and hot keys can
    be spread, where a window would sort a hot key within one task.
    """
    return skew.lookup_join(df, df.groupBy(*keys).agg(*aggregates), keys)


def fraud_interval_join(
    transactions: DataFrame,
    suspicious: Column,
    ts: str,
    user: str,
    amount: str,
    size: str = "5 minutes",
    min_count: int = 5,
) -> DataFrame:
    """Suspicious rows whose user has more than ``min_count`` rows in the window. Runs a job: a sketch finds hot keys.

    Windows are half-open, so "ts inside [start, end)" is equality of the
    window a row falls in: an equi-join, with no range comparison left.
    """
    windowed = transactions.withColumn("_window", F.window(ts, size))
    velocity = (
        windowed.groupBy("_window", user)
        .agg(F.count("*").alias("recent_txn_count"), C.money_sum(amount).alias("recent_amount"))
        .filter(F.col("recent_txn_count") > min_count)
    )
    return skew.lookup_join(windowed.filter(suspicious), velocity, ["_window", user]).drop("_window")


def trailing_velocity(df: DataFrame, ts: str, user: str, seconds: int) -> DataFrame:
    """Rows of the same user in the trailing ``seconds`` before and at each row.

    Rows are first counted per user and whole second, which combines map-side.
    Each second then visits the bucket it lies in and the next one, so a window
    sorts at most ``2 * seconds`` rows however hot the user is.
    """
    per_second = (
        df.filter(F.col(user).isNotNull() & F.col(ts).isNotNull())
        .groupBy(F.col(user).alias(user), F.date_trunc("second", F.col(ts)).cast(df.schema[ts].dataType).alias("_second"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_epoch", F.unix_seconds(F.col("_second").cast("timestamp")))
    )
    own = F.floor(F.col("_epoch") / seconds)
    spread = per_second.withColumn("_bucket", F.explode(F.array(own, own + 1)))
    trailing = F.expr(
        f"sum(_n) over (partition by `{user}`, _bucket order by _epoch range between {seconds - 1} preceding and current row)"
    )
    return (
        spread.withColumn("trailing_count", trailing)
        .filter(F.col("_bucket") == own)
        .select(user, F.col("_second").alias("second"), F.col("_n").alias("row_count"), "trailing_count")
    )


def orphan_rows(child: DataFrame, parent: DataFrame, foreign_key: str, primary_key: str) -> DataFrame:
    """Child rows without a parent; a NULL key has none.

    NULL keys skip the join: they would otherwise all hash to one partition.
    """
    parents = parent.select(F.col(primary_key).alias(foreign_key))
    unkeyed = child.filter(F.col(foreign_key).isNull())
    return child.filter(F.col(foreign_key).isNotNull()).join(parents, foreign_key, "left_anti").unionByName(unkeyed)


def valid_child_rows(child: DataFrame, parent: DataFrame, foreign_key: str, primary_key: str) -> DataFrame:
    """Child rows with a parent, once each even when the parent key repeats."""
    parents = parent.select(F.col(primary_key).alias(foreign_key))
    return child.filter(F.col(foreign_key).isNotNull()).join(parents, foreign_key, "left_semi")


def orphan_placeholder(
    child: DataFrame, parent: DataFrame, foreign_key: str, primary_key: str, defaults: dict[str, Column]
) -> DataFrame:
    """The parent table plus one default row for every key only children know."""
    missing = (
        child.filter(F.col(foreign_key).isNotNull())
        .select(F.col(foreign_key).alias(primary_key))
        .distinct()
        .join(parent.select(primary_key), primary_key, "left_anti")
    )
    filled = missing.select(
        *[
            F.col(field.name)
            if field.name == primary_key
            else defaults.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in parent.schema.fields
        ]
    )
    return parent.unionByName(filled)


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """Hint a broadcast when the table is small in rows and, as JSON, in bytes.

    Reads at most ``max_rows + 1`` rows to find out; a larger table comes back
    without the hint and joins by shuffle.
    """
    size = df.limit(max_rows + 1).agg(
        F.count("*").alias("rows"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")
    ).first()
    return F.broadcast(df) if size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes else df


def broadcast_dim_join(
    facts: DataFrame, dimension: DataFrame, on: str | Sequence[str], how: str = "inner", max_rows: int = 100_000
) -> DataFrame:
    """Join a dimension, by broadcast behind a check of its size."""
    return facts.join(broadcast_if_small(dimension, max_rows), on, how)


def anti_join_ledger(df: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the ledger has not recorded; NULL-safe on the key."""
    return skew.keyed_join(df, ledger.select(*keys), keys, "left_anti", null_safe=True)
