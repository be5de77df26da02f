"""Packing by optimal length buckets.

The global histogram of lengths, on a grid of bounded size, goes to the driver.
Dynamic programming picks the bucket boundaries that minimise padding when
every document is padded to its bucket's boundary. Inside each bucket,
documents form batches of up to ``token_budget`` padded tokens.

A bucket may hold most rows, so each is dealt into parts of about ``part_rows``
by a hash of the key and batches are numbered inside a part: one narrow
exchange, no group beyond a part, at most one unfilled batch per part. A
document longer than the budget is a batch of its own, whole. NULL or empty
texts have 0 tokens and are packed too. Rows equal in every key column take
neighbouring places. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECES = r"[\p{L}\p{M}]+|\p{N}|[^\s\p{L}\p{M}\p{N}]"
EXACT = 256  # lengths up to here are told apart; above, the grid has EXACT / 2 steps per doubling
BUCKETS = 12
TOKEN_BUDGET = 32_768
PART_ROWS = 100_000


def count_tokens(text: Column) -> Column:
    """Runs of letters, digits one by one and signs, as tokenizers split text before merging."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(PIECES)).cast("bigint")


def grid(length: Column) -> Column:
    """The length rounded up to the grid; at most ``EXACT / 2`` values per doubling."""
    step = F.greatest(F.lit(1), F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(length - 1, F.lit(1)))) - int(np.log2(EXACT)) + 1)).cast("bigint")
    return F.when(length <= EXACT, length).otherwise(F.ceil(length / step).cast("bigint") * step).cast("bigint")


def length_histogram(docs: DataFrame, length: str = "n_tokens") -> list[tuple[int, int, int]]:
    """(grid length, documents, tokens) by length. One row per grid value: bounded by the grid."""
    rows = docs.groupBy(grid(F.col(length)).alias("at")).agg(F.count("*").alias("n"), F.sum(length).alias("tokens")).collect()
    return sorted((row["at"], row["n"], row["tokens"]) for row in rows)


def optimal_boundaries(histogram: Sequence[tuple[int, int, int]], buckets: int = BUCKETS) -> list[int]:
    """Boundaries of at most ``buckets`` buckets with the least padding.

    ``best[k][j]`` is the least padding of the first ``j`` lengths in ``k``
    buckets; the last bucket of it starts at the ``i`` that minimises
    ``best[k-1][i] + bound * documents - tokens`` over lengths ``i+1 .. j``.
    """
    if not histogram:
        return []
    at, n, tokens = (np.array(column, dtype=np.float64) for column in zip(*histogram))
    size = len(at)
    docs_to, tokens_to = np.concatenate([[0.0], np.cumsum(n)]), np.concatenate([[0.0], np.cumsum(tokens)])
    cost = at[None, :] * (docs_to[None, 1:] - docs_to[:-1, None]) - (tokens_to[None, 1:] - tokens_to[:-1, None])
    cost[np.tril_indices(size, -1)] = np.inf
    best = cost[0].copy()
    choices = [np.zeros(size, dtype=int)]
    for _ in range(1, min(buckets, size)):
        through = np.concatenate([[0.0], best[:-1]])[:, None] + cost
        choices.append(through.argmin(axis=0))
        best = through.min(axis=0)
    bounds, j = [], size - 1
    for choice in reversed(choices):
        bounds.append(int(at[j]))
        j = int(choice[j]) - 1
        if j < 0:
            break
    return sorted(bounds)


def pack(
    docs: DataFrame,
    keys: Sequence[str],
    text: str = "text",
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    part_rows: int = PART_ROWS,
    tokens: Column | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``keys`` and ``carry`` with ``n_tokens``, ``bucket`` (its padded length), ``batch_id``, ``slot`` and ``padding``.

    ``tokens`` may give the count, for example a tokenizer's. Runs the histogram
    job. Texts move only if they are carried. Columns of the input that are
    named like a result must not be among ``keys`` and are replaced in ``carry``.
    """
    results = ("n_tokens", "bucket", "batch_id", "slot", "padding", "_capacity", "_part", "_place")
    carry = [name for name in carry if name.lower() not in results]
    count = count_tokens(F.col(text)) if tokens is None else F.coalesce(tokens, F.lit(0))
    counted = docs.select(*keys, *carry, count.cast("bigint").alias("n_tokens"))
    histogram = length_histogram(counted)
    bounds = optimal_boundaries(histogram, buckets)
    held = {bound: 0 for bound in bounds}
    for at, n, _ in histogram:
        held[next(bound for bound in bounds if bound >= at)] += n
    bucket, capacity, parts = (F.lit(None).cast("bigint") for _ in range(3))
    for bound in reversed(bounds):
        fits = F.col("n_tokens") <= bound
        bucket = F.when(fits, F.lit(bound)).otherwise(bucket)
        capacity = F.when(fits, F.lit(max(1, token_budget // max(1, bound)))).otherwise(capacity)
        parts = F.when(fits, F.lit(-(-held[bound] // part_rows))).otherwise(parts)
    placed = counted.withColumns({"bucket": bucket.cast("bigint"), "_capacity": capacity.cast("bigint")}).withColumn(
        "_part", F.pmod(F.xxhash64(*keys, "n_tokens"), parts.cast("bigint"))
    )
    place = F.row_number().over(Window.partitionBy("bucket", "_part").orderBy(*keys, "n_tokens")) - 1
    batch = F.concat_ws("-", "bucket", "_part", F.floor(F.col("_place") / F.col("_capacity")))
    return placed.withColumn("_place", place.cast("bigint")).select(
        *keys,
        *carry,
        "n_tokens",
        "bucket",
        batch.alias("batch_id"),
        F.pmod("_place", "_capacity").alias("slot"),
        (F.col("bucket") - F.col("n_tokens")).alias("padding"),
    )
