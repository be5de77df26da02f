"""Writes that give the same table however often they run.

Operators return the new content; publishing it is ``sources.tables``' part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import joins, ranking, skew
from millrace.session import materialize


def merge_upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """Update matched keys, insert the others; without a target, create it.

    NULL matches NULL in a key, so that repeating a merge changes nothing. The
    source shrinks to one row per key. Untouched target rows pass through
    an anti-join against the source's keys: when those are few the join
    broadcasts them and the target is not shuffled.
    """
    updates = ranking.dedup_keep_latest(source, keys, latest_by)
    if target is None:
        return updates
    kept = skew.keyed_join(target, updates.select(*keys), keys, "left_anti", null_safe=True)
    return kept.unionByName(updates, allowMissingColumns=True)


def merge_into(table: str, source: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> None:
    """The same upsert as a row-level MERGE, for catalogs whose tables allow it."""
    updates = ranking.dedup_keep_latest(source, keys, latest_by).alias("source")
    matched = C.all_of([F.expr(f"{table}.{key} <=> source.{key}") for key in keys])
    updates.mergeInto(table, matched).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str], first_by: Sequence[str]) -> DataFrame:
    """Add rows whose key is new; existing rows stay as they are.

    The source shrinks to one row per key before it meets the target.
    """
    firsts = ranking.dedup_keep_first(source, keys, first_by)
    return target.unionByName(joins.anti_join_ledger(firsts, target, keys), allowMissingColumns=True)


def latest_changes(changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last change event of every key, the key taken from either image."""
    keyed = changes.withColumn("_key", F.coalesce(f"after.{key}", f"before.{key}"))
    return ranking.dedup_keep_latest(keyed, ["_key"], order)


def cdc_apply(target: DataFrame, changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Apply create, update, snapshot-read and delete events to a table; NULL matches NULL in the key."""
    last = latest_changes(changes, key, order)
    kept = skew.keyed_join(target, last.select(F.col("_key").alias(key)), [key], "left_anti", null_safe=True)
    upserts = last.filter(F.col("op").isin("c", "u", "r")).select("after.*")
    return kept.unionByName(upserts, allowMissingColumns=True)


def first_write_wins(requests: DataFrame, ledger: DataFrame | None, key: str, arrival: Sequence[str]) -> DataFrame:
    """Requests to carry out: the first of every key the ledger lacks."""
    firsts = ranking.dedup_keep_first(requests, [key], arrival)
    return firsts if ledger is None else joins.anti_join_ledger(firsts, ledger, [key])


def replay_results(requests: DataFrame, ledger: DataFrame, key: str, request_id: str) -> DataFrame:
    """Every request with its key's stored result; repeats are ``replayed``.

    ``ledger`` holds one row per key and carries the id of the winning request
    as ``first_<request_id>``.
    """
    answered = skew.lookup_join(requests.select(key, request_id), ledger, [key])
    return answered.withColumn("replayed", F.col(request_id) != F.col(f"first_{request_id}"))


def content_hash_dedup(df: DataFrame, content: Sequence[str], first_by: Sequence[str]) -> DataFrame:
    """Keep the first of the rows with equal content."""
    hashed = df.withColumn("content_hash", C.content_hash(content))
    return ranking.dedup_keep_first(hashed, ["content_hash"], first_by)


def apply_one_update(
    target: DataFrame, updates: DataFrame, key: str, expected: str, values: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Version-gated update with at most one update per key; return the new table and the verdicts.

    ``target`` has ``version``; a key it lacks is at version 0. A verdict, one
    per update, is ``applied``, ``already_updated`` (current is newer) or
    ``conflict`` (current is older). A rejected update changes nothing, also
    for a key that the target lacks.
    """
    proposed = updates.select(
        key, F.col(expected).alias("_expected"), *[F.col(name).alias(f"_new_{name}") for name in values]
    )
    known = target.withColumn("_known", F.lit(True))
    joined = known.join(proposed, key, "full_outer").withColumn("version", F.coalesce("version", F.lit(0).cast("bigint")))
    verdict = (
        F.when(F.col("_expected").isNull(), "untouched")
        .when(F.col("version") > F.col("_expected"), "already_updated")
        .when(F.col("version") < F.col("_expected"), "conflict")
        .otherwise("applied")
    )
    applied = F.col("verdict") == "applied"
    judged = joined.withColumn("verdict", verdict)
    table = judged.filter(applied | F.col("_known")).select(
        key,
        F.when(applied, F.col("version") + 1).otherwise(F.col("version")).alias("version"),
        *[F.when(applied, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name) for name in values],
    )
    return table, judged.filter(F.col("verdict") != "untouched").select(key, "verdict")


OFFSET_KEYS = ("topic", "partition", "offset")


def offset_ledger_apply(messages: DataFrame, ledger: DataFrame | None, event_key: str, offset_keys: Sequence[str] = OFFSET_KEYS) -> DataFrame:
    """Messages to record: unseen offsets, flagged where the event is new.

    ``ledger`` is the table this appends to, so data and offsets are one
    write: rows with ``inserted`` are the data, all rows are the ledger. For bounded loads: the whole ledger's
    keys are read, as an event may have come at any offset before. Streams keep
    them as state (``streaming.views.unseen_messages``). The unseen
    messages, needed twice, are written once to the session's shared folder.
    """
    offsets = list(offset_keys)
    fresh = messages if ledger is None else joins.anti_join_ledger(messages, ledger, offsets)
    fresh = materialize(ranking.dedup_keep_first(fresh, offsets, [event_key]), "fresh-messages")
    firsts = ranking.dedup_keep_first(fresh.select(event_key, *offsets), [event_key], offsets)
    if ledger is not None:
        firsts = joins.anti_join_ledger(firsts, ledger.filter("inserted"), [event_key])
    winners = firsts.select(*offsets).withColumn("inserted", F.lit(True))
    return fresh.join(winners, offsets, "left").fillna({"inserted": False})


def inserted_once(marked: DataFrame, event_key: str, offset_keys: Sequence[str] = OFFSET_KEYS) -> DataFrame:
    """Unseen messages with ``inserted``: the first, by offset, of an event that has a ``_new`` row.

    ``marked`` holds every unseen message with ``_new`` false and one more row,
    ``_new`` true, per unseen event; whichever message that row repeats.
    """
    at = F.struct(*offset_keys)
    events = marked.groupBy(event_key).agg(F.bool_or("_new").alias("_fresh"), F.min(at).alias("_first"))
    joined = skew.lookup_join(marked.filter(~F.col("_new")), events, [event_key], null_safe=True)
    return joined.withColumn("inserted", F.col("_fresh") & (at == F.col("_first"))).drop("_new", "_fresh", "_first")


def process_order_once(
    stock: DataFrame,
    order_lines: DataFrame,
    processed: DataFrame,
    order_id: str,
    line_keys: Sequence[str],
    product: str,
    quantity: str,
) -> tuple[DataFrame, DataFrame]:
    """Decrement stock by orders not processed before; return stock and ledger.

    ``line_keys`` identify an order line, so a line delivered twice within the
    batch also counts once.
    """
    fresh = joins.anti_join_ledger(order_lines, processed, [order_id])
    once = ranking.dedup_keep_first(fresh, line_keys, [quantity])
    taken = once.groupBy(product).agg(F.sum(quantity).alias("_taken"))
    updated = stock.join(taken, product, "left").withColumn("on_hand", F.col("on_hand") - F.coalesce("_taken", F.lit(0)))
    return updated.drop("_taken"), processed.select(order_id).unionByName(once.select(order_id).distinct())
