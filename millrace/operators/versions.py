"""Optimistic locking: apply an update only at the version it expects.

Whether an update applies depends on all earlier ones of its record, so each
record is a fold over its updates in order. Records are cut by rank into segments of
bounded size. A segment acts on the version it is entered
with as a function, and such functions compose: entry versions follow from the
segments' maps, composed in a tree, and then every segment folds on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators import skew
from millrace.operators.segments import cut_segments
from millrace.session import materialize

WIDTH = 1024  # versions per bucket of a map


def summarize_segment(expected: Sequence[int]) -> list[tuple[int, int, int]]:
    """What a segment does to the version it is entered with.

    Returns ``(low, high, out)`` runs: entering at a version inside a run
    leaves at ``out``; any other version passes unchanged.
    """
    leaves: dict[int, int] = {}
    for version in reversed(expected):
        leaves[version] = leaves.get(version + 1, version + 1)
    runs: list[tuple[int, int, int]] = []
    for version in sorted(leaves):
        out = leaves[version]
        if runs and runs[-1][1] == version - 1 and runs[-1][2] == out:
            runs[-1] = (runs[-1][0], version, out)
        else:
            runs.append((version, version, out))
    return runs


def _segment_runs(segments: pa.Array) -> pa.Array:
    """The runs of every segment of an Arrow batch."""
    runs = [[dict(zip(("low", "high", "leave"), run, strict=True)) for run in summarize_segment(expected)] for expected in segments.to_pylist()]
    return pa.array(runs, pa.list_(pa.struct([(name, pa.int64()) for name in ("low", "high", "leave")])))


def _in_buckets(runs: DataFrame) -> DataFrame:
    """Runs cut at multiples of ``WIDTH``: a bucket of a map holds ``WIDTH`` runs at most, as they do not overlap."""
    each = F.explode(F.sequence(F.floor(F.col("low") / WIDTH), F.floor(F.col("high") / WIDTH)))
    cut = runs.withColumn("bucket", each)
    begin, end = F.col("bucket") * WIDTH, F.col("bucket") * WIDTH + (WIDTH - 1)
    return cut.withColumns({"low": F.greatest("low", begin), "high": F.least("high", end)})


def _leave_by(early: DataFrame, late: DataFrame) -> DataFrame:
    """The early runs with ``leave`` as the later map takes it on.

    Each run asks at the version it leaves at. Versions that different runs of a map
    leave at are different, so a bucket is asked ``WIDTH`` times at most.
    """
    asked = early.select("_key", "parent", F.floor(F.col("leave") / WIDTH).alias("at_bucket"), F.col("leave").alias("at"),
                         F.struct("bucket", "low", "high").alias("run"), F.lit(None).cast("struct<high: bigint, leave: bigint>").alias("known"))
    known = late.select("_key", "parent", F.col("bucket").alias("at_bucket"), F.col("low").alias("at"),
                        F.lit(None).cast("struct<bucket: bigint, low: bigint, high: bigint>").alias("run"), F.struct("high", "leave").alias("known"))
    so_far = Window.partitionBy("_key", "parent", "at_bucket").orderBy("at", F.col("run").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = asked.unionByName(known).withColumn("met", F.last("known", ignorenulls=True).over(so_far)).where("run IS NOT NULL")
    leave = F.when(F.col("met.high") >= F.col("at"), F.col("met.leave")).otherwise(F.col("at"))
    return met.select("_key", "parent", "run.*", leave.alias("leave"))


def _overlay(early: DataFrame, late: DataFrame) -> DataFrame:
    """Runs of both maps; where early ones lie, the late ones do not count. Touching runs that leave alike become one."""
    def edges(runs: DataFrame, name: str, other: str) -> DataFrame:
        kind = "struct<leave: bigint>"
        starts = F.struct(F.col("low").alias("at"), F.lit(True).alias("starts"), F.struct("leave").alias("piece"))
        ends = F.struct((F.col("high") + 1).alias("at"), F.lit(False).alias("starts"), F.struct(F.lit(None).cast("bigint").alias("leave")).alias("piece"))
        edge = runs.select("_key", "parent", "bucket", F.explode(F.array(starts, ends)).alias("edge"))
        return edge.select("_key", "parent", "bucket", "edge.at", "edge.starts", F.col("edge.piece").alias(name), F.lit(None).cast(kind).alias(other))

    bucket = Window.partitionBy("_key", "parent", "bucket").orderBy("at", "starts")
    so_far = bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    leave = F.coalesce(F.last("early", ignorenulls=True).over(so_far)["leave"], F.last("late", ignorenulls=True).over(so_far)["leave"])
    pieces = edges(early, "early", "late").unionByName(edges(late, "late", "early")).select(
        "_key", "parent", "bucket", F.col("at").alias("low"), (F.lead("at").over(bucket) - 1).alias("high"), leave.alias("leave"), "starts"
    ).where("leave IS NOT NULL AND high >= low")
    # The pieces of a bucket stay in its task: these windows need no exchange.
    in_order = Window.partitionBy("_key", "parent", "bucket").orderBy("low")
    goes_on = (F.lag("high").over(in_order) == F.col("low") - 1) & (F.lag("leave").over(in_order) == F.col("leave"))
    marked = pieces.withColumn("new", F.when(goes_on, 0).otherwise(1))
    numbered = marked.withColumn("island", F.sum("new").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("_key", "parent", "bucket", "island").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.first("leave").alias("leave")).drop("island")


def _entry_versions(rows: DataFrame) -> DataFrame:
    """Entry version per key and segment, for keys cut into segments.

    A segment is a map of versions, summarised from three narrow columns. Maps of
    neighbours are composed, level by level, to the map of the whole record;
    then entry versions go down the levels: the first half of a node is entered
    as the node is, the second where the first half's map leads. A map is rows
    (key, node, bucket of versions, run), so a record's maps are spread over
    tasks however many runs they have, and no group exceeds a few ``WIDTH``.
    """
    order = [name for name in rows.columns if name.startswith("_o")]
    known = rows.filter(F.col("_expected").isNotNull()).select("_key", "_segment", F.struct(*order, "_expected").alias("step"))
    steps = known.groupBy("_key", F.col("_segment").alias("node")).agg(F.array_sort(F.collect_list("step"))["_expected"].alias("expected"))
    # Batches of segments go to Python: a group of its own for each would cost milliseconds.
    summaries = F.arrow_udf(_segment_runs, "array<struct<low: bigint, high: bigint, leave: bigint>>")
    runs = steps.select("_key", "node", F.inline(summaries("expected")))
    records = materialize(rows.groupBy("_key").agg(F.max("_segment").alias("last"), F.first("_start").alias("version")), "versioned-records")
    largest = records.agg(F.max("last")).scalar()
    levels, last = [materialize(_in_buckets(runs), "version-maps")], records.select(largest).first()[0]
    while last >> len(levels) - 1:
        halves = levels[-1].withColumns({"parent": F.floor(F.col("node") / 2), "late": F.col("node") % 2 == 1}).drop("node")
        early, late = halves.where(~F.col("late")).drop("late"), halves.where("late").drop("late")
        composed = _overlay(_leave_by(early, late), late).withColumnRenamed("parent", "node")
        levels.append(materialize(composed, "version-maps"))
    entries = records.select("_key", F.lit(0).cast("bigint").alias("node"), "last", "version")
    for depth in range(len(levels) - 2, -1, -1):
        first = entries.withColumn("node", F.col("node") * 2)
        second = first.where(F.col("node") + 1 <= F.floor(F.col("last") / 2**depth)).withColumn("bucket", F.floor(F.col("version") / WIDTH))
        asked = second.select("_key", "node", "bucket", "version").withColumnsRenamed({"_key": "_asked", "node": "_of", "bucket": "_in", "version": "_at"})
        inside = F.col("_at").between(F.col("low"), F.col("high"))
        same = F.col("_key").eqNullSafe(F.col("_asked")) & (F.col("node") == F.col("_of")) & (F.col("bucket") == F.col("_in")) & inside
        led = levels[depth].join(asked, same).select("_key", "node", "leave")
        moved = skew.keyed_join(second.drop("bucket"), led, ["_key", "node"], "left", null_safe=True)
        moved = moved.select("_key", (F.col("node") + 1).alias("node"), "last", F.coalesce("leave", "version").alias("version"))
        entries = materialize(first.unionByName(moved), "version-entries")
    return entries.select("_key", F.col("node").alias("_segment"), F.col("version").alias("_entry"))


def version_gated_update(
    updates: DataFrame,
    key: str,
    expected: str,
    order: Sequence[str],
    current: DataFrame | None = None,
    max_rows: int = 2_000,
) -> DataFrame:
    """Judge updates in order; add ``current_version`` and ``verdict``.

    ``applied`` raises the version by one; ``already_updated`` met a newer
    version, ``conflict`` an older one. ``current`` may give ``(key, version)``
    of existing records. The order is unique within a key. Runs jobs: the
    updates are cut by rank into segments of ``max_rows``, whatever their
    positions, and keys with several segments are looked up; those have their
    segments summarised.
    """
    rows = updates.select(
        F.col(key).alias("_key"),
        F.col(expected).cast("bigint").alias("_expected"),
        *[F.col(name).alias(f"_o{i}") for i, name in enumerate(order)],
        F.struct(*updates.columns).alias("_row"),
    )
    if current is None:
        rows = rows.withColumn("_start", F.lit(0).cast("bigint"))
    else:
        versions = current.select(F.col(key).alias("_key"), F.col("version").cast("bigint").alias("_start"))
        rows = skew.lookup_join(rows, versions, ["_key"], "left", null_safe=True).withColumn("_start", F.coalesce("_start", F.lit(0).cast("bigint")))

    rows = cut_segments(rows, ["_key"], [f"_o{i}" for i in range(len(order))], max_rows, "versioned-updates")
    several = rows.filter("_segment > 0").select("_key").distinct()
    if several.isEmpty():
        rows = rows.withColumn("_entry", F.col("_start"))
    else:
        entries = _entry_versions(skew.keyed_join(rows, several, ["_key"], "left_semi", null_safe=True))
        rows = skew.keyed_join(rows, entries, ["_key", "_segment"], "left", null_safe=True).withColumn("_entry", F.coalesce("_entry", "_start"))

    ordered = F.array_sort(F.collect_list(F.struct(*[f"_o{i}" for i in range(len(order))], "_expected", "_row")))
    segments = (
        rows.repartition("_key", "_segment")
        .groupBy("_key", "_segment")
        .agg(ordered.alias("_steps"), F.first("_entry").alias("_entry"))
    )

    def follow(state: Column, step: Column) -> Column:
        applies = F.coalesce(state["version"] == step["_expected"], F.lit(False))
        return F.struct(
            (state["version"] + applies.cast("bigint")).alias("version"),
            F.concat(state["trace"], F.when(applies, "1").otherwise("0")).alias("trace"),
        )

    # The fold leaves one character per update; an array would be copied whole
    # at every step.
    start = F.struct(F.col("_entry").alias("version"), F.lit("").alias("trace"))
    traced = segments.withColumn("_trace", F.aggregate("_steps", start, follow, lambda state: state["trace"]))
    steps = traced.select("_key", "_segment", "_entry", "_trace", F.posexplode("_steps").alias("_at", "_step"))
    applied = F.substring("_trace", F.col("_at") + 1, F.lit(1)).cast("bigint")
    earlier = Window.partitionBy("_key", "_segment").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    version = F.col("_entry") + F.coalesce(F.sum(applied).over(earlier), F.lit(0).cast("bigint"))
    verdict = (
        F.when(F.col("current_version") > F.col("_step._expected"), "already_updated")
        .when(F.col("current_version") == F.col("_step._expected"), "applied")
        .otherwise("conflict")
    )
    judged = steps.withColumn("current_version", version).withColumn("verdict", verdict)
    return judged.select("_step._row.*", "current_version", "verdict")
