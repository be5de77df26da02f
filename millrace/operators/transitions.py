"""Status transitions judged against each entity's state at that point.

An entity's events are cut into segments of bounded size by rank. What a
segment does to the state it is entered with is a map of bounded size: per
status, the outcome for a token equal to that of the segment's first valid
event, and the outcome for any other token. Maps compose, so entry states
follow by composing them in a tree, and then every segment folds on its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import values as V
from millrace.operators import skew
from millrace.operators.segments import cut_segments

Transitions = Mapping[str, Sequence[str]]
FANOUT = 256


class _Table:
    """A transition table with its statuses numbered; any table, cyclic ones too."""

    def __init__(self, transitions: Transitions, initial: str) -> None:
        self.names = list(dict.fromkeys([initial, *transitions, *(t for targets in transitions.values() for t in targets)]))
        self._matrix = F.array(*[F.array(*[F.lit(b in transitions.get(a, ())) for b in self.names]) for a in self.names])

    def number(self, status: Column) -> Column:
        """The status's number; -1 for a status the table lacks."""
        return F.coalesce(*[F.when(status == name, i) for i, name in enumerate(self.names)], F.lit(-1))

    def name(self, number: Column) -> Column:
        return F.get(F.array(*map(F.lit, self.names)), number)

    def valid(self, status: Column, to: Column) -> Column:
        """Whether a transition between numbered statuses is in the table and not a stay."""
        return (status != to) & F.coalesce(F.get(F.get(self._matrix, status), to), F.lit(False))


def _outcome(token: Column, moved: Column, status: Column, held: Column, same_moved: Column, same_status: Column, same_held: Column) -> Column:
    """A status's entry of a map: the first valid event's token, and what becomes of another and of an equal token."""
    return F.struct(
        token.alias("token"), moved.alias("moved"), status.alias("status"), held.alias("held"),
        same_moved.alias("same_moved"), same_status.alias("same_status"), same_held.alias("same_held"),
    )


def _enter(segment: Column, status: Column, held: Column) -> Column:
    """State after a segment that is entered with a status and a token, and whether an event applied."""
    entry = F.get(segment, status)
    same = F.coalesce(entry["token"] == held, F.lit(False))
    moved = F.when(same, entry["same_moved"]).otherwise(entry["moved"])
    return F.struct(
        moved.alias("moved"),
        F.when(~moved, status).when(same, entry["same_status"]).otherwise(entry["status"]).alias("status"),
        F.when(~moved, held).when(same, entry["same_held"]).otherwise(entry["held"]).alias("held"),
    )


def _compose(first: Column, second: Column) -> Column:
    """The map of two segments in a row."""
    def both(entry: Column, status: Column) -> Column:
        other = _enter(second, entry["status"], entry["held"])
        same = _enter(
            second,
            F.when(entry["same_moved"], entry["same_status"]).otherwise(status),
            F.when(entry["same_moved"], entry["same_held"]).otherwise(entry["token"]),
        )
        moved = _outcome(
            entry["token"], F.lit(True), other["status"], other["held"],
            entry["same_moved"] | same["moved"], same["status"], same["held"],
        )
        return F.when(entry["moved"], moved).otherwise(F.get(second, status))

    return F.transform(first, both)


def _unmoved(table: _Table) -> Column:
    nothing, no = F.lit(None).cast("string"), F.lit(False)
    return F.array(*[_outcome(nothing, no, F.lit(i), nothing, no, F.lit(i), nothing) for i in range(len(table.names))])


def _segment_map(steps: Column, table: _Table) -> Column:
    """Fold (``_number``, ``_token``) steps into the segment's map."""
    def follow(segment: Column, step: Column) -> Column:
        to, token = step["_number"], step["_token"]

        def grown(entry: Column, status: Column) -> Column:
            begins = ~entry["moved"] & table.valid(status, to)
            goes_on = entry["moved"] & table.valid(entry["status"], to) & ~F.coalesce(token == entry["held"], F.lit(False))
            same_status = F.when(entry["same_moved"], entry["same_status"]).otherwise(status)
            same_held = F.when(entry["same_moved"], entry["same_held"]).otherwise(entry["token"])
            same_on = entry["moved"] & table.valid(same_status, to) & ~F.coalesce(token == same_held, F.lit(False))
            applies, same_applies = begins | goes_on, same_on | (begins & token.isNull())
            return _outcome(
                F.when(begins, token).otherwise(entry["token"]),
                entry["moved"] | applies,
                F.when(applies, to).otherwise(entry["status"]),
                F.when(applies, token).otherwise(entry["held"]),
                entry["same_moved"] | same_applies,
                F.when(same_applies, to).otherwise(entry["same_status"]),
                F.when(same_applies, token).otherwise(entry["same_held"]),
            )

        return F.transform(segment, grown)

    return F.aggregate(steps, _unmoved(table), follow)


def _entry_states(maps: DataFrame, table: _Table, fanout: int) -> DataFrame:
    """Status and token that each segment is entered with, from the maps of all segments of a key in order.

    ``maps`` has ``_key``, ``_segment`` and ``_map``. Neighbours compose up a
    tree of ``fanout`` children; states then descend it. No group exceeds the
    fanout, however many segments a key has.
    """
    deepest = maps.agg(F.max("_segment")).first()[0] or 0
    level, children = maps.select("_key", F.col("_segment").alias("_place"), "_map"), []
    while True:
        listed = F.array_sort(F.collect_list(F.struct("_place", "_map")))
        grouped = level.groupBy("_key", F.floor(F.col("_place") / fanout).alias("_parent")).agg(listed.alias("_children"))
        children.append(grouped)
        if deepest < fanout:
            break
        composed = F.aggregate("_children", _unmoved(table), lambda whole, child: _compose(whole, child["_map"]))
        level = grouped.select("_key", F.col("_parent").alias("_place"), composed.alias("_map"))
        deepest //= fanout
    root = F.struct(F.lit(0).alias("status"), F.lit(None).cast("string").alias("held"))
    states = children[-1].select("_key", F.col("_parent").alias("_place"), root.alias("_state"))

    def descend(before: Column, child: Column) -> Column:
        after = _enter(child["_map"], before["now"]["status"], before["now"]["held"])
        now = F.struct(after["status"].alias("status"), after["held"].alias("held"))
        entered = F.struct(child["_place"].alias("_place"), before["now"].alias("_state"))
        return F.struct(now.alias("now"), F.concat(before["list"], F.array(entered)).alias("list"))

    none = "array<struct<_place:bigint,_state:struct<status:int,held:string>>>"
    for grouped in reversed(children):
        parents = states.withColumnRenamed("_place", "_parent")
        start = F.struct(F.col("_state").alias("now"), F.array().cast(none).alias("list"))
        met = skew.keyed_join(grouped, parents, ["_key", "_parent"], null_safe=True)
        states = met.select("_key", F.explode(F.aggregate("_children", start, descend, lambda s: s["list"])).alias("_e")).select("_key", "_e.*")
    return states.select(
        "_key", F.col("_place").alias("_segment"), table.name(F.col("_state.status")).alias("_status"), F.col("_state.held").alias("_held")
    )


def _fold(segments: DataFrame, table: _Table, initial: str) -> DataFrame:
    """Judge each segment's sorted events from its entry state."""
    def follow(state: Column, step: Column) -> Column:
        status = table.number(state["status"])
        mark = (
            F.when(state["status"] == step["_to"], "s")
            .when(~table.valid(status, step["_number"]), "i")
            .when(state["token"] == step["_token"], "k")
            .otherwise("a")
        )
        applies = mark == "a"
        return F.struct(
            F.when(applies, step["_to"]).otherwise(state["status"]).alias("status"),
            F.when(applies, step["_token"]).otherwise(state["token"]).alias("token"),
            F.concat(state["trace"], mark).alias("trace"),
        )

    # The fold leaves one character per event; an array would be copied whole at every step.
    start = F.struct(F.col("_status").alias("status"), F.col("_held").alias("token"), F.lit("").alias("trace"))
    traced = segments.withColumn("_trace", F.aggregate("_steps", start, follow, lambda state: state["trace"]))
    steps = traced.select("_key", "_segment", "_status", "_trace", F.posexplode("_steps").alias("_index", "_step"))
    marked = steps.withColumn("_mark", F.substring("_trace", F.col("_index") + 1, F.lit(1)))
    earlier = Window.partitionBy("_key", "_segment").orderBy("_index").rowsBetween(Window.unboundedPreceding, -1)
    applied = F.last(F.when(F.col("_mark") == "a", F.col("_step._to")), ignorenulls=True).over(earlier)
    verdict = (
        F.when(F.col("_mark") == "a", "applied")
        .when(F.col("_mark") == "s", "same_state")
        .when(F.col("_mark") == "i", "invalid")
        .otherwise("same_key")
    )
    judged = marked.withColumn("current_status", F.coalesce(applied, "_status", F.lit(initial))).withColumn("verdict", verdict)
    return judged.select("_step._row.*", "current_status", "verdict")


def state_transition_check(
    events: DataFrame,
    key: str,
    status: str,
    order: Sequence[str],
    idempotency_key: str | None = None,
    transitions: Transitions = V.ORDER_TRANSITIONS,
    initial: str = V.INITIAL_STATUS,
    max_rows: int = 2_000,
    fanout: int = FANOUT,
) -> DataFrame:
    """Judge every requested transition.

    Adds ``current_status`` and ``verdict``: ``applied``, ``same_state``,
    ``invalid`` or ``same_key`` (checked in that order of precedence: state,
    validity, then the last applied key). ``order`` is unique per entity; rows
    whose order repeats are taken in an order of Spark's choice.

    Runs jobs: the ranged events are written to the session's shared folder,
    and whether any entity has several segments of ``max_rows`` is looked up;
    only those segments that another follows need a map. ``max_rows`` and
    ``fanout`` bound groups and do not change the result.
    """
    table = _Table(transitions, initial)
    token = F.lit(None).cast("string") if idempotency_key is None else F.col(idempotency_key).cast("string")
    facts = events.select(
        F.col(key).alias("_key"),
        F.struct(*[F.col(name).alias(f"o{i}") for i, name in enumerate(order)]).alias("_at"),
        F.col(status).alias("_to"),
        table.number(F.col(status)).alias("_number"),
        F.nullif(token, F.lit("")).alias("_token"),
        F.struct(*events.columns).alias("_row"),
    )
    cut = cut_segments(facts, ["_key"], ["_at"], max_rows, "transition-events")
    own = ["_key", "_segment"]
    steps = F.array_sort(F.collect_list(F.struct("_at", "_to", "_number", "_token", "_row")))
    segments = cut.groupBy(*own).agg(steps.alias("_steps"))
    pieces = cut.where("_segment > 0").select("_key").distinct()
    if pieces.isEmpty():
        entered = segments.withColumns({"_status": F.lit(initial), "_held": F.lit(None).cast("string")})
    else:
        several = skew.keyed_join(cut.select(*own, "_at", "_number", "_token"), pieces, ["_key"], "left_semi", null_safe=True)
        narrow = F.array_sort(F.collect_list(F.struct("_at", "_number", "_token")))
        maps = several.groupBy(*own).agg(narrow.alias("_steps")).select(*own, _segment_map(F.col("_steps"), table).alias("_map"))
        states = _entry_states(maps, table, fanout)
        entered = skew.keyed_join(segments, states, own, "left", null_safe=True).withColumn("_status", F.coalesce("_status", F.lit(initial)))
    return _fold(entered, table, initial)
