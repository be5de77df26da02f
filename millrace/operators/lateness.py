"""Late data in batch form: what a watermark would have let through, and what late rows change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators import skew
from millrace.session import materialize


def late_data_split(df: DataFrame, ts: str, arrival: str, delay: str) -> tuple[DataFrame, DataFrame]:
    """Split rows into on time and late, in order of ``arrival``.

    A row is late when its event time lies more than ``delay`` before the
    latest event time that arrived earlier. Rows that arrived together (equal
    ``arrival``) do not make each other late. Rows without an arrival
    have no place in the order: they are on time, with no watermark, and make
    no other row late.

    Rows collapse to one peak per arrival, combined before the exchange. Those
    are dealt into ranges by rank and written to the session's shared folder; the running
    maximum is taken inside each range, plus one maximum per earlier range, so
    only one row per range is ever ordered as a whole. The watermark then joins
    the rows of its arrival, spread where very many share one.
    """
    peaks = df.where(F.col(arrival).isNotNull()).groupBy(F.col(arrival).alias("_at")).agg(F.max(ts).alias("_peak"))
    ranged = materialize(peaks.repartitionByRange("_at").withColumn("_range", F.spark_partition_id()), "arrivals")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranged.groupBy("_range").agg(F.max("_peak").alias("_top")).select("_range", F.max("_top").over(before).alias("_carried"))
    within = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    marks = ranged.withColumn("_within", F.max("_peak").over(within)).join(carried, "_range")
    marks = marks.select(F.col("_at").alias(arrival), (F.greatest("_within", "_carried") - F.expr(f"interval {delay}")).alias("watermark"))
    tagged = skew.lookup_join(df, marks, [arrival], "left", null_safe=True).select(*df.columns, "watermark")
    late = F.coalesce(F.col(ts) < F.col("watermark"), F.lit(False))
    return tagged.filter(~late), tagged.filter(late)


def corrections(late: DataFrame, keys: Sequence[str | Column], measures: Sequence[Column], retract: bool = False) -> DataFrame:
    """What late rows change in windows that have closed: one row of differences per key.

    ``keys`` are the windows' keys (a window among them) and ``measures`` sums
    or counts under the names of the windows' columns. ``retract`` takes rows out again instead, with the sign turned.
    """
    changed = late.groupBy(*keys).agg(*measures)
    if not retract:
        return changed
    names = changed.columns[-len(measures):]
    return changed.withColumns({name: -F.col(name) for name in names})


def fold_corrections(closed: DataFrame, deltas: DataFrame, keys: Sequence[str], measures: Sequence[str], rows: str | None = None) -> DataFrame:
    """The closed windows with any number of corrections added: what a batch over all rows would have given.

    A union that is summed per key, combined before the exchange; windows that only late rows fall in
    appear. NULL counts as no difference. With ``rows``, the measure that counts a window's rows, windows that corrections emptied leave.
    """
    columns = [*keys, *measures]
    both = closed.select(*columns).unionByName(deltas.select(*columns))
    folded = both.groupBy(*keys).agg(*[F.sum(name).cast(closed.schema[name].dataType).alias(name) for name in measures])
    return folded if rows is None else folded.filter(F.col(rows) != 0)
