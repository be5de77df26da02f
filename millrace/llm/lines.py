"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of the last lines with a word ends a chunk
wherever it is divisible, so boundaries depend on the lines around them and not on their
number: after an insertion the same chunks come back. A line that repeats the one
before it ends a chunk too, and so does the last line.

Chunks are what repeated runs are found by, and a run seldom begins and ends where
chunks do. So around each boundary there are spans: from every line of the chunk,
or the one before it, up to the boundary, and from the boundary's own lines on to every line of the next
chunk, ``REACH`` lines either way, and the chunk as a whole. A span has two lines with a
word at least. A run that repeats and holds a boundary is thus covered by spans
that repeat, up to its first and last line; a run of n lines holds none with a
probability of ``(1 - 1 / divisor) ** (n - 1)``.

Spans that occur at several places of the corpus go at all but the first place, in
order of key and line. The first place of a span stays whole: its lines
stay even where they are in a repeat of another span. So one whole copy of
every repeated span is left.

Only hashes of spans move at first. Spans whose hash repeats are then
compared by their bytes, and what is equal is grouped by the text itself.
Everything is a built-in function: a row per document, arrays for its lines.
Counting combines before the exchange; the joins that follow read written
tables, so adaptive execution splits a span that a third of all rows hold.

NULL and empty texts have no span and stay as they are. Lines without a word belong
to the span around them. Rows equal in key and
text are the same place and fare alike; rows of one key with different texts
are told apart. NULL keys sort first. An empty table gives an empty result.
Further columns are kept; ``n_lines`` and ``n_removed_lines`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import NOT_SPACE, Scratch, attach, fresh, let

WINDOW = 2  # lines the rolling hash spans
DIVISOR = 2  # a chunk has this many lines on average
REACH = 16  # lines by which a span reaches from its boundary
BASE, MODULUS = 1_000_003, 2_147_483_647


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("bigint")


def rolling_hash(hashes: Column, i: Column, window: int = WINDOW) -> Column:
    """Polynomial hash of the ``window`` lines that end with the ``i``-th, counted from 1."""
    value = F.lit(0).cast("bigint")
    for back in range(window - 1, -1, -1):
        value = F.pmod(value * BASE + F.coalesce(F.get(hashes, i - 1 - back), F.lit(0).cast("bigint")), F.lit(MODULUS))
    return value


def line_spans(lines: Column, window: int = WINDOW, divisor: int = DIVISOR) -> Column:
    """(first, last, hash) of the chunks of two or more worded lines and of what extends them; lines count from 1."""
    marked = F.transform(lines, lambda line, i: F.when(line.rlike(NOT_SPACE), F.struct((i + 1).alias("at"), line_hash(line).alias("hash"), F.xxhash64(line).alias("long"))))

    def chunk_ends(hashes: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(1), F.size(hashes)),
            lambda i: (i == F.size(hashes)) | (F.pmod(rolling_hash(hashes, i, window), F.lit(divisor)) == 0) | (F.get(hashes, i - 1) == F.get(hashes, i - 2)),
        )

    def around(ends: Column, end: Column, k: Column) -> Column:
        start, after = F.coalesce(F.get(ends, k - 1), F.lit(0)) + 1, F.coalesce(F.get(ends, k + 1), end + 1)
        back = F.when(end > 1, F.sequence(F.greatest(F.lit(1), F.least(start, end) - 1, end - REACH), end - 1)).otherwise(F.array().cast("array<int>"))
        whole = F.when(start < end - REACH, F.array(start)).otherwise(F.array().cast("array<int>"))
        on = F.when(after > end + 1, F.sequence(end + 1, F.least(after - 1, end + REACH))).otherwise(F.array().cast("array<int>"))
        ending = F.transform(F.concat(whole, back), lambda first: F.struct(first.alias("first"), end.alias("last")))
        return F.concat(ending, F.transform(on, lambda last: F.struct(F.greatest(end - 1, F.lit(1)).alias("first"), last.alias("last"))))

    def spanned(worded: Column) -> Column:
        spans = let(let(worded["hash"], chunk_ends), lambda ends: F.flatten(F.transform(ends, lambda end, k: around(ends, end, k))))
        held = F.transform(spans, lambda s: F.struct(
            F.get(worded, s["first"] - 1)["at"].alias("first"), F.get(worded, s["last"] - 1)["at"].alias("last"),
            F.xxhash64(F.slice(worded["long"], s["first"], s["last"] - s["first"] + 1)).alias("hash"),
        ))
        return F.when(F.size(worded) > 1, held)

    return let(F.filter(marked, lambda m: m.isNotNull()), spanned)


def span_text(lines: Column, span: Column) -> Column:
    return F.array_join(F.slice(lines, span["first"], span["last"] - span["first"] + 1), "\n")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """The rows with repeated runs of lines taken out of ``text``, ``n_lines`` and ``n_removed_lines``. Runs jobs."""
    scratch = Scratch(docs.sparkSession, "lines")
    place = F.struct("key", "version", "first", "last")
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("version"), split_lines(F.col(text)).alias("lines"))

    found = rows.select("key", "version", F.explode(let(F.col("lines"), lambda lines: line_spans(lines, window, divisor))).alias("span"))
    spans = scratch.write("spans", found.select("key", "version", "span.*"))
    many = spans.groupBy("hash").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low != high")
    suspects = spans.join(scratch.write("many", many.select("hash")).hint("merge"), "hash", "left_semi")
    by_row = scratch.write("suspects", suspects.groupBy("key", "version").agg(F.collect_set(F.struct("first", "last")).alias("spans")))

    matched, (held,) = attach(rows, "key", F.col("version"), by_row, scratch, inner=True)
    texts = matched.select("key", "version", F.explode(
        F.transform(held, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), span_text(F.col("lines"), s).alias("bytes")))
    ).alias("span")).select("key", "version", "span.*")
    texts = scratch.write("texts", texts)
    equal = texts.groupBy("bytes").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low != high")
    equal = scratch.write("equal", equal.select("bytes", "low"))
    same = F.col("key").eqNullSafe(F.col("low.key")) & (F.col("version") == F.col("low.version")) & (F.col("first") == F.col("low.first"))
    repeats = texts.join(equal.hint("merge"), "bytes").where(~same).select("key", "version", "first", "last", F.lit(True).alias("gone"))
    firsts = equal.select("low.*", F.lit(False).alias("gone"))
    judged = repeats.unionByName(firsts).groupBy("key", "version").agg(F.collect_set(F.struct("first", "last", "gone")).alias("spans"))
    joined, (found,) = attach(docs, key, F.xxhash64(text), scratch.write("judged", judged), scratch)

    def numbers(gone: bool) -> Column:
        return F.flatten(F.transform(F.filter(found, lambda s: s["gone"] == gone), lambda s: F.sequence(s["first"], s["last"])))

    (removed,) = fresh(joined, "_removed")
    joined = joined.withColumn(removed, F.array_except(numbers(True), numbers(False)))

    def rest(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(1), F.size(lines)), F.col(removed))
        return F.array_join(F.transform(left, lambda i: F.get(lines, i - 1)), "\n")

    n_removed = F.coalesce(F.array_size(removed), F.lit(0))
    cut = F.when(n_removed == 0, F.col(text)).otherwise(let(split_lines(F.col(text)), rest))
    counts = {"n_lines": F.size(split_lines(F.col(text))).cast("bigint"), "n_removed_lines": n_removed.cast("bigint"), text: cut}
    return joined.withColumns(counts).drop(found, removed)
