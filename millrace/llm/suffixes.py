"""Suffix-array dedup: bytes covered by strings of ``LENGTH`` bytes that occur elsewhere.

Whether a string repeats is decided in the merged Burrows-Wheeler transform of
shards. What goes into a shard is first narrowed without loss:

1. Each window of ``LENGTH`` bytes has an anchor, the rightmost byte n-gram
   of least hash in its middle. Equal windows have equal anchors at equal
   offsets, so windows are compared only where their anchors' cores, the bytes
   that all windows of an anchor share, are equal. An anchor serves a run of
   consecutive windows; the bytes of the run are its context.
2. Cores that occur once are done. Contexts that occur several times repeat as a
   whole (copies collapse here, combined before the exchange, so a group of any
   size becomes one row).
3. The rest are the ends of repeated passages: cores with several contexts. The
   core becomes a symbol, and its contexts, strings of what stands left
   and right of it, are dealt into buckets of bounded size by core. A bucket's
   strings form shards, each with its transform, and the shards' transforms are
   merged by interleave refinement (``bwt``). A window repeats where its block
   has another suffix.

A core with more contexts than ``group_rows`` (the start of a passage that a
third of all documents quote) is cut finer: its windows are dealt by how many
bytes they reach to the left, in steps that double from either side, and each
piece is grouped by core and the bytes that its windows share. Equal pieces
collapse as contexts do; the merge is the same.

A piece that still has more than ``group_rows`` contexts (its windows lie inside
a passage that as many documents quote, with different text after it) does not
go to a merge: each of its windows becomes a 128-bit hash, and Spark counts
those. So a bucket holds at most ``group_rows`` contexts of any core or piece.

Contexts are compared by 128-bit hashes. NULL counts as an empty text. Every row
is a document: rows equal in key and text repeat each other. Texts shorter than
``LENGTH`` have no window. Very long texts are read in stretches. An empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm import bwt
from millrace.llm.common import Scratch, attach

LENGTH = 400
GRAM = 16
SPREAD = 160  # n-grams among which a window's anchor is chosen
STRETCH = 1 << 20
GROUP_ROWS = 4096
BUCKET_SYMBOLS = 1_000_000
SHARD_SYMBOLS = 250_000
_TABLE = np.random.default_rng(42).integers(0, 2**64, 256, dtype=np.uint64)
_FACTOR = 0x9E3779B97F4A7C15
CORE_SYMBOLS = 4


class Layout:
    """Where anchors and cores lie for a window of ``length`` bytes."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM, spread: int = SPREAD) -> None:
        if gram & (gram - 1) or length < gram + spread:
            raise ValueError("the n-gram must be a power of two and the window hold all among which its anchor is chosen")
        self.length, self.gram, self.spread = length, gram, spread
        self.skip = (length - gram - spread + 1) // 2  # bytes before the first n-gram
        self.core = length - spread + 1
        self.free = spread - 1  # bytes of a window outside its core

    def runs(self, data: bytes) -> Iterator[tuple[int, int, int]]:
        """(first window, last window, anchor) of every run, in order."""
        for at in range(0, len(data) - self.length + 1, STRETCH):
            part = np.frombuffer(data, np.uint8, min(len(data) - at, STRETCH + self.length - 1), at)
            anchor = self._anchors(part)
            change = np.flatnonzero(anchor[1:] != anchor[:-1])
            firsts, lasts = np.concatenate([[0], change + 1]), np.concatenate([change, [len(anchor) - 1]])
            yield from zip((firsts + at).tolist(), (lasts + at).tolist(), (anchor[firsts] + at).tolist())

    def _anchors(self, part: np.ndarray) -> np.ndarray:
        """The anchor's place for each window of the part."""
        hashes, width = _TABLE[part], 1
        while width < self.gram:
            hashes = hashes[:-width] * np.uint64(pow(_FACTOR, width, 1 << 64)) + hashes[width:]
            width *= 2
        hashes ^= hashes >> np.uint64(31)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        places = np.arange(len(hashes), dtype=np.uint64)
        keys = (hashes >> np.uint64(32) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - places)
        n_windows = len(part) - self.length + 1
        keys = keys[self.skip : self.skip + n_windows + self.spread - 1]
        padded = np.full(-(-len(keys) // self.spread) * self.spread, np.uint64(2**64 - 1), dtype=np.uint64)
        padded[: len(keys)] = keys
        rows = padded.reshape(-1, self.spread)
        ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()[:n_windows]
        behind = np.minimum.accumulate(rows, axis=1).ravel()[self.spread - 1 : self.spread - 1 + n_windows]
        return (np.uint64(0xFFFFFFFF) - (np.minimum(ahead, behind) & np.uint64(0xFFFFFFFF))).astype(np.int64)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def anchor_runs(docs: DataFrame, layout: Layout) -> DataFrame:
    """``key``, ``version``, ``lo``, ``hi`` (windows), ``at`` (the core's place), ``core`` and ``c1``, ``c2`` (the context's hash)."""
    schema = StructType(docs.select("key", "version").schema.fields)
    for name, kind in (("lo", "long"), ("hi", "long"), ("at", "long"), ("core", "long"), ("c1", "long"), ("c2", "long")):
        schema = schema.add(name, kind)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, los, his, ats, cores, c1, c2 = [], [], [], [], [], [], []
            for row, data in enumerate(batch.column("data").to_pylist()):
                view = memoryview(data)
                for lo, hi, anchor in layout.runs(data):
                    at = anchor - layout.skip
                    context = xxhash.xxh3_128_intdigest(view[lo : hi + layout.length], at - lo)
                    rows.append(row)
                    los.append(lo)
                    his.append(hi)
                    ats.append(at)
                    cores.append(xxhash.xxh3_64_intdigest(view[at : at + layout.core]))
                    c1.append(context >> 64)
                    c2.append(context & 0xFFFFFFFFFFFFFFFF)
            taken = [batch.column(name).take(pa.array(rows, pa.int64())) for name in ("key", "version")]
            numbers = [np.array(v, dtype=np.int64) for v in (los, his, ats)] + [_signed(v) for v in (cores, c1, c2)]
            yield pa.RecordBatch.from_arrays([*taken, *map(pa.array, numbers)], names=schema.names)

    return docs.mapInArrow(found, schema)


def _context_strings(docs: DataFrame, places: DataFrame, layout: Layout, scratch: Scratch) -> DataFrame:
    """The places with ``left`` and ``right``, the bytes of their context around the core."""
    wanted = [f for f in places.columns if f not in ("key", "version")]
    grouped = scratch.write("places", places.groupBy("key", "version").agg(F.collect_list(F.struct(*wanted)).alias("places")))
    joined, (held,) = attach(docs, "key", F.col("version"), grouped, scratch, inner=True)
    # Rows equal in key and text both come: their contexts occur twice then and serve as witnesses only.
    one = joined.select("key", "version", "data", F.explode(held).alias("p"))
    core_end = F.col("p.at") + layout.core
    return one.select(
        "key", "version", "p.*",
        F.substring(F.col("data"), (F.col("p.lo") + 1).cast("int"), (F.col("p.at") - F.col("p.lo")).cast("int")).alias("left"),
        F.substring(F.col("data"), (core_end + 1).cast("int"), (F.col("p.hi") + layout.length - core_end).cast("int")).alias("right"),
    )


def _cuts(free: int) -> list[tuple[int, int]]:
    """(least, most) bytes to the left of the core of each piece: steps that double from both ends."""
    ends = {0, free + 1}
    step = 1
    while step <= free // 2:
        ends |= {step, free + 1 - step}
        step *= 2
    marks = sorted(ends)
    return [(a, b - 1) for a, b in zip(marks, marks[1:])]


def _pieces(strings: DataFrame, layout: Layout) -> DataFrame:
    """Contexts of crowded cores, cut by how far windows reach to the left."""
    cuts = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in _cuts(layout.free)])).alias("cut")
    cut = strings.withColumn("cut", cuts).where("cut.a <= most AND cut.b >= least")
    cut = cut.withColumns({"_least": F.greatest("least", "cut.a"), "_most": F.least("most", "cut.b")})

    def left(n: Column) -> Column:
        return F.substr(F.col("left"), (F.length("left") - n + 1).cast("int"), n.cast("int"))

    def right(x: Column) -> Column:
        return F.substr(F.col("right"), F.lit(1), (F.lit(layout.free) - x).cast("int"))

    # Windows of a piece all hold the bytes that its shortest reach to either side holds.
    shared = F.xxhash64(F.col("core"), F.col("cut.a"), left(F.col("cut.a")), right(F.col("cut.b")))
    return cut.select(
        "key", "version", "at", "n", shared.alias("core"),
        F.col("_least").alias("least"), F.col("_most").alias("most"), left(F.col("_most")).alias("left"), right(F.col("_least")).alias("right"),
    )


def _counted_windows(strings: DataFrame, layout: Layout, scratch: Scratch) -> DataFrame:
    """``key``, ``version``, ``lo``, ``hi`` of the windows of once-occurring contexts that repeat, by counting hashes."""
    reach = F.explode(F.sequence(F.col("least").cast("int"), F.col("most").cast("int"))).alias("reach")
    each = strings.select("key", "version", "at", "n", "core", "most", "left", "right", reach)
    before = F.substr(F.col("left"), (F.length("left") - F.col("reach") + 1).cast("int"), F.col("reach"))
    after = F.substr(F.col("right"), F.lit(1), F.lit(layout.free) - F.col("reach"))
    # Core and reach are keys of their own: only the bytes around the core are hashed.
    digest = F.md5(F.concat(before, after))
    hashed = each.select("key", "version", "at", "n", "core", "reach", F.unhex(digest).alias("digest"))
    windows = scratch.write("windows", hashed)
    same = ["core", "reach", "digest"]
    often = scratch.write("windows-often", windows.groupBy(*same).agg(F.sum("n").alias("total")).where("total > 1").select(*same))
    found = windows.where("n = 1").join(often.hint("merge"), same, "left_semi")
    lo = F.col("at") - F.col("reach")
    return found.select("key", "version", lo.alias("lo"), lo.alias("hi"))


def _repeated_windows(strings: DataFrame, layout: Layout, bucket_symbols: int, shard_symbols: int) -> DataFrame:
    """``key``, ``version``, ``lo``, ``hi`` of the windows of once-occurring contexts that repeat.

    ``least`` and ``most`` are how many bytes the context's windows have left of the core.
    """
    size = F.length("left") + F.length("right") + CORE_SYMBOLS + 1
    total = strings.agg(F.sum(size).alias("n")).first()["n"] or 0
    buckets = max(1, -(-total // bucket_symbols))
    schema = StructType(strings.select("key", "version").schema.fields).add("lo", "long").add("hi", "long")
    depth = layout.free + CORE_SYMBOLS

    def merged(table: pa.Table) -> pa.Table:
        left, right = table.column("left").to_pylist(), table.column("right").to_pylist()
        cores = np.unique(table.column("core").to_numpy(), return_inverse=True)[1]
        least, most, n, at = (table.column(c).to_numpy() for c in ("least", "most", "n", "at"))
        lengths = np.array([len(a) + len(b) + CORE_SYMBOLS + 1 for a, b in zip(left, right)], dtype=np.int64)
        begins = np.cumsum(lengths) - lengths
        symbols = np.frombuffer(b"".join(a + bytes(CORE_SYMBOLS) + b + b"\0" for a, b in zip(left, right)), np.uint8).astype(np.int64) + 1
        for k in range(CORE_SYMBOLS):
            digit = 257 if not k else (cores >> 8 * (k - 1) & 255) + 1
            symbols[begins + most + k] = digit
        symbols[begins + lengths - 1] = 0
        shard_of = begins // shard_symbols
        shards, offsets = [], []
        for shard in np.unique(shard_of):
            own = np.flatnonzero(shard_of == shard)
            first, last = begins[own[0]], begins[own[-1]] + lengths[own[-1]]
            shards.append(bwt.build(symbols[first:last], begins[own] + lengths[own] - 1 - first))
            offsets.append(first)
        block, _, _ = bwt.merge(shards, depth)
        shared = np.bincount(block)[block] > 1
        repeats = np.zeros(len(symbols), dtype=bool)  # by place in the text
        done = 0
        for shard, first in zip(shards, offsets):
            repeats[first + shard.text_at] = shared[done : done + len(shard.text_at)]
            done += len(shard.text_at)
        rows, los, his = [], [], []
        for row in np.flatnonzero(n == 1):
            flags = repeats[begins[row] : begins[row] + most[row] - least[row] + 1]
            edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
            start = at[row] - most[row]  # the window with the most bytes to the left
            for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
                rows.append(row)
                los.append(start + a)
                his.append(start + b - 1)
        taken = table.select(["key", "version"]).take(pa.array(rows, pa.int64()))
        return taken.append_column("lo", pa.array(los, pa.int64())).append_column("hi", pa.array(his, pa.int64()))

    bucketed = strings.select("key", "version", "core", "at", "n", "least", "most", "left", "right", F.pmod(F.xxhash64("core"), F.lit(buckets)).alias("bucket"))
    return bucketed.groupBy("bucket").applyInArrow(merged, schema)


def repeated_runs(
    docs: DataFrame, layout: Layout, scratch: Scratch, group_rows: int = GROUP_ROWS,
    bucket_symbols: int = BUCKET_SYMBOLS, shard_symbols: int = SHARD_SYMBOLS,
) -> DataFrame:
    """``key``, ``version``, ``lo``, ``hi``: runs of window starts whose string also starts elsewhere."""
    place = ["key", "version", "lo", "hi", "at"]
    context = ["core", "c1", "c2"]
    often = anchor_runs(docs, layout).groupBy("core").agg(F.count("*").alias("n")).where("n > 1")
    runs = scratch.write("runs", anchor_runs(docs, layout).join(scratch.write("often", often.select("core")), "core", "left_semi"))
    contexts = scratch.write("contexts", runs.groupBy(*context).agg(F.count("*").alias("n"), F.min(F.struct(*place)).alias("place")))
    copied = scratch.write("copied", contexts.where("n > 1").select(*context))
    sure = runs.join(copied, context, "left_semi").select("key", "version", "lo", "hi")
    ends = contexts.groupBy("core").agg(F.count("*").alias("m"), F.min("n").alias("fewest")).where("m > 1 AND fewest = 1")
    ends = scratch.write("ends", ends.select("core", "m"))
    places = contexts.join(ends, "core").select("core", "m", F.least("n", F.lit(2)).alias("n"), "place.*")
    strings = _context_strings(docs, places, layout, scratch).withColumns(
        {"most": F.col("at") - F.col("lo"), "least": F.col("at") - F.col("hi")}
    )
    strings = scratch.write("strings", strings)
    calm = strings.where(F.col("m") <= group_rows).select("key", "version", "core", "at", "n", "least", "most", "left", "right")
    pieces = scratch.write("pieces", _pieces(strings.where(F.col("m") > group_rows), layout))
    same = ["core", "least", "most", "left", "right"]
    alike = scratch.write("alike", pieces.groupBy(*same).agg(F.sum("n").alias("n"), F.min(F.struct("key", "version", "at")).alias("place")))
    shared = pieces.where("n = 1").join(alike.where("n > 1").select(*same), same, "left_semi")
    shared = shared.select("key", "version", (F.col("at") - F.col("most")).alias("lo"), (F.col("at") - F.col("least")).alias("hi"))
    single = alike.select("place.key", "place.version", "core", "place.at", F.least("n", F.lit(2)).cast("int").alias("n"), "least", "most", "left", "right")
    crowded = single.groupBy("core").agg(F.count("*").alias("m")).where(F.col("m") > group_rows)
    crowded = scratch.write("crowded", crowded.select("core")).hint("merge")
    counted = _counted_windows(single.join(crowded, "core", "left_semi"), layout, scratch)
    open_strings = scratch.write("open", calm.unionByName(single.join(crowded, "core", "left_anti")))
    found = scratch.write("found", _repeated_windows(open_strings, layout, bucket_symbols, shard_symbols))
    return sure.unionByName(shared).unionByName(counted).unionByName(found)


def dedup_substrings(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, spread: int = SPREAD,
    keep_bytes: bool = False, **sizes: int,
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, if asked for, ``kept`` (binary) per row. Runs jobs."""
    layout, scratch = Layout(length, gram, spread), Scratch(docs.sparkSession, "suffixes")
    data = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("version"), data.alias("data"))
    long_rows = rows.where(F.length("data") >= length)
    runs = repeated_runs(long_rows, layout, scratch, **sizes)
    spans = runs.groupBy("key", "version").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    joined, (held,) = attach(rows, "key", F.col("version"), scratch.write("spans", spans), scratch)
    schema = StructType(rows.select("key").schema.fields)
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"), ("kept", "binary")):
        schema = schema.add(name, kind)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for held, found in zip(batch.column("data").to_pylist(), batch.column("runs").to_pylist()):
                spans = covered([(r["lo"], r["hi"] + length) for r in found or ()])
                parts, at = [], 0
                for a, b in spans:
                    parts.append(held[at:a])
                    at = b
                kept = b"".join([*parts, held[at:]])
                out.append((len(held), len(held) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
            columns = list(zip(*out)) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=schema.names)

    result = joined.select("key", "data", F.col(held).alias("runs")).mapInArrow(cut, schema)
    return result.select(F.col("key").alias(key), *schema.names[1 : None if keep_bytes else -1])


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans as maximal ones, in order; spans that touch are one."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [(a, b) for a, b in merged]
