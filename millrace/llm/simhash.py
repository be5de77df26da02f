"""Near-duplicates by SimHash, found by anchor-point covering.

Fingerprints are the bitwise majority of the 64-bit hashes of a text's word
shingles. Two link when they differ in at most three bits, and then the halves
of 32 bits differ in at most one bit on one side. For each half the anchors are
a covering code: the Hamming code of 31 bits with the last bit free, so every
value has an anchor within distance 1 (the covering radius). A value is placed
at its own anchor and copied to all anchors within radius plus threshold,
1 + 1: 17 at most. Whoever is within one bit of it has its own anchor among
those, so comparing per anchor loses no link. Anchors are computed by parity
checks; there is no list of all 2^27.

Equal fingerprints are grouped first (their number is combined before the
exchange), so copies never meet pairwise. Fingerprints that share one half and
the other half's anchor differ by two bits at most and are hooked to the
smallest of them without comparing; only what is not yet connected is compared.

NULL and empty texts have fingerprint zero and link like any other. Every row
is judged by its own text, also where ids repeat. Rows whose id is NULL take
part and get the component of their group, NULL if no id in it is known. An
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.common import Scratch, attach
from millrace.llm.components import connected_components

SEED = 42
SHINGLE = 3
MAX_BITS = 3
HALF = (1 << 32) - 1
BLOCK = 1 << 14  # shingle hashes counted at a time


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority of the bits of XXH64 over the word shingles; 0 without words."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = (ends - [len(w) for w in words])[: len(words) - width + 1].tolist()
    spans = zip(starts, ends[width - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """``id`` and ``fingerprint``, a signed 64-bit number, of every row.

    Not a UDF: Spark 4.1 cannot run one whose text is computed on both sides of a union, as after ``attach``.
    """
    held = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    schema = StructType(held.select("id").schema.fields).add("fingerprint", "long")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint_of(value, shingle) for value in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.array(prints, dtype=np.uint64).view(np.int64))], names=schema.names)

    return held.mapInArrow(found, schema)


def _syndrome(value: Column) -> Column:
    """Which of bits 1 to 31 to flip to reach the code; 0 for none."""
    parity = F.lit(0)
    for k in range(5):
        checked = sum(1 << (j - 1) for j in range(1, 32) if j >> k & 1)
        odd = F.bit_count(value.bitwiseAND(F.lit(checked))).bitwiseAND(F.lit(1))
        parity = parity + odd * (1 << k)
    return parity


def own_anchor(value: Column) -> Column:
    """The nearest code word of a 32-bit value."""
    flips = F.array(*[F.lit(1 << (s - 1) if s else 0).cast("bigint") for s in range(32)])
    return value.bitwiseXOR(F.get(flips, _syndrome(value)))


def near_anchors(value: Column) -> Column:
    """All code words within two bits of a 32-bit value."""
    last = 1 << 31
    table = []
    for s in range(32):
        one = 1 << (s - 1) if s else 0
        pairs = [1 << (i - 1) | 1 << ((i ^ s) - 1) for i in range(1, 32) if s and i ^ s and i < i ^ s]
        table.append(F.array(*[F.lit(flip).cast("bigint") for flip in (one, one | last, *pairs)]))
    return F.transform(F.get(F.array(*table), _syndrome(value)), lambda flip: value.bitwiseXOR(flip))


def _halves(fingerprint: Column) -> dict[str, Column]:
    return {
        "high": F.shiftrightunsigned(fingerprint, 32).bitwiseAND(F.lit(HALF)),
        "low": fingerprint.bitwiseAND(F.lit(HALF)),
    }


def _sure_links(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """Links to the smallest fingerprint with the same half and the same anchor of the other half."""
    halves = _halves(F.col("fingerprint"))
    found = None
    for same, other in (("high", "low"), ("low", "high")):
        near = prints.select("fingerprint", F.lit(same).alias("side"), halves[same].alias("same"), own_anchor(halves[other]).alias("anchor"))
        found = near if found is None else found.unionByName(near)
    least = found.groupBy("side", "same", "anchor").agg(F.min("fingerprint").alias("b"), F.max("fingerprint").alias("_max")).where("b != _max")
    least = scratch.write("nearest", least)
    return found.join(least, ["side", "same", "anchor"]).select(F.col("fingerprint").alias("a"), "b").where("a != b").distinct()


def _compared_links(prints: DataFrame) -> DataFrame:
    """Pairs of fingerprints within ``MAX_BITS`` whose groups differ; each pair from one half only."""
    halves = _halves(F.col("fingerprint"))
    shape = ["side", "anchor", "fingerprint", "group"]
    own = [prints.select(F.lit(s).alias("side"), own_anchor(h).alias("anchor"), "fingerprint", "group") for s, h in halves.items()]
    near = [prints.select(F.lit(s).alias("side"), F.explode(near_anchors(h)).alias("anchor"), "fingerprint", "group") for s, h in halves.items()]
    left = own[0].unionByName(own[1]).toDF("side", "anchor", "a", "group_a")
    right = near[0].unionByName(near[1]).select(*shape).toDF("side", "anchor", "b", "group_b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    once = (F.col("side") == "low") | (F.bit_count(differ.bitwiseAND(F.lit(HALF))) > 1)
    close = (F.col("a") < F.col("b")) & (F.col("group_a") != F.col("group_b")) & (F.bit_count(differ) <= MAX_BITS) & once
    return left.join(right, ["side", "anchor"]).where(close).select(F.col("group_a").alias("a"), F.col("group_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id``, one row per row of the input. Runs jobs."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.write("rows", fingerprints(docs, key, text, shingle))
    prints = scratch.write("prints", rows.groupBy("fingerprint").agg(F.min("id").alias("id")))
    sure = connected_components(_sure_links(prints, scratch), Scratch(docs.sparkSession, "simhash-sure"))
    sure = scratch.write("sure", sure)
    grouped = prints.join(sure, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "id", F.coalesce("component", "fingerprint").alias("group")
    )
    grouped = scratch.write("grouped", grouped)
    linked = connected_components(_compared_links(grouped), Scratch(docs.sparkSession, "simhash-linked"))
    final = grouped.join(linked, F.col("group") == F.col("node"), "left").select(
        "fingerprint", "id", F.coalesce("component", "group").alias("component")
    )
    final = scratch.write("final", final)
    least = scratch.write("least", final.groupBy("component").agg(F.min("id").alias("component_id")))
    named = scratch.write("named", final.join(least, "component").select("fingerprint", "component_id"))
    return rows.join(named, "fingerprint").select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The documents of the smallest id of each component, all columns as they were.

    Rows that repeat the kept id are all kept; rows without an id are kept only
    where their whole group has none.
    """
    scratch = Scratch(docs.sparkSession, "simhash-kept")
    found = near_duplicates(docs, key, text, shingle).select(F.col(key).alias("key"), "component_id")
    kept = found.groupBy("key").agg(F.bool_or(F.col("key").eqNullSafe(F.col("component_id"))).alias("kept"))
    dropped = kept.where("NOT kept").select("key", F.lit(0).cast("bigint").alias("version"), "kept")
    joined, (mark,) = attach(docs, key, F.lit(0).cast("bigint"), scratch.write("dropped", dropped), scratch)
    return joined.where(F.col(mark).isNull()).drop(mark)
