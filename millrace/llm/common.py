"""Helpers the training-data operators share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import remove_dir, scratch_dir

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it.

    A lambda evaluates its whole body for every element, so an expression that
    does not depend on the element has to be bound outside.
    """
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is; a text of ASCII takes the faster function."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def space_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda word: word != "")


def total(values: Column) -> Column:
    """The sum of an array of whole numbers."""
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` has it."""
    taken = {name.lower() for name in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


class Scratch:
    """Intermediate tables of one operator call in the shared folder.

    Written tables survive the loss of an executor. ``replace`` removes a table
    once its successor is written, so a loop holds two of them at most.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.label = spark, label
        self.paths: dict[str, str] = {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = scratch_dir(self.spark, f"{self.label}-{name}")
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.parquet(path)

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        old = self.paths.get(name)
        written = self.write(name, df)
        if old:
            remove_dir(self.spark, old)
        return written

    def drop(self, *names: str) -> None:
        for name in names:
            remove_dir(self.spark, self.paths.pop(name))


ROW_BITS = 1 << 26  # slots of the row filter; its bitmaps take 8 MB at most


def attach(
    rows: DataFrame, key: str, version: Column, found: DataFrame, scratch: Scratch, inner: bool = False
) -> tuple[DataFrame, list[str]]:
    """Join rows (mostly long texts) with what was found for some of them.

    ``found`` has ``key``, ``version`` and further columns, once per key and
    version; it must be a written table. They come back under the returned
    names, NULL where nothing was found; ``inner`` leaves those rows out.

    Few rows usually have a match, and rows with texts are dear to exchange. So
    the matches' hashes set bits in bitmaps of fixed total size, which are
    broadcast; a row without its bit has no match and does not move. With more
    matches than bits every row moves, and the result is the same.
    """
    payload = [name for name in found.columns if name not in ("key", "version")]
    slot, bucket, bitmap, other_key, other_version, *names = fresh(rows, "_slot", "_bucket", "_bitmap", "_key", "_version", *[f"_{n}" for n in payload])

    def slot_of(row_key: Column, row_version: Column) -> Column:
        return F.pmod(F.xxhash64(row_key, row_version), F.lit(ROW_BITS)) + 1

    slots = found.select(slot_of(F.col("key"), F.col("version")).alias("slot"))
    bits = slots.groupBy(F.bitmap_bucket_number("slot").alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias(bitmap))
    bits = F.broadcast(scratch.write("bits", bits))
    placed = rows.withColumn(slot, slot_of(F.col(key), version)).withColumn(bucket, F.bitmap_bucket_number(slot)).join(bits, bucket, "left")
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.coalesce(F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1, F.lit(False))
    may_match = placed.where(marked).select(*rows.columns)
    renamed = found.select(F.col("key").alias(other_key), F.col("version").alias(other_version), *[F.col(o).alias(n) for o, n in zip(payload, names)])
    same = F.col(key).eqNullSafe(F.col(other_key)) & (version == F.col(other_version))
    # Sort-merge at every size: a plan that turns with the size of what was found is hard to foresee, and it splits hot keys.
    joined = may_match.join(renamed.hint("merge"), same, "inner" if inner else "left").drop(other_key, other_version)
    if inner:
        return joined, names
    nothing = [F.lit(None).cast(found.schema[o].dataType).alias(n) for o, n in zip(payload, names)]
    return joined.unionByName(placed.where(~marked).select(*rows.columns, *nothing)), names
