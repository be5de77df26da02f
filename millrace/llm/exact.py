"""Exact dedup with a heavy-hitter split.

A row's digest is the SHA-256 of its text without ASCII white space. Of the rows
with equal digests the longest text stays, then the smallest key.

Digests that very many rows share would meet in one task of a shuffle. So they
are found first: a Misra-Gries summary (Spark's ``approx_top_k``, whose counters
are bounded and merge across tasks) names the digests that may hold a share of
``HEAVY_SHARE`` of the rows. A summary only estimates: the candidates are then
counted exactly, combined before the exchange, and their winners, one row per
candidate and so ``1 / HEAVY_SHARE`` rows at most, are broadcast: rows of a heavy
digest are judged where they are read and never move. All other digests have few
rows each and take an ordinary shuffle. The split decides only where rows are
judged: a digest the summary misses is right too.

One pass reads the texts and writes a narrow table (key, length, digest); both
sides work on that, so texts do not move unless ``carry`` names them.

NULL counts as an empty text, and so does one of white space alone: they are
equal. NULL keys come after all others. Rows equal in key and length are told
apart by their place in the narrow table: exactly one row of a group stays. An
empty table gives an empty result. Columns named in ``carry`` come along under
their names; a name the result already has is an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, Scratch

HEAVY_SHARE = 1e-3
COUNTERS = 16_384  # of the summary: its error is a quarter of the share at most
RESULT = ("keep_key", "group_size", "kept", "text_sha256")


def normal_text(text: Column) -> Column:
    """The text without ASCII white space; NULL is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", "")


def digests(docs: DataFrame, key: str, text: str, carry: Sequence[str] = ()) -> DataFrame:
    """``key``, ``chars``, ``digest``, ``row`` and the carried columns, named by their place."""
    carried = [F.col(name).alias(f"carry_{i}") for i, name in enumerate(carry)]
    chars = F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("chars")
    digest = F.sha2(F.encode(normal_text(F.col(text)), "utf-8"), 256).alias("digest")
    return docs.select(F.col(key).alias("key"), chars, digest, F.monotonically_increasing_id().alias("row"), *carried)


def heavy_candidates(rows: DataFrame, share: float = HEAVY_SHARE, counters: int = COUNTERS) -> DataFrame:
    """Digests that may hold at least ``share`` of the rows: every such digest, and few others."""
    top = F.expr(f"approx_top_k(digest, {round(1 / share)}, {counters})")
    summary = rows.agg(top.alias("top"), F.count("*").alias("n"))
    each = summary.select("n", F.explode("top").alias("entry"))
    # Estimates never fall below the true count.
    return each.where(F.col("entry.count") >= F.greatest(F.col("n") * share, F.lit(2.0))).select(F.col("entry.item").alias("digest"))


def winners(rows: DataFrame) -> DataFrame:
    """``digest``, ``first`` (the row that stays) and ``group_size`` of every digest; combines before the exchange."""
    order = F.struct((-F.col("chars")).alias("shorter"), F.col("key").isNull().alias("unknown"), "key", "row")
    return rows.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))


def exact_dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", carry: Sequence[str] = (),
    share: float = HEAVY_SHARE, counters: int = COUNTERS,
) -> DataFrame:
    """One row per input row: the key, ``keep_key``, ``group_size``, ``kept``, ``text_sha256`` and the carried columns. Runs jobs."""
    taken = {key.lower(), *RESULT}
    if clash := [name for name in carry if name.lower() in taken]:
        raise ValueError(f"the result has columns of these names: {clash}")
    scratch = Scratch(docs.sparkSession, "exact")
    rows = scratch.write("digests", digests(docs, key, text, carry))
    candidates = scratch.write("candidates", heavy_candidates(rows, share, counters))
    verified = scratch.write("heavy", winners(rows.join(F.broadcast(candidates), "digest", "left_semi")))
    heavy = rows.join(F.broadcast(verified), "digest")
    others = rows.join(F.broadcast(verified.select("digest")), "digest", "left_anti")
    light = others.join(winners(others).hint("merge"), "digest")  # one plan at every size
    judged = heavy.unionByName(light)
    return judged.select(
        F.col("key").alias(key),
        F.col("first.key").alias("keep_key"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
        *[F.col(f"carry_{i}").alias(name) for i, name in enumerate(carry)],
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    rest = [name for name in docs.columns if name != key]
    numbered = docs.select(key, F.struct(*rest).alias("_rest"), F.col(text).alias("_text"))
    judged = exact_dedup(numbered, key, "_text", carry=["_rest"]).where("kept")
    return judged.select(key, "_rest.*").select(*docs.columns)
