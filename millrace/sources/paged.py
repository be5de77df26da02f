"""Paged API responses, saved as one row per page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize


def paged_payload_flatten(pages: DataFrame, record: str) -> DataFrame:
    """Records of the pages a client would have fetched, in one pass order. Runs a job.

    ``pages`` has ``page``, ``status`` and ``body``; a body is JSON with
    ``results`` and ``has_next_page``. Fetching ends at the first page that is
    not a 200 or is empty (left out), or that has no next page (included).
    ``record`` is the DDL of one result.

    Two phases: bodies are parsed once, into rows (page, what it means for the
    scan, results) in the session's shared folder. The page where the scan stops is the least over its
    narrow columns, and the results of the pages before it are read from there.
    """
    parsed = pages.select(
        "page",
        "status",
        F.from_json("body", f"results array<struct<{record}>>, has_next_page boolean").alias("body"),
    )
    unusable = (F.col("status") != 200) | (F.coalesce(F.size("body.results"), F.lit(0)) <= 0)
    shaped = parsed.select(
        "page", F.coalesce(unusable, F.lit(False)).alias("unusable"), (~F.coalesce("body.has_next_page", F.lit(False))).alias("last"), "body.results"
    )
    written = materialize(shaped, "parsed-pages")
    ends = written.agg(
        F.struct(
            F.min(F.when(F.col("unusable"), F.col("page"))).alias("unusable"),
            F.min(F.when(F.col("last"), F.col("page"))).alias("last"),
        ).alias("ends")
    ).scalar()
    fetched = F.coalesce(F.col("page") < ends["unusable"], F.lit(True)) & F.coalesce(
        F.col("page") <= ends["last"], F.lit(True)
    )
    return written.filter(fetched).select("page", F.explode("results").alias("r")).select("page", "r.*")


def paged_incremental(pages: DataFrame, record: str, since: Column, updated: str = "updated_at") -> DataFrame:
    """Fetched records updated since a time, oldest first."""
    return paged_payload_flatten(pages, record).filter(F.col(updated) >= since).orderBy(updated)
