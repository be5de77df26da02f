"""From raw documents to packed training batches, in five stages.

Each stage takes the documents its predecessor kept, as a written table, and
works on all of them. All but the last return the columns of ``documents``.
The toxicity model is trained, so SQL cannot state the rows of ``run``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, lines, packing, simhash, toxicity
from millrace.llm.catalog import table, toxicity_model
from millrace.llm.common import Scratch
from millrace.session import configure


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labelled ones among them does not call toxic."""
    configure(spark)
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.where("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the runs of lines that stand earlier; ``n_chars`` follows the text."""
    configure(spark)
    cut = lines.dedup_lines(docs)
    n_chars = F.when(F.col("n_removed_lines") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of linked fingerprints."""
    configure(spark)
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    configure(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their length bucket, batch and slot."""
    configure(spark)
    return packing.pack(docs, ["doc_id"], carry=[name for name in docs.columns if name != "doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("length_bucket_packing", pack_batches),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; what is between two stages is a Parquet table."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.replace("docs", stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
