"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, exact, html, lines, merkle, oracles, packing, periodic, pii, quality, simhash, suffixes, toxicity, urls
from millrace.llm.common import lower_ascii

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = oracles.SQL


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed_lines")


@query
def op2_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query
def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.dedup_substrings(table(spark, sf, "documents"))


@query
def op4_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    items = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", items, "contaminated")


@query
def op5_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(table(spark, sf, "documents")))


@query
def op6_length_bucket_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), ["doc_id"])


@query
def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op8_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract(table(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op9_url_link_graph(spark: SparkSession, sf: str) -> DataFrame:
    return urls.url_filter(table(spark, sf, "pages")).select("page_id", "host", "path", "rule", "verdict")


def held_out(key):
    return F.pmod(F.crc32(key.cast("string")), F.lit(5)) == 0


def toxicity_model(spark: SparkSession, docs: DataFrame, sf: str) -> toxicity.Model:
    """Fitted on the labelled documents of the table that are not held out."""
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    return toxicity.train(docs.select(F.col("doc_id").alias("id"), "text"), labels.where(~held_out(F.col("id"))))


@query
def op10_toxicity_mil(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "worst_sentence", "n_offending")


@query
def op11_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = exact.exact_dedup(table(spark, sf, "documents"))
    return found.select("doc_id", F.col("keep_key").alias("keep_id"), "group_size", "kept", "text_sha256")


@query
def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = [lower_ascii(F.col(name)) if name == "text" else F.col(name) for name in fields]
    tampered = F.when(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")), F.lit(3)) == 0, merkle.leaf_hash(lowered))
    rows = merkle.manifest(table(spark, sf, "documents"), fields, "lang", "doc_id", carry={"tampered": tampered})
    proved = rows.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        merkle.path_digest(F.col("path")).alias("proof_sha256"),
        merkle.fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    )
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", periodic.with_repeats(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic.collapse_runs(docs)
    best = F.get("runs", F.col("strongest"))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[best[name].alias(name) for name in ("start", "length", "period")],
        F.expr("get(runs, strongest).length * 1000 div get(runs, strongest).period").alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(line, ""), "utf-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("text", "utf-8"), 256).alias("collapsed_sha256"),
    )
