"""The registered training-data queries against their SQL, and the pipeline."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import decontaminate, simhash, toxicity
from millrace.llm.catalog import ORACLES, QUERIES, held_out, table, toxicity_model
from millrace.session import configure
from tests.llm import brute
from tools.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table_and_matches_sql(spark, db, name):
    result = QUERIES[name](configure(spark), SF)
    got = [tuple(row) for row in result.collect()]
    source = "pages" if "page_id" in result.columns else "documents"
    assert len(got) == db.execute(f"SELECT count(*) FROM {source}").fetchall()[0][0]
    if name in ORACLES:
        expected = db.execute(ORACLES[name])
        columns = [column[0] for column in expected.description]
        assert rows_of(result.columns, got) == rows_of(columns, expected.fetchall())


def test_substring_query_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op3_substring_dedup"](spark, SF).collect()}
    assert [got[i] for i in texts] == brute.substrings(list(texts.values()), 400)


def test_held_out_documents_are_told_apart(spark):
    sf = SF.replace("0.001", "0.01")
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").where(held_out(F.col("doc_id")))
    scored = toxicity.score(docs.join(labels, "doc_id"), toxicity_model(spark, docs, sf)).select("toxic", "score", "predicted").collect()
    bad, good = [r.score for r in scored if r.toxic], [r.score for r in scored if not r.toxic]
    assert bad and sum(b > g for b in bad for g in good) >= 0.9 * len(bad) * len(good)


def test_pipeline_stages_follow_each_other(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF)
        assert after.columns == columns, name
        assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in kept.select("doc_id").collect()}
        kept = after
    whole = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in whole.collect()} == {r.doc_id for r in kept.collect()}
    assert set(columns) < set(whole.columns)
    assert decontaminate.decontaminate(kept, table(spark, SF, "benchmark")).where("contaminated").isEmpty()
    assert simhash.near_duplicates(kept).where("doc_id <> component_id").isEmpty()
