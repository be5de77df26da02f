"""Exact dedup, the Merkle manifest and periodic runs against plain versions, at their edges."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import exact, merkle, periodic
from millrace.llm.catalog import QUERIES, table
from tests.llm import brute

SF = "/root/testdata/sf0.001"


# ---- exact dedup

TEXTS = [(3, "a b"), (1, "ab"), (2, "a\tb"), (4, None), (5, ""), (6, " \n"), (7, " ab"), (8, "é" * 3), (9, "é é é"), (10, "A b"), (11, "a b")]


def exact_rows(df):
    return {r.doc_id: (r.keep_key, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


@pytest.mark.parametrize("share", [1e-3, 0.2, 1.0])
def test_exact_dedup_is_the_same_whatever_is_heavy(spark, share):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string").repartition(3)
    assert exact_rows(exact.exact_dedup(docs, share=share)) == brute.exact(TEXTS)


def test_exact_dedup_of_a_group_with_a_third_of_the_rows(spark):
    rows = [(i, "the same  text" if i % 3 == 0 else f"text {i // 2}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert exact_rows(exact.exact_dedup(docs)) == brute.exact(rows)
    digests = exact.digests(docs, "doc_id", "text")
    heavy = {r.digest for r in exact.heavy_candidates(digests, share=0.1).collect()}
    assert heavy == {brute.sha256("thesametext")}


def test_exact_dedup_keeps_one_of_equal_rows_and_prefers_known_keys(spark):
    docs = spark.createDataFrame([(None, "x"), (7, "x"), (7, "x"), (None, "lone")], "doc_id bigint, text string")
    got = exact.exact_dedup(docs).collect()
    assert sorted((r.text_sha256 == brute.sha256("x"), r.kept) for r in got) == [(False, True), (True, False), (True, False), (True, True)]
    assert {r.keep_key for r in got} == {None, 7}


def test_exact_dedup_drops_copies_with_all_columns(spark):
    docs = spark.createDataFrame([(1, "a", "u", 1), (2, "a ", "v", 2), (3, "b", None, None)], "doc_id bigint, text string, digest string, row int")
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(2, "a ", "v", 2), (3, "b", None, None)]
    carried = exact.exact_dedup(docs, carry=["digest", "row"])
    assert {(r.doc_id, r.digest, r.row) for r in carried.collect()} == {(1, "u", 1), (2, "v", 2), (3, None, None)}
    with pytest.raises(ValueError):
        exact.exact_dedup(docs.withColumn("kept", F.lit(1)), carry=["kept"])


def test_exact_dedup_of_nothing_and_of_a_very_long_text(spark):
    assert exact.exact_dedup(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    long = "wort " * 400_000
    rows = [(1, long), (2, long.replace(" ", "\n")), (3, long + "x")]
    assert exact_rows(exact.exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"))) == brute.exact(rows)


# ---- Merkle manifest

def manifest_rows(spark, rows, fanout, levels):
    docs = spark.createDataFrame(rows, "part string, key bigint, text string").repartition(5)
    got = merkle.manifest(docs, ["key", "text"], "part", "key", fanout=fanout, block_levels=levels)
    return sorted([(r.key, r.part, r.leaf, r.subroot, r.root, tuple(map(tuple, r.path))) for r in got.collect()], key=repr)


def leaf(*values):
    return brute.sha256("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


@pytest.mark.parametrize(
    ("sizes", "fanout", "levels"),
    [([1], 8, 3), ([0, 1, 9], 8, 1), ([1, 2, 70, 3, 65, 64, 8, 9, 600, 5], 8, 1), ([40, 1, 17] * 6, 3, 1), ([5] * 9, 2, 2), ([700, 10, 1, 513, 512], 8, 3)],
)
def test_manifest_matches_a_plain_tree(spark, sizes, fanout, levels):
    dice = random.Random(len(sizes))
    rows = [
        (None if p == 1 else f"p{p}é", None if dice.random() < 0.02 else dice.randrange(10**6), dice.choice([None, "", "aé", "x" * 50]))
        for p, size in enumerate(sizes) for _ in range(size)
    ]
    expected = brute.merkle([(part, key, leaf(key, text)) for part, key, text in rows], fanout)
    assert manifest_rows(spark, rows, fanout, levels) == sorted(expected, key=repr)


def test_manifest_of_nothing_and_of_repeated_rows(spark):
    assert manifest_rows(spark, [], 8, 3) == []
    rows = [("a", 1, "same")] * 10 + [(None, None, None)]
    assert manifest_rows(spark, rows, 8, 1) == sorted(brute.merkle([(p, k, leaf(k, t)) for p, k, t in rows]), key=repr)


def test_manifest_root_does_not_depend_on_row_order_and_shows_any_change(spark):
    rows = [(f"p{i % 3}", i, f"text {i}") for i in range(100)]

    def root(changed):
        (value,) = {r[4] for r in manifest_rows(spark, changed, 4, 1)}
        return value

    whole = root(rows)
    assert root(rows[::-1]) == whole
    assert root([*rows[:-1], ("p0", 99, "text 99 ")]) != whole
    assert root(rows[:-1]) != whole


def test_manifest_carries_columns_and_refuses_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a", "t", "x")], "doc_id bigint, lang string, text string, leaf string")
    got = merkle.manifest(docs, ["text"], "lang", "doc_id", carry={"other": F.col("leaf")}).first()
    assert (got.other, got.leaf, got.path) == ("x", leaf("t"), [])
    with pytest.raises(ValueError):
        merkle.manifest(docs, ["text"], "lang", "doc_id", carry={"leaf": F.col("leaf")})


def test_manifest_query_finds_the_tampered_rows(spark):
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    for r in QUERIES["op12_merkle_manifest"](spark, SF).collect():
        doc = docs[r.doc_id]
        fields = [doc.doc_id, doc.source, doc.lang, doc.n_chars]
        assert r.leaf == leaf(*fields, doc.text)
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in doc.text)
        tampered = brute.zlib.crc32(str(doc.doc_id).encode()) % 3 == 0 and lowered != doc.text
        assert r.verified == (not tampered) == (r.folded_root == r.root)


# ---- periodic runs

def collapsed(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id: r for r in periodic.collapse_runs(docs).collect()}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12)), max_size=5))
def test_runs_match_all_periods_tried(parts):
    words = [str(w).encode() for base, times in parts for w in base * times]
    assert periodic.word_runs(words) == brute.runs(words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=3, max_size=60))
def test_short_runs_match_all_periods_tried(words):
    assert [tuple(r) for r in periodic.stretch_runs(words, 3).tolist()] == brute.runs(words, 3)


def test_query_matches_plain_version(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert got == {key: brute.periodic_row(text, key) for key, text in texts.items()}
    assert any(row[1] for row in got.values())


def test_runs_at_the_edges(spark):
    one = "a " * 30
    got = collapsed(spark, [None, "", " \n", "x", one, "b c d\n" * 8, ("p q r s " * 6) + "t " + ("u v " * 12), "é " * 23])
    assert [got[i].n_words for i in range(8)] == [0, 0, 0, 1, 30, 16, 49, 23]
    assert [[tuple(r) for r in got[i].runs] for i in range(8)] == [[], [], [], [], [(0, 30, 1)], [], [(0, 24, 4), (25, 24, 2)], []]
    assert [got[i].strongest for i in (0, 4, 6)] == [None, 0, 1]
    assert [got[i].text for i in (0, 2, 3, 4, 6)] == ["", "", "x", "a", "p q r s t u v"]


def test_runs_of_a_very_long_text(spark):
    run = collapsed(spark, ["x " + " ".join([f"w{i * i % 1009}" for i in range(1009)] * 120)])[0]
    assert [tuple(r) for r in run.runs] == [(1, 121_080, 1009)]
    assert len(run.text.split()) == 1010


def test_runs_keep_other_columns_and_replace_their_own(spark):
    docs = spark.createDataFrame([(1, "a " * 24, "u"), (1, "a " * 24, "u")], "runs int, text string, c string")
    got = periodic.collapse_runs(docs)
    assert got.columns == ["text", "c", "n_words", "runs", "strongest"]
    assert [(r.text, r.c, len(r.runs)) for r in got.collect()] == [("a", "u", 1)] * 2
    assert periodic.collapse_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic.collapse_runs(docs, repeats=2)
