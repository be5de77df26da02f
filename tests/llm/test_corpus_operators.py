"""SimHash, substring dedup and decontamination against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import bwt, decontaminate, lines, simhash, suffixes
from millrace.llm.common import Scratch
from millrace.llm.components import connected_components
from tests.llm import brute

DOCS = "doc_id long, text string, _key string, component string, lo long"


@pytest.fixture(scope="session")
def docs(spark):
    return lambda *rows: spark.createDataFrame([(i, t, "k", "c", 1) for i, t in rows], DOCS)


# --- SimHash


def test_every_near_value_shares_an_own_anchor(spark):
    rng = random.Random(1)
    pairs = []
    for _ in range(400):
        x = rng.getrandbits(32)
        pairs += [(x, x ^ 1 << rng.randrange(32)), (x, x)]
    df = spark.createDataFrame(pairs, "x long, y long")
    checked = df.select(
        F.array_contains(simhash.near_anchors(F.col("y")), simhash.own_anchor(F.col("x"))).alias("met"),
        F.bit_count(F.col("x").bitwiseXOR(simhash.own_anchor(F.col("x")))).alias("radius"),
        F.size(simhash.near_anchors(F.col("x"))).alias("n"),
    ).collect()
    assert all(r.met and r.radius <= 1 and r.n <= 17 for r in checked)


def near_texts():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    out = []
    for group in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(200, 500))]
        for copy in range(6):
            text = list(base)
            for _ in range(copy % 3):
                text[rng.randrange(len(text))] = rng.choice(words)
            out.append(" ".join(text).title() if copy == 5 else " ".join(text))
    return [*out, None, "", " \t ", "one", "One two", "x " * 30000]


def test_components_match_all_pairs(docs):
    texts = near_texts()
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(*enumerate(texts))).collect()}
    prints = {i: brute.fingerprint(t) for i, t in enumerate(texts)}
    expected = brute.components(prints)
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in got.items()} == expected
    assert len(set(expected.values())) < len(texts) - 30


def test_links_across_halves_are_found(spark):
    rng = random.Random(3)
    prints = {}
    for i in range(150):
        x = rng.getrandbits(64)
        for j in range(4):
            y = x
            for bit in rng.sample(range(64), j):
                y ^= 1 << bit
            prints[4 * i + j] = y
    rows = [(i, int(np.uint64(p).view(np.int64))) for i, p in prints.items()]
    df = spark.createDataFrame(rows, "doc_id long, fp long").withColumn("group", F.col("fp"))
    compared = simhash._compared_links(df.select(F.col("fp").alias("fingerprint"), "group"))
    linked = {frozenset(int(np.int64(v).view(np.uint64)) for v in r) for r in compared.collect()}
    values = sorted(set(prints.values()))
    expected = {frozenset((a, b)) for k, a in enumerate(values) for b in values[k + 1 :] if (a ^ b).bit_count() <= 3}
    assert linked == expected


def test_texts_that_another_operator_computes_need_not_be_written_first(docs):
    cut = lines.dedup_lines(docs((1, "a b c\nd e f"), (2, "g h i"), (3, "a b c\nd e f\ng h i"), (4, None)))
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[3] == "g h i"
    got = {r.doc_id: int(r.fingerprint, 16) for r in simhash.near_duplicates(cut).collect()}
    assert got == {i: brute.fingerprint(t) for i, t in texts.items()}
    assert sorted(r.doc_id for r in simhash.keep_one(cut).collect()) == [1, 2, 4]


def test_simhash_edge_rows(docs):
    table = docs((5, "a b c d"), (None, "a b c d"), (3, "a b c d"), (3, "other words entirely here"), (None, None))
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(table).collect()), key=repr)
    assert len(got) == 5 and (5, 3) in got and (None, 3) in got and (None, None) in got
    assert sorted(r.text for r in simhash.keep_one(table.where("doc_id IS NOT NULL")).collect()) == ["a b c d", "other words entirely here"]
    assert simhash.near_duplicates(docs()).collect() == []


def test_components_of_chains_and_stars(spark, rows):
    chain = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 160)] + [(7, 7), (None, 3), (1, 0)]
    got = rows(connected_components(spark.createDataFrame(chain, "a long, b long"), Scratch(spark, "t")), "node", "component")
    assert got == sorted([(i, 0) for i in range(41)] + [(j, 100) for j in range(100, 160)], key=repr)


# --- near copies by shingles


def test_pipeline_stage_keeps_one_of_each_group(spark, docs):
    import corpus_pipeline

    texts = [" ".join(f"w{i * k % 97}" for i in range(120)) for k in range(1, 9)]
    rows = [(10 * k + c, text + " extra" * (c == 2)) for k, text in enumerate(texts) for c in range(3)]
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(*rows)).collect()}
    kept = corpus_pipeline.drop_near_copies(spark, docs(*rows), "")
    assert kept.columns == docs().columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups.values()))


# --- substring dedup


def blocks_by_sorting(texts, depth):
    """Blocks of ring suffixes by their first symbols; symbols past a terminator go on with the same string."""
    out = []
    for text in texts:
        ring = text * (depth // len(text) + 2)
        out += [tuple(ring[i : i + depth]) for i in range(len(text))]
    return out


@pytest.mark.parametrize("depth", [1, 2, 3, 5, 8, 13])
def test_merge_groups_equal_prefixes(depth):
    rng = random.Random(depth)
    shards, prefixes = [], []
    for _ in range(3):
        texts = [[rng.randint(1, 2) for _ in range(rng.randint(0, 12))] + [0] for _ in range(5)]
        ends = np.cumsum([len(t) for t in texts]) - 1
        shard = bwt.build(np.array([s for t in texts for s in t]), ends)
        shards.append(shard)
        own = blocks_by_sorting(texts, depth)
        prefixes += [own[i] for i in shard.text_at]
    block, order, common = bwt.merge(shards, depth)
    assert sorted(order.tolist()) == list(range(len(prefixes)))
    by_block = {}
    for b, p in zip(block.tolist(), prefixes):
        assert by_block.setdefault(b, p) == p
    assert len(by_block) == len(set(prefixes))
    merged = [prefixes[i] for i in order]
    assert merged == sorted(merged)
    for i in range(1, len(merged)):
        shared = next((k for k, (x, y) in enumerate(zip(merged[i - 1], merged[i])) if x != y), depth)
        assert common[i] <= shared and (common[i] == depth) == (shared == depth)


def passages(seed, alphabet="abcd"):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [make(rng.randint(30, 90)) for _ in range(4)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts.append(make(rng.randint(0, 40)))
            if rng.random() < 0.6:
                parts.append(rng.choice(shared))
        texts.append("".join(parts))
    return [*texts, texts[0], None, "", "é" * 40, "a" * 200, "ab" * 60 + "é"]


@pytest.mark.parametrize("sizes", [{}, {"group_rows": 3}, {"group_rows": 3, "bucket_symbols": 500, "shard_symbols": 120}])
@pytest.mark.parametrize("seed", [1, 2])
def test_removed_bytes_match_all_windows(docs, sizes, seed):
    texts = passages(seed)
    table = docs(*enumerate(texts))
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.dedup_substrings(table, length=32, gram=4, spread=16, **sizes).collect()}
    assert [got[i] for i in range(len(texts))] == brute.substrings(texts, 32)


def test_crowded_cores_are_cut_without_loss(docs):
    rng = random.Random(9)
    common = "".join(rng.choice("xyz") for _ in range(50))
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(5, 60))) + common + "".join(rng.choice("abc") for _ in range(40)) for _ in range(150)]
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.dedup_substrings(docs(*enumerate(texts)), length=32, gram=4, spread=16, group_rows=8).collect()}
    assert [got[i] for i in range(len(texts))] == brute.substrings(texts, 32)


def test_no_bucket_holds_a_whole_crowded_piece(docs, monkeypatch):
    rng = random.Random(10)
    common = "".join(rng.choice("xyz") for _ in range(50))
    texts = ["".join(rng.choice("abc") for _ in range(20)) + common + "".join(rng.choice("abc") for _ in range(40)) for _ in range(100)]
    most, merge = [], suffixes._repeated_windows

    def watched(strings, *sizes):
        most.append(max([0, *(r["count"] for r in strings.groupBy("core").count().collect())]))
        return merge(strings, *sizes)

    monkeypatch.setattr(suffixes, "_repeated_windows", watched)
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.dedup_substrings(docs(*enumerate(texts)), length=32, gram=4, spread=16, group_rows=8).collect()}
    assert [got[i] for i in range(len(texts))] == brute.substrings(texts, 32)
    assert most and max(most) <= 8


def test_stretches_of_long_texts_and_repeated_rows(docs, monkeypatch):
    monkeypatch.setattr(suffixes, "STRETCH", 50)
    layout = suffixes.Layout(32, 4, 16)
    data = bytes(random.Random(4).choices(b"abc", k=500))
    whole = [s for lo, hi, _ in layout.runs(data) for s in range(lo, hi + 1)]
    assert whole == list(range(len(data) - 31))
    same = docs((1, "abcdefgh" * 8), (1, "abcdefgh" * 8), (2, "short"))
    got = sorted(tuple(r) for r in suffixes.dedup_substrings(same, length=32, gram=4, spread=16, keep_bytes=True).select("doc_id", "n_removed").collect())
    assert got == [(1, 64), (1, 64), (2, 0)]
    assert suffixes.dedup_substrings(docs()).collect() == []


# --- decontamination


def brute_hits(texts, items):
    import re

    words = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for text in texts:
        own, hit, found = words(text), set(), set()
        for item, item_text in items:
            ws = words(item_text)
            size = min(10, len(ws))
            for i in range(len(ws) - size + 1 if ws else 0):
                for j in range(len(own) - size + 1):
                    if own[j : j + size] == ws[i : i + size]:
                        hit |= set(range(j, j + size))
                        found.add("" if item is None else str(item))
        out.append((len(own), len(hit), len(found), sorted(found), bool(hit)))
    return out


def leak_rows():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(25)] + ["École", "naïve"]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(0, 25)))) for i in range(20)] + [(100, None), (101, "only"), (None, "w1, W2; w3"), (10, "w4 w4 w4")]
    texts = []
    for i in range(60):
        text = rng.choices(words, k=rng.randint(0, 60))
        if i % 3 == 0:
            ws = (rng.choice(items)[1] or "").split()
            text[5:5] = ws[: rng.randint(5, 25)]
        texts.append(" ".join(text).upper() if i % 7 == 0 else " ".join(text))
    return [*texts, None, "", "w1-w2.w3", "w4 w4 w4 w4 w4"], items


@pytest.mark.parametrize("rarest", [1, 3])
def test_hits_match_all_windows(spark, docs, rarest):
    texts, items = leak_rows()
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.decontaminate(docs(*enumerate(texts)), bench, rarest=rarest)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in found.collect()}
    assert [got[i] for i in range(len(texts))] == brute_hits(texts, items)
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs(*enumerate(texts)), bench).collect()}
    assert kept == {i for i, r in got.items() if not r[4]}


def test_decontamination_edge_rows(spark, docs):
    bench = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "zzz")], "item_id long, text string")
    table = docs((1, "x a b c y"), (1, "other"), (None, "A-B-C"), (2, None), (2, None))
    got = sorted(((r.doc_id, r.n_words, r.n_hit) for r in decontaminate.decontaminate(table, bench).collect()), key=repr)
    assert got == sorted([(1, 5, 3), (1, 1, 0), (None, 3, 3), (2, 0, 0), (2, 0, 0)], key=repr)
    assert decontaminate.decontaminate(docs(), bench).collect() == []
    assert [r.n_hit for r in decontaminate.decontaminate(table, bench.limit(0)).collect()] == [0] * 5


def test_proximity_finds_loose_matches(spark, docs):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    table = docs((1, "alpha x x beta"), (2, "alpha " + "x " * 30 + "beta"), (3, "gamma"), (4, "gamma gamma alpha alpha beta"))
    windows = decontaminate.item_windows(bench).withColumn("window", F.lit("w"))
    frequency = spark.createDataFrame([("alpha", 1), ("beta", 2), ("gamma", 9)], "term string, n long")
    ranked = decontaminate.ranked_terms(windows, frequency)
    postings = decontaminate.positional_index(table, frequency.select("term"))
    assert {r.key for r in decontaminate.proximity_matches(postings, ranked, span=5).collect()} == {1, 4}
