"""Line dedup, quality rules, personal data, main text, URL filters, toxicity and packing."""

from __future__ import annotations

import hashlib
import random
from itertools import combinations

from hypothesis import given
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from millrace.llm import html, lines, packing, pii, quality, toxicity, urls
from millrace.llm.common import lower_ascii
from tests.llm import brute

DOCS = "doc_id long, text string, _key string, hash long, n_words string, bucket string"


@pytest.fixture(scope="session")
def docs(spark):
    """Builds a table with columns whose names clash with the operators' own."""
    return lambda *rows: spark.createDataFrame([(i, t, "k", 7, "w", "b") for i, t in rows], DOCS)


def test_lower_ascii_leaves_other_letters(spark):
    df = spark.createDataFrame([("ÉCOLE Abc",), ("ABC",), (None,)], "t string").select(lower_ascii(F.col("t")))
    assert [r[0] for r in df.collect()] == ["ÉcolE abc".replace("E", "e"), "abc", None]


# --- line dedup

PASSAGE = "\n".join(f"shared line number {i} with some words" for i in range(12))


def test_repeated_chunks_go_after_their_first_place(docs):
    first = f"alpha intro\n{PASSAGE}\nalpha outro"
    second = f"beta one\nbeta two\n{PASSAGE}\nbeta end"
    got = {r.doc_id: r for r in lines.dedup_lines(docs((1, first), (2, second), (3, "lone\nlines here"))).collect()}
    assert got[1].text == first and got[1].n_removed_lines == 0
    assert got[2].n_removed_lines >= 6
    assert set(got[2].text.split("\n")) <= set(second.split("\n"))
    assert got[2].text.startswith("beta one\n") and got[2].n_lines == 15
    assert got[3].text == "lone\nlines here" and got[3]["_key"] == "k"


def test_line_dedup_edge_rows(docs):
    rows = [(1, None), (2, ""), (3, "\n\n\n"), (4, "x\n" * 5000), (None, f"a\n{PASSAGE}"), (5, f"b\n{PASSAGE}"), (5, f"b\n{PASSAGE}")]
    got = lines.dedup_lines(docs(*rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].text is None and by_id[2].text == "" and by_id[3].text == "\n\n\n"
    assert by_id[None].n_removed_lines == 0
    fives = [r for r in got if r.doc_id == 5]
    assert len({r.text for r in fives}) == 1 and fives[0].n_removed_lines > 0
    assert lines.dedup_lines(docs()).collect() == []


def pairs_of(text):
    worded = [line for line in (text or "").split("\n") if line.strip(" \t\r\v\f")]
    return list(zip(worded, worded[1:]))


def test_runs_go_whole_whatever_stands_around_them(docs):
    runs = [[f"run {r} line {i}" for i in range(8 + r % 4)] for r in range(12)]
    rows = [(i, "\n".join([f"before {i}", *run, f"after {i}"])) for i, run in enumerate(runs)]
    rows += [(100 + i, "\n".join([f"other {i}", *run, f"end {i}"])) for i, run in enumerate(runs)]
    rows += [(200, "x\n" * 9 + "last"), (203, "a\nlone")]
    got = {r.doc_id: r for r in lines.dedup_lines(docs(*rows)).collect()}
    for i, run in enumerate(runs):
        assert got[i].text == rows[i][1]
        assert (got[100 + i].text, got[100 + i].n_removed_lines) == (f"other {i}\nend {i}", len(run))
    assert got[200].text == "x\nx\nlast" and got[200].n_removed_lines == 7
    assert got[203].text == "a\nlone"


def test_one_whole_copy_of_every_repeated_pair_stays(docs):
    rng = random.Random(5)
    blocks = [[f"block {b} line {i}" for i in range(rng.randint(2, 6))] for b in range(8)]
    texts = ["\n".join(line for _ in range(rng.randint(1, 6)) for line in rng.choice(blocks)) for _ in range(60)]
    texts += ["A\nB", "A\nB\nC", "B\nC", "A\n\nB", "A\n\nB"]
    kept = [r.text for r in lines.dedup_lines(docs(*enumerate(texts))).collect()]
    left = {pair for text in kept for pair in pairs_of(text)}
    inside = {pair for block in blocks for pair in zip(block, block[1:])} | {("A", "B"), ("B", "C")}
    assert inside & {pair for text in texts for pair in pairs_of(text)} <= left
    assert sum(len(pairs_of(t)) for t in kept) < 0.5 * sum(len(pairs_of(t)) for t in texts)


# --- quality rules


def brute_repeats(words):
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            hit |= set(range(i, i + 8))
    return len(hit)


def test_repeated_words_match_a_plain_count(docs):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("ab" if i % 2 else "abcdef") for _ in range(rng.randint(0, 60))) for i in range(60)]
    got = {r.doc_id: r for r in quality.measures(docs(*enumerate(texts))).collect()}
    for i, text in enumerate(texts):
        assert got[i]["n_repeat_words"] == brute_repeats(text.split()), text


def test_quality_edge_rows(docs):
    plain = "The cat sat on the mat and it was a good day for all of us in the old town by the sea. " * 1
    rows = [(1, None), (2, ""), (3, plain), (4, "#### $$$$ " * 30), (None, plain), (5, "same line\nsame line\n \nsame line")]
    got = {r.doc_id: r for r in quality.quality_rules(docs(*rows)).collect()}
    assert (got[1].n_words, got[1].base_failed, got[1].kept) == (0, True, False)
    assert got[3].kept and got[None].kept and not got[4].kept
    assert got[4].n_symbols == 240 and got[5].n_dup_lines == 2
    assert quality.quality_rules(docs()).collect() == []


# --- personal data

TEXTS = [
    "mail a.b@c.de, x@y.z_d@e.f and @no.one or a@b",
    "é 1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.255 1.2.3",
    "cards 4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111 11111111 0000000000000",
    "call +49 (30) 1234567-8, +1+1 555 0100 222 or +12 3",
    "a@" + "b." * 3000 + "c and " + "1 " * 6000 + "+1" + "0" * 12,
    "a" * 30000,
    None,
    "",
]


def test_base_spans_match_the_patterns(docs):
    got = {r.doc_id: r for r in pii.digest(pii.find_personal_data(docs(*enumerate(TEXTS)))).collect()}
    for i, text in enumerate(TEXTS):
        spans = brute.base_spans(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), i
        assert [got[i][f"n_{k}"] for k in brute.BASE] == [sum(s[0] == k for s in spans) for k in brute.BASE]
        assert set(joined.split(",")) <= set(got[i].spans.split(","))


def test_votes_add_what_form_alone_does_not_decide(docs):
    rows = [(i, f"login password=ab{i}cd34ef then text") for i in range(40)] + [(99, "of page 1.2 and chapter 4"), (98, "Dear Mr John Smith,")]
    got = {r.doc_id: r.spans for r in pii.digest(pii.find_personal_data(docs(*rows))).collect()}
    assert got[3] == "secret:6:24" and got[99] == ""
    masked = {r.doc_id: r.text for r in pii.mask(docs(*rows)).collect()}
    assert masked[3] == "login [secret] then text"
    assert pii.find_personal_data(docs()).collect() == []


def test_reliable_labelers_weigh_more():
    histogram = {(1, 1, 0): 80, (-1, -1, 1): 80, (1, 0, -1): 40, (-1, 0, 1): 40, (1, -1, 0): 2}
    odds, _, posterior = pii.estimate(histogram)
    assert posterior[1, 1, 0] > 0.9 > 0.1 > posterior[-1, -1, 1]
    assert odds[0][1] > odds[2][1]
    weights = pii.span_classifier(histogram, posterior)
    score = lambda p: sum(w * v for w, v in zip(weights, pii.features(p)))
    assert score((1, 1, 0)) > 0 > score((-1, -1, 1))


# --- main text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
%s
<aside class="sidebar">Side words that are long enough to count as a text of their own, really.</aside>
<div id="comments"><p>First!</p><article>Nested reply that goes on and on for quite a while here.</article></div>
<form><p>Name</p><input></form><footer>&copy; me</footer><script>var t = "</p><p>no</p>";</script></body></html>"""


def test_marked_article_is_taken_whole():
    body = '<article><h1>Title &amp; more</h1><p>One\n  <b>two</b>three.<br>four<div class="ad">Buy</div><p>Hi.<p class="notice">Mind the gap</p><ul><li>a<li>b</ul></article>'
    assert html.main_text(PAGE % body) == "Title & more\nOne twothree. four\nHi.\na\nb"


def test_unmarked_text_is_found_by_its_surge():
    words = "These are several words of a longer paragraph that carries the story along for a while."
    body = f'<div>menu</div><div>x</div><div>y</div><div>z</div><div><h2>Head</h2><p>{words}</p><p>{words} Two.</p><p>Short.</p></div><div></div><p><a href=a>one link</a></p><p><a href=b>two links</a></p><p><a href=c>three links</a></p><p><a href=d>more links</a></p>'
    text = html.main_text(PAGE % body).split("\n")
    assert text[:4] == ["Head", words, f"{words} Two.", "Short."]
    assert "Side words" not in "".join(text) and "First!" not in "".join(text)


def test_short_unmarked_text_is_found_with_its_byline():
    page = "<html><body><div>menu</div><nav>a</nav><h1>Title</h1><p>By me</p><p>Forty characters of a story that is short.</p><p>End.</p></body></html>"
    assert html.main_text(page) == "Title\nBy me\nForty characters of a story that is short.\nEnd."
    assert html.main_text("<p>Only this.</p>") == "Only this."
    assert html.main_text("<p><a href=x>only a link</a></p>") == ""


def test_the_mark_is_a_weight_that_much_text_outweighs():
    story = "Words of a paragraph outside of the marked text, " * 4
    body = f"<h2>Site</h2><p>{story}</p><article><p>One.</p></article><p>{story}</p><article><p><a href=x>Two</a></p></article><p>{story}</p>"
    assert html.main_text(body) == "One.\nTwo"
    assert html.main_text(body, mark=50).split("\n") == [story.strip(), "One.", story.strip(), "Two", story.strip()]
    assert html.line_weights(html.blocks(body))[:3] == [4 - html.MARK, len(story.strip()) - html.MARK, 4 + html.MARK]


def plain_surging(weights, window, surge):
    """The lines of the texts by the definition: each line asks for the last begin and dive before it."""
    def ahead(i):
        return sum(max(0, w) for w in weights[i : i + window])

    def may_begin(i, least):
        return ahead(i) >= least and weights[i] >= 1 and weights[i] >= least // 4

    possible = [least for least in range(surge, 0, -1) if any(may_begin(i, least) for i in range(len(weights)))]
    least = possible[0] if possible else surge
    kept, inside = set(), False
    for i, w in enumerate(weights):
        if inside:
            inside = w >= 0 and ahead(i) > 0
        else:
            inside = may_begin(i, least)
        if inside:
            kept.add(i)
    return kept


@given(st.lists(st.integers(-100, 200) | st.just(0), max_size=40), st.integers(1, 5), st.integers(1, 300))
def test_surge_and_dive_equal_the_plain_version(weights, window, surge):
    spans = html.surging(weights, window, surge)
    assert {i for a, b in spans for i in range(a, b + 1)} == plain_surging(weights, window, surge)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_broken_pages_do_not_stop_the_reader(spark):
    pages = [None, "", "<", "<p", "<article><p>open", "<!-- never closed <p>x</p>", '<div class="ad>x', "<script>let a = 1", "a < b && c", "<p>" * 3000 + "deep"]
    df = spark.createDataFrame([(i, p, "t") for i, p in enumerate(pages)], "page_id long, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html.extract(df).collect()}
    assert got[0] == got[1] == ("", 0) and got[4] == ("open", 4) and len(got) == len(pages)
    assert html.extract(df.limit(0)).collect() == []


def test_extracted_blocks_are_joined_by_two_newlines(spark):
    page = PAGE % "<article><h1>Title</h1><p>One\n two.<p>Three.</article>"
    row = html.extract(spark.createDataFrame([(1, page)], "page_id long, html string")).first()
    assert (row.text, row.n_chars) == ("Title\n\nOne two.\n\nThree.", 23)


# --- URL filters

URLS = [
    (1, "http://a.com/x", "com/", "allow"),
    (2, "https://EXAMPLE.com/en/1", "example.com/en/", "block"),
    (3, "https://www.example.com/en/1?x", "www.example.com/en/", "allow"),
    (4, "http://b.net/es/", "net/es/", "block"),
    (5, "http://com", None, None),
    (6, "nothing", None, "allow"),
    (7, None, None, "allow"),
    (8, "ftp://com/#a", "com/", "allow"),
]


def test_longest_rule_wins(spark):
    pages = spark.createDataFrame([(i, u, None, "h", "r") for i, u, *_ in URLS], "page_id long, url string, html string, Host string, ruled string")
    got = {r.page_id: r for r in urls.url_filter(pages.drop("Host")).collect()}
    for i, _, rule, verdict in URLS:
        assert got[i].rule == rule
        assert verdict in (None, got[i].verdict)
    assert (got[2].host, got[2].path, got[7].host) == ("example.com", "/en/1", "")
    assert urls.url_filter(pages.drop("Host").limit(0)).collect() == []


def test_scores_match_a_plain_page_rank(spark):
    links = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "c"), ("e", "d"), ("e", "a")]
    seeds = {"a": (1.0, 0.0), "c": (0.0, 1.0)}
    df = spark.createDataFrame(links, "src string, dst string")
    start = spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, trust0 double, distrust0 double")
    got = {r.host: (r.trust, r.distrust) for r in urls.link_scores(df, start, rounds=6).collect()}
    scores = dict(seeds)
    for _ in range(6):
        new = {h: (0.15 * t, 0.15 * d) for h, (t, d) in seeds.items()}
        for s, t in links:
            out, into = sum(x == s for x, _ in links), sum(y == t for _, y in links)
            new[t] = (new.get(t, (0, 0))[0] + 0.85 * scores.get(s, (0, 0))[0] / out, new.get(t, (0, 0))[1])
            new[s] = (new.get(s, (0, 0))[0], new.get(s, (0, 0))[1] + 0.85 * scores.get(t, (0, 0))[1] / into)
        scores = new
    for host, (trust, distrust) in got.items():
        assert trust == pytest.approx(scores.get(host, (0, 0))[0]) and distrust == pytest.approx(scores.get(host, (0, 0))[1])


def test_who_links_to_a_blocked_host_is_doubted(spark):
    pages = [(1, "http://bad.net/es/1", ""), (2, "http://friend.org/1", '<a href="http://bad.net/es/1">x</a>'), (3, "http://good.com/", '<a href=//ok.org/>'), (4, "http://ok.org/1", None)]
    got = {r.page_id: r.verdict for r in urls.url_filter(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow"}


def test_the_last_of_equally_long_rules_wins(spark):
    pages = spark.createDataFrame([(1, "http://a.b/x", "")], "page_id long, url string, html string")
    for verdicts in (("allow", "block"), ("block", "allow")):
        rules = [urls.Rule(verdict, "a.b", "/") for verdict in verdicts]
        assert urls.url_filter(pages, rules).first().verdict == verdicts[1]


# --- toxicity


def toxic_rows(n, seed=3):
    rng = random.Random(seed)
    words = [f"word{chr(97 + i)}{chr(97 + j)}" for i, j in combinations(range(12), 2)]
    rows = []
    for i in range(n):
        sentences = [" ".join(rng.choices(words, k=8)) for _ in range(rng.randint(2, 8))]
        label = int(i % 4 == 0)
        if label:
            sentences[rng.randrange(len(sentences))] += " " + rng.choice(["nastyone", "nastytwo", "vile"])
        rows.append((i, ". ".join(sentences), label))
    return rows


def test_document_labels_teach_which_sentences_are_bad(spark, docs):
    train = spark.createDataFrame(toxic_rows(400), "id long, text string, label int")
    train = train.unionByName(spark.createDataFrame([(9999, "x", None), (None, "nastyone", 0)], train.schema))
    model = toxicity.train(train.drop("label"), train.drop("text"))
    held = toxic_rows(200, seed=4)
    table = docs(*[(i, t) for i, t, _ in held], (1000, None), (1001, ""), (1002, "wordab " * 50000))
    got = {r.doc_id: r for r in toxicity.score(table, model).collect()}
    assert sum(got[i].predicted == label for i, _, label in held) >= 198
    assert got[1000].score == got[1001].score < 0.1 and got[1000].worst_sentence is None and 0 <= got[1002].score <= 1
    bad = next((i, t) for i, t, label in held if label)
    located = toxicity.offending_sentences(docs(bad), model, "doc_id").collect()
    assert len(located) == 1 and ("nasty" in located[0].sentence or "vile" in located[0].sentence)
    assert located[0].place == got[bad[0]].worst_sentence
    assert toxicity.score(docs(), model).collect() == []


def test_labels_of_one_kind_teach_nothing(spark):
    rows = spark.createDataFrame([(1, "a b", 0), (2, "c", 0)], "id long, text string, label int")
    model = toxicity.train(rows.drop("label"), rows.drop("text"))
    assert not model.weights and model.score(model.sentence_scores("a. b", {})) < 0.1


# --- packing


def test_boundaries_are_optimal():
    rng = random.Random(5)
    for _ in range(30):
        lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 9)))
        histogram = [(x, (n := rng.randint(1, 9)), x * n) for x in lengths]
        k = rng.randint(1, 4)

        def padding(bounds, histogram=histogram):
            return sum(next(b for b in bounds if b >= x) * n - t for x, n, t in histogram)

        best = min(padding([*chosen, lengths[-1]]) for r in range(k) for chosen in combinations(lengths[:-1], min(r, len(lengths) - 1)))
        bounds = packing.optimal_boundaries(histogram, k)
        assert len(bounds) <= k and padding(bounds) == best


def test_batches_keep_to_the_budget(docs, rows):
    texts = [(i, "w " * (i % 50)) for i in range(300)] + [(900, "w " * 5000), (901, None), (902, ""), (None, "one two"), (903, "x"), (903, "x")]
    packed = packing.pack(docs(*texts), ["doc_id"], buckets=4, token_budget=200, part_rows=64, carry=["text", "bucket"])
    got = packed.collect()
    assert len(got) == len(texts) and all(0 <= r.padding == r.bucket - r.n_tokens for r in got)
    batches = {}
    for r in got:
        batches.setdefault(r.batch_id, []).append(r)
    assert all(len({r.slot for r in b}) == len(b) and (len(b) == 1 or sum(r.bucket for r in b) <= 200 or b[0].bucket == 0) for b in batches.values())
    assert next(r for r in got if r.doc_id == 900).n_tokens == 5000
    assert packing.pack(docs(), ["doc_id"]).collect() == []


def test_grid_is_fine_and_monotonic(spark):
    got = [r[0] for r in spark.range(0, 20000).select(packing.grid(F.col("id"))).collect()]
    assert got[:257] == list(range(257)) and got == sorted(got)
    assert all(i <= g <= i * 1.008 + 1 for i, g in enumerate(got)) and len(set(got)) < 256 + 128 * 8
