"""Benchmark decontamination with a distributed positional inverted index.

Benchmark items become windows of consecutive words. Counting the corpus's
words drops every window with a word the corpus lacks and orders the words of
the others by rarity. The index stores a posting (term, document, place) for
each occurrence of a term that is among the ``RAREST`` of some window. The
postings of a window's rarest term, shifted by its offset, are the possible
starts; the lists of the next rare terms are intersected with them by (term,
document, place), a key that no frequent word makes hot. What is left is
compared with the document's own words, so matches are exact phrases.

Only built-in functions are used. The benchmark side is broadcast only where
its size was checked; beyond, the joins shuffle and adaptive execution splits
frequent terms, as postings and windows are written tables.

NULL texts have no words; NULL ids of items count as the id ''. Rows equal in
key and text get equal results; rows of one key with other texts are judged by
their own text. An empty corpus gives an empty result, an empty benchmark finds
nothing. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, attach, let, lower_ascii
from millrace.operators.joins import broadcast_if_small

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
RAREST = 3


def terms(text: Column) -> Column:
    """The words of a text in order, A-Z lower-cased."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAK), lambda word: word != "")


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``item`` and ``words`` of every window; an item of fewer words is one window, without words none."""
    def cut(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (window - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.slice(words, i, window))

    held = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), terms(F.col(text)).alias("_words"))
    return held.where(F.size("_words") > 0).select("item", F.explode(let(F.col("_words"), cut)).alias("words"))


def _tokens(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Every word of the corpus with its place."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("version"), terms(F.col(text)).alias("_words"))
    return rows.select("key", "version", F.posexplode("_words").alias("place", "term"))


def ranked_terms(windows: DataFrame, frequency: DataFrame) -> DataFrame:
    """``window`` with ``terms``: (n, offset, term) from the rarest, where the corpus has every term."""
    each = windows.select("window", F.size("words").alias("n_words"), F.posexplode("words").alias("offset", "term"))
    ranked = each.join(frequency, "term").groupBy("window", "n_words").agg(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("terms"))
    return ranked.where(F.size("terms") == F.col("n_words")).drop("n_words")


def positional_index(docs: DataFrame, wanted: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``term``, ``key``, ``version`` (the text's hash) and ``place`` of each occurrence of the wanted terms."""
    return _tokens(docs, key, text).join(broadcast_if_small(wanted), "term").select("term", "key", "version", "place")


def phrase_starts(postings: DataFrame, ranked: DataFrame, rarest: int = RAREST) -> DataFrame:
    """``window``, ``key``, ``version`` and ``start`` where the rarest terms stand as in the window."""
    nth = F.col("terms")
    first = ranked.select("window", "terms", nth[0]["term"].alias("term"), nth[0]["offset"].alias("offset"))
    starts = postings.join(first, "term").select("window", "terms", "key", "version", (F.col("place") - F.col("offset")).alias("start"))
    starts = starts.where("start >= 0")
    listed = postings.select(F.col("term").alias("_term"), F.col("key").alias("_key"), F.col("version").alias("_version"), F.col("place").alias("_place"))
    for k in range(1, rarest):
        term = F.get("terms", F.lit(k))
        meets = (
            (F.coalesce(term["term"], nth[0]["term"]) == F.col("_term"))
            & F.col("key").eqNullSafe(F.col("_key"))
            & (F.col("version") == F.col("_version"))
            & (F.col("start") + F.coalesce(term["offset"], nth[0]["offset"]) == F.col("_place"))
        )
        starts = starts.join(listed, meets, "left_semi")
    return starts.select("window", "key", "version", "start").distinct()


def proximity_matches(postings: DataFrame, ranked: DataFrame, span: int = 20) -> DataFrame:
    """``window``, ``key``, ``version`` and ``place`` where its two rarest terms are within ``span`` words of each other.

    Places are compared within stretches of ``span`` words and the next one, so
    a frequent term meets only its neighbourhood. Windows of one word count by it alone.
    """
    cell = F.floor(F.col("place") / span)
    nth = F.col("terms")
    a = postings.join(ranked.select("window", nth[0]["term"].alias("term")), "term").select("window", "key", "version", "place", cell.alias("cell"))
    other = F.coalesce(F.get("terms", F.lit(1)), nth[0])["term"]
    b = postings.join(ranked.select("window", other.alias("term")), "term").select(
        F.col("window").alias("_window"), F.col("key").alias("_key"), F.col("version").alias("_version"), F.col("place").alias("_place"),
        F.explode(F.array(cell - 1, cell, cell + 1)).alias("_cell"),
    )
    near = (
        (F.col("window") == F.col("_window")) & F.col("key").eqNullSafe(F.col("_key")) & (F.col("version") == F.col("_version"))
        & (F.col("cell") == F.col("_cell")) & (F.abs(F.col("place") - F.col("_place")) <= span)
    )
    return a.join(b, near, "left_semi").select("window", "key", "version", "place")


def decontaminate(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    window: int = WINDOW, rarest: int = RAREST,
) -> DataFrame:
    """``key``, ``version``, ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted ids) and ``contaminated`` per row. Runs jobs.

    ``version`` is the hash of the text, by which rows of one key are told apart.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    listed = scratch.write("windows", item_windows(items, item_key, item_text, window).withColumn("window", F.sha2(F.array_join("words", " "), 256)))
    windows = listed.groupBy("window").agg(F.first("words").alias("words"))
    vocabulary = broadcast_if_small(scratch.write("vocabulary", windows.select(F.explode("words").alias("term")).distinct()))
    counted = _tokens(docs, key, text).select("term").join(vocabulary, "term").groupBy("term").agg(F.count("*").alias("n"))
    ranked = scratch.write("ranked", ranked_terms(windows, scratch.write("frequency", counted)))

    wanted = ranked.select(F.explode(F.slice("terms", 1, rarest)).alias("t")).select(F.col("t.term").alias("term")).distinct()
    postings = scratch.write("postings", positional_index(docs, scratch.write("wanted", wanted), key, text))
    starts = scratch.write("starts", phrase_starts(postings, ranked, rarest))
    possible = starts.join(windows, "window").groupBy("key", "version").agg(F.collect_list(F.struct("start", "window", "words")).alias("possible"))
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    rows, (held,) = attach(rows, "key", F.col("version"), scratch.write("possible", possible), scratch)
    none = F.array().cast("array<struct<start:int,window:string,words:array<string>>>")

    def verified(words: Column) -> Column:
        exact = F.filter(F.coalesce(held, none), lambda p: F.slice(words, p["start"] + 1, F.size(p["words"])) == p["words"])
        return F.struct(F.size(words).cast("bigint").alias("n_words"), exact.alias("exact"))

    checked = rows.select("key", "version", let(terms(F.col("text")), verified).alias("found")).select("key", "version", "found.*")
    places = F.flatten(F.transform("exact", lambda p: F.sequence(p["start"], p["start"] + F.size(p["words"]) - 1)))
    summary = checked.select(
        "key", "version", "n_words", F.size(F.array_distinct(places)).cast("bigint").alias("n_hit"),
        F.array_distinct(F.transform("exact", lambda p: p["window"])).alias("hit"),
    )
    summary = scratch.write("summary", summary)
    named = summary.where(F.size("hit") > 0).select("key", "version", F.explode("hit").alias("window")).distinct()
    named = named.join(listed.select("window", "item").distinct(), "window").groupBy("key", "version").agg(F.array_sort(F.collect_set("item")).alias("items"))
    joined, (held,) = attach(summary, "key", F.col("version"), scratch.write("named", named), scratch)
    items = F.coalesce(held, F.array().cast("array<string>"))
    return joined.select(
        F.col("key").alias(key), "version", "n_words", "n_hit", F.size(items).cast("bigint").alias("n_items"), items.alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows without any benchmark window, all columns as they were."""
    scratch = Scratch(docs.sparkSession, "leaks")
    found = decontaminate(docs, items, key, text, **options).where("contaminated").select(F.col(key).alias("key"), "version", "contaminated")
    joined, (leaks,) = attach(docs, key, F.xxhash64(text), scratch.write("found", found.distinct()), scratch)
    return joined.where(F.col(leaks).isNull()).drop(leaks)
