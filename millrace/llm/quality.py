"""Quality rules: a table of thresholds compiled into one projection.

Everything is computed per row from the row's text with built-in functions, so
there is no exchange, no state and no Python. A NULL text counts as empty. Rows
are judged one by one: repeated ids, ties and further columns make no difference,
and an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import NOT_SPACE, fresh, let, space_words, total

GRAM = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = r"[#*$%&|<>]"
# Frequent function words; a text of sentences has some of its language's.
STOP_WORDS = (
    "the be to of and that have with is it in a this for "
    "le la les de des et que un une en est du dans qui par "
    "der die das und ist ein eine zu von mit den nicht auf sich "
    "el los las del y una se su con por para no lo"
).split()


@dataclass(frozen=True)
class Threshold:
    """Keeps a row while ``low * of <= measure <= high * of``; a missing end is open."""

    measure: str
    of: str
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        kept = F.lit(True)
        if self.low is not None:
            kept = kept & (F.col(self.measure) >= F.col(self.of) * self.low)
        if self.high is not None:
            kept = kept & (F.col(self.measure) <= F.col(self.of) * self.high)
        return kept


THRESHOLDS = (
    Threshold("word_chars", "n_words", low=2.0, high=15.0),
    Threshold("n_symbols", "n_words", high=0.25),
    Threshold("n_stop_words", "n_words", low=0.02),
    Threshold("n_letter_words", "n_words", low=0.7),
    Threshold("n_dup_lines", "n_lines", high=0.5),
)


def repeated_word_count(words: Column) -> Column:
    """Words inside ``GRAM``-word windows that the text has twice or more.

    Windows are compared by a 64-bit hash. Sorting (hash, place) pairs brings
    equal windows together; the places that have an equal neighbour are then
    walked in text order, each adding the words the one after it does not cover.
    """
    def covered(starts: Column) -> Column:
        widths = F.transform(starts, lambda p, j: F.least(F.lit(GRAM), F.coalesce(F.get(starts, j + 1) - p, F.lit(GRAM))))
        return total(widths)

    def repeats(pairs: Column) -> Column:
        same = F.filter(
            pairs,
            lambda x, j: F.get(pairs, j - 1)["hash"].eqNullSafe(x["hash"]) | F.get(pairs, j + 1)["hash"].eqNullSafe(x["hash"]),
        )
        return let(F.array_sort(F.transform(same, lambda x: x["place"])), covered)

    def counted(grams: Column) -> Column:
        pairs = F.transform(grams, lambda g, i: F.struct(g.alias("hash"), i.alias("place")))
        none = F.size(F.array_distinct(grams)) == F.size(grams)
        return F.when(none, F.lit(0).cast("bigint")).otherwise(let(F.sort_array(pairs), repeats))

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (GRAM - 1))
        return let(F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, GRAM))), counted)

    hashes = F.transform(words, lambda word: F.xxhash64(word))
    return F.when(F.size(words) < GRAM, F.lit(0).cast("bigint")).otherwise(let(hashes, windows))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the counts the rules are about, from the whole text."""
    held = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(held, "\n"), lambda line: line.rlike(NOT_SPACE))
    word_list, line_list = fresh(docs, "_words", "_lines")
    words, lined = F.col(word_list), F.col(line_list)
    split = docs.withColumn(word_list, space_words(held)).withColumn(line_list, lines)
    counts = {
        "n_words": F.size(words),
        "word_chars": F.char_length(F.array_join(words, "")),
        "n_symbols": F.size(F.split(held, SYMBOLS)) - 1,
        "n_lines": F.size(lined),
        "n_dup_lines": F.size(lined) - F.size(F.array_distinct(lined)),
        "n_repeat_words": repeated_word_count(words),
        "n_stop_words": F.size(F.filter(words, lambda word: F.lower(word).isin(STOP_WORDS))),
        "n_letter_words": F.size(F.filter(words, lambda word: word.rlike(r"\p{L}"))),
    }
    return split.withColumns({name: count.cast("bigint") for name, count in counts.items()}).drop(word_list, line_list)


def base_failed() -> Column:
    """Too short, or too much of it in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def quality_rules(docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS, text: str = "text") -> DataFrame:
    """The rows with their measures, ``base_failed`` and ``kept``.

    ``kept`` is false for rows that fail the base rules or any threshold.
    Columns of the input that are named like a measure are replaced.
    """
    kept = ~F.col("base_failed")
    for threshold in thresholds:
        kept = kept & threshold.passes()
    return measures(docs, text).withColumn("base_failed", base_failed()).withColumn("kept", kept)
