"""Periodic runs of words, found with suffix trees.

A run is a stretch of words with smallest period q (words q apart are equal)
that no neighbouring word extends, of at least ``max(least, repeats * q)`` words:
a phrase said over and over. All but the first q words of a run are dropped.

The runs of a text are found exactly. Every run holds Lyndon words of its
period that are the longest ones at their place, in the order of the words or
in its reverse; so of each place the longest Lyndon word of either order, up to
the next smaller suffix, is a candidate for a root. A root is extended in both
directions by the longest common extension of its two ends: the depth of the
lowest common ancestor of two leaves in the suffix tree (Ukkonen) of the words,
and of the words reversed. A tour of the tree meets the leaves in order; the
least depth between two of them is their ancestor's, so a table of minima over
the tour answers each query in constant time.

Only stretches that can hold a run get trees: a run of 24 words with three
periods consists of ``gram`` words in a row that stand in the stretch twice, so
places that no such repeat covers lie outside of every run. One word more on either
side shows where a run ends. Spark deals the documents; a document is read by one
task, and its trees take memory in proportion to its repeated stretches.

NULL and empty texts have no words and no runs; their collapsed text is empty.
Words are what ASCII white space parts. Of the runs, the strongest has the
greatest length / period (exactly), then the smallest start, then period. Other
columns, keys and repeated rows are untouched; ``n_words``, ``runs`` and
``strongest`` of the input are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.common import let, space_words

LEAST = 24
REPEATS = 3
ADDED = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, strongest int"


def suffix_tree(symbols: list[int]) -> tuple[list[int], list[int], list[dict[int, int] | None]]:
    """Start and end of each node's edge and its children, by Ukkonen; the last symbol must be unique. Leaves have no children."""
    n = len(symbols)
    start, end, link = [0], [0], [0]
    children: list[dict[int, int] | None] = [{}]
    active = edge = length = remaining = 0
    for i, symbol in enumerate(symbols):
        waiting = 0  # the inner node that still needs its suffix link
        remaining += 1
        while remaining:
            if not length:
                edge = i
            child = children[active].get(symbols[edge])
            if child is None:
                children[active][symbols[edge]] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                children.append(None)
                if waiting:
                    link[waiting] = active
                    waiting = 0
            else:
                width = end[child] - start[child]
                if length >= width:
                    active, edge, length = child, edge + width, length - width
                    continue
                at = start[child] + length
                if symbols[at] == symbol:
                    length += 1
                    if waiting:
                        link[waiting] = active
                    break
                inner = len(start)
                start += [start[child], i]
                end += [at, n]
                link += [0, 0]
                children += [{symbols[at]: child, symbol: inner + 1}, None]
                children[active][symbols[edge]] = inner
                start[child] = at
                if waiting:
                    link[waiting] = inner
                waiting = inner
            remaining -= 1
            if active:
                active = link[active]
            elif length:
                length -= 1
                edge = i - remaining + 1
    return start, end, children


class Extensions:
    """Longest common extensions of places of a word sequence, from its suffix tree."""

    def __init__(self, words: list[int]) -> None:
        self.n = len(words)
        self._tree = suffix_tree([*words, -1])
        order, turns = self._tour(lambda symbol: symbol)
        self.rank = self._places(order)
        self._minima = [np.array(turns, dtype=np.int32)]
        while len(self._minima[-1]) > 1 << len(self._minima) - 1:
            last, step = self._minima[-1], 1 << len(self._minima) - 1
            self._minima.append(np.minimum(last[:-step], last[step:]))

    def _tour(self, rank) -> tuple[list[int], list[int]]:
        """Leaves (suffixes) in the order of their symbols, the end first, and the least depth between neighbours."""
        start, end, children = self._tree
        order, turns, after_leaf, stack = [], [], False, [(0, 0)]
        while stack:
            node, above = stack.pop()
            if after_leaf:
                turns.append(above)
            depth = above + end[node] - start[node]
            below = children[node]
            after_leaf = below is None
            if below is None:
                order.append(self.n + 1 - depth)
            else:
                stack += [(below[s], depth) for s in sorted(below, key=rank, reverse=True)]
        return order, turns

    def _places(self, order: list[int]) -> np.ndarray:
        rank = np.empty(self.n + 1, dtype=np.int32)
        rank[order] = np.arange(self.n + 1, dtype=np.int32)
        return rank

    def reversed_rank(self) -> np.ndarray:
        """Ranks of the suffixes when words compare the other way round; the end is the smallest still."""
        return self._places(self._tour(lambda symbol: -symbol if symbol >= 0 else -self.n - 1)[0])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from places ``a`` and ``b`` (different ones) on."""
        low, high = np.minimum(self.rank[a], self.rank[b]), np.maximum(self.rank[a], self.rank[b])
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(a), dtype=np.int64)
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self._minima[k][low[own]], self._minima[k][high[own] - (1 << int(k))])
        return out


def lyndon_ends(rank: np.ndarray) -> np.ndarray:
    """Where the longest Lyndon word of each place ends: at the next smaller suffix."""
    values, ends, stack = rank.tolist(), [0] * (len(rank) - 1), []
    for i, value in enumerate(values):
        while stack and values[stack[-1]] > value:
            ends[stack.pop()] = i
        stack.append(i)
    return np.array(ends, dtype=np.int64)


def stretch_runs(words: list[int], least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """(start, length, period) of the runs of a word sequence of numbers, a row each, in order."""
    n = len(words)
    ahead = Extensions(words)
    begins, ends = [], []
    for rank in (ahead.rank, ahead.reversed_rank()):
        end = lyndon_ends(rank)
        begins.append(np.flatnonzero(end < n))
        ends.append(end[begins[-1]])
    begin, end = np.concatenate(begins), np.concatenate(ends)
    period = end - begin
    right = ahead.common(begin, end)
    # Of a run's roots one lies in its first period, and from there on all but two periods are ahead.
    strong = right >= (repeats - 2) * period
    begin, end, period, right = begin[strong], end[strong], period[strong], right[strong]
    if not len(begin):
        return np.empty((0, 3), dtype=np.int64)
    behind = Extensions(words[::-1])
    left = behind.common(n - begin, n - end)
    length = left + period + right
    good = length >= np.maximum(least, repeats * period)
    return np.unique(np.stack([begin - left, length, period], axis=1)[good], axis=0)


def stretches(grams: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
    """(first, last + 1) word of the stretches that grams standing in them twice cover."""
    todo = [(0, len(grams))]
    while todo:
        lo, hi = todo.pop()
        _, inverse, counts = np.unique(grams[lo:hi], return_inverse=True, return_counts=True)
        places = np.flatnonzero(counts[inverse] > 1) + lo
        if not len(places):
            continue
        gap = np.flatnonzero(np.diff(places) > width)
        firsts, lasts = places[np.concatenate([[0], gap + 1])], places[np.concatenate([gap, [len(places) - 1]])]
        for a, b in zip(firsts.tolist(), lasts.tolist()):
            if (a, b + 1) == (lo, hi):
                yield lo, hi - 1 + width
            else:
                todo.append((a, b + 1))


def word_runs(words: list[bytes], least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a text's words, by start and period."""
    width = least - least // repeats  # words of a shortest run that come again a period later
    if len(words) < least:
        return []
    numbers: dict[bytes, int] = {}
    ids = [numbers.setdefault(word, len(numbers)) for word in words]
    if len(numbers) == len(ids):
        return []
    hashes = np.array(ids, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(29)
    grams = np.zeros(len(ids) - width + 1, dtype=np.uint64)
    for k in range(width):
        grams = grams * np.uint64(0xBF58476D1CE4E5B9) + hashes[k : k + len(grams)]
    found = []
    for lo, hi in stretches(grams, width):
        lo, hi = max(0, lo - 1), min(len(ids), hi + 1)
        own = {value: i for i, value in enumerate(sorted(set(ids[lo:hi])))}
        runs = stretch_runs([own[value] for value in ids[lo:hi]], least, repeats)
        found += [(lo + start, length, period) for start, length, period in runs.tolist()]
    return sorted(found, key=lambda run: (run[0], run[2]))


def strongest(runs: list[tuple[int, int, int]]) -> int | None:
    """The place in the list of the run with the greatest length / period; the first of equal ones."""
    best = None
    for i, (_, length, period) in enumerate(runs):
        if best is None or length * runs[best][2] > runs[best][1] * period:
            best = i
    return best


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [word for word, inside in zip(words, np.cumsum(edges).tolist()) if not inside]


def collapse_runs(docs: DataFrame, text: str = "text", least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """The rows, runs taken out of ``text``, with ``n_words``, ``runs`` and ``strongest`` (place in ``runs``, from 0; NULL without any).

    ``runs`` are structs of ``start`` (word, from 0), ``length`` and ``period``.
    What is left of a text is its kept words, one space between. ``repeats`` is 3 at least.
    """
    if repeats < 3 or least < repeats:
        raise ValueError("a run has three periods at least, and one word a period")
    held = docs.drop(*[name for name in ("n_words", "runs", "strongest") if name != text])
    schema = StructType([*held.schema.fields, *StructType.fromDDL(ADDED).fields])
    place = held.columns.index(text)
    run_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, counts, runs, best = [], [], [], []
            for value in batch.column(place).to_pylist():
                words = (value or "").encode().split()
                own = word_runs(words, least, repeats)
                left.append(b" ".join(kept_words(words, own)).decode())
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                best.append(strongest(own))
            columns = [pa.array(left, pa.string()) if i == place else batch.column(i) for i in range(len(batch.columns))]
            new = [pa.array(counts, pa.int64()), pa.array(runs, run_type), pa.array(best, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=schema.names)

    return held.mapInArrow(found, schema)


def with_repeats(text: Column, key: Column) -> Column:
    """The text, or for keys whose checksum ends in 0 its words from some place on said over and over.

    With ``h = crc32(key)`` and ``g = h div 10``: from word ``a = g mod n`` on, ``p = 1 + (n - a) div (3 + g mod 8)`` words repeat.
    """
    h = F.crc32(F.encode(key.cast("string"), "utf-8"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        return let(F.struct(a.alias("a"), p.alias("p")), lambda at: F.array_join(
            F.transform(words, lambda word, i: F.when(i >= at["a"], F.get(words, (at["a"] + F.pmod(i - at["a"], at["p"])).cast("int"))).otherwise(word)), " "
        ))

    chosen = F.pmod(h, F.lit(10)) == 0
    return F.when(chosen, let(space_words(text), lambda words: F.when(F.size(words) > 0, repeated(words)).otherwise(text))).otherwise(text)
