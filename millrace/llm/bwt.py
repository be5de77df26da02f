"""Burrows-Wheeler transforms of shards of short strings, and their merge.

A shard is a set of strings, each closed by a terminator. Its transform lists,
in suffix order, the symbol before each suffix; the LF step leads from a suffix
to the one that starts a symbol earlier, the string read as a ring.

``merge`` interleaves any number of shards. It starts from their suffixes in
shard order and refines: given the interleave sorted by the first ``h`` symbols
and the blocks of suffixes that share them, a stable sort of the suffixes ``h``
steps later in their ring by block orders the suffixes by ``2 h`` symbols. Texts
are not read again and suffixes are not compared: each round moves block
numbers along LF. A block's border that first shows after a round bounds the
common prefix of its neighbours, so blocks are the intervals of suffixes that
share a prefix of the round's length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Shard:
    bwt: np.ndarray  # symbol before each suffix, in suffix order
    lf: np.ndarray  # rank of the suffix that starts one symbol earlier
    first: np.ndarray  # first symbol of each suffix
    text_at: np.ndarray  # place in the shard's text of each suffix


def build(symbols: np.ndarray, ends: np.ndarray) -> Shard:
    """The transform of a text of strings; ``ends`` are the places of their terminators.

    Suffixes are sorted by doubling within the shard; terminators differ by string.
    """
    n = len(symbols)
    key = symbols.astype(np.int64) + len(ends)
    key[ends] = np.arange(len(ends))
    order = np.argsort(key, kind="stable")
    width = 1
    while True:
        sorted_key = key[order]
        rank_of = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = rank_of
        if not n or rank_of[-1] == n - 1:
            break
        later = np.zeros(n, dtype=np.int64)
        later[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        width *= 2
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else np.empty(0, dtype=np.int64)
    ring = np.arange(n) - 1
    ring[starts] = ends
    before = ring[order]
    return Shard(symbols[before], rank[before], symbols[order], order)


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interleave the shards by ``depth`` symbols.

    Gives, for each suffix (shard after shard, in its shard's order), the number
    of its block: suffixes have equal blocks exactly where their first ``depth``
    symbols are equal. Then the interleave (suffixes in merged order) and the
    length of the common prefix of each with the one before it, as known from
    the round that parted them (0, 1, 2, 4, ... up to ``depth``).
    """
    offsets = np.cumsum([0] + [len(s.bwt) for s in shards])
    n = int(offsets[-1])
    step = np.concatenate([s.lf + o for s, o in zip(shards, offsets)]) if n else np.empty(0, dtype=np.int64)
    first = np.concatenate([s.first for s in shards]) if n else np.empty(0, dtype=np.int64)
    order = np.argsort(first, kind="stable")
    block, common = _blocks(first[order], order, np.zeros(n, dtype=np.int64), 1)
    forward = np.empty(n, dtype=np.int64)
    forward[step] = np.arange(n)  # one symbol on in the ring
    known, on = 1, forward
    while known < depth:
        gain = min(known, depth - known)
        if gain < known:  # the last round: blocks overlap
            on = _power(forward, gain)
        pairs = block * (n + 1) + block[on]
        order = order[np.argsort(pairs[order], kind="stable")]
        known += gain
        block, common = _blocks(pairs[order], order, common, known)
        if known < depth:
            on = on[on]
    return block, order, common


def _blocks(keys: np.ndarray, order: np.ndarray, common: np.ndarray, known: int) -> tuple[np.ndarray, np.ndarray]:
    """Block numbers by suffix, and common prefixes raised to ``known`` inside blocks; borders keep theirs."""
    border = np.ones(len(keys), dtype=bool)
    border[1:] = keys[1:] != keys[:-1]
    block = np.empty(len(keys), dtype=np.int64)
    block[order] = np.cumsum(border) - 1
    return block, np.where(border, common, known)


def _power(step: np.ndarray, times: int) -> np.ndarray:
    """The step taken ``times`` times over."""
    result = np.arange(len(step))
    while times:
        if times & 1:
            result = step[result]
        step = step[step]
        times >>= 1
    return result
