"""Plain re-statements of the contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction

import xxhash


def fingerprint(text: str | None) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def components(prints: dict[int, int]) -> dict[int, int]:
    root = {i: i for i in prints}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def substrings(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    data = [(t or "").encode() for t in texts]
    starts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if starts[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    spans = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows: list[tuple[int | None, str | None]]) -> dict[int | None, tuple[int | None, int, bool, str]]:
    """Keep id, group size, kept and digest by id, for distinct ids."""
    groups: dict[str, list[tuple[int, bool, int]]] = {}
    for key, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), key is None, key or 0))
    out = {}
    for normal, members in groups.items():
        best = min(members)
        for one in members:
            out[None if one[1] else one[2]] = (None if best[1] else best[2], len(members), one == best, sha256(normal))
    return out


def merkle(rows: list[tuple[str | None, int | None, str]], fanout: int = 8) -> list[tuple]:
    """Key, part, leaf, subroot, root and path of (part, key, leaf) rows."""
    def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
        paths: list[list[tuple[str, str]]] = [[] for _ in nodes]
        at = list(range(len(nodes)))
        while len(nodes) > 1:
            for path, a in zip(paths, at):
                run = a // fanout * fanout
                path.append(("".join(nodes[run:a]), "".join(nodes[a + 1 : run + fanout])))
            nodes = [sha256("".join(nodes[k : k + fanout])) for k in range(0, len(nodes), fanout)]
            at = [a // fanout for a in at]
        return nodes[0], paths

    parts: dict[str | None, list[tuple[int | None, str]]] = {}
    for part, key, leaf in rows:
        parts.setdefault(part, []).append((key, leaf))
    order = sorted(parts, key=lambda part: (part is not None, (part or "").encode()))
    for part in order:
        parts[part].sort(key=lambda one: (one[0] is not None, one[0] or 0, one[1]))
    below = [tree([leaf for _, leaf in parts[part]]) for part in order]
    root, above = tree([subroot for subroot, _ in below])
    return [
        (key, part, leaf, subroot, root, tuple(path + top))
        for part, (subroot, paths), top in zip(order, below, above)
        for (key, leaf), path in zip(parts[part], paths)
    ]


def repeated(text: str | None, key: int) -> list[bytes]:
    """The words of a text, with the repeats that the contract of op13 puts in."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    h, n = zlib.crc32(str(key).encode()), len(words)
    if h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [word if i < a else words[a + (i - a) % p] for i, word in enumerate(words)]


def runs(words: list, least: int = 24) -> list[tuple[int, int, int]]:
    """Start, length and period of every run, by trying all periods."""
    found: list[tuple[int, int, int]] = []
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j - i + q
            if n >= max(least, 3 * q) and not any(s <= i and i + n <= s + m and q % p == 0 for s, m, p in found):
                found.append((i, n, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def periodic_row(text: str | None, key: int) -> tuple:
    words = repeated(text, key)
    found = runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    best = max(found, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    kept = b" ".join(word for i, word in enumerate(words) if i not in gone).decode()
    return (key, len(found), *best, milli, sha256(lines), sha256(kept))
