"""Plain versions of what the operators return, for comparison."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash


def words(text: str | None) -> list[str]:
    return re.findall("[^\\x20\\x09-\\x0D]+", text or "")


def license_base(text: str | None, phrases: dict[str, str]) -> tuple:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", lower)
    places, labels = [], set()
    for phrase, label in phrases.items():
        parts = phrase.split()
        for i in range(len(found) - len(parts) + 1):
            if found[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def quality_metrics(text: str | None) -> tuple:
    found = words(text)
    windows = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    covered = set()
    for i in range(len(found) - 2):
        if windows[tuple(found[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in (text or "").split("\n") if words(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)


def fingerprint(text: str | None) -> int:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = words(lower)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(nodes: list, linked) -> dict:
    """The smallest node of each node's group; ``linked`` tells whether two nodes are."""
    group = {n: n for n in nodes}

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = root(a), root(b)
                group[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def near_duplicates(rows: list[tuple]) -> dict:
    """(fingerprint, component) by id."""
    prints = {r[0]: fingerprint(r[1]) for r in rows}
    first: dict[int, int] = {}
    for doc, value in prints.items():
        first[value] = min(doc, first.get(value, doc))
    groups = grouped(sorted(first.values()), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    return {doc: (f"{value:016x}", groups[first[value]]) for doc, value in prints.items()}


def without_repeats(rows: list[tuple], window: int = 20) -> dict:
    """(n_words, n_removed, kept words) by id."""
    lists = {r[0]: words(r[1]) for r in rows}
    first: dict[tuple, tuple] = {}
    for doc in sorted(lists):
        for i in range(len(lists[doc]) - window + 1):
            first.setdefault(tuple(lists[doc][i : i + window]), (doc, i))
    out = {}
    for doc, found in lists.items():
        gone = set()
        for i in range(len(found) - window + 1):
            if first[tuple(found[i : i + window])] < (doc, i):
                gone |= set(range(i, i + window))
        kept = [w for i, w in enumerate(found) if i not in gone]
        out[doc] = (len(found), len(gone), kept)
    return out


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
