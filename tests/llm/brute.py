"""Brute-force versions of the operators, in plain Python."""

from __future__ import annotations

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, width: int) -> set[tuple[str, ...]]:
    words = WORDS.findall(ascii_lower(text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def components(ids: list[int], links: list[tuple[int, int]]) -> dict[int, int]:
    parent = {i: i for i in ids}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_duplicates(rows: list[tuple[int, str | None]], width: int, per_cent: int) -> dict[int, tuple[int, int]]:
    """doc_id -> (shingles, component), comparing all pairs that share a shingle."""
    sets = {i: shingles(t, width) for i, t in rows}
    holders: dict[tuple, list[int]] = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= per_cent * len(sets[a] | sets[b])]
    found = components(list(sets), links)
    return {i: (len(sets[i]), found[i]) for i in sets}
