"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import defaultdict
from pathlib import Path

import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.001"


def rows(folder: str, table: str, *columns: str) -> list[tuple]:
    found = pq.read_table(f"{folder}/{table}.parquet", columns=list(columns)).to_pydict()
    return list(zip(*(found[c] for c in columns)))


def words(text: str | None) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingles(text: str | None, size: int = 5) -> set[tuple[str, ...]]:
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}


def similarity(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a or b else 0.0


def components(texts: list[tuple[int, str | None]], percent: int = 85) -> dict[int, int]:
    """The least id that links reach, for ids without repeats."""
    sets, holders = {i: shingles(t) for i, t in texts}, defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    parent = {i: i for i in sets}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        common = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j < i:
                    common[j] += 1
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in sets}
