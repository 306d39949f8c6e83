"""Plain versions of the operators for small tables, written for clarity only."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORDS.findall(text or "")


def lower_az(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingle_set(text: str | None, size: int) -> set[tuple[str, ...]]:
    w = words(lower_az(text or ""))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def near_components(rows: list[tuple[int, str | None]], size: int = 4, percent: int = 80) -> dict[int, int]:
    """Smallest id reachable by links, by comparing all pairs."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def repeated_bytes(rows: list[tuple[int, str | None]], length: int) -> dict[int, tuple[int, int, int, str]]:
    """Per id (n_bytes, n_removed, n_spans, hash of the rest)."""
    texts = {i: (t or "").encode() for i, t in rows}
    seen = Counter(t[p : p + length] for t in texts.values() for p in range(len(t) - length + 1))
    out = {}
    for i, t in texts.items():
        covered = [False] * len(t)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                covered[p : p + length] = [True] * length
        spans = sum(c and (k == 0 or not covered[k - 1]) for k, c in enumerate(covered))
        left = bytes(b for b, c in zip(t, covered, strict=True) if not c)
        out[i] = (len(t), sum(covered), spans, hashlib.sha256(left).hexdigest())
    return out


def repeat_words(text: str | None) -> int:
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = Counter(windows)
    return len({i + k for i, x in enumerate(windows) if many[x] > 1 for k in range(3)})


def dedup_lines(rows: list[tuple[int, str | None]], window: int, long_words: int) -> dict[int, str | None]:
    """Texts without the runs that an earlier place has."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        lines = [x for x in (text or "").split("\n") if words(x)]
        gone = set()
        for at in range(len(lines)):
            runs = [tuple(lines[at : at + window])] if at + window <= len(lines) else []
            if len(words(lines[at])) >= long_words:
                runs.append((lines[at],))
            for run in runs:
                if run in seen:
                    gone.update(range(at, at + len(run)))
                seen.add(run)
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else text
    return out
