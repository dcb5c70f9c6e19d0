"""Plain versions of the operators, for small inputs only."""

from __future__ import annotations

import hashlib
import re

UPPER_TO_LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
SPACES = " \t\n\x0b\x0c\r"


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def shingle_set(text: str | None) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER_TO_LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


class Groups:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def root(self, n):
        while self.up[n] != n:
            self.up[n] = self.up[self.up[n]]
            n = self.up[n]
        return n

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def near_groups(docs: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    """id -> (set size, smallest id reachable) by comparing all pairs."""
    sets = {d: shingle_set(t) for d, t in docs.items()}
    groups = Groups(docs)
    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                groups.link(a, b)
    return {d: (len(sets[d]), groups.root(d)) for d in ids}


def without_repeats(docs: dict[int, str | None], width: int = 50) -> dict[int, tuple[int, int, int, bytes]]:
    """id -> (bytes, removed bytes, removed runs, kept bytes)."""
    owner: dict[bytes, int] = {}
    raw = {d: (t or "").encode() for d, t in sorted(docs.items())}
    for d, b in raw.items():
        for i in range(len(b) - width + 1):
            owner.setdefault(b[i : i + width], d)
    out = {}
    for d, b in raw.items():
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if owner[b[i : i + width]] < d:
                gone[i : i + width] = b"\1" * width
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[d] = (len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g))
    return out


def deduped_lines(docs: dict[int, str | None], least: int = 10) -> dict[int, tuple[int, int, str]]:
    """id -> (lines, dropped lines, kept text)."""
    key = lambda line: line.strip(SPACES).translate(UPPER_TO_LOWER)
    owner: dict[str, int] = {}
    for d in sorted(docs):
        for line in (docs[d] or "").split("\n"):
            owner.setdefault(key(line), d)
    out = {}
    for d, text in docs.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or owner[key(x)] == d]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def leaks(text: str | None, items: dict[int, str], window: int) -> list[int]:
    """Items of which some stretch of ``window`` words, begun at each half window, holds enough of both halves."""
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UPPER_TO_LOWER))
    runs = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    words, half, out = split(text), window // 2, []
    for item, body in items.items():
        w = split(body)
        cut = (len(w) + 1) // 2
        halves = [h for h in (w[:cut], w[cut:]) if h]
        for k in range(max(1, -(-len(words) // half) - 1)):
            own = words[k * half : k * half + window]
            if halves and all(len(runs(h, min(5, len(h))) & runs(own, min(5, len(h)))) >= 0.75 * len(runs(h, min(5, len(h))))
                              for h in halves):
                out.append(item)
                break
    return sorted(out)
