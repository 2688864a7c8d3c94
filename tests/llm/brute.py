"""Plain, slow versions of the operators' contracts, on lists of (id, text)."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


class Groups:
    """Connected components by union."""

    def __init__(self, ids):
        self.parent = {i: i for i in ids}

    def root(self, i):
        while self.parent[i] != i:
            i = self.parent[i]
        return i

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def near_duplicates(docs, percent: int) -> dict:
    sets = {}
    for i, text in docs:
        words = SPACED.findall(lower(text or ""))
        grams = {tuple(words[j : j + 5]) for j in range(len(words) - 4)}
        sets[i] = grams or ({tuple(words)} if words else set())
    groups, ids = Groups(sets), sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            inner = len(sets[a] & sets[b])
            if inner and 100 * inner >= percent * (len(sets[a]) + len(sets[b]) - inner):
                groups.link(a, b)
    return {i: (len(s), groups.root(i), groups.root(i) == i) for i, s in sets.items()}


def repeats(docs, length: int = 50) -> dict:
    least: dict[bytes, int] = {}
    data = [(i, (t or "").encode()) for i, t in docs]
    for i, b in data:
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            least[s] = min(least.get(s, i), i)
    out = {}
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if least[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def license_base(text: str | None) -> tuple:
    words = LETTERS.findall(lower(text or ""))
    places, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(labels)),
    )


def base_scores(docs) -> dict:
    words = {i: [*SPACED.findall(lower(t or "")), None] for i, t in docs}
    out_of = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    counts = Counter(w for i, ws in words.items() if not out_of[i] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    return {
        i: (
            out_of[i],
            len(ws),
            sum(counts[w] > 0 for w in ws),
            total,
            sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws),
        )
        for i, ws in words.items()
    }


def cosine_links(vectors, least: float) -> dict:
    import numpy as np

    ids = sorted(i for i, _ in vectors)
    sound = {
        i: np.array(v, float)
        for i, v in vectors
        if v and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)
    }
    groups, links = Groups(ids), defaultdict(int)
    for a in sound:
        for b in sound:
            if a < b and len(sound[a]) == len(sound[b]):
                x, y = sound[a], sound[b]
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                    links[a] += 1
                    links[b] += 1
                    groups.link(a, b)
    return {i: (links[i], groups.root(i), groups.root(i) == i) for i in ids}


def quality_counts(text: str | None) -> tuple:
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


def contamination(docs, items, length: int = 10) -> dict:
    """Per document: words, hit words, ids of the items with an occurring window."""
    windows = defaultdict(set)
    for item, text in items:
        words = tuple(LETTERS.findall(lower(text or "")))
        for at in range(max(len(words) - length, 0) + 1 if words else 0):
            windows[words[at : at + length]].add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in docs:
        words = tuple(LETTERS.findall(lower(text or "")))
        hit, found = set(), set()
        for size in sizes:
            for at in range(len(words) - size + 1):
                if words[at : at + size] in windows:
                    hit.update(range(at, at + size))
                    found |= windows[words[at : at + size]]
        out[i] = (len(words), len(hit), found - {None})
    return out


def near(words: list[str], query: list[str], span: int) -> list[int]:
    """Places of each word such that a run of ``span`` words around it holds all words of the query."""
    wanted, out = set(query), set()
    for start in range(len(words)):
        if wanted <= set(words[start : start + span]):
            out.update(range(start, min(start + span, len(words))))
    return sorted(out)


def resampling(docs, target, percent: int = 10, seed: int = 2024, longest: int = 1, buckets: int = 10_000) -> dict:
    """Per document: features, weight, score, rank; ids are unique."""

    def cells(text):
        words = LETTERS.findall(lower(text or ""))
        runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    of_docs = {i: cells(t) for i, t in docs}
    source = Counter(b for _, bs in of_docs.values() for b in bs)
    goal = Counter(b for t in target for b in cells(t)[1])
    s, t = sum(source.values()), sum(goal.values())
    gain = [
        math.floor(1000 * math.log((goal[b] + 1) * (s + buckets) / ((source[b] + 1) * (t + buckets)))) for b in range(buckets)
    ]
    rows = {}
    for i, (n, bs) in of_docs.items():
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in bs)
        rows[i] = (n, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
    able = sorted((i for i in rows if rows[i][0] >= 20), key=lambda i: (-rows[i][3], i))
    rank = {i: r + 1 for r, i in enumerate(able[: percent * len(able) // 100])}
    return {i: (*rows[i][1:], rank.get(i)) for i in rows}


def planted_runs(i: int, text: str | None) -> str | None:
    words, h = SPACED.findall(text or ""), zlib.crc32(str(i).encode())
    if h % 10 or not words:
        return text
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(w if j < a else words[a + (j - a) % p] for j, w in enumerate(words))


def runs(words: list[str]) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by trying each period."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        at = 0
        while at + q < len(words):
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            stretch = words[at : end + q]
            smaller = any(stretch[d:] == stretch[:-d] for d in range(1, q))
            if len(stretch) >= max(6, 4 * q) and not smaller:
                out.append((at, len(stretch), q))
            at = end
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[str]) -> tuple:
    """The runs, the longest one (with its exponent) and the words that are kept."""
    found = runs(words)
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return found, top, " ".join(w for i, w in enumerate(words) if i not in drop)
