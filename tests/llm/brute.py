"""Plain-Python answers for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower_az(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def exact_dedup(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub(" ", t or "")].append(i)
    return {i: (min(ids), len(ids), i == min(ids), sha(norm)) for norm, ids in groups.items() for i in ids}


def shingles(text: str | None, n: int) -> frozenset:
    w = words(lower_az(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def near_dedup(rows, n=4, percent=80):
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_gram = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            by_gram[g].append(i)
    shared = Counter()
    for ids in by_gram.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1:]:
                shared[min(a, b), max(a, b)] += 1
    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def repeated_windows(rows, window=35):
    count = Counter()
    for _, t in rows:
        w = words(t)
        count.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = {}
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        out[i] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def repetition_base(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    count = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = [False] * len(w)
    for i in range(len(w) - 7):
        if count[tuple(w[i:i + 8])] > 1:
            hit[i:i + 8] = [True] * 8
    failed = len(w) < 20 or 100 * sum(hit) > 30 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(hit), failed)


PATTERNS = (
    ("assign", re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
                          r"[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 6),
    ("access", re.compile(r"(AKIA[A-Z0-9]+)()"), 20),
    ("hex", re.compile(r"([0-9a-f]+)()"), 24),
)


def secret_spans(text):
    out = []
    for rank, (kind, pattern, least) in enumerate(PATTERNS):
        for m in pattern.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((m.start(), rank, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]
