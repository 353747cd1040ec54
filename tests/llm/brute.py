"""Plain Python versions of the operators' results."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def substring_dedup(docs, k=13):
    """docs: (id, text) -> {id: (n_words, n_removed, kept_sha256)}."""
    first = {}
    for i, t in docs:
        w = words(t)
        for a in range(len(w) - k + 1):
            key = tuple(w[a : a + k])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for a in range(len(w) - k + 1):
            if first[tuple(w[a : a + k])] < i:
                gone[a : a + k] = [True] * k
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), sum(gone), sha(" ".join(kept)))
    return out


def quality_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    grams = {}
    for a in range(len(w) - 7):
        grams.setdefault(tuple(w[a : a + 8]), []).append(a)
    cover = set()
    for at in grams.values():
        if len(at) > 1:
            for a in at:
                cover.update(range(a, a + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover)


def near_classes(docs, k=5, least=0.8):
    """docs: (id, text) -> {id: (class id, number of differing texts linked)}; all pairs."""
    sets = {}
    for i, t in docs:
        w = (t or "").lower()
        w = words(w)
        sets[i] = frozenset(tuple(w[a : a + k]) for a in range(len(w) - k + 1)) or (frozenset([tuple(w)]) if w else frozenset())
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = {i: set() for i in ids}
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and len(a & b) >= least * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
                if a != b:
                    links[i].add(b)
                    links[j].add(a)
    return {i: (find(i), len(links[i])) for i in ids}


def distance_at_most_one(a, b):
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p:] == b[p + 1 :] or (len(a) == len(b) and a[p + 1 :] == b[p + 1 :])


def line_dedup(docs, least):
    """docs: (id, text) -> {id: (n_lines, n_removed, kept text)}; a line goes if an earlier one is within one edit; lines
    without a word and lines under ``least`` characters stay."""
    out, seen = {}, []
    known = set()
    for i, t in sorted(docs, key=lambda d: d[0]):
        kept = []
        lines = (t or "").split("\n")
        for x in lines:
            if len(x) >= least and words(x):
                gone = x in known or any(distance_at_most_one(x, y) for y in seen)
                if x not in known:
                    known.add(x)
                    seen.append(x)
                if gone:
                    continue
            kept.append(x)
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out
