"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter
from hashlib import md5

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, n):
    w = words((text or "").translate(LOWER))
    if len(w) < n:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*[w[k:] for k in range(n)]))


def near_duplicates(rows, n, percent):
    """rows: (doc_id, text) -> sorted (doc_id, size, component_id), all pairs compared."""
    sets = [shingle_set(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                if 100 * len(a & b) >= percent * len(a | b):
                    parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), least.get(find(i))) for i, (doc_id, _) in enumerate(rows)]


def kept_words(texts, length):
    """Per text: (words, kept words)."""
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((w, [x for i, x in enumerate(w) if i not in gone]))
    return out


def plain(text):
    return re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", (text or "").translate(LOWER)).split(" ")


def plain_words(text):
    return [w for w in plain(text) if w]


def targets(sizes, weights, share=1.5, most=2.0):
    """source -> target, by sharing out the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        target = {s: most * sizes[s] for s in capped} | {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target
        capped |= over


def copies(doc_id, size, source_size, target, seed=0):
    rate = target / source_size if source_size else 0.0
    key = f"{seed}:{'null' if doc_id is None else doc_id}"
    draw = int(md5(key.encode()).hexdigest()[:8], 16) / 2**32
    return int(rate) + (draw < rate - int(rate))
