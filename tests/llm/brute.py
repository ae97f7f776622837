"""Plain-Python restatements of the operators' contracts, one document at a time."""

import hashlib
import math
import re
import zlib
from collections import Counter

BLANK = re.compile("[^\x20\x09-\x0D]+")
FOLD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def lowered(text):
    return BLANK.findall((text or "").translate(LOWER))


def folded(text):
    return FOLD.findall((text or "").translate(LOWER))


def fold_of(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def rule_stats(text):
    text = text or ""
    words = BLANK.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if BLANK.search(line):
            repeated += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(inside))


def shingles(text, size=4):
    words = lowered(text)
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def linked(a, b):
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= 85 * (len(a) + len(b) - both)


def reachable(ids, edges):
    """The least id, nulls aside, that edges (places) reach from each place."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in edges:
        root[find(a)] = find(b)
    least = {}
    for i, key in enumerate(ids):
        known = [k for k in (key, least.get(find(i))) if k is not None]
        least[find(i)] = min(known) if known else None
    return [least[find(i)] for i in range(len(ids))]


def components(sets):
    """Smallest reachable id of each id; sets: [(id, shingles)]."""
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            if linked(a, sets[j][1]):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(sets):
        least[find(i)] = min(key, least.get(find(i), key))
    return [least[find(i)] for i in range(len(sets))]


def contamination(text, items, size=10):
    words, hit, found = folded(text), set(), set()
    for item, item_text in items:
        w = folded(item_text)
        n = min(size, len(w))
        for window in {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else ():
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) == window:
                    hit.update(range(i, i + n))
                    found.add(str(item))
    listed = sorted(found)
    return len(words), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)


def unigram_scores(docs):
    """{doc_id: (held_out, n_tokens, n_known, N, base_score)} of [(doc_id, text)]."""
    tokens = {i: [*lowered(t), None] for i, t in docs}
    counts = Counter(t for i, ts in tokens.items() if fold_of(i, 10) for t in ts)
    total, distinct = sum(counts.values()), len(counts)
    bottom = total + 0.1 * (distinct + 1)
    return {i: (fold_of(i, 10) == 0, len(ts), sum(counts[t] > 0 for t in ts), total,
                sum(math.log10((counts[t] + 0.1) / bottom) for t in ts)) for i, ts in tokens.items()}
