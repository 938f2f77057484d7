"""Plain single-process versions of the operators, to compare with."""

from itertools import combinations

import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(texts, first=0):
    """(doc_id, text, ...) rows of the documents table."""
    return [(first + i, t, "en", "s", len(t) if t is not None else None) for i, t in enumerate(texts)]


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(prints, radius):
    """prints: (id, fingerprint) pairs -> {id: smallest id}"""
    by = {}
    for i, p in prints:
        by.setdefault(p, []).append(i)
    parent = {p: p for p in by}

    def root(p):
        while parent[p] != p:
            parent[p] = parent[parent[p]]
            p = parent[p]
        return p

    for a, b in combinations(by, 2):
        if (a ^ b).bit_count() <= radius:
            parent[root(a)] = root(b)
    least = {}
    for p, ids in by.items():
        least[root(p)] = min(least.get(root(p), min(ids)), min(ids))
    return {i: least[root(p)] for p, ids in by.items() for i in ids}


def word_shingles(text, size=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def alike(texts, likeness=0.8):
    """texts: {id: text} -> pairs of ids whose sets of word shingles have at least this Jaccard coefficient."""
    sets = {i: word_shingles(t) for i, t in texts.items()}
    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, set()).add(i)
    pairs = {p for ids in by.values() for p in combinations(sorted(ids), 2)}
    return {(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= likeness * len(sets[a] | sets[b])}


def joined(ids, pairs):
    """{id: smallest id that links reach}"""
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}
