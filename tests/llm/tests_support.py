"""Brute-force counterparts that several tests use."""

import re
from collections import defaultdict

import xxhash

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_windows(text, items):
    """The windows of items that occur in a text."""
    held = words(text)
    grams = defaultdict(set)
    found = set()
    for item in items:
        w = words(item)
        for at in range(max(1, len(w) - 9) if w else 0):
            gram = tuple(w[at:at + 10])
            if len(gram) not in grams:
                grams[len(gram)] = {tuple(held[i:i + len(gram)]) for i in range(len(held) - len(gram) + 1)}
            if gram in grams[len(gram)]:
                found.add(gram)
    return found


def plain_fingerprint(text):
    held = (text or "").encode().lower().split()
    grams = [b" ".join(held[i:i + 3]) for i in range(max(1, len(held) - 2))] if held else []
    values = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_components(docs, prints, radius):
    """Per doc_id the least doc_id reachable by links of at most `radius` bits."""
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        least[find(i)].append(doc_id)
    return {doc_id: min(least[find(i)]) for i, (doc_id, _) in enumerate(docs)}
