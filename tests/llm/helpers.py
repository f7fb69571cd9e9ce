"""Brute-force versions of the operators."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def as_bytes(text):
    return (text or "").encode()


def kept_bytes(texts, length):
    """(covered flag of each byte, the rest) of each text."""
    counts = Counter()
    for data in map(as_bytes, texts):
        counts.update(data[i : i + length] for i in range(len(data) - length + 1))
    out = []
    for data in map(as_bytes, texts):
        covered = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if counts[data[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        kept = bytes(c for c, gone in zip(data, covered) if not gone)
        out.append((covered, kept))
    return out


def repeated_bytes(texts, length):
    """(bytes, removed, runs, digest of the rest) of each text."""
    return [
        (
            len(covered),
            sum(covered),
            sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered)),
            hashlib.sha256(kept).hexdigest(),
        )
        for covered, kept in kept_bytes(texts, length)
    ]


def shingle_set(text, n):
    capitals = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    words = WORD.findall((text or "").translate(capitals))
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def linked_components(rows, n, percent):
    """(set size, smallest id reached) of each row (id, text)."""
    sets = [shingle_set(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [
        (len(s), least.get(find(i)) if s else key) for i, (s, (key, _)) in enumerate(zip(sets, rows))
    ]
