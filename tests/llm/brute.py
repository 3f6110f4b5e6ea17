"""The contracts of the queries once more, in plain Python on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WHITE = " \t\n\x0b\x0c\r"


def words(text, pattern="[^\x20\x09-\x0d]+"):
    return re.findall(pattern, (text or "").translate(_LOWER))


def shingles(tokens, width=5):
    if len(tokens) < width:
        return frozenset([tuple(tokens)]) if tokens else frozenset()
    return frozenset(tuple(tokens[i : i + width]) for i in range(len(tokens) - width + 1))


def similar(a, b):
    common = len(a & b)
    return 100 * common >= 80 * (len(a) + len(b) - common)


def groups(sets):
    """The smallest key that each key reaches by similar sets."""
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = [k for k in sorted(sets) if sets[k]]
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if sets[a] & sets[b] and similar(sets[a], sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in sets}


def kept_lines(rows):
    """By document: lines before, lines dropped, text that stays."""
    key = lambda line: line.strip(_WHITE).translate(_LOWER)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= 10:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if doc is None or len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def contamination(rows, items, width=13):
    """By document: words, hit words, ids of the items found."""
    pattern = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    windows = defaultdict(set)
    for item, text in items:
        w = words(text, pattern)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in rows:
        w = words(text, pattern)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def pieces(rows, encode, capacity=2048):
    """The pieces of each document: (doc_id, piece, start, length, crc32)."""
    out = []
    for doc, text in rows:
        ids = [*encode(text or ""), 0]
        bounds = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            out.append((doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def check_packed(rows, capacity=2048):
    """The number of sequences of (sequence, offset, length) rows, which must be gapless and no longer than ``capacity``."""
    by = defaultdict(list)
    for sequence, offset, length in rows:
        by[sequence].append((offset, length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def periodic_runs(tokens, least_words=6, least_periods=4):
    """(start, length, period) of every run, by start and period."""
    n, out = len(tokens), []
    for q in range(1, n // least_periods + 1):
        i = q
        while i < n:
            if tokens[i] != tokens[i - q]:
                i += 1
                continue
            j = i
            while j < n and tokens[j] == tokens[j - q]:
                j += 1
            start, length = i - q, j - i + q
            smaller = any(all(tokens[k] == tokens[k - p] for k in range(start + p, j)) for p in range(1, q))
            if length >= max(least_words, least_periods * q) and not smaller:
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(tokens, runs):
    gone = {k for start, length, q in runs for k in range(start + q, start + length)}
    return [t for k, t in enumerate(tokens) if k not in gone]


def cycled(doc_id, tokens):
    """The words that the run query takes for a document."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(tokens), h // 10
    if h % 10 or not n:
        return tokens
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [tokens[i] if i < a else tokens[a + (i - a) % p] for i in range(n)]


def trie(conversations):
    """The nodes of the prefix trie of {id: [(role, text)]}, by prefix."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, own in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(own) - 1) * len(k[-1][1].encode()) if k else 0
    out = set()
    for k, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(conversations[c]) == len(k))
        parent = min(members[k[:-1]]) if k else None
        out.add((min(own), len(k), parent, len(own), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rebuilt(conversations):
    """Each conversation on the head of another, as the trie query takes them."""
    out = {}
    for c, own in conversations.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = conversations.get(c - c % 5, [])[:h] + own[h:]
    return out


def equal_texts(rows):
    """By normalised text: the ids that hold it, and the largest, a null id being the smallest."""
    holders = defaultdict(list)
    for doc, text in rows:
        holders[(text or "").translate(_LOWER)].append(doc)
    return {t: (ids, max(ids, key=lambda x: (x is not None, x or 0))) for t, ids in holders.items()}
