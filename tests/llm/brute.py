"""Brute-force forms of the operators, on lists of rows."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    data = (text or "").encode()
    return WORD.findall(bytes(c + 32 if lower and 65 <= c <= 90 else c for c in data))


def shingles(text):
    w = words(text, True)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(docs):
    """doc_id -> (size of set, least doc_id reachable)."""
    sets = {d: shingles(t) for d, t in docs if d is not None}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def without_word_repeats(docs, n=13):
    first = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - n + 1):
            if d is not None:
                key = tuple(w[i : i + n])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        if d is not None:
            for i in range(len(w) - n + 1):
                if first[tuple(w[i : i + n])] < d:
                    gone[i : i + n] = [True] * n
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def without_byte_repeats(docs, n=100):
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - n + 1):
            if d is not None:
                key = b[i : i + n]
                first[key] = min(first.get(key, (d, i)), (d, i))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        if d is not None:
            for i in range(len(b) - n + 1):
                if first[b[i : i + n]] < (d, i):
                    gone[i : i + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def contained(docs, items):
    sets = [(i, shingles(t)) for i, t in items]
    out = set()
    for d, t in docs:
        own = shingles(t)
        for i, s in sets:
            if s and 100 * len(s & own) >= 75 * len(s):
                out.add((d, i, len(s), len(s & own)))
    return sorted(out, key=repr)


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = [x.decode() for x in words(text)]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = {g for g in grams if grams.count(g) > 1}
    hit = {j for i, g in enumerate(grams) if g in many for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)
