"""Licence scan: a positional index of rare words of licence notices, with mandatory phrases.

A first pass counts, over all documents, in how many each word of the notices stands. The rarest half of a notice's words
(RARE_WORDS at most), and the two rarest of each of its phrases, are indexed with their places. In the second pass each stretch of BLOCK words of a text looks up its
RAREST highest-IDF indexed words; a word at place x that the notice has at place y says that the notice begins at x - y.
Where two different words of a notice agree, up to SLACK words, the notice's mandatory phrases are looked for at their
places, word by word; a notice is found if all of them stand there and LEAST_SHARE of its words do. Whole texts are gone through, in stretches, so that a notice is found wherever it stands.

Words are found by 64-bit hashes; phrases are confirmed byte by byte.

Defined cases
-------------
* null or empty text: no words, no labels, score 0. null and repeated doc_id: each row is judged by itself.
* what stands across two documents is never one place. An empty table gives an empty result. Extra columns are ignored.
* words that no document has are the rarest; equally rare ones go by their bytes, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays


class Notice(NamedTuple):
    label: str
    text: str
    #: All of these must stand near their places in the text.
    phrases: tuple[str, ...]


# Phrases that are labels by themselves.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# The opening words of common public licences and notices, in lower case and without punctuation.
_GRANT = "this program is free software you can redistribute it and or modify it under the terms of the {} as published by the free software foundation either version {} of the license or at your option any later version"
_WORK = "this work is licensed under the {} version {}"
_COMMONS = "this work is licensed under a creative commons {} 4 0 international license"
_BSD = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
_GNU = [
    ("gpl-2", "gnu general public license", "2"),
    ("gpl-3", "gnu general public license", "3"),
    ("lgpl-2.1", "gnu lesser general public license", "2 1"),
    ("lgpl-3", "gnu lesser general public license", "3"),
    ("agpl-3", "gnu affero general public license", "3"),
]
_CREATIVE = [
    ("cc-by", "attribution"),
    ("cc-by-sa", "attribution sharealike"),
    ("cc-by-nc", "attribution noncommercial"),
    ("cc-by-nd", "attribution noderivatives"),
    ("cc-by-nc-sa", "attribution noncommercial sharealike"),
    ("cc-by-nc-nd", "attribution noncommercial noderivatives"),
]
NOTICES = [
    *(Notice(label, form.format(name, version), (name, f"version {version}")) for label, name, version in _GNU for form in (_GRANT, _WORK)),
    *(Notice(label, _COMMONS.format(terms), ("creative commons", f"{terms} 4 0 international")) for label, terms in _CREATIVE),
    Notice("mit", "released under the mit license", ("mit license",)),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge", "deal in the software without restriction")),
    Notice("apache-2", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    Notice("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache license", "version 2 0")),
    Notice("bsd", _BSD, ("redistribution and use in source and binary forms", "with or without modification")),
    Notice("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ("neither the name of", "endorse or promote products derived from this software")),
    Notice("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license", "2 0")),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute this software", "with or without fee is hereby granted")),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
    Notice("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ("provided as is without any express or implied warranty", "in no event will the authors be held liable")),
    Notice("bsl-1", "distributed under the boost software license version 1 0", ("boost software license", "version 1 0")),
    Notice("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", ("eclipse public license", "2 0")),
    Notice("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright and related or neighboring rights",)),
    Notice("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Notice("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
]

#: Indexed words of a notice, looked-up words of a stretch, and its length.
RARE_WORDS, RAREST, BLOCK = 8, 16, 64
#: Words by which places may differ from the notice's, and the share of its words that must stand at their places.
SLACK, LEAST_SHARE = 6, 0.5

#: Words are of 0-9, a-z (after A-Z became a-z) and what isn't ASCII.
_OF_WORDS = np.zeros(256, bool)
_OF_WORDS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Lexicon:
    """The words of all notices and phrases by number, and what stands of them in a chunk."""

    def __init__(self, texts: list[str]):
        self.words = sorted({w for t in texts for w in t.split()})
        self.number = {w: i for i, w in enumerate(self.words)}
        chunk = next(arrays.chunks(pa.array([" ".join(self.words)])))
        start, end, _ = chunk.words(_OF_WORDS)
        hashes = chunk.hashes(start, end)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def ids(self, text: str) -> np.ndarray:
        return np.array([self.number[w] for w in text.split()], np.int64)

    def read(self, chunk: arrays.Chunk) -> Words:
        start, end, doc = chunk.words(_OF_WORDS)
        found = chunk.hashes(start, end)
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        return Words(chunk, start, end, doc, np.where(self.hashes[at] == found, self.order[at], -1))


class Words:
    """The words of a chunk: their numbers in the lexicon, or -1, and where each document's begin."""

    def __init__(self, chunk: arrays.Chunk, start: np.ndarray, end: np.ndarray, doc: np.ndarray, ids: np.ndarray):
        self.chunk, self.start, self.end, self.doc, self.ids = chunk, start, end, doc, ids
        self.first = np.searchsorted(doc, np.arange(chunk.n + 1))

    def places(self, phrase: str, ids: np.ndarray, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Where in the words [lo, hi) the phrase's words stand consecutively in one document."""
        hi = len(self.ids) if hi is None else hi
        at = np.flatnonzero(self.ids[lo : max(lo, hi - len(ids) + 1)] == ids[0]) + lo
        for k in range(1, len(ids)):
            at = at[self.ids[at + k] == ids[k]]
        at = at[self.doc[at] == self.doc[at + len(ids) - 1]]
        words = [w.encode() for w in phrase.split()]
        same = [all(self.chunk.data[self.start[i + k] : self.end[i + k]].tobytes() == w for k, w in enumerate(words)) for i in at.tolist()]
        return at[np.array(same, bool)]


def frequencies(docs: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """In how many documents each word of the lexicon stands."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(lexicon.words), np.int64)
        for batch in batches:
            for chunk in arrays.chunks(batch["text"], lower=True):
                words = lexicon.read(chunk)
                known = words.ids >= 0
                pairs = np.unique(words.doc[known] * len(total) + words.ids[known])
                total += np.bincount(pairs % len(total), minlength=len(total))
        yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total)], names=["word", "n"])

    rows = docs.select("text").mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row a word of the notices
    out = np.zeros(len(lexicon.words), np.int64)
    for word, n in rows:
        out[word] = n
    return out


def _place(text: str, phrase: str) -> int:
    """At which word of the text the phrase begins."""
    before, found, _ = f" {text} ".partition(f" {phrase} ")
    if not found:
        raise ValueError(f"the notice {text!r} lacks its phrase {phrase!r}")
    return len(before.split())


class Index:
    """Places of the rarest words of each notice."""

    def __init__(self, lexicon: Lexicon, notices: list[Notice], frequency: np.ndarray):
        self.lexicon, self.notices = lexicon, notices
        #: 0 is the word of the highest IDF.
        self.rarity = np.empty(len(frequency), np.int64)
        self.rarity[np.lexsort([np.arange(len(frequency)), frequency])] = np.arange(len(frequency))
        self.texts = [lexicon.ids(n.text) for n in notices]
        self.phrases = [[(p, lexicon.ids(p)) for p in n.phrases] for n in notices]
        self.offsets = [[_place(n.text, p) for p in n.phrases] for n in notices]
        rows = []
        for k, text in enumerate(self.texts):
            words = sorted(set(text.tolist()), key=lambda w: self.rarity[w])
            rare = set(words[: min(RARE_WORDS, max(2, (len(words) + 1) // 2))])
            for _, ids in self.phrases[k]:  # two of these agree wherever the phrase stands
                rare |= set(sorted(set(ids.tolist()), key=lambda w: self.rarity[w])[:2])
            rows += [(w, k, y) for y, w in enumerate(text.tolist()) if w in rare]
        rows.sort()
        self.word, self.notice, self.place = (np.array(c, np.int64) for c in zip(*rows, strict=True))
        self.first = np.searchsorted(self.word, np.arange(len(frequency) + 1))

    def looked_up(self, words: Words) -> np.ndarray:
        """The words, by their index in the chunk, of the RAREST highest-IDF indexed words of each stretch."""
        at = np.flatnonzero(words.ids >= 0)
        at = at[self.first[words.ids[at] + 1] > self.first[words.ids[at]]]
        doc = words.doc[at]
        block = (at - words.first[doc]) // BLOCK
        rare = self.rarity[words.ids[at]]
        order = np.lexsort([at, rare, block, doc])
        at, doc, block, rare = at[order], doc[order], block[order], rare[order]
        new_block = np.diff(doc, prepend=-1).astype(bool) | np.diff(block, prepend=-1).astype(bool)
        rank = np.cumsum(new_block | np.diff(rare, prepend=-1).astype(bool))
        before = np.maximum.accumulate(np.where(new_block, rank, 0))
        return at[rank - before < RAREST]

    def candidates(self, words: Words) -> Iterator[tuple[int, int, int, int]]:
        """Document, notice, and the first and last word at which it could begin, where two of its words agree."""
        at = self.looked_up(words)
        if not len(at):
            return
        lo, hi = self.first[words.ids[at]], self.first[words.ids[at] + 1]
        n = hi - lo
        posting = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        at = np.repeat(at, n)
        notice, begins, doc = self.notice[posting], at - self.place[posting], words.doc[at]
        order = np.lexsort([begins, notice, doc])
        at, notice, begins, doc = at[order], notice[order], begins[order], doc[order]
        new = np.diff(doc, prepend=-1).astype(bool) | np.diff(notice, prepend=-1).astype(bool) | (np.diff(begins, prepend=-(10**9)) > SLACK)
        group = np.cumsum(new) - 1
        kinds = np.unique(group * len(self.rarity) + words.ids[at]) // len(self.rarity)
        agreed = np.bincount(kinds, minlength=group[-1] + 1) >= 2
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(new)) - 1
        for s, e in zip(starts[agreed].tolist(), ends[agreed].tolist(), strict=True):
            yield int(doc[s]), int(notice[s]), int(begins[s]), int(begins[e])

    def confirmed(self, words: Words, doc: int, k: int, lo: int, hi: int) -> list[tuple[int, int, float]]:
        """First word, end and share of the places of notice k that begin in [lo, hi], give or take SLACK."""
        first, last = int(words.first[doc]), int(words.first[doc + 1])
        text = self.texts[k]
        a, b = max(first, lo - SLACK), min(last, hi + len(text) + SLACK)
        places = [words.places(p, ids, a, b) - y for (p, ids), y in zip(self.phrases[k], self.offsets[k], strict=True)]
        out = []
        for x in places[0].tolist():
            near = [p[(p >= x - SLACK) & (p <= x + SLACK)] for p in places[1:]]
            share = self._share(words, text, x, first, last)
            if all(map(len, near)) and share >= LEAST_SHARE:
                out.append((max(first, x) - first, min(last, x + len(text)) - first, share))
        return out

    def _share(self, words: Words, text: np.ndarray, x: int, first: int, last: int) -> float:
        """The share of a notice's words that stand at their places, give or take SLACK."""
        at = x + np.arange(len(text))
        hit = np.zeros(len(text), bool)
        for shift in range(-SLACK, SLACK + 1):
            there = at + shift
            inside = (there >= first) & (there < last)
            hit[inside] |= words.ids[there[inside]] == text[inside]
        return float(hit.mean())


RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "places array<struct<label: string, first: long, until: long, share: double>>"
)
_PLACES = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("until", pa.int64()), ("share", pa.float64())]))


def scan(docs: DataFrame, notices: list[Notice] = NOTICES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """docs(doc_id, text) -> labels of every text, the places of base phrases, and of the notices found (words from 0, `until` excluded)."""
    lexicon = Lexicon([*phrases, *(n.text for n in notices), *(p for n in notices for p in n.phrases)])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = Index(lexicon, notices, frequencies(texts, lexicon))
    base = [(p, lexicon.ids(p), label) for p, label in phrases.items()]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for chunk in arrays.chunks(batch["text"], lower=True):
                words = lexicon.read(chunk)
                hits = [[] for _ in range(chunk.n)]
                for phrase, ids, label in base:
                    for i in words.places(phrase, ids).tolist():
                        hits[words.doc[i]].append((i - int(words.first[words.doc[i]]), label))
                places = [[] for _ in range(chunk.n)]
                for doc, k, lo, hi in index.candidates(words):
                    places[doc] += [(notices[k].label, *p) for p in index.confirmed(words, doc, k, lo, hi)]
                for d in range(chunk.n):
                    own, found = hits[d], sorted(set(places[d]), key=lambda p: (p[1], p[0], p[2]))
                    starts, labels = [i for i, _ in own], {x for _, x in own}
                    score = 1.0 if own else max((p[3] for p in found), default=0.0)
                    both = labels | {p[0] for p in found}
                    rows.append((int(words.first[d + 1] - words.first[d]), len(own), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(both)), score, [dict(zip(("label", "first", "until", "share"), p, strict=True)) for p in found]))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _PLACES]
            yield pa.record_batch([batch["doc_id"], *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=[f.split()[0] for f in RESULT.split(", ")[:8]] + ["places"])

    return texts.mapInArrow(scanned, RESULT)
