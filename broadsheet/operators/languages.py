"""The language of a text by its trigrams.

`fitted` counts the trigrams of every labelled text: words are counted by language first, so that each distinct word is
split into trigrams once. `detected` adds the smoothed log-probabilities of a text's trigrams for each language; the
confidence is the share of the best language in the likelihoods, all languages being equally likely before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Trigrams a language keeps, the most frequent ones; rarer ones are as likely as unseen ones. And what is added to each count.
MOST_GRAMS, ADDED = 50_000, 0.5
#: Languages of a model, which is sent to all tasks.
MOST_LANGUAGES = 300
#: Characters of a group of texts, which is scored at once; a longer text is one of its own, in slices of as many.
GROUP = 1 << 19
#: Trigrams of an alphabet are looked up in a table of up to so many cells, those of a larger one by search.
MOST_CELLS = 1 << 22


def fitted(rows: DataFrame, language: str, text: str) -> DataFrame:
    """language, gram, n, total: the model. Rows without language or text are left out."""
    words = F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0)))
    counted = rows.filter(F.col(language).isNotNull()).select(F.col(language).alias("language"), words.alias("word")).groupBy("language", "word").agg(F.count(F.lit(1)).alias("n"))
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    grams = F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.substr(padded, i, F.lit(3)))
    counted = counted.select("language", F.explode(grams).alias("gram"), "n").groupBy("language", "gram").agg(F.sum("n").alias("n"))
    totals = counted.groupBy("language").agg(F.sum("n").alias("total"))
    best = Window.partitionBy("language").orderBy(F.col("n").desc(), "gram")
    kept = counted.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= MOST_GRAMS).drop("rank")
    return kept.join(totals, "language")


class Model:
    def __init__(self, rows: list[tuple[str, str, int, int]]):
        """rows: language, gram, n, total."""
        self.languages = sorted({r[0] for r in rows})
        self.grams = {g: i for i, g in enumerate(sorted({r[1] for r in rows}))}
        self.unseen = len(self.grams)
        at = {x: i for i, x in enumerate(self.languages)}
        n, total = np.zeros((self.unseen + 1, len(at))), np.zeros(len(at))
        for language, gram, count, whole in rows:
            n[self.grams[gram], at[language]] = count
            total[at[language]] = whole
        self.scores = np.log((n + ADDED) / (total + ADDED * (self.unseen + 1)))
        self.symbols = _letters().astype(np.int64)  # of each code point: 0 no letter, 1 a letter that the model doesn't have, then its own ones
        three = [g for g in self.grams if len(g) == 3]  # no other ones stand around a letter
        own = [c for c in sorted(set("".join(three))) if self.symbols[ord(c)]]
        self.symbols[[ord(c) for c in own]] = np.arange(2, len(own) + 2)
        self.base, at = len(own) + 2, {" ": 0} | {c: i for i, c in enumerate(own, 2)}
        kept = [g for g in three if at.keys() >= set(g)]
        keys = np.array([(at[g[0]] * self.base + at[g[1]]) * self.base + at[g[2]] for g in kept], np.int64)
        places = np.array([self.grams[g] for g in kept], np.int64)
        if self.base**3 <= MOST_CELLS:
            self.keys, self.places = None, np.full(self.base**3, self.unseen)
            self.places[keys] = places
        else:
            order = np.argsort(keys)
            self.keys, self.places = np.append(keys[order], np.iinfo(np.int64).max), np.append(places[order], self.unseen)
        self.by_language = np.ascontiguousarray(self.scores.T)

    def places_of(self, keys: np.ndarray) -> np.ndarray:
        if self.keys is None:
            return self.places[keys]
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.places[at], self.unseen)

    def best(self, texts: list[str | None]) -> list[tuple[str | None, float | None]]:
        """Each letter of a text is the middle of a trigram, with blanks for all that is no letter."""
        out: list[tuple[str | None, float | None]] = [(None, None)] * len(texts)
        if not self.languages:
            return out
        lower = [(t or "").lower() for t in texts]
        symbols = self.symbols[np.frombuffer(f" {' '.join(lower)} ".encode("utf-32-le"), np.uint32)]
        ends = np.cumsum([len(t) + 1 for t in lower])  # the places of the blanks behind the texts
        total, n = np.zeros((len(self.languages), len(texts))), np.zeros(len(texts), np.int64)
        for lo in range(0, len(symbols), GROUP):
            letters = lo + np.flatnonzero(symbols[lo : lo + GROUP])
            doc = np.searchsorted(ends, letters)
            places = self.places_of((symbols[letters - 1] * self.base + symbols[letters]) * self.base + symbols[letters + 1])
            n += np.bincount(doc, minlength=len(texts))
            for k, scores in enumerate(self.by_language):
                total[k] += np.bincount(doc, weights=scores[places], minlength=len(texts))
        top = np.argmax(total, axis=0)
        shares = 1 / np.exp(total - total[top, np.arange(len(texts))]).sum(axis=0)
        for i in np.flatnonzero(n).tolist():
            out[i] = self.languages[top[i]], round(float(shares[i]), 4)
        return out


@cache
def _letters() -> np.ndarray:
    """Of each code point: whether it is a letter, as words have them."""
    every = "".join(map(chr, range(0x110000)))
    out = np.zeros(len(every), bool)
    for m in re.finditer(r"[^\W\d_]+", every):
        out[m.start() : m.end()] = True
    return out


def _groups(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Texts in groups of about GROUP characters."""
    lo, size = 0, 0
    for i, t in enumerate(texts, 1):
        size += len(t or "")
        if size >= GROUP or i == len(texts):
            yield texts[lo:i]
            lo, size = i, 0


def detected(rows: DataFrame, key: str, text: str, model: DataFrame) -> DataFrame:
    """key, language_code, confidence_score; nulls for a text without letters. Equally likely languages go by code."""
    spark = rows.sparkSession
    model = model.select("language", "gram", "n", "total").persist()  # fitted once, for both that follow
    try:
        if model.select("language").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
            raise ValueError(f"a model has at most {MOST_LANGUAGES} languages")
        held = spark.sparkContext.broadcast([tuple(r) for r in model.collect()])  # MOST_GRAMS a language at most
    finally:
        model.unpersist()
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(held.value)
        for batch in batches:
            found = [x for group in _groups(batch.column(1).to_pylist()) for x in own.best(group)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=[key, "language_code", "confidence_score"])

    return rows.select(key, text).mapInArrow(run, f"{key} {kind}, language_code string, confidence_score double")
