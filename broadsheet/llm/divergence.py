"""Source divergence audit: how the word counts of a language's sources differ, by a two-pass vocabulary automaton.

Documents are dealt into parts of one language and source and about PART bytes. The first pass counts in how many
documents of a part each term stands; summed over all parts these are exact document frequencies, and terms in LEAST or
more documents of their language are kept. In the second pass a part meets its own kept terms: an Aho-Corasick automaton of
them, each between two delimiters, goes once over the part's texts and counts occurrences. So an automaton holds what
a part's text can hold, however large the vocabulary is.

The counts are sparse: most sources lack most terms. With p(s, w) of source s and term w, and p0(s) that of a term that
s doesn't have, the value of a pair of sources over all V terms of the language is

    sum over w of s     f(p(s, w), p0(t))                       by counts: equal counts give equal values
  + sum over w of t     f(p0(s), p(t, w))                       likewise
  + (V - n(s) - n(t)) * f(p0(s), p0(t))
  + sum over w of both  f(p, p) - f(p, p0) - f(p0, p) + f(p0, p0)

and only the last sum looks at terms; it is taken over groups of postings, dealt by term, and leaves them as a number a
pair. All numbers are whole: f(p, q) = (p - q) ** 2 div q.

Defined cases
-------------
* null text, lang, source: "". A group whose documents have no kept terms is compared like any other; values are 0 where
  a language keeps no term, and there are no pairs in a language of one source.
* null and repeated doc_id: each row is a document. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import keep

#: Documents of a language that a kept term stands in.
LEAST = 3
#: Probabilities are in units of 1 / ONE.
ONE = 1_000_000_000
#: Terms listed a group.
TOP = 200
#: Bytes of text that an automaton goes over, and postings that meet in one group.
PART, POSTINGS = 4 << 20, 200_000
#: Groups of documents that are sent to all tasks; more are joined by shuffle, a large group dealt over SALTS tasks.
MOST_SENT, SALTS = 50_000, 64

#: A-Z to a-z, other ASCII but letters to spaces; bytes of other characters stay.
_SPACED = bytes((b | 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def _texts(table: pa.Table) -> list[bytes]:
    return [x.translate(_SPACED) for x in table["text"].cast(pa.large_binary()).to_pylist()]


def joined(rows: DataFrame, groups: DataFrame, by: list[str], few: bool) -> DataFrame:
    """rows with the columns of groups: sent if they are few, else by shuffle, with the rows of a large group in several tasks."""
    if few:
        return rows.join(F.broadcast(groups), by)
    salted = rows.withColumn("salt_", (F.rand(1) * SALTS).cast("int"))
    return salted.join(groups.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*by, "salt_"]).drop("salt_")


def _with_terms(key: tuple, table: pa.Table) -> pa.Table:
    """First pass over a part: how many of its documents each term stands in."""
    counts: Counter[bytes] = Counter()
    for text in _texts(table):
        counts.update(set(text.split()))
    lang, source, piece = (x.as_py() for x in key)
    n = len(counts)
    terms = pa.array(list(counts), pa.binary()).cast(pa.string())
    return pa.table([pa.repeat(lang, n), pa.repeat(source, n), pa.repeat(piece, n), terms, pa.array(list(counts.values()), pa.int64())], names=["lang", "source", "piece", "term", "n"])


def _recounted(key: tuple, table: pa.Table, terms: pa.Table) -> pa.Table:
    """Second pass over a part: occurrences of its kept terms."""
    lang, source, _ = (x.as_py() for x in key)
    words = terms["term"].to_pylist()
    counts = np.zeros(len(words), np.int64)
    if words:
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, word in enumerate(words):
            automaton.add_word(f" {word} ", i)
        automaton.make_automaton()
        for text in _texts(table):
            found = np.fromiter((i for _, i in automaton.iter(f" {text.decode()} ")), np.int64)
            if len(found) < len(words):
                which, n = np.unique(found, return_counts=True)
                counts[which] += n
            else:
                counts += np.bincount(found, minlength=len(words))
    n = len(words)
    return pa.table([pa.repeat(lang, n), pa.repeat(source, n), terms["term"].combine_chunks(), pa.array(counts)], names=["lang", "source", "term", "n"])


def counts(docs: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
    """docs(lang, source, text) -> groups(lang, source, total, kinds, v), occurrences(lang, source, term, n), whether groups are few.

    total: N, the sum of a group's counts; kinds: how many kept terms it has; v: how many its language keeps.
    """
    texts = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")], F.xxhash64("doc_id", "text").alias("deal"))
    sizes = keep(texts.groupBy("lang", "source").agg(F.sum(F.octet_length("text").cast("long")).alias("size")), "divergence-groups")
    few = sizes.count() <= MOST_SENT
    pieces = sizes.select("lang", "source", F.greatest(F.lit(1), F.ceil(F.col("size") / PART)).alias("pieces"))
    dealt = joined(texts, pieces, ["lang", "source"], few)
    part = ["lang", "source", "piece"]
    dealt = dealt.select("lang", "source", F.pmod("deal", F.col("pieces")).alias("piece"), "text")

    terms = keep(dealt.groupBy(*part).applyInArrow(_with_terms, "lang string, source string, piece long, term string, n long"), "divergence-terms")
    kept = keep(terms.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST).select("lang", "term"), "divergence-vocabulary")
    own = terms.join(kept, ["lang", "term"]).select(*part, "term")
    recounted = dealt.groupBy(*part).cogroup(own.groupBy(*part)).applyInArrow(_recounted, "lang string, source string, term string, n long")
    occurrences = keep(recounted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "divergence-occurrences")

    totals = occurrences.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    groups = sizes.select("lang", "source").join(totals, ["lang", "source"], "left").join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v")), "lang", "left")
    return keep(groups.fillna(0, ["total", "kinds", "v"]), "divergence-totals"), occurrences, few


def _p(count: Column, total: Column, v: Column) -> Column:
    return F.lit(1) + F.call_function("div", F.lit(ONE) * (count + 1), F.greatest(total + v, F.lit(1)))


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _p_of(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    return 1 + ONE * (count + 1) // total


def _f_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


_FOUND = "lang string, source string, item string, term boolean, value long"


def _together(key: tuple, table: pa.Table) -> pa.Table:
    """Postings of some terms of a language, all of each -> corrections of pairs of sources, and the most telling terms of each source."""
    term, source = (table[c].combine_chunks().dictionary_encode() for c in ("term", "source"))
    at = term.indices.to_numpy()
    order = np.argsort(at, kind="stable")
    at, s = at[order], source.indices.to_numpy().astype(np.int64)[order]
    n, total, v, of_lang = (table[c].to_numpy()[order] for c in ("n", "total", "v", "lang_total"))
    p, p0 = _p_of(n, total + v), _p_of(np.zeros_like(n), total + v)

    starts = np.flatnonzero(np.diff(at, prepend=-1))
    q = np.repeat(_p_of(np.add.reduceat(n, starts), (of_lang + v)[starts]), np.diff(starts, append=len(at))) if len(at) else p
    value = _f_of(p, q)
    names = term.dictionary.take(pa.array(at))
    best = []
    for k in range(len(source.dictionary)):
        rows = np.flatnonzero((s == k) & (p > q))
        if len(rows) > TOP:  # all that are equal to the last one stay
            rows = rows[value[rows] >= np.partition(value[rows], -TOP)[-TOP]]
        best.append(rows)
    best = np.concatenate(best) if best else np.zeros(0, np.int64)

    width = len(source.dictionary)
    sums: dict[int, int] = Counter()
    step = 1
    while len(i := np.flatnonzero(at[step:] == at[:-step])):  # postings that stand `step` apart, of one term
        j = i + step
        for a, b in ((i, j), (j, i)):
            more = _f_of(p[a], p[b]) - _f_of(p[a], p0[b]) - _f_of(p0[a], p[b]) + _f_of(p0[a], p0[b])
            pair = s[a] * width + s[b]
            by = np.argsort(pair, kind="stable")
            pair, first = np.unique(pair[by], return_index=True)
            for k, x in zip(pair.tolist(), np.add.reduceat(more[by], first).tolist(), strict=True):
                sums[k] += x
        step += 1
    keys = np.fromiter(sums, np.int64, len(sums))
    pick = lambda codes: source.dictionary.take(pa.array(codes))
    m = len(best) + len(keys)
    return pa.table(
        {
            "lang": pa.repeat(key[0].as_py(), m),
            "source": pa.concat_arrays([pick(s[best]), pick(keys // max(width, 1))]),
            "item": pa.concat_arrays([names.take(pa.array(best)), pick(keys % max(width, 1))]),
            "term": pa.array(np.arange(m) < len(best)),
            "value": pa.concat_arrays([pa.array(value[best]), pa.array(list(sums.values()), pa.int64())]),
        }
    )


def divergence(docs: DataFrame) -> DataFrame:
    """docs(doc_id, lang, source, text) -> lang, source, part ("pair" or "term"), item, value, rank."""
    groups, occurrences, few = counts(docs)
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    told = joined(occurrences, groups.join(langs, "lang"), ["lang", "source"], few)
    buckets = max(1, -(-occurrences.count() // POSTINGS))
    told = told.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)))
    found = keep(told.groupBy("lang", "bucket").applyInArrow(_together, _FOUND), "divergence-found")

    terms = _ranked(found.filter("term").select("lang", "source", "item", "value"), "term").filter(F.col("rank") <= TOP)

    zero = F.lit(0).cast("long")
    other = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("t2"), F.col("kinds").alias("k2"))
    other = F.broadcast(other) if few else other
    p02 = _p(zero, F.col("t2"), F.col("v"))
    histogram = occurrences.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("m"))
    counted = joined(histogram, groups, ["lang", "source"], few).join(other, "lang").filter("source != item")
    p = _p(F.col("n"), F.col("total"), F.col("v"))
    sides = counted.groupBy("lang", "source", "item").agg(F.sum(F.col("m") * _f(p, p02)).alias("own"), F.sum(F.col("m") * _f(p02, p)).alias("others"))
    pairs = groups.join(other, "lang").filter("source != item")
    both = (F.col("v") - F.col("kinds") - F.col("k2")) * _f(_p(zero, F.col("total"), F.col("v")), p02)
    values = (
        pairs.select("lang", "source", "item", F.when(F.col("v") > 0, both).otherwise(0).alias("value"))
        .unionByName(sides.select("lang", "source", "item", F.col("own").alias("value")))
        .unionByName(sides.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("others").alias("value")))
        .unionByName(found.filter("not term").select("lang", "source", "item", "value"))
    )
    summed = values.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(summed, "pair").unionByName(terms)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
