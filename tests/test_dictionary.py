"""Dictionary matching against Python's own patterns, longest terms first."""

from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from broadsheet.operators import dictionary
from broadsheet.sources import readers


def brute(text, terms):
    """Counter of (category, term)."""
    known = {t.casefold(): c for t, c in sorted(terms) if t}
    if text is None or not text.strip():
        return None
    ordered = sorted(known, key=lambda t: (-len(t), t))
    # Each character of a text is compared in folded case, where that is one character.
    one = "".join(next((x for x in (c.casefold(), c.lower()) if len(x) == 1), c) for c in text)
    found = re.compile(r"\b(" + "|".join(map(re.escape, ordered)) + r")\b").findall(one) if ordered else []
    return Counter((known[t], t) for t in found)


def random_case():
    rng = random.Random(15)
    words = ["a", "ab", "Abc", "b", "bc", "ß", "ss", "É", "x_y", "9", "Straße", "STRASSE", "İ", "-", "b-c", "'", "日本"]
    terms = [("".join(rng.choice(words) + rng.choice((" ", " ", "", "-", "'")) for _ in range(rng.randint(1, 4))).strip(), rng.choice("pqr")) for _ in range(150)]
    texts = ["".join(rng.choice(words) + rng.choice((" ", " ", "", "\n", "-", ".", "'")) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    return terms + [("ab", "one"), ("AB", "two"), ("***", "signs"), ("b***", "signs")], [*texts, None, "", " \t", "ab *** a*** b***b", "abc" * 2000, texts[0]]


@pytest.mark.parametrize("most_chars, piece", [(None, dictionary.PIECE), (10, dictionary.PIECE), (10, 300)])
def test_matches_equal_patterns(spark, monkeypatch, most_chars, piece):
    monkeypatch.setattr(dictionary, "PIECE", piece)
    terms, texts = random_case()
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3)
    got = dictionary.matched(rows, "id", "t", spark.createDataFrame(terms, "term string, category string"), most_chars).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r["id"]], terms)
        if want is None:
            assert r["matches"] is r["match_count"] is r["term_count"] is None
        else:
            assert Counter({(c, t): n for c, m in r["matches"].items() for t, n in m.items()}) == want, texts[r["id"]]
            assert (r["match_count"], r["term_count"]) == (sum(want.values()), len(want))


@pytest.mark.parametrize("most_chars", [None, -1])
def test_empty_dictionary_and_table(spark, most_chars):
    none = spark.createDataFrame([], "term string, category string")
    rows = spark.createDataFrame([(1, "a b"), (2, None)], "id int, t string")
    got = {r["id"]: tuple(r)[1:] for r in dictionary.matched(rows, "id", "t", none, most_chars).collect()}
    assert got == {1: ({}, 0, 0), 2: (None, None, None)}
    assert dictionary.matched(rows.limit(0), "id", "t", spark.createDataFrame([("a", "b")], none.schema), most_chars).count() == 0


def test_large_dictionary(spark):
    """More terms than a pattern could hold; every third word of the text is one."""
    terms = spark.range(300_000).selectExpr("concat('word', id * 3, ' tail') as term", "concat('c', id % 5) as category")
    rows = spark.createDataFrame([(k, " ".join(f"WORD{i} tail" for i in range(k, k + 3000))) for k in (0, 5000, 899_990)], "id long, t string")
    got = {r["id"]: r["match_count"] for r in dictionary.matched(rows, "id", "t", terms).collect()}
    assert got == {0: 1000, 5000: 1000, 899_990: 3}


def test_thesaurus_is_in_folded_case(spark):
    lines = spark.createDataFrame([(0, '{"keyword": "Straße", "category": "a", "related_terms": ["STRASSE", "Weg"]}')], "line int, value string")
    assert {r["term"] for r in readers.thesaurus(lines).collect()} == {"strasse", "weg"}


def test_batches_go_in_slices(monkeypatch):
    """All rows in order, a long text alone, none over the limits."""
    texts = ["a" * 10, None, "", "b" * 5000, "c" * 90, "d" * 20, "é" * 40] + ["x"] * 30
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"]).slice(1)
    monkeypatch.setattr(dictionary, "SLICE_BYTES", 100), monkeypatch.setattr(dictionary, "SLICE_ROWS", 8)
    parts = list(dictionary.sliced(batch, 1))
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    assert all(p.num_rows == 1 or p.num_rows <= 8 and sum(len((t or "").encode()) for t in p["text"].to_pylist()) <= 100 for p in parts)
    assert [p.num_rows for p in parts][:3] == [2, 1, 1]
