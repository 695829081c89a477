"""Breaks against the annex's own examples, and against another implementation of its rules for words."""

from __future__ import annotations

import random

import pytest
import regex
from pyspark.sql import functions as F

from broadsheet.functions import breaks


@pytest.mark.parametrize(
    "text, want",
    [
        ("The quick (“brown”) fox can’t jump 32.3 feet, right?", ["The", "quick", "brown", "fox", "can’t", "jump", "32.3", "feet", "right"]),
        ("can't 'tis e.g. a:b a.b. x''y", ["can't", "tis", "e.g", "a:b", "a.b", "x", "y"]),
        ("3,141.5 1.a a.1 1:2 1'2", ["3,141.5", "1", "a", "a", "1", "1", "2", "1'2"]),
        ("foo_bar _a_ a__1 __", ["foo_bar", "_a_", "a__1"]),
        ("cafés ä‍b naïve", ["cafés", "ä‍b", "naïve"]),
        ("́a \ńb", ["a", "b"]),
        ("צה״ל צ׳ אב'", ["צה״ל", "צ׳", "אב'"]),
        ("カタカナ ひら 漢字 한국어", ["カタカナ", "ひ", "ら", "漢", "字", "한국어"]),
        ("ภาษาไทย ง่าย", ["ภาษาไทย", "ง่าย"]),
        ("😀 👩‍🚀 … -- ", []),
        ("A1b2 2x x2.5", ["A1b2", "2x", "x2.5"]),
        ("", []),
    ],
)
def test_words(text, want):
    assert breaks.words_of(text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("It is 3.4 and c.d here.", ["It is 3.4 and c.d here."]),
        ("The U.S. Army came. It left.", ["The U.S.", "Army came.", "It left."]),
        ("In U.S.A now", ["In U.S.A now"]),
        ("the resp. leaders are", ["the resp. leaders are"]),
        ("the etc.)’ ‘(the", ["the etc.)’ ‘(the"]),
        ("He said “Go.” She went.", ["He said “Go.”", "She went."]),
        ("Really?! Yes... no. And, so!, he", ["Really?!", "Yes... no.", "And, so!, he"]),
        ("One\nTwo\r\nThree Four", ["One", "Two", "Three", "Four"]),
        ("End. \n next", ["End.", "next"]),
        ("No stop", ["No stop"]),
        ("你好。再见！", ["你好。", "再见！"]),
        ("a.̈ B", ["a.̈", "B"]),
        ("  \n ", []),
        ("", []),
    ],
)
def test_sentences(text, want):
    assert breaks.sentences_of(text) == want


def test_words_equal_boundaries_of_another_implementation():
    """Without single quotes, which that one breaks off before vowels. Signs that belong to the one before change nothing, wherever they stand."""
    rng = random.Random(29)
    signs = ["a", "É", "ß", "я", "א", "ב", "1", "٣", "カ", "_", ":", "·", ",", ";", ".", '"', " ", " ", "\n", "-", "!", "漢"]
    boundary, inner = regex.compile(r"(?w)\b"), regex.compile(r"[\p{WB=ALetter}\p{WB=Hebrew_Letter}\p{WB=Numeric}\p{WB=Katakana}\p{Ideographic}]")
    for _ in range(5000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 12)))
        at = sorted({0, len(text), *(m.start() for m in boundary.finditer(text))})
        want = [text[a:z] for a, z in zip(at, at[1:]) if inner.search(text[a:z])]
        assert breaks.words_of(text) == want, repr(text)
        marked = "".join(c + rng.choice(("", "\u0301", "\u00ad", "\u200d\u0301")) for c in text)
        assert [regex.sub("[\u0301\u00ad\u200d]", "", w) for w in breaks.words_of(marked)] == want, repr(marked)


def test_columns(spark):
    rows = spark.createDataFrame([(1, "A b. C​ d! a B."), (2, None), (3, " \n"), (4, "x " * 50_000)], "id int, t string").repartition(2)
    got = {r["id"]: r for r in rows.select("id", breaks.words(F.col("t")).alias("w"), breaks.sentences(F.col("t")).alias("s"), breaks.counts(F.col("t")).alias("n")).collect()}
    assert got[1]["w"] == ["A", "b", "C", "d", "a", "B"] and got[1]["s"] == ["A b.", "C​ d!", "a B."]
    assert tuple(got[1]["n"]) == (6, 4, 3, 2)
    assert got[2]["w"] is None and got[3]["w"] == [] and tuple(got[2]["n"]) == tuple(got[3]["n"]) == (None,) * 4
    assert tuple(got[4]["n"]) == (50_000, 1, 1, 1)
