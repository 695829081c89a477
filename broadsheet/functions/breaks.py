"""Word and sentence breaks by Unicode's annex 29, as tables of classes and patterns over them.

Each character becomes one letter for its class, and the annex's rules are patterns over those letters, so a text is gone
through by compiled tables whatever it holds. Classes come from the Unicode data of the `regex` package, once for each
distinct character of a task.

What the annex leaves to dictionaries is decided like this: an ideograph and a sign of Hiragana are words by themselves, a run of
Katakana is one word, and so is a run of a script that writes no spaces (Thai, Lao, Khmer, Burmese), up to the next
space or sign.
"""

from __future__ import annotations

import re

import pandas as pd
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T


class _Classes(dict):
    """Code point -> letter of its class: the first property that holds, or else `other`."""

    def __init__(self, properties: dict[str, str], other: str):
        super().__init__()
        self.properties = [(letter, regex.compile(pattern)) for letter, pattern in properties.items()]
        self.other = other

    def __missing__(self, point: int) -> str:
        char = chr(point)
        self[point] = next((letter for letter, p in self.properties if p.match(char)), self.other)
        return self[point]


# The annex's properties, by the letter that stands for them. x: signs that belong to the one before them.
WORD_CLASSES = {
    "x": r"[\p{WB=Extend}\p{WB=Format}\p{WB=ZWJ}]", "A": r"\p{WB=ALetter}", "H": r"\p{WB=Hebrew_Letter}", "N": r"\p{WB=Numeric}",
    "K": r"\p{WB=Katakana}", "_": r"\p{WB=ExtendNumLet}", "l": r"\p{WB=MidLetter}", "n": r"\p{WB=MidNum}", "b": r"\p{WB=MidNumLet}",
    "q": r"\p{WB=Single_Quote}", "d": r"\p{WB=Double_Quote}", "I": r"\p{Ideographic}", "J": r"\p{Script=Hiragana}", "S": r"\p{LB=Complex_Context}",
}
SENTENCE_CLASSES = {
    "x": r"[\p{SB=Extend}\p{SB=Format}]", "r": r"\p{SB=CR}", "f": r"\p{SB=LF}", "p": r"\p{SB=Sep}", "s": r"\p{SB=Sp}", "L": r"\p{SB=Lower}",
    "U": r"\p{SB=Upper}", "O": r"\p{SB=OLetter}", "N": r"\p{SB=Numeric}", "a": r"\p{SB=ATerm}", "c": r"\p{SB=SContinue}", "t": r"\p{SB=STerm}", "e": r"\p{SB=Close}",
}

_words, _sentences = _Classes(WORD_CLASSES, "."), _Classes(SENTENCE_CLASSES, ".")

#: Letters with at most one sign for letters between two of them, numbers likewise, in any order; Hebrew keeps its quotes.
_LETTERS = r"[AH](?:[lbq]?[AH]|(?<=H)q|(?<=H)d(?=H))*"
_UNIT = rf"(?:(?:{_LETTERS}|N(?:[nbq]?N)*)+|K+)"
_WORD = re.compile(rf"_*{_UNIT}(?:_+{_UNIT})*_*|I|J|S+")

#: A line's end, or a stop with what closes the sentence and the spaces after it.
_STOP = re.compile(r"(?P<line>rf|[rfp])|(?:(?P<point>a)|t)x*(?P<closed>(?:ex*)*(?:sx*)*)(?P<end>rf|[rfp])?")
#: After a point: what goes on with a number, in capitals within an abbreviation, or in lower case; after any stop, a comma or another stop.
_NUMBER, _CAPITAL, _LOWER, _GOES_ON, _AFTER_LETTER = re.compile("N"), re.compile("U"), re.compile("[^OULrfpat]*L"), re.compile("[cat]"), re.compile("[UL]x*$")


def words_of(text: str) -> list[str]:
    classes = text.translate(_words)
    if "x" not in classes:
        return [text[m.start() : m.end()] for m in _WORD.finditer(classes)]
    # What belongs to the sign before it takes no part in the rules.
    at = [i for i, c in enumerate(classes) if c != "x"]
    ends = [*at, len(text)]
    return [text[at[m.start()] : ends[m.end()]] for m in _WORD.finditer("".join(classes[i] for i in at))]


def sentences_of(text: str) -> list[str]:
    classes = text.translate(_sentences)
    out, start = [], 0
    for m in _STOP.finditer(classes):
        at = m.end()
        if not m["line"] and not m["end"]:
            point = m["point"] is not None
            if _GOES_ON.match(classes, at) or (point and _LOWER.match(classes, at)):
                continue
            if point and not m["closed"]:
                before = classes[max(start, m.start() - 50) : m.start()]
                if _NUMBER.match(classes, at) or (_CAPITAL.match(classes, at) and _AFTER_LETTER.search(before)):
                    continue
        out.append(text[start:at])
        start = at
    out.append(text[start:])
    return [s for s in map(str.strip, out) if s]


_STRINGS = T.ArrayType(T.StringType())


@F.pandas_udf(_STRINGS)
def words(text: pd.Series) -> pd.Series:
    """The words of a text, in order; null for null."""
    return text.map(words_of, na_action="ignore")


@F.pandas_udf(_STRINGS)
def sentences(text: pd.Series) -> pd.Series:
    """The sentences of a text without white space around them, in order; null for null."""
    return text.map(sentences_of, na_action="ignore")


_COUNTS = T.StructType([T.StructField(n, T.IntegerType()) for n in ("word_count", "unique_word_count", "sentence_count", "unique_sentence_count")])


@F.pandas_udf(_COUNTS)
def counts(text: pd.Series) -> pd.DataFrame:
    """Words and sentences, and how many differ in lower case; nulls for null and blank text. Zero-width spaces don't count."""

    def of(value: str | None) -> tuple:
        value = (value or "").replace("​", "")
        if not value.strip():
            return None, None, None, None
        w, s = words_of(value), sentences_of(value)
        return len(w), len({x.lower() for x in w}), len(s), len({x.lower() for x in s})

    return pd.DataFrame([of(v) for v in text], columns=_COUNTS.names, dtype="Int32")
