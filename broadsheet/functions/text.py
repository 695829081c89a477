"""Text clean-up and metrics of recognised text. All of it but folded case stays in the JVM."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Named character references that occur in recognised text, besides numeric ones.
_REFERENCES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&middot;": "·", "&copy;": "©", "&amp;": "&"}

#: Unicode words: letters, marks, digits and underscores, with inner apostrophes, points and commas. An approximation
#: of the word breaks of Unicode's annex 29, without dictionaries for scripts that write no spaces.
WORDS = r"(?U)[\p{L}\p{M}\p{N}_]+(?:['’.:,·](?=[\p{L}\p{N}])[\p{L}\p{M}\p{N}_]+)*"
#: A sentence ends with . ! or ? and perhaps quotes or brackets, before white space.
_SENTENCE_SPLIT = r"([.!?][\"'”’)\]]{0,2})\s+"


def strip_markup(text: Column) -> Column:
    """Markup to plain text: scripts, styles, comments and tags go, blocks break lines, references are decoded."""
    text = F.regexp_replace(text, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", "")
    text = F.regexp_replace(text, r"(?i)<(?:br|/p|/div|/h[1-6]|/li|/tr)\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"(?s)<[a-zA-Z/!][^>]*>", "")
    for name, char in _REFERENCES.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def flatten(text: Column) -> Column:
    """One line of plain text: markup gone, words split by a hyphen joined, line ends to spaces.

    Most texts have no markup, many no hyphen; a search for the signs that begin them spares the patterns.
    """
    join = lambda t: F.regexp_replace(t, r"-\s+(?=[a-z])", "")
    has = lambda sign: F.contains(text, F.lit(sign))
    plain = F.when(has("<") | has("&"), join(strip_markup(text))).when(has("-"), join(text)).otherwise(text)
    return F.replace(plain, F.lit("\n"), F.lit(" "))


def trimmed(lines: Column) -> Column:
    """Each text of an array without the spaces around it. F.trim by itself would be given the place in the array as the characters to trim."""
    return F.transform(lines, lambda line: F.trim(line))


def all_caps(line: Column) -> Column:
    """At least one letter, and no letter that isn't upper case."""
    return line.rlike(r"\p{L}") & ~line.rlike(r"[\p{L}&&[^\p{Lu}]]")


def glue_headings(text: Column) -> Column:
    """Neighbouring lines in capitals become one line, with the blank lines between them gone."""
    empty = F.array().cast("array<string>")

    def ended(s: Column) -> Column:
        heading = F.when(F.size(s["heads"]) > 1, F.array(F.array_join(trimmed(s["heads"]), " "))).otherwise(s["heads"])
        return F.concat(s["out"], heading, s["blanks"])

    def step(s: Column, line: Column) -> Column:
        state = lambda out, heads, blanks: F.struct(out.alias("out"), heads.alias("heads"), blanks.alias("blanks"))
        open_ = F.size(s["heads"]) > 0
        return (
            F.when(all_caps(line), state(s["out"], F.concat(s["heads"], F.array(line)), empty))
            .when(open_ & (F.trim(line) == ""), state(s["out"], s["heads"], F.concat(s["blanks"], F.array(line))))
            .otherwise(state(F.concat(ended(s), F.array(line)), empty, empty))
        )

    start = F.struct(empty.alias("out"), empty.alias("heads"), empty.alias("blanks"))
    return F.array_join(F.aggregate(F.split(text, "\n"), start, step, ended), "\n")


def mark_heading(text: Column) -> Column:
    """"# " before the first line with text, if that is in capitals and has no mark."""
    first = F.regexp_extract(text, r"^\s*(\S[^\n]*)", 1)
    lead = F.regexp_extract(text, r"^((?:[^\S\n]*\n)*)", 1)
    marked = F.concat(lead, F.lit("# "), F.substring(text, F.length(lead) + 1, F.length(text)))
    return F.when(all_caps(first) & ~first.startswith("#"), marked).otherwise(text)


def clean_recognised(text: Column) -> Column:
    """Hyphens at line ends, headings over several lines, heading marks, runs of one sign, repeated words. Null: ''."""
    out = F.regexp_replace(text, r"-\s*\n\s*(?=[a-zA-Z])", "")
    out = mark_heading(glue_headings(out))
    out = F.regexp_replace(out, r"([.\-_=*~#>|])\1{29,}", "")
    out = F.regexp_replace(out, r"(?iU)\b(\w+)\b(?:\s+\1\b){9,}", "$1")
    return F.coalesce(F.when(text != "", out), F.lit(""))


def cleaned(rows: DataFrame, text: str) -> DataFrame:
    """rows with `cleaned` and `changed`: whether it differs from what was there; '' and false for null and empty text."""
    found = rows.withColumn("cleaned", clean_recognised(F.col(text)))
    return found.withColumn("changed", F.col("cleaned") != F.coalesce(F.col(text), F.lit("")))


def words(flat: Column) -> Column:
    return F.regexp_extract_all(flat, F.lit(WORDS), F.lit(0))


def sentences(flat: Column) -> Column:
    parts = F.split(F.regexp_replace(flat, _SENTENCE_SPLIT, "$1\u0001"), "\u0001")
    return F.filter(trimmed(parts), lambda s: s != "")


def metrics(rows: DataFrame, text: str) -> DataFrame:
    """rows and, for the flat text of a column, six numbers; all null for blank text. The ratio has two digits, halves away from zero.

    Words and sentences are projected before they are counted, so that each is found once.
    """
    clean = F.replace(F.col(text), F.lit("\u200b"), F.lit(""))
    some = F.trim(F.regexp_replace(clean, r"\s+", " ")) != ""
    found = rows.withColumns({"_w": F.when(some, words(clean)), "_s": F.when(some, sentences(clean))})
    n, unique = F.size("_w"), F.size(F.array_distinct(F.transform("_w", F.lower)))
    has = F.col("_w").isNotNull()
    numbers = {
        "char_count": F.length(text), "word_count": n, "unique_word_count": unique, "type_token_ratio": F.when(n > 0, F.round(100 * unique / n, 2)),
        "sentence_count": F.size("_s"), "unique_sentence_count": F.size(F.array_distinct(F.transform("_s", F.lower))),
    }
    return found.withColumns({k: F.when(has, v) for k, v in numbers.items()}).drop("_w", "_s")


@F.pandas_udf(T.StringType())
def casefolded(text: pd.Series) -> pd.Series:
    """Folded case, as dictionaries are compared: unlike lower case, "Straße" and "STRASSE" are one."""
    return text.str.casefold()


def tokenizability(n_words: Column, n_tokens: Column) -> Column:
    """Words times 1.25 to tokens, in percent, 100 at most; null without tokens."""
    return F.least(F.round(F.try_divide(n_words * 125.0, n_tokens), 2), F.lit(100.0))


#: What tells a table, and Markdown.
TABLE, MARKDOWN = r"(?i)<table|\|[\s\-:]+\|", r"(?md)^#{1,6}\s|\*\*[^*]+\*\*|^[-*+]\s|```"


def has_table(text: Column) -> Column:
    """A table in HTML, or the rule below the head of one in Markdown; false for null."""
    return F.coalesce(text.rlike(TABLE), F.lit(False))


def has_markdown(text: Column) -> Column:
    """Headings, strong text, lists or code fences of Markdown; false for null."""
    return F.coalesce(text.rlike(MARKDOWN), F.lit(False))


def guarded_pieces(text: Column, most_chars: int = 3500, most_words: int = 400) -> Column:
    """The first most_chars characters in pieces of at most most_words words: what a model with short input is given."""
    parts = F.filter(F.split(F.substring(text, 1, most_chars), r"\s+"), lambda w: w != "")
    starts = F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts), F.lit(most_words))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(parts, i, most_words), " "))
