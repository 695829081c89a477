"""Terms of a dictionary in texts: whole words in any case, the leftmost and then the longest, without overlaps.

The terms are an Aho-Corasick automaton that goes over a text once, however many they are. A dictionary of up to MOST_CHARS
characters is sent to all tasks. A larger one is split by the first words of its terms: texts are dealt into pieces of
about PIECE bytes, and a piece meets only the terms whose first word stands in it, so all that can begin anywhere in a text are
in one automaton, and the result is the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import casefolded

MOST_CHARS, PIECE = 4_000_000, 8 << 20
#: Rows and bytes of text that are Python objects at a time; one longer text is alone.
SLICE_ROWS, SLICE_BYTES = 512, 1 << 20

_MAP = pa.map_(pa.string(), pa.map_(pa.string(), pa.int32()))
_WORD, _EDGE = re.compile(r"\w+"), re.compile(r"\b")


def folded(text: str) -> str:
    """Folded case with every character at its place: one that would become several stays, in lower case."""
    whole = text.casefold()
    if len(whole) == len(text):
        return whole
    one = lambda c: next((x for x in (c.casefold(), c.lower()) if len(x) == 1), c)
    return "".join(map(one, text))


def marked(text: str) -> str:
    """A mark at each end of a word, so that only whole words are found."""
    return _EDGE.sub("\0", text.replace("\0", "\1"))


def first_word(term: str) -> str:
    found = _WORD.search(term)
    return found[0] if found else ""


def sliced(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices, so that its texts and what is found in them aren't Python objects all at once."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        most = (ends[at - 1] if at else 0) + SLICE_BYTES
        end = min(max(at + 1, int(np.searchsorted(ends, most, side="right"))), at + SLICE_ROWS, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


class Automaton:
    def __init__(self, terms: list[tuple[str, str]]):
        """terms: (term in folded case, category)."""
        self.terms = [t for t in terms if t[0]]
        self.sizes = []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, (term, _) in enumerate(self.terms):
            word = "\0" + marked(term).strip("\0") + "\0"
            self.sizes.append(len(word))
            self.automaton.add_word(word, i)
        self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[str, str]]:
        """(category, term) of every match, from the left."""
        if not self.terms:
            return
        found = [(last + 1 - self.sizes[i], -last, i) for last, i in self.automaton.iter(marked(folded(text)))]
        at = 0
        for start, last, i in sorted(found):
            if start >= at:
                at = -last  # the mark between two terms belongs to both
                yield self.terms[i][::-1]

    def rows(self, keys: pa.Array, texts: list[str | None], names: list[str]) -> pa.RecordBatch:
        maps, matches, distinct = [], [], []
        for text in texts:
            if text is None or not text.strip():
                maps.append(None), matches.append(None), distinct.append(None)
                continue
            counts: dict[str, dict[str, int]] = {}
            for category, term in self.matches(text):
                own = counts.setdefault(category, {})
                own[term] = own.get(term, 0) + 1
            maps.append([(c, list(t.items())) for c, t in counts.items()])
            matches.append(sum(n for t in counts.values() for n in t.values()))
            distinct.append(sum(map(len, counts.values())))
        return pa.RecordBatch.from_arrays([keys, pa.array(maps, _MAP), pa.array(matches, pa.int32()), pa.array(distinct, pa.int32())], names=names)


def matched(rows: DataFrame, key: str, text: str, terms: DataFrame, most_chars: int | None = None) -> DataFrame:
    """key, matches (category -> term -> n), match_count, term_count; nulls for blank text, an empty map for no match.

    terms(term, category); of a term that stands there twice, in any case, the last by spelling and category counts. Rows of
    one key are matched each by itself.
    """
    kind = rows.schema[key].dataType.simpleString()
    names = [key, "matches", "match_count", "term_count"]
    schema = f"{key} {kind}, matches map<string,map<string,int>>, match_count int, term_count int"
    rows = rows.select(key, text)
    terms = terms.filter("term != ''").select(casefolded(F.col("term")).alias("folded"), "category", F.struct("term", "category").alias("order"))
    terms = terms.groupBy("folded").agg(F.max_by("category", "order").alias("category"))
    chars = terms.agg(F.sum(F.length("folded"))).first()[0] or 0

    if chars <= (MOST_CHARS if most_chars is None else most_chars):
        held = rows.sparkSession.sparkContext.broadcast([tuple(r) for r in terms.collect()])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = Automaton(held.value)
            for batch in batches:
                for part in sliced(batch, 1):
                    yield automaton.rows(part.column(0), part.column(1).to_pylist(), names)

        return rows.mapInArrow(run, schema)

    size = rows.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    piece = F.pmod(F.xxhash64(key, text), F.lit(-(-size // PIECE) or 1)).alias("piece_")
    dealt = rows.select(piece, F.col(key).alias("key_"), F.col(text).alias("text_"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[int, set[str]] = {}
            for part in sliced(batch, batch.schema.get_field_index("text_")):
                for p, value in zip(part["piece_"].to_pylist(), part["text_"].to_pylist(), strict=True):
                    own.setdefault(p, {""}).update(_WORD.findall(folded(value or "")))
            pieces = [p for p, w in own.items() for _ in w]
            yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.int64()), pa.array([x for w in own.values() for x in w], pa.string())], names=["piece_", "first_"])

    def with_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([first_word(t) for t in batch["folded"].to_pylist()], pa.string())], names=["folded", "category", "first_"])

    def run_piece(table: pa.Table, own: pa.Table) -> pa.Table:
        automaton = Automaton(list(zip(own["folded"].to_pylist(), own["category"].to_pylist(), strict=True)))
        return pa.Table.from_batches([automaton.rows(table["key_"].combine_chunks(), table["text_"].to_pylist(), names)]) if len(table) else pa.table({n: pa.array([], t) for n, t in zip(names, (table.schema.field("key_").type, _MAP, pa.int32(), pa.int32()), strict=True)})

    first = terms.mapInArrow(with_first, "folded string, category string, first_ string")
    near = dealt.mapInArrow(words, "piece_ long, first_ string").distinct().join(first, "first_").select("piece_", "folded", "category")
    return dealt.groupBy("piece_").cogroup(near.groupBy("piece_")).applyInArrow(run_piece, schema)
