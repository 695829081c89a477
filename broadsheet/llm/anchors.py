"""What the two repeat finders share: winnowed anchors, the phrases around them, and the spans that come back.

A text is a sequence of units (bytes or words). The anchor of a window of `length` units is the run of `seed` units
in it with the least hash, the leftmost if several. Equal windows have equal anchors at equal places, so windows
need only be compared with windows of the same anchor. The windows of a text that follow each other and share an
anchor make one phrase, [first window's start, last window's end): phrases cover all windows, about one phrase for
(length - seed) / 2 units, and they alone are shuffled, by the anchor's hash:

* a phrase that occurs whole at an earlier place is removed whole (`DECIDED`); tasks already do this among the texts
  they read, so that of a passage in many texts each task sends one phrase;
* the earliest of equal phrases meets, if its anchor has other phrases too, their earliest ones (`OPEN`): some of its
  windows may occur earlier inside a different phrase, as at the end of a copied passage;
* all other phrases are done with.

The open phrases are few, and they are what an operator has to compare window by window. If an anchor has over
CROWD different phrases, or a multiple of that by the rule, an operator may divide them by a rule with a longer seed; else their
windows are dealt by their own hash instead (`CROWDED`), of equal ones that a task meets only those that are earlier than
all before (`Earliest`).

Phrases are the same if the hashes of their anchor and of the whole phrase are, 128 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays
from .tables import keep

U = np.uint64
DECIDED, OPEN, CROWDED = 0, 1, 2
CROWD = 512
#: Phrases that a task compares among its own texts at a time.
OWN = 1 << 18
#: Bits of a place in a chunk, where seeds are ranked; those above are the seed's, so that ranks are the same in all chunks.
_PLACE = U(36)


@dataclass(frozen=True)
class Rule:
    """inside: an equal window earlier in the same document counts too; otherwise only those of smaller doc_ids do."""

    length: int
    seed: int
    words: bool
    inside: bool
    #: Times CROWD, how many different phrases of an anchor are compared with each other.
    crowds: int = 1


class Sequence:
    """The units of a chunk: `codes` (hashes), `off` (where documents begin and end)."""

    def __init__(self, chunk: arrays.Chunk, words: bool):
        if words:
            self.start, self.end, doc = chunk.words()
            self.codes = chunk.hashes(self.start, self.end)
            self.off = np.searchsorted(doc, np.arange(chunk.n + 1))
        else:
            self.codes, self.off = arrays.byte_codes(chunk.data), chunk.off
        self.n = len(self.codes)
        self.sums, self.inverses = arrays.sums_of(self.codes)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return arrays.mixed((self.sums[end] - self.sums[start]) * self.inverses[start])


def phrases_of(seq: Sequence, rule: Rule) -> dict[str, np.ndarray]:
    """anchor, phrase (hashes), doc, start (in its document) and size of all phrases of a chunk."""
    n, width = seq.n, rule.length - rule.seed + 1
    none = {k: np.zeros(0, np.int64) for k in ("doc", "start", "size")} | {k: np.zeros(0, U) for k in ("anchor", "phrase")}
    if n < rule.length:
        return none
    at = np.arange(n - rule.seed + 1)
    seeds = seq.hashes(at, at + rule.seed)
    least = ((seeds >> _PLACE) << _PLACE) | at.astype(U)
    # Least of `width` neighbours by doubling.
    done = 1
    while done < width:
        step = min(done, width - done)
        least = np.minimum(least[: len(least) - step], least[step:])
        done += step
    place = (least & ((U(1) << _PLACE) - U(1))).astype(np.int64)
    last = seq.off[1:] - rule.length  # the last window of each document
    some = last >= seq.off[:-1]
    ok = arrays.covered(seq.off[:-1][some], last[some] + 1, len(place))
    window = np.flatnonzero(ok)
    if not len(window):
        return none
    new = np.ones(len(window), bool)
    new[1:] = (np.diff(window) > 1) | (np.diff(place[window]) != 0)
    doc = np.searchsorted(seq.off, window, side="right") - 1
    new[1:] |= np.diff(doc) != 0
    first = np.flatnonzero(new)
    final = np.append(first[1:], len(window)) - 1
    start, end = window[first], window[final] + rule.length
    anchor = seeds[place[start]]
    return {
        "anchor": anchor, "phrase": seq.hashes(start, end), "doc": doc[first],
        "start": start - seq.off[doc[first]], "size": end - start,
    }


PHRASE = "anchor long, phrase long, doc_id long, start long, size int, tag int"
_FOUND = "doc_id long, tag int, start long, size int, anchor long, state int"


def _order(*keys: np.ndarray) -> np.ndarray:
    return np.lexsort(keys[::-1])


def _combined(rows: dict[str, np.ndarray], inside: bool) -> dict[str, np.ndarray]:
    """Among the phrases of one task: those with an earlier equal one get a size below 0, and an anchor of no one else."""
    key = arrays.mixed(rows["anchor"] + arrays.mixed(rows["phrase"]))
    order = _order(key, rows["doc_id"], rows["start"])
    later = _later(key[order], rows["doc_id"][order], rows["start"][order], inside)
    at = order[later]
    rows["size"][at] *= -1
    rows["anchor"][at] = arrays.mixed(rows["doc_id"][at].astype(U) * U(0x9E3779B97F4A7C15) + rows["start"][at].astype(U))
    return rows


def _later(key: np.ndarray, doc: np.ndarray, start: np.ndarray, inside: bool) -> np.ndarray:
    """Sorted rows: which have an earlier row of the same key."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    later = doc > doc[first]
    return later | (start > start[first]) if inside else later


def _batch(rows: dict[str, np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(arrays.signed(x) if (x := rows[f.name]).dtype == U else x, f.type) for f in schema], schema=schema
    )


_PHRASE_ARROW = pa.schema(
    [("anchor", pa.int64()), ("phrase", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("size", pa.int32()), ("tag", pa.int32())]
)
_FOUND_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("tag", pa.int32()), ("start", pa.int64()), ("size", pa.int32()), ("anchor", pa.int64()), ("state", pa.int32())]
)


def combined(found: Iterator[dict[str, np.ndarray]], inside: bool) -> Iterator[pa.RecordBatch]:
    """Phrases of a task as rows of PHRASE, compared among themselves about OWN at a time."""
    held: list[dict[str, np.ndarray]] = []
    count = 0

    def flush() -> Iterator[pa.RecordBatch]:
        rows = _combined({k: np.concatenate([h[k] for h in held]) for k in held[0]}, inside)
        for lo in range(0, len(rows["size"]), 100_000):
            yield _batch({k: v[lo : lo + 100_000] for k, v in rows.items()}, _PHRASE_ARROW)

    for rows in found:
        held.append(rows)
        count += len(rows["size"])
        if count > OWN:
            yield from flush()
            held, count = [], 0
    if held:
        yield from flush()


def phrases(docs: DataFrame, rule: Rule) -> DataFrame:
    """docs(doc_id, tag, text) -> a row per phrase."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        for batch in batches:
            ids, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for chunk in arrays.chunks(batch.column(2)):
                rows = phrases_of(Sequence(chunk, rule.words), rule)
                doc = rows.pop("doc")
                yield rows | {"doc_id": ids[chunk.rows][doc].astype(np.int64), "tag": tags[chunk.rows][doc].astype(np.int32)}

    return docs.select("doc_id", "tag", "text").mapInArrow(lambda batches: combined(found(batches), rule.inside), PHRASE)


class _Sifter:
    """Goes through the phrases of a task, sorted by anchor, phrase, doc_id and start, and gives them their state."""

    def __init__(self, inside: bool, most: int | None = None):
        self.inside, self.most = inside, CROWD if most is None else most
        self.kept: dict[str, np.ndarray] | None = None  # rows of the anchor that isn't over yet
        self.crowd: tuple[int, int, int, int] | None = None  # anchor, phrase, doc_id, start: inside a crowd, its last first row

    def __call__(self, rows: dict[str, np.ndarray], over: bool = False) -> dict[str, np.ndarray] | None:
        if self.kept is not None:
            rows = {k: np.concatenate([self.kept[k], v]) for k, v in rows.items()}
            self.kept = None
        n = len(rows["anchor"])
        if n and not over:
            begin = int(np.searchsorted(rows["anchor"], rows["anchor"][-1]))
            if n - begin <= self.most:
                self.kept = {k: v[begin:] for k, v in rows.items()}
                rows = {k: v[:begin] for k, v in rows.items()}
                n = begin
            else:  # a long run isn't waited for
                return self._sift(rows, True)
        return self._sift(rows, False) if n else None

    def _sift(self, rows: dict[str, np.ndarray], goes_on: bool) -> dict[str, np.ndarray]:
        anchor, phrase, doc, start = (rows[k] for k in ("anchor", "phrase", "doc_id", "start"))
        n = len(anchor)
        new_anchor, new = np.ones(n, bool), np.ones(n, bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        new[1:] = new_anchor[1:] | (phrase[1:] != phrase[:-1])
        index = np.arange(n)
        first = np.maximum.accumulate(np.where(new, index, 0))
        first_doc, first_start = doc[first], start[first]
        run = np.cumsum(new_anchor) - 1
        crowded = np.bincount(run, weights=new) > self.most
        several = np.bincount(run, weights=new) > 1
        if goes_on:
            crowded[-1] = True
        if self.crowd and self.crowd[0] == anchor[0]:
            crowded[0] = True
            if self.crowd[1] == phrase[0]:  # the first of this phrase has gone by
                same = first == 0
                first_doc = np.where(same, self.crowd[2], first_doc)
                first_start = np.where(same, self.crowd[3], first_start)
        self.crowd = (anchor[-1], phrase[-1], first_doc[-1], first_start[-1]) if goes_on else None
        later = doc > first_doc
        if self.inside:
            later |= (doc == first_doc) & (start > first_start)
        state = np.where(later | (rows["size"] < 0), DECIDED, np.where(crowded[run], CROWDED, OPEN))
        out = (state == DECIDED) | several[run] | crowded[run]
        again = np.zeros(n, bool)  # a row that stands in the table twice
        again[1:] = ~new[1:] & (doc[1:] == doc[:-1]) & (start[1:] == start[:-1]) & (rows["tag"][1:] == rows["tag"][:-1])
        out &= ~again
        return {k: rows[k][out] for k in ("doc_id", "tag", "start", "anchor")} | {"size": np.abs(rows["size"][out]), "state": state[out]}


def sifted(found: DataFrame, rule: Rule) -> DataFrame:
    """Phrases -> (doc_id, tag, start, size, anchor, state): those removed whole, and those to compare."""

    most = rule.crowds * CROWD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sift = _Sifter(rule.inside, most)
        names = _PHRASE_ARROW.names
        for batch in batches:
            rows = sift({k: batch.column(i).to_numpy(zero_copy_only=False) for i, k in enumerate(names)})
            if rows is not None and len(rows["state"]):
                yield _batch(rows, _FOUND_ARROW)
        if sift.kept is not None:
            yield _batch(sift({k: v[:0] for k, v in sift.kept.items()}, over=True), _FOUND_ARROW)

    dealt = found.repartition("anchor").sortWithinPartitions("anchor", "phrase", "doc_id", "start")
    return dealt.mapInArrow(run, _FOUND)


def tagged(docs: DataFrame) -> DataFrame:
    """doc_id and tag name a text: rows that share a doc_id but not their text stay apart."""
    return docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.hash("text").alias("tag"), F.col("text")
    )


def open_texts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Texts (doc_id, tag, text) that have open phrases, with these as `spans`. One row's phrases at most in a list."""
    spans = (
        found.filter(F.col("state") != DECIDED)
        .groupBy("doc_id", "tag")
        .agg(F.collect_list(F.struct("start", "size", "anchor", "state")).alias("spans"))
    )
    return docs.join(spans, ["doc_id", "tag"])


def spans_of(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """A list<struct> column: offsets, and the structs' fields flat. Null lists are empty."""
    off = np.concatenate([[0], np.cumsum(np.nan_to_num(np.asarray(pc.list_value_length(column).to_numpy(zero_copy_only=False), float)).astype(np.int64))])
    flat = column.flatten()
    return off, {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}


def repeats(
    docs: DataFrame, rule: Rule, compare: Callable[[DataFrame, DataFrame], DataFrame], divided: Callable[[DataFrame, DataFrame], DataFrame] | None = None
) -> DataFrame:
    """(doc_id, tag, spans): the unit spans [start, start + size) to remove, for texts that have any.

    compare(texts, found) gives the spans that window-by-window comparison of the open phrases adds. divided(texts, found)
    gives found with finer phrases in place of the crowded ones.
    """
    texts = tagged(docs)
    found = keep(sifted(phrases(texts, rule), rule), "phrases")
    if divided is not None:
        found = divided(texts, found)
    decided = found.filter(F.col("state") == DECIDED).select("doc_id", "tag", "start", "size")
    # Kept, so that the texts and phrases that were shuffled for it are gone before texts are shuffled again.
    more = keep(compare(open_texts(texts, found), found.filter(F.col("state") != DECIDED)), "compared-spans")
    return decided.unionByName(more).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "size")).alias("spans"))


class Earliest:
    """Which windows have an earlier equal one among those that a task has met. It forgets all if they are over OWN."""

    def __init__(self, inside: bool):
        self.inside, self.known = inside, (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def __call__(self, key: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
        old = len(self.known[0])
        key, doc, start = (np.concatenate([a, b]) for a, b in zip(self.known, (key, doc, start)))
        order = _order(key, doc, start)
        out = np.zeros(len(key), bool)
        out[order] = _later(key[order], doc[order], start[order], self.inside)
        new = np.ones(len(key), bool)
        new[1:] = np.diff(key[order]) != 0
        first = order[new] if new.sum() <= OWN else order[:0]
        self.known = key[first], doc[first], start[first]
        return out[old:]


def spread(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Routes that deal out rows which need meet no others."""
    return arrays.signed(arrays.mixed(doc.astype(U) * U(0x9E3779B97F4A7C15) + start.astype(U)))


def runs(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (row, place) pairs -> row, first place and length of every stretch of neighbours."""
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (np.diff(place) != 1)
    first = np.flatnonzero(new)
    return row[first], place[first], np.diff(np.append(first, len(row)))


def removed(off: np.ndarray, start: np.ndarray, size: np.ndarray, at: int, n: int) -> np.ndarray:
    """Which of the n units of text `at` its spans cover."""
    mine = slice(off[at], off[at + 1])
    return arrays.covered(start[mine], start[mine] + size[mine], n)


def lists_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A list column without nulls: offsets from 0, and the values."""
    off = column.offsets.to_numpy()
    return (off - off[0]).astype(np.int64), column.flatten().to_numpy(zero_copy_only=False)
