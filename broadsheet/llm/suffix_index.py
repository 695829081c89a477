"""Repeated passages of bytes: a logarithmic family of suffix arrays.

`SuffixFamily` takes batches of texts. A batch's suffixes (each to LENGTH bytes, which is all that matters) are
sorted to a suffix array, scanned against the levels that are there, and what is new becomes a level. Levels of
about equal size are merged, so that there are as many as the logarithm of the number of suffixes, and a suffix is
merged as often at most.

Over a cluster, the suffixes are dealt by their winnowed anchor (`anchors`), so that equal ones meet; every task has
a family of its own, which gets its texts in order of doc_id and place. What is earlier is then what is already in
the family. Phrases that were found to occur earlier whole never get there: the family compares the open ones, about
SUFFIXES suffixes a task. Phrases of an anchor that has too many of them are divided by longer seeds first.

Defined cases
-------------
* null and empty texts: no bytes, nothing removed. Texts of under 100 bytes stay whole.
* doc_id null: the text is neither cut nor a source of repeats.
* repeated rows: an equal place of an equal doc_id isn't earlier, so both get the same result.
  Rows of one id and different texts are each handled whole, by their own text.
* an empty table gives an empty result. Extra columns pass `cut` unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors, arrays
from .tables import keep, with_fields

LENGTH, SEED, FINER = 100, 32, 80
#: A task takes 8 * CROWD phrases of one anchor well: their windows are fewer than SUFFIXES.
RULE = anchors.Rule(length=LENGTH, seed=SEED, words=False, inside=True, crowds=8)
FINER_RULE = anchors.Rule(length=LENGTH, seed=FINER, words=False, inside=True, crowds=8)
#: Suffixes a task, on average.
SUFFIXES = 250_000

_SPANS = "doc_id long, tag int, start long, size int"
_SPANS_ARROW = pa.schema([("doc_id", pa.int64()), ("tag", pa.int32()), ("start", pa.int64()), ("size", pa.int32())])
_TEXTS = "route long, doc_id long, tag int, start long, part binary"


class SuffixFamily:
    """Suffix arrays in levels, each at least twice as long as the next."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.levels: list[np.ndarray] = []

    def add(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which suffixes data[start : start + length] are in the family or stand earlier in this batch. All are in it then."""
        if not len(starts):
            return np.zeros(0, bool)
        suffixes = np.lib.stride_tricks.sliding_window_view(data, self.length)[starts].view(f"S{self.length}").ravel()
        order = np.argsort(suffixes, kind="stable")
        array = suffixes[order]
        new = np.ones(len(array), bool)
        new[1:] = array[1:] != array[:-1]
        array = array[new]
        seen = np.zeros(len(array), bool)
        for level in self.levels:
            seen |= self._scan(level, array)
        found = np.zeros(len(starts), bool)
        found[order] = seen[np.cumsum(new) - 1] | ~new
        self._push(array[~seen])
        return found

    @staticmethod
    def _scan(level: np.ndarray, array: np.ndarray) -> np.ndarray:
        at = np.searchsorted(level, array)
        inside = at < len(level)
        hit = np.zeros(len(array), bool)
        hit[inside] = level[at[inside]] == array[inside]
        return hit

    def _push(self, array: np.ndarray) -> None:
        if len(array):
            self.levels.append(array)
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            small, large = self.levels.pop(), self.levels.pop()
            self.levels.append(np.insert(large, np.searchsorted(large, small), small))


def _finer(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Texts with crowded phrases -> the phrases inside these by the finer rule."""
    for batch in batches:
        ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        off, spans = anchors.spans_of(batch.column(3))
        for chunk in arrays.chunks(batch.column(2)):
            lo, hi = off[chunk.rows.start], off[chunk.rows.stop]
            row = np.repeat(np.arange(chunk.n), np.diff(off[chunk.rows.start : chunk.rows.stop + 1]))
            start = spans["start"][lo:hi]
            begin, data = chunk.off[row] + start, chunk.data.tobytes()
            parts = pa.array([data[b : b + s] for b, s in zip(begin.tolist(), spans["size"][lo:hi].tolist())], pa.binary())
            for part in arrays.chunks(parts):
                rows = anchors.phrases_of(anchors.Sequence(part, False), FINER_RULE)
                at = rows.pop("doc") + part.rows.start
                rows["start"] = rows["start"] + start[at]
                of = chunk.rows.start + row[at]
                yield rows | {"doc_id": ids[of].astype(np.int64), "tag": tags[of].astype(np.int32)}


def _divided(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Phrases of crowded anchors are divided by longer seeds and sifted again: equal windows have equal finer anchors, too.

    So windows go one by one only if too many texts differ around a run of FINER bytes that they share.
    """
    crowded = F.col("state") == anchors.CROWDED
    parts = anchors.open_texts(texts, found.filter(crowded)).select("doc_id", "tag", "text", "spans")
    again = parts.mapInArrow(lambda batches: anchors.combined(_finer(batches), FINER_RULE.inside), anchors.PHRASE)
    return found.filter(~crowded).unionByName(keep(anchors.sifted(again, FINER_RULE), "finer-phrases"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with open phrases -> the bytes of each phrase; of crowded anchors, of each window.

    A window without bytes is one that was found to have an earlier equal one in this task.
    """
    earliest = anchors.Earliest(RULE.inside)
    names = ["route", "doc_id", "tag", "start", "part"]
    for batch in batches:
        ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        off, spans = anchors.spans_of(batch.column(3))
        for chunk in arrays.chunks(batch.column(2)):
            lo, hi = off[chunk.rows.start], off[chunk.rows.stop]
            row = np.repeat(np.arange(chunk.n), np.diff(off[chunk.rows.start : chunk.rows.stop + 1]))
            begin, size, route = chunk.off[row] + spans["start"][lo:hi], spans["size"][lo:hi].astype(np.int64), spans["anchor"][lo:hi]
            alone = spans["state"][lo:hi] == anchors.CROWDED
            if alone.any():
                n = np.where(alone, size - LENGTH + 1, 1)
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                row, begin, alone, route = (np.repeat(x, n) for x in (row, begin, alone, route))
                begin, size = begin + step, np.where(alone, LENGTH, np.repeat(size, n))
                route = np.where(alone, arrays.signed(chunk.hashes(begin, begin + size)), route)
                at = np.flatnonzero(alone)
                doc, start = ids[chunk.rows.start + row[at]], begin[at] - chunk.off[row[at]]
                later = earliest(route[at], doc, start)
                route[at[later]] = anchors.spread(doc[later], start[later])
                size[at[later]] = 0
            data = chunk.data.tobytes()
            for some in np.array_split(np.arange(len(begin)), len(begin) // 50_000 + 1):
                rows = chunk.rows.start + row[some]
                parts = [data[b : b + s] for b, s in zip(begin[some].tolist(), size[some].tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(route[some]), pa.array(ids[rows]), pa.array(tags[rows]),
                    pa.array(begin[some] - chunk.off[row[some]]), pa.array(parts, pa.binary()),
                ], names=names)


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts in order of doc_id and place -> the spans that stand earlier."""
    family = SuffixFamily()
    last = None
    for batch in batches:
        decided = pc.equal(pc.binary_length(batch.column(4)), 0)
        out = batch.filter(decided)
        if out.num_rows:
            sizes = pa.array(np.full(out.num_rows, LENGTH, np.int32))
            yield pa.RecordBatch.from_arrays([*(out.column(i) for i in (1, 2, 3)), sizes], schema=_SPANS_ARROW)
        batch = batch.filter(pc.invert(decided))
        doc, tag, start = (batch.column(i).to_numpy() for i in (1, 2, 3))
        for chunk in arrays.chunks(batch.column(4), size=1 << 17):
            rows = np.arange(chunk.rows.start, chunk.rows.stop)
            # The same place of a row that stands twice is looked up once; both get its result.
            fresh = np.ones(len(rows), bool)
            fresh[1:] = (np.diff(doc[rows]) != 0) | (np.diff(start[rows]) != 0)
            if last is not None and last[0] == (doc[rows[0]], start[rows[0]]):
                fresh[0] = False
            n = np.diff(chunk.off) - LENGTH + 1
            of = np.repeat(np.arange(chunk.n), n)
            place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            asked = fresh[of]
            found = np.zeros(len(of), bool)
            found[asked] = family.add(chunk.data, (chunk.off[of] + place)[asked])
            source = np.maximum.accumulate(np.where(fresh, np.arange(chunk.n), 0))
            if not fresh.all():
                base = np.cumsum(n) - n
                copy = ~asked & (place < n[source[of]])
                found[copy] = found[(base[source[of]] + place)[copy]]
                if not fresh[0]:
                    head = (source[of] == 0) & (place < len(last[1]))
                    found[head] = last[1][place[head]]
            tail = chunk.n - 1
            last = ((doc[rows[-1]], start[rows[-1]]), found[of == tail])
            r, p, size = anchors.runs(of[found], place[found])
            r = rows[r]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[r]), pa.array(tag[r]), pa.array(start[r] + p), pa.array((size + LENGTH - 1).astype(np.int32))],
                schema=_SPANS_ARROW,
            )


def _compare(texts: DataFrame, found: DataFrame) -> DataFrame:
    n = found.agg(F.sum(F.col("size") - (LENGTH - 1))).first()[0] or 0
    parts = texts.select("doc_id", "tag", "text", "spans").mapInArrow(_parts, _TEXTS)
    dealt = parts.repartition(max(1, -(-n // SUFFIXES)), "route").sortWithinPartitions("doc_id", "start", "tag")
    return dealt.mapInArrow(_matched, _SPANS)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text, spans) -> (row, n_bytes, n_removed, n_spans, kept)."""
    for batch in batches:
        text = batch.column(1).cast(pa.binary())
        off, spans = anchors.spans_of(batch.column(2))
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for i, value in enumerate(text):
            data = value.as_py() or b""
            n_bytes.append(len(data))
            if off[i] == off[i + 1]:
                n_removed.append(0)
                n_spans.append(0)
            else:
                gone = anchors.removed(off, spans["start"], spans["size"], i, len(data))
                n_removed.append(int(gone.sum()))
                n_spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                data = np.frombuffer(data, np.uint8)[~gone].tobytes()
            kept.append(data)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary())],
            names=["row", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def cut(docs: DataFrame) -> DataFrame:
    """row (struct of all columns of docs), n_bytes, n_removed, n_spans, kept (binary: a cut may fall inside a character)."""
    spans = anchors.repeats(docs, RULE, _compare, _divided).select(F.col("doc_id").alias("id_"), F.col("tag").alias("tag_"), F.col("spans").alias("spans_"))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].alias("text"),
        docs["doc_id"].cast("long").alias("doc_id"), F.hash(docs["text"]).alias("tag"),
    )
    joined = rows.join(spans, (F.col("doc_id") == F.col("id_")) & (F.col("tag") == F.col("tag_")), "left").select("row", "text", "spans_")
    return joined.mapInArrow(_without, with_fields([joined.schema["row"]], "n_bytes long, n_removed long, n_spans long, kept binary"))
