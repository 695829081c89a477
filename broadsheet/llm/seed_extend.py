"""Repeated passages of words: seeds on winnowed anchors, extended both ways.

Texts are joined on the winnowed anchors (`anchors`) of their 13-word windows: a seed of SEED words. Each occurrence
of a seed comes with the words around it, and matches are extended from the seed a word at a time, to the right and to
the left, by comparing the words' 64-bit hashes. All partners of a seed are extended at once: occurrences that agree in
the seed and in k words on one side are one class, and the classes of k + 1 words are those of k words and of the next
word. So no pairs are formed, however common a passage is. A window of 13 words is removed if an occurrence of a
smaller doc_id agrees with it as far to the left and to the right; neighbouring windows that are removed make one
maximal repeat.

Defined cases
-------------
* null and empty texts have no words and nothing is removed. Texts of under 13 words stay whole.
* doc_id null: the text is neither cut nor a source of repeats.
* repeated rows have one doc_id, so none is earlier than the other: both get the same result.
  Rows of one id and different texts are each handled whole, by their own text.
* a passage that one text repeats any number of times is handled whole: only what earlier documents have goes.
* an empty table gives an empty result. `cut` keeps extra columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors, arrays
from .tables import with_fields

LENGTH, SEED = 13, 5
#: The most words that a window has on one side of its seed.
SIDE = LENGTH - SEED
RULE = anchors.Rule(length=LENGTH, seed=SEED, words=True, inside=False)

_SEEDS = "route long, doc_id long, tag int, start long, lead int, words array<long>"
_SPANS = "doc_id long, tag int, start long, size int"
_SPANS_ARROW = pa.schema([("doc_id", pa.int64()), ("tag", pa.int32()), ("start", pa.int64()), ("size", pa.int32())])


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with open phrases -> the words of each phrase, `lead` of them before the seed; of crowded anchors, of each window.

    A window without words is one that was found to have an earlier equal one in this task.
    """
    earliest = anchors.Earliest(RULE.inside)
    for batch in batches:
        ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        off, spans = anchors.spans_of(batch.column(3))
        for chunk in arrays.chunks(batch.column(2)):
            seq = anchors.Sequence(chunk, True)
            mine = slice(off[chunk.rows.start], off[chunk.rows.stop])
            row = np.repeat(np.arange(chunk.n), np.diff(off[chunk.rows.start : chunk.rows.stop + 1]))
            start, size, route = spans["start"][mine], spans["size"][mine].astype(np.int64), spans["anchor"][mine]
            alone = spans["state"][mine] == anchors.CROWDED
            lead = _leads(seq, seq.off[row] + start, size, route)
            n = np.where(alone, size - LENGTH + 1, 1)
            of = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            row, alone, route = row[of], alone[of], route[of]
            start, lead, size = start[of] + step, lead[of] - step, np.where(alone, LENGTH, size[of])
            begin = seq.off[row] + start
            at = np.flatnonzero(alone)
            if len(at):
                route[at] = arrays.signed(seq.hashes(begin[at], begin[at] + LENGTH))
                doc = ids[chunk.rows.start + row[at]]
                later = earliest(route[at], doc, start[at])
                route[at[later]] = anchors.spread(doc[later], start[at[later]])
                size[at[later]] = 0
            for lo in range(0, len(row), 50_000):
                some = slice(lo, lo + 50_000)
                flat = np.arange(size[some].sum()) - np.repeat(np.cumsum(size[some]) - size[some], size[some])
                codes = arrays.signed(seq.codes[np.repeat(begin[some], size[some]) + flat])
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size[some])).astype(np.int32)), pa.array(codes))
                rows = chunk.rows.start + row[some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(route[some]), pa.array(ids[rows]), pa.array(tags[rows]), pa.array(start[some]), pa.array(lead[some].astype(np.int32)), lists],
                    names=["route", "doc_id", "tag", "start", "lead", "words"],
                )


def _leads(seq: anchors.Sequence, begin: np.ndarray, size: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Where in its phrase each seed begins: the first place that all the phrase's windows have and that has its hash."""
    lead = np.full(len(begin), -1)
    for k in range(SIDE + 1):
        at = np.flatnonzero((lead < 0) & (k >= size - LENGTH) & (k + SEED <= size))
        found = arrays.signed(seq.hashes(begin[at] + k, begin[at] + k + SEED)) == anchor[at]
        lead[at[found]] = k
    return lead


def _refined(group: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Numbers of the groups of rows that have the same group and the same code."""
    order = np.lexsort((code, group))
    new = np.zeros(len(order), np.int64)
    new[1:] = (np.diff(group[order]) != 0) | (code[order[1:]] != code[order[:-1]])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


class Extension:
    """Extends the seeds of a task, whose rows come sorted by route and doc_id.

    Of a route that goes on with the next batch, the earliest row of each content is carried there: as many as an
    anchor has different phrases, at most anchors.CROWD.
    """

    def __init__(self):
        self.carried: dict[str, np.ndarray] | None = None

    def __call__(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        route, doc, tag, start, lead = (batch.column(i).to_numpy() for i in range(5))
        off, flat = anchors.lists_of(batch.column(5))
        size = np.diff(off)
        decided = np.flatnonzero(size == 0)
        at = np.flatnonzero(size)
        # Seeds stand in columns SIDE ... SIDE + SEED; columns without a word hold 0.
        words = np.zeros((len(at), 2 * SIDE + SEED), np.int64)
        of = np.repeat(np.arange(len(at)), size[at])
        step = np.arange(len(of)) - np.repeat(np.cumsum(size[at]) - size[at], size[at])
        words[of, SIDE - lead[at][of] + step] = flat
        own = {"route": route[at], "doc": doc[at], "left": lead[at].astype(np.int64), "right": size[at] - lead[at] - SEED, "words": words}
        old = 0
        if self.carried is not None and len(at) and self.carried["route"][0] == own["route"][0]:
            old = len(self.carried["route"])
            own = {k: np.concatenate([self.carried[k], v]) for k, v in own.items()}
        r, p = self._extended(own)
        mine = r >= old
        r, p, n = anchors.runs(at[r[mine] - old], p[mine])
        r, p, n = np.append(r, decided), np.append(p, np.zeros_like(decided)), np.append(n, np.ones_like(decided))
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[r]), pa.array(tag[r]), pa.array(start[r] + p), pa.array((n + LENGTH - 1).astype(np.int32))], schema=_SPANS_ARROW
        )

    def _extended(self, own: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the places of their windows that an earlier document has, sorted."""
        route, doc, words = own["route"], own["doc"], own["words"]
        n = len(route)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        seed = _refined(np.zeros(n, np.int64), route)
        for k in range(SEED):
            seed = _refined(seed, words[:, SIDE + k])
        right, left = [seed], [seed]
        for k in range(SIDE):
            right.append(_refined(right[-1], words[:, SIDE + SEED + k]))
            left.append(_refined(left[-1], words[:, SIDE - 1 - k]))
        rows, places = [], []
        for k in range(SIDE + 1):  # k words to the left, SIDE - k to the right
            some = np.flatnonzero((own["left"] >= k) & (own["right"] >= SIDE - k))
            group = _refined(left[k][some], right[SIDE - k][some])
            first = np.full(len(some), len(some))
            np.minimum.at(first, group, np.arange(len(some)))  # rows go by doc_id: the first has the least
            later = some[doc[some] > doc[some[first[group]]]]
            rows.append(later)
            places.append(own["left"][later] - k)
        whole = _refined(_refined(_refined(left[-1], right[-1]), own["left"]), own["right"])
        last = np.flatnonzero(route == route[-1])
        _, first = np.unique(whole[last], return_index=True)
        keep = last[np.sort(first)]
        self.carried = {k: v[keep] for k, v in own.items()}
        rows, places = np.concatenate(rows), np.concatenate(places)
        order = np.lexsort((places, rows))
        return rows[order], places[order]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    extension = Extension()
    for batch in batches:
        if batch.num_rows:
            yield extension(batch)


def _compare(texts: DataFrame, found: DataFrame) -> DataFrame:
    rows = texts.select("doc_id", "tag", "text", "spans").mapInArrow(_occurrences, _SEEDS)
    return rows.repartition("route").sortWithinPartitions("route", "doc_id").mapInArrow(_compared, _SPANS)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, spans) -> (row, n_words, n_removed, kept), about arrays.CHUNK bytes of text at a time."""
    for batch in batches:
        row = batch.column(0)
        texts = pc.struct_field(row, "text").cast(pa.large_binary())
        off, spans = anchors.spans_of(batch.column(1))
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
        cuts = np.flatnonzero(np.diff(ends // arrays.CHUNK)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            n_words, n_removed, kept = [], [], []
            for i, value in enumerate(texts[lo:hi], lo):
                words = (value.as_py() or b"").split()  # on the six ASCII white-space characters
                n_words.append(len(words))
                if off[i] == off[i + 1]:
                    n_removed.append(0)
                else:
                    gone = anchors.removed(off, spans["start"], spans["size"], i, len(words))
                    n_removed.append(int(gone.sum()))
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [row[lo:hi], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["row", "n_words", "n_removed", "kept"],
            )


def cut(docs: DataFrame) -> DataFrame:
    """row (struct of all columns of docs), n_words, n_removed, kept (the words left, joined by one space)."""
    spans = anchors.repeats(docs, RULE, _compare).select(F.col("doc_id").alias("id_"), F.col("tag").alias("tag_"), F.col("spans").alias("spans_"))
    rows = docs.select(  # a text is shuffled and sent to Python once, in its row
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("doc_id"), F.hash(docs["text"]).alias("tag")
    )
    joined = rows.join(spans, (F.col("doc_id") == F.col("id_")) & (F.col("tag") == F.col("tag_")), "left").select("row", "spans_")
    return joined.mapInArrow(_without, with_fields([joined.schema["row"]], "n_words long, n_removed long, kept string"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with repeats cut out of `text`, and n_chars (if there) counted anew. Untouched texts keep their white space."""
    text = F.when(F.col("n_removed") == 0, F.col("row.text")).otherwise(F.col("kept"))
    new = {"text": text, "n_chars": F.coalesce(F.length(text), F.lit(0)).cast("long")}
    return cut(docs).select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])
