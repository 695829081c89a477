"""Masked pseudo-likelihood: how well each word of a text is predicted from the words on both sides of it.

The network's vocabulary are the FREQUENT most frequent words (A-Z in lower case) of the corpus and RARE buckets for all
others. A word of a bucket has the bucket's probability times its share n / (N + UNSEEN) of the bucket's N occurrences in
the corpus; all words that the corpus doesn't have share UNSEEN / (N + UNSEEN). A network sees the CONTEXT words before
and after a masked one: position-wise embeddings, a hidden tanh layer, and a softmax in two steps, over classes of words
(by frequency) and over the words of the class. It begins with the corpus's word frequencies as biases, so it starts as
the unigram model.

Texts are turned into ids once, in a table that is dealt by content into parts of about PART words. Training covers all
words of all documents: hashes deal the words of a part into ROUNDS shares, each part trains on one share a round,
beginning with the shared parameters, and the parts' parameters are averaged, as whole numbers, so that neither the
order of rows nor that of tasks changes a model. What goes to the driver is of fixed size: vocabulary, sizes of buckets
and parameters. Scoring sums the conditional log-probabilities of all words; counts of the MOST_KNOWN most frequent rare
words are sent to the tasks, those of others come by a join of a text's distinct ones with all counts.

Defined cases
-------------
* null, empty and blank texts: 0 tokens, log-probability 0, mean null. A text of one word is predicted from its edges.
* repeated rows train and are scored each; null ids are kept. Texts of any length are scored whole.
* an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrays
from .tables import keep

U = np.uint64
CLASSES, CLASS_SIZE = 64, 64
RARE = 64
FREQUENT = CLASSES * CLASS_SIZE - RARE
CONTEXT, DIMENSIONS, HIDDEN = 2, 16, 32
ROUNDS, RATE = 3, 0.4
#: Words of a step: the least, and the most, when a part has learned 8 times as many.
FEWEST, BATCH = 256, 4096
#: Words of a part, about.
PART = 2_000_000
#: Logits are cut here, so that their exponentials stay finite.
MOST_LOGIT = 60.0
#: Parameters are averaged as whole numbers of 1 / SCALE.
SCALE = float(1 << 24)
#: Occurrences that a bucket keeps for the words that the corpus doesn't have.
UNSEEN = 0.5
#: Logarithms of counts are summed as whole numbers of 1 / LOG_SCALE, so that their order doesn't matter.
LOG_SCALE = float(1 << 24)
#: Words whose counts are sent to all tasks; those of rarer ones are joined.
MOST_KNOWN = 1 << 18
#: Places of words that are neighbours.
OFFSETS = [*range(-CONTEXT, 0), *range(1, CONTEXT + 1)]
EDGE = CLASSES * CLASS_SIZE
#: Distinct words that a task counts before it hands them on.
MOST_COUNTED = 1 << 20
_PIECE, _SALTS = 4096, 64

#: The last row of each layer behind the hidden one is its bias.
SHAPES = {
    "embed": (EDGE + 1, DIMENSIONS), "mix": (len(OFFSETS) * DIMENSIONS, HIDDEN), "mix_bias": (HIDDEN,),
    "to_class": (HIDDEN + 1, CLASSES), "to_word": (CLASSES, HIDDEN + 1, CLASS_SIZE),
}


@dataclass
class Model:
    vocabulary: np.ndarray  # sorted hashes of the frequent words
    ids: np.ndarray  # their ids
    weights: dict[str, np.ndarray]
    rare: np.ndarray  # occurrences of each bucket's words
    known: np.ndarray  # sorted hashes of at most MOST_KNOWN words, all that are more frequent than others
    logs: np.ndarray  # logarithms of their counts, as whole numbers
    counts: DataFrame | None  # key, n of all words; stays on the driver

    def ids_of(self, keys: np.ndarray) -> np.ndarray:
        rare = FREQUENT + (keys % U(RARE)).astype(np.int64)
        if not len(self.vocabulary):
            return rare
        at = np.minimum(np.searchsorted(self.vocabulary, keys), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == keys, self.ids[at], rare)


def tokens(chunk: arrays.Chunk) -> tuple[np.ndarray, np.ndarray]:
    start, end, doc = chunk.words()
    return chunk.hashes(start, end), doc


def word_counts(docs: DataFrame) -> DataFrame:
    """key (word hash), n: over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(back, weights=np.concatenate([n for _, n in held]), minlength=len(keys)).astype(np.int64)

        def out(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(arrays.signed(keys)), pa.array(counts)], names=["key", "n"])

        for batch in batches:
            for chunk in arrays.chunks(batch.column(0), lower=True):
                held.append(np.unique(tokens(chunk)[0], return_counts=True))
                size += len(held[-1][0])
                if size > MOST_COUNTED:  # chunks are sorted together only then; if few words go away by that, they are handed on
                    held = [merged()]
                    size = len(held[0][0])
                    if size > MOST_COUNTED // 2:
                        yield out(*held[0])
                        held, size = [], 0
        if size:
            yield out(*merged())

    return docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _log(n: Column) -> Column:
    return F.round(F.log(F.coalesce(n.cast("double"), F.lit(UNSEEN))) * LOG_SCALE).cast("long")


def _known(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the most frequent words, at most MOST_KNOWN, and logarithms of their counts: whole levels of frequency."""
    level = F.floor(F.log2("n") * 8)
    sizes = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # a few hundred rows
    total = np.cumsum([r["count"] for r in sizes])
    fits = int(np.searchsorted(total, MOST_KNOWN, side="right"))
    if not fits:
        return np.zeros(0, U), np.zeros(0, np.int64)
    found = counts.filter(level >= sizes[fits - 1]["level"]).select("key", _log(F.col("n")).alias("log")).toArrow()  # at most MOST_KNOWN rows
    keys, logs = found["key"].to_numpy().view(U), found["log"].to_numpy()
    order = np.argsort(keys)
    return keys[order], logs[order]


def first_model(docs: DataFrame) -> Model:
    counts = keep(word_counts(docs), "word-counts")
    top = counts.orderBy(F.desc("n"), "key").limit(FREQUENT).collect()  # at most FREQUENT rows
    n = np.full(EDGE, 0.5)
    n[: len(top)] += [r["n"] for r in top]
    hashes = np.array([r["key"] for r in top], np.int64).view(U)
    rare = np.zeros(RARE)
    for r in counts.groupBy(F.pmod("key", F.lit(RARE)).alias("bucket")).agg(F.sum("n").alias("n")).collect():  # RARE rows
        rare[r["bucket"]] = r["n"]
    rare -= np.bincount((hashes % U(RARE)).astype(np.int64), weights=[r["n"] for r in top], minlength=RARE)
    n[FREQUENT:] += rare
    random = np.random.default_rng(11)
    w = {k: np.zeros(s) for k, s in SHAPES.items()}
    w["embed"] = random.normal(0, 0.1, SHAPES["embed"])
    w["mix"] = random.normal(0, 0.3, SHAPES["mix"])
    w["to_word"] = random.normal(0, 0.01, SHAPES["to_word"])
    by_class = n.reshape(CLASSES, CLASS_SIZE)
    w["to_class"][-1], w["to_word"][:, -1] = np.log(by_class.sum(axis=1) / n.sum()), np.log(by_class / by_class.sum(axis=1, keepdims=True))
    order = np.argsort(hashes)
    return Model(hashes[order], order.astype(np.int64), w, rare, *_known(counts), counts)


def neighbours(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Ids of the words around every word, a column a place; EDGE beyond the text."""
    out = np.full((len(ids), len(OFFSETS)), EDGE, np.uint16)
    for k, step in enumerate(OFFSETS):
        size = max(0, len(ids) - abs(step))
        here, there = slice(max(0, -step), max(0, -step) + size), slice(max(0, step), max(0, step) + size)
        out[here, k] = np.where(doc[here] == doc[there], ids[there], EDGE)
    return out


class Pass:
    """The network's way forward for words with these ids and neighbours: inputs, hidden layer (and 1), exponentials of the
    logits of classes and of words in their class, and their sums.

    Words are ordered by class, so that each class is one slice.
    """

    def __init__(self, w: dict[str, np.ndarray], ids: np.ndarray, around: np.ndarray):
        kind, n = (ids // CLASS_SIZE).astype(np.uint8), len(ids)
        self.order = np.argsort(kind, kind="stable")
        self.kind, self.word, self.around = kind[self.order], ids[self.order] % CLASS_SIZE, around[self.order].astype(np.int64)
        self.inputs = np.take(w["embed"], self.around, axis=0).reshape(n, -1)
        self.hidden = np.ones((n, HIDDEN + 1), self.inputs.dtype)
        hidden = self.inputs @ w["mix"]
        hidden += w["mix_bias"]
        np.tanh(hidden, out=self.hidden[:, :HIDDEN])
        cuts = np.searchsorted(self.kind, np.arange(CLASSES + 1)).tolist()
        self.slices = [(c, slice(lo, hi)) for c, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if lo < hi]
        self.of_word = np.empty((n, CLASS_SIZE), self.inputs.dtype)
        for c, own in self.slices:
            np.matmul(self.hidden[own], w["to_word"][c], out=self.of_word[own])
        self.of_class = self.hidden @ w["to_class"]
        self.sums = []
        for x in (self.of_class, self.of_word):
            if n and not x.max() <= MOST_LOGIT:
                np.minimum(x, MOST_LOGIT, out=x)
            np.exp(x, out=x)
            self.sums.append(x @ np.ones(x.shape[1], x.dtype))
        self.rows = np.arange(n)

    def log_probabilities(self) -> np.ndarray:
        out = np.zeros(len(self.rows), self.of_word.dtype)
        least = np.finfo(out.dtype).tiny
        for x, total, at in zip((self.of_class, self.of_word), self.sums, (self.kind, self.word)):
            out[self.order] += np.log(np.maximum(x[self.rows, at] / total, least))
        return out


def log_probabilities(w: dict[str, np.ndarray], ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of every word, given its neighbours."""
    out, around = np.zeros(len(ids)), neighbours(ids, doc)
    for lo in range(0, len(ids), 1 << 13):
        some = slice(lo, lo + (1 << 13))
        out[some] = Pass(w, ids[some], around[some]).log_probabilities()
    return out


class Trainer:
    """Adagrad over the words of one round's share of one part."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = {k: v.astype(np.float32) for k, v in weights.items()}
        self.past = {k: np.full_like(v, 1e-3) for k, v in self.w.items()}
        self.seen = 0

    def learn(self, ids: np.ndarray, doc: np.ndarray, round_: int) -> None:
        place = np.arange(len(ids)) - np.searchsorted(doc, doc)  # in its document
        share = arrays.mixed(place.astype(U) * U(0x9E3779B97F4A7C15) + ids.astype(U))
        at = np.flatnonzero(share % U(ROUNDS) == U(round_))
        around, lo = neighbours(ids, doc), 0
        while lo < len(at):
            step = min(BATCH, max(FEWEST, self.seen // 8), len(at) - lo)
            self._batch(ids, around, at[lo : lo + step])
            lo, self.seen = lo + step, self.seen + step

    def _batch(self, ids: np.ndarray, around: np.ndarray, at: np.ndarray) -> None:
        for name, gradient in self._gradients(ids[at], around[at]).items():
            self.past[name] += gradient**2
            gradient /= np.sqrt(self.past[name])
            gradient *= RATE
            self.w[name] -= gradient

    def gradients(self, ids: np.ndarray, doc: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-probability of the words `at`."""
        return self._gradients(ids[at], neighbours(ids, doc)[at])

    def _gradients(self, ids: np.ndarray, around: np.ndarray) -> dict[str, np.ndarray]:
        w, n = self.w, len(ids)
        f = Pass(w, ids, around)
        for x, total, at in zip((f.of_class, f.of_word), f.sums, (f.kind, f.word)):
            x /= (total * n)[:, None]
            x[f.rows, at] -= 1 / n
        back, by_word = f.of_class @ w["to_class"][:HIDDEN].T, np.empty((n, HIDDEN), f.inputs.dtype)
        to_word = np.zeros_like(w["to_word"])
        for c, own in f.slices:
            np.matmul(f.of_word[own], w["to_word"][c, :HIDDEN].T, out=by_word[own])
            np.matmul(f.hidden[own].T, f.of_word[own], out=to_word[c])
        back += by_word
        hidden = f.hidden[:, :HIDDEN]
        back *= 1 - hidden * hidden
        cell = (f.around.ravel() * DIMENSIONS)[:, None] + np.arange(DIMENSIONS)
        embed = np.bincount(cell.ravel(), weights=(back @ w["mix"].T).ravel(), minlength=w["embed"].size)
        return {
            "to_word": to_word, "to_class": f.hidden.T @ f.of_class, "mix": f.inputs.T @ back, "mix_bias": np.ones(n, back.dtype) @ back,
            "embed": embed.reshape(w["embed"].shape).astype(w["embed"].dtype),
        }


def _flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in SHAPES])


def _unflat(x: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        out[k] = x[at : at + int(np.prod(s))].reshape(s)
        at += int(np.prod(s))
    return out


def numbered(docs: DataFrame, model: Model) -> DataFrame:
    """row, doc_id, part, n_tokens, ids (2 bytes a word), share (logarithms of the counts of its rare words that are known, summed),
    words and times (the text's other distinct rare words): a row per document."""
    held = docs.sparkSession.sparkContext.broadcast(replace(model, counts=None, weights={}))  # vocabulary and known counts: some 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            for chunk in arrays.chunks(batch.column(1), lower=True):
                keys, doc = tokens(chunk)
                ids = own.ids_of(keys)
                n = np.bincount(doc, minlength=chunk.n)
                rare = np.flatnonzero(ids >= FREQUENT)
                sizes, words, times = _rare_words(keys[rare], doc[rare], chunk.n)
                share, sizes, words, times = _shares(own, sizes, words, times)
                off = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
                data, ends = ids.astype(np.uint16).tobytes(), np.append(0, np.cumsum(2 * n))
                packed = pa.array([data[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())], pa.binary())
                lists = [pa.ListArray.from_arrays(off, pa.array(x)) for x in (arrays.signed(words), times)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.rows.start, chunk.n), pa.array(n), packed, pa.array(share), *lists],
                    names=["doc_id", "n_tokens", "ids", "share", "words", "times"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, share long, words array<long>, times array<long>")
    total = model.counts.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // PART))
    # Dealt by content and doc_id, so that the copies of a text are spread over parts; in a part equal texts are interchangeable.
    dealt = rows.withColumn("hash", F.xxhash64("ids", "share", "words")).withColumn("part", F.pmod(F.xxhash64("hash", "doc_id"), F.lit(parts)))
    dealt = dealt.repartition(parts, "part").sortWithinPartitions("part", "hash", "ids").drop("hash")
    return keep(dealt.withColumn("row", F.monotonically_increasing_id()), "word-ids")  # the table numbers rows once and for all


def _ids_of(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch, and the row of each."""
    data = batch.column(column).to_pylist()
    ids = np.frombuffer(b"".join(data), np.uint16).astype(np.int64)
    return ids, np.repeat(np.arange(len(data)), [len(x) // 2 for x in data])


def _round(rows: DataFrame, weights: dict[str, np.ndarray], round_: int) -> dict[str, np.ndarray]:
    held = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, trainer, part = 0, 0, None, None

        def end() -> None:
            nonlocal total, n
            total, n = total + np.rint(_flat(trainer.w).astype(np.float64) * SCALE).astype(np.int64), n + 1

        for batch in batches:
            parts, (ids, doc) = batch.column(0).to_numpy(), _ids_of(batch, 1)
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if parts[lo] != part:
                    if trainer:
                        end()
                    trainer, part = Trainer(held.value), parts[lo]
                own = slice(*np.searchsorted(doc, [lo, hi]))
                trainer.learn(ids[own], doc[own], round_)
        if trainer:
            end()
            pieces = [total[i : i + _PIECE].tobytes() for i in range(0, len(total), _PIECE)]
            m = len(pieces)
            salt = TaskContext.get().partitionId() % _SALTS
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(m), pa.int32()), pa.array([salt] * m, pa.int32()), pa.array([n] * m, pa.int64()), pa.array(pieces, pa.binary())], names=["piece", "salt", "n", "x"]
            )

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        x = sum(np.frombuffer(b, np.int64) for b in frame["x"])
        return pd.DataFrame({"piece": frame["piece"].iloc[:1].to_numpy(), "salt": [0], "n": [int(frame["n"].sum())], "x": [x.tobytes()]})

    schema = "piece int, salt int, n long, x binary"
    summed = rows.filter("n_tokens > 0").select("part", "ids").mapInArrow(run, schema)
    pieces = summed.groupBy("piece", "salt").applyInPandas(added, schema).groupBy("piece").applyInPandas(added, schema)
    got = pieces.orderBy("piece").collect()  # the parameters once
    if not got:
        return weights
    return _unflat(np.frombuffer(b"".join(r["x"] for r in got), np.int64) / (SCALE * got[0]["n"]))


def fit(rows: DataFrame, model: Model) -> Model:
    """rows: texts by `numbered`."""
    for k in range(ROUNDS):
        model = replace(model, weights=_round(rows, model.weights, k))
    return model


def _rare_words(keys: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of each of n documents: numbers of words, the words, how often they occur."""
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (np.diff(doc) != 0) | (keys[1:] != keys[:-1])
    first = np.flatnonzero(new)
    return np.bincount(doc[first], minlength=n), keys[first], np.diff(np.append(first, len(keys)))


def _shares(model: Model, sizes: np.ndarray, words: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of documents -> each document's sum of times * log of known words; sizes, words and times of the others."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    share, other = np.zeros(len(sizes), np.int64), np.ones(len(words), bool)
    if len(model.known):
        at = np.minimum(np.searchsorted(model.known, words), len(model.known) - 1)
        other = model.known[at] != words
        np.add.at(share, doc[~other], times[~other] * model.logs[at[~other]])
    return share, np.bincount(doc[other], minlength=len(sizes)), words[other], times[other]


def score(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, log_probability (sum), mean_log_probability: a row per row of texts by `numbered`."""
    none = np.zeros(0, np.int64)
    held = rows.sparkSession.sparkContext.broadcast(replace(model, counts=None, vocabulary=none, ids=none, known=none, logs=none))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        w = {k: v.astype(np.float32) for k, v in own.weights.items()}
        buckets = np.log(own.rare + UNSEEN)
        for batch in batches:
            ids, doc = _ids_of(batch, 4)
            logs = log_probabilities(w, ids, doc)
            rare = np.flatnonzero(ids >= FREQUENT)
            logs[rare] -= buckets[ids[rare] - FREQUENT]
            total = np.bincount(doc, weights=logs, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(total)], names=["row", "doc_id", "n_tokens", "known", "log_probability"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.select("row", "doc_id", "n_tokens", "share", "ids").mapInArrow(
        run, f"row long, doc_id {kind}, n_tokens long, known long, log_probability double"
    )
    words = rows.select("row", F.inline(F.arrays_zip("words", "times"))).withColumnRenamed("words", "key")
    shares = words.join(model.counts, "key", "left").groupBy("row").agg(F.sum(F.col("times") * _log(F.col("n"))).alias("share"))
    scored = scored.join(shares, "row", "left")
    log_probability = F.col("log_probability") + (F.col("known") + F.coalesce("share", F.lit(0))) / LOG_SCALE
    return scored.select(
        "doc_id", "n_tokens", log_probability.alias("log_probability"), F.try_divide(log_probability, "n_tokens").alias("mean_log_probability")
    )


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    model = first_model(docs)
    rows = numbered(docs, model)
    return score(rows, fit(rows, model))
