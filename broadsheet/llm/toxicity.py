"""Toxicity: a convolutional text classifier, trained in numpy.

Words (A-Z in lower case, without punctuation at their ends) are hashed to embeddings, to which that of their first
PREFIX bytes is added, so that unseen forms of a word aren't lost; filters over 1, 2 and 3
neighbouring words are max-pooled over the whole text, and a logistic layer gives the score. So a text is as toxic
as its worst passage, however long it is. Embeddings are kept for hashes that occur in LEAST_TEXTS training texts at
least; all others are zero, as they were before training.

The classifier is fitted on the driver on a sample of labelled texts, of about TRAIN_ROWS a class and TRAIN_CHARS
characters in all at most (by hash of the id); texts of over MOST_CHARS characters aren't in it. Tasks hash the sample's
words, so that no text goes to the driver. Every document is scored once, without a shuffle. All other labelled
documents, a CHECKED-th of them at least, calibrate the scores in Spark, by histograms of their logits by language: so
that the best cut is at CUT, and a cut for each language of its own; a text is `flagged` by its language's cut.
Neither language nor source or id enters a score.

Defined cases
-------------
* null and empty texts and those without known words get the score of no evidence. Texts of any length are read whole.
* labels: rows with null id or null label are not learned from; of several labels of one id, each counts.
* without labels of both classes, every score is 0.
* null and unseen languages use the cut of all. Repeated rows are scored each. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import arrays
from .tables import keep

U = np.uint64
WIDTHS, FILTERS, DIMENSIONS = (1, 2, 3), 16, 16
#: Bounds of the sample that the classifier is fitted on.
TRAIN_ROWS, TRAIN_CHARS, MOST_CHARS = 2000, 30_000_000, 200_000
#: One labelled document in so many is never trained on.
CHECKED = 4
#: Logits are counted in bins of 1 / BINS from -MOST_LOGIT to MOST_LOGIT.
BINS, MOST_LOGIT = 64, 50.0
LEAST_TEXTS = 3
PREFIX = 5
EPOCHS, BATCH, RATE, DECAY = 6, 16, 0.05, 1e-4
CUT = 0.7
#: Languages need so many calibration texts of each class for a cut of their own.
LEAST_CALIBRATED = 15

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[ord(c) for c in ".,;:!?\"'()[]{}*%$#&|<>-"]] = True


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def word_keys(chunk: arrays.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (of the whole and of the first bytes) and document of every word that has more than punctuation."""
    start, end, doc = chunk.words()
    for _ in range(4):
        start = np.where((start < end) & _PUNCTUATION[chunk.data[np.minimum(start, len(chunk.data) - 1)]], start + 1, start)
        end = np.where((start < end) & _PUNCTUATION[chunk.data[end - 1]], end - 1, end)
    full = start < end
    start, end = start[full], end[full]
    whole, first = chunk.hashes(start, end), chunk.hashes(start, np.minimum(start + PREFIX, end))
    return np.stack([whole, arrays.mixed(first + U(PREFIX))]), doc[full]


@dataclass
class Network:
    known: np.ndarray  # sorted word hashes; embedding 0 is that of all other words
    embeddings: np.ndarray  # (1 + known, DIMENSIONS)
    filters: list[np.ndarray]  # for each width: (width, DIMENSIONS, FILTERS)
    bias: np.ndarray  # (widths, FILTERS)
    out: np.ndarray  # (widths * FILTERS)
    out_bias: float

    def rows_of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(keys.shape, np.int64)
        at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        return np.where(self.known[at] == keys, at + 1, 0)

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        return self.embeddings[rows[0]] + self.embeddings[rows[1]]

    def tables(self) -> list[list[np.ndarray]]:
        """What a word adds to each filter at each place of it."""
        return [[(self.embeddings @ f[j]).astype(np.float32) for j in range(len(f))] for f in self.filters]

    def logits(self, rows: np.ndarray, doc: np.ndarray, n: int, tables: list[list[np.ndarray]]) -> np.ndarray:
        pooled = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        known = rows.any(axis=0)
        for w, width in enumerate(WIDTHS):
            m = rows.shape[1] - width + 1
            if m <= 0:
                continue
            # Windows of unknown words alone all look the same: one a document is enough.
            seen = np.zeros(m, bool)
            for j in range(width):
                seen |= known[j : j + m]
            seen[1:] |= doc[1:m] != doc[: m - 1]
            seen[:1] = True
            at = np.flatnonzero(seen & (doc[:m] == doc[width - 1 :]))
            if not len(at):
                continue
            z = np.zeros((len(at), FILTERS), np.float32)
            for j in range(width):
                z += tables[w][j][rows[0, at + j]]
                z += tables[w][j][rows[1, at + j]]
            z += self.bias[w].astype(np.float32)
            first = np.flatnonzero(np.append(True, np.diff(doc[at]) != 0))
            pooled[doc[at[first]], w * FILTERS : (w + 1) * FILTERS] = np.maximum(np.maximum.reduceat(z, first, axis=0), 0)
        return pooled.astype(np.float64) @ self.out + self.out_bias


def evidence(texts: list[np.ndarray], label: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Root of the likelihood ratio of each word's share of the two classes' texts; negative if it is the clean ones' word."""
    n = np.array([(label == k).sum() for k in (0, 1)], float)
    found = np.zeros((2, len(known)))
    for text, k in zip(texts, label):
        found[k, np.searchsorted(known, np.intersect1d(text, known))] += 1
    both = found.sum(axis=0)
    share = both / n.sum()
    ratio = np.zeros(len(known))
    for k in (0, 1):
        for seen, expected in ((found[k], n[k] * share), (n[k] - found[k], n[k] * (1 - share))):
            ratio += 2 * seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12))
    return np.sign(found[1] - n[1] * share) * np.sqrt(np.maximum(ratio, 0))


def train(texts: list[np.ndarray], label: np.ndarray, seed: int = 7) -> Network:
    """Adagrad on the logistic loss; classes weigh the same."""
    random = np.random.default_rng(seed)
    keys, counts = np.unique(np.concatenate([np.unique(t) for t in texts] or [np.zeros(0, U)]), return_counts=True)
    known = keys[counts >= LEAST_TEXTS]
    net = Network(
        known, np.zeros((len(known) + 1, DIMENSIONS)),
        [random.normal(0, 0.3, (w, DIMENSIONS, FILTERS)) for w in WIDTHS], np.full((len(WIDTHS), FILTERS), -0.05),
        np.abs(random.normal(0, 0.3, len(WIDTHS) * FILTERS)) * np.tile([1, -1], len(WIDTHS) * FILTERS // 2), 0.0,
    )
    net.embeddings[1:] = random.normal(0, 0.05, (len(known), DIMENSIONS))
    # One dimension begins with what the words' numbers of texts tell, and one filter of one word with reading it.
    net.embeddings[1:, 0], net.filters[0][0, 0, 0], net.out[0] = evidence(texts, label, known) / 4, 1.0, 1.0
    rows = [net.rows_of(t) for t in texts]
    weight = np.where(label == 1, 0.5 / max((label == 1).sum(), 1), 0.5 / max((label == 0).sum(), 1)) * len(label)
    past = {"e": np.full_like(net.embeddings, 1e-6), "o": np.full_like(net.out, 1e-6), "f": [np.full_like(f, 1e-6) for f in net.filters], "b": np.full_like(net.bias, 1e-6)}

    def step(value: np.ndarray, gradient: np.ndarray, sum_: np.ndarray) -> None:
        sum_ += gradient**2
        value -= RATE * gradient / np.sqrt(sum_)

    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            batch = [i for i in order[lo : lo + BATCH] if rows[i].size]
            if not batch:
                continue
            pooled = np.zeros((len(batch), len(WIDTHS), FILTERS))
            place = np.zeros((len(batch), len(WIDTHS), FILTERS), np.int64)
            for b, i in enumerate(batch):
                vectors = net.vectors(rows[i])
                for w, width in enumerate(WIDTHS):
                    m = len(vectors) - width + 1
                    if m <= 0:
                        continue
                    z = sum(vectors[j : j + m] @ net.filters[w][j] for j in range(width)) + net.bias[w]
                    place[b, w] = z.argmax(axis=0)
                    pooled[b, w] = np.maximum(z.max(axis=0), 0)
            flat = pooled.reshape(len(batch), -1)
            p = 1 / (1 + np.exp(-(flat @ net.out + net.out_bias)))
            error = (p - label[batch]) * weight[batch] / len(batch)
            back = (error[:, None] * net.out).reshape(pooled.shape) * (pooled > 0)
            step(net.out, error @ flat + DECAY * net.out, past["o"])
            net.out_bias -= RATE * error.sum()
            step(net.bias, back.sum(axis=0), past["b"])
            to_embeddings = np.zeros_like(net.embeddings)
            for w, width in enumerate(WIDTHS):
                gradient = np.zeros_like(net.filters[w])
                for b, i in enumerate(batch):
                    if rows[i].shape[1] < width:
                        continue
                    for j in range(width):
                        words = rows[i][:, place[b, w] + j]
                        gradient[j] += net.vectors(words).T * back[b, w]
                        for part in words:
                            np.add.at(to_embeddings, part, (net.filters[w][j] * back[b, w]).T)
                step(net.filters[w], gradient + DECAY * net.filters[w], past["f"][w])
            to_embeddings[0] = 0
            touched = np.flatnonzero(to_embeddings.any(axis=1))
            past["e"][touched] += to_embeddings[touched] ** 2
            net.embeddings[touched] -= RATE * to_embeddings[touched] / np.sqrt(past["e"][touched])
    return net


def _dealt(key: str) -> Column:
    """A number from 0 to 1 by hash of the id."""
    return F.pmod(F.xxhash64(F.lit(key), "l_"), F.lit(1 << 20)) / F.lit(float(1 << 20))


def marks(labels: DataFrame) -> DataFrame:
    """l_ (id), toxic, checks (not trained on, whatever the sample): labels that may be learned from."""
    rows = labels.select(F.col("doc_id").alias("l_"), F.col("toxic").cast("int").alias("toxic")).filter("l_ is not null and toxic in (0, 1)")
    return rows.filter(~held_out(F.col("l_"))).withColumn("checks", _dealt("check") < 1 / CHECKED)


def sample_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """l_ (id), toxic: the labels that the classifier is fitted on."""
    rows = marks(labels).filter("not checks")
    sized = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("chars")).join(rows, F.col("doc_id") == F.col("l_"))
    sized = sized.filter(F.col("chars") <= MOST_CHARS)
    totals = {r["toxic"]: r for r in sized.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars")).collect()}  # a row a class
    share = F.lit(0.0)
    for k, r in totals.items():
        share = F.when(F.col("toxic") == k, min(TRAIN_ROWS / r["n"], TRAIN_CHARS / 2 / max(r["chars"], 1))).otherwise(share)
    return sized.filter(_dealt("train") < share).select("l_", "toxic")


def fit(docs: DataFrame, sample: DataFrame) -> Network:
    """sample(l_, toxic): about 2 * TRAIN_ROWS rows, sent to all tasks as ids, and back as hashes of words."""
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("l_")).select("doc_id", "toxic", "text")
    rows = rows.filter(F.coalesce(F.length("text"), F.lit(0)) <= MOST_CHARS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in arrays.chunks(batch.column(2), lower=True):
                keys, doc = word_keys(chunk)
                parts = [k.tobytes() for k in np.split(keys, np.searchsorted(doc, np.arange(1, chunk.n)), axis=1)]
                ids, toxic = (batch.column(i).slice(chunk.rows.start, chunk.n) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([ids, toxic, pa.array(parts, pa.binary())], names=["doc_id", "toxic", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = rows.mapInArrow(run, f"doc_id {kind}, toxic int, keys binary").collect()  # bounded by TRAIN_ROWS and TRAIN_CHARS
    got = sorted(got, key=lambda r: (r["doc_id"], r["toxic"], bytes(r["keys"])))
    label = np.array([r["toxic"] for r in got], np.int64)
    if not len(label) or label.min() == label.max():
        none = [np.zeros((w, DIMENSIONS, FILTERS)) for w in WIDTHS]
        return Network(np.zeros(0, U), np.zeros((1, DIMENSIONS)), none, np.zeros((len(WIDTHS), FILTERS)), np.zeros(len(WIDTHS) * FILTERS), -1e3)
    return train([np.frombuffer(r["keys"], U).reshape(2, -1) for r in got], label)


def logits(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, lang, logit: a row per document."""
    held = docs.sparkSession.sparkContext.broadcast(net)  # at most some ten thousands of words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        tables = own.tables()
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for chunk in arrays.chunks(batch.column(2), lower=True):
                keys, doc = word_keys(chunk)
                out[chunk.rows] = own.logits(own.rows_of(keys), doc, chunk.n, tables)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], names=["doc_id", "lang", "logit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "lang", "text").mapInArrow(run, f"doc_id {kind}, lang string, logit double")


def best_cuts(cells: DataFrame, by: list[str]) -> DataFrame:
    """cells(by, bin, n, hits) -> by, cut, hits, misses: the logit with the best F1, in the middle between the bins beside it."""
    down = Window.partitionBy(*by).orderBy(F.desc("bin"))  # at most 2 * BINS * MOST_LOGIT rows
    whole = Window.partitionBy(*by)
    upto = down.rowsBetween(Window.unboundedPreceding, 0)
    rows = cells.withColumns({
        "f1": 2 * F.sum("hits").over(upto) / (F.sum("n").over(upto) + F.sum("hits").over(whole)),
        "low": F.coalesce(F.lead("bin").over(down), F.col("bin") - BINS), "all_hits": F.sum("hits").over(whole), "all": F.sum("n").over(whole),
    })
    best = rows.groupBy(*by).agg(F.max_by(F.struct("bin", "low", "all_hits", "all"), F.struct("f1", "bin")).alias("x"))
    return best.select(*by, ((F.col("x.bin") + F.col("x.low") + 1) / (2 * BINS)).alias("cut"), F.col("x.all_hits").alias("hits"), (F.col("x.all") - F.col("x.all_hits")).alias("misses"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, score, predicted (by CUT), flagged (by the language's cut), held_out: a row per document."""
    sample = keep(sample_of(docs, labels), "toxic-sample")
    scored = keep(logits(docs, fit(docs, sample)), "toxic-logits")
    checks = marks(labels).join(F.broadcast(sample.select(F.col("l_").alias("s_"))), F.col("l_") == F.col("s_"), "left_anti")
    cell = F.floor(F.greatest(F.least("logit", F.lit(MOST_LOGIT)), F.lit(-MOST_LOGIT)) * BINS).alias("bin")
    checked = scored.join(checks, F.col("doc_id") == F.col("l_")).groupBy("lang", cell).agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits"))
    checked = keep(checked, "toxic-checked")
    general = best_cuts(checked.groupBy(F.lit(0).alias("all_"), "bin").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")), ["all_"]).first()  # one row
    spread = checked.agg(F.sum("n"), F.sum(F.col("n") * F.col("bin") / BINS), F.sum(F.col("n") * F.pow(F.col("bin") / BINS, 2))).first()
    scale, middle = 1.0, 0.0
    if general is not None and general["hits"] and general["misses"]:
        # Scores go up from 0 to 1 about the best cut, which is put at CUT.
        deviation = max(spread[2] / spread[0] - (spread[1] / spread[0]) ** 2, 0.0) ** 0.5
        scale, middle = 2.0 / max(deviation, 1e-6), general["cut"] - float(np.log(CUT / (1 - CUT))) * max(deviation, 1e-6) / 2.0
    own = best_cuts(checked, ["lang"]).filter((F.col("hits") >= LEAST_CALIBRATED) & (F.col("misses") >= LEAST_CALIBRATED))
    rows = scored.join(own.select(F.col("lang").alias("lang_"), F.col("cut")), F.col("lang") == F.col("lang_"), "left")
    z = F.greatest(F.least((F.col("logit") - middle) * scale, F.lit(500.0)), F.lit(-500.0))
    score = 1 / (1 + F.exp(-z))
    flagged = F.when(F.col("cut").isNotNull(), F.col("logit") >= F.col("cut")).otherwise(score >= CUT)
    return rows.select("doc_id", "lang", score.alias("score"), (score >= CUT).cast("int").alias("predicted"), flagged.alias("flagged"), held_out(F.col("doc_id")).alias("held_out"))
