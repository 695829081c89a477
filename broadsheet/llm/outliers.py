"""Quality rules: robust multivariate outliers among the texts of one language and source.

Each text gives a few counts (`base_columns`), and these a vector of transformed statistics. Per language and source,
and per language, the minimum covariance determinant estimate of centre and scatter is found by concentration steps
over all documents. A source's estimate is drawn towards its language's: with n documents nearest its centre, it weighs
n against the language's PRIOR. So a source of three documents is judged nearly by its language, one of thousands by
itself, and there is no size at which one rule gives way to another. A text is rejected whose squared Mahalanobis
distance is above a chi-square quantile.

A concentration step is one aggregate: distances are binned, counts and moments are summed by unit and bin, and
the bins that hold the nearest SUPPORT of a unit's documents give the next centre and scatter. A unit keeps the estimate
of the least determinant; steps end when that of no unit falls. Statistics are
whole numbers (1/SCALE), so that sums don't depend on the order of the rows and reruns agree. No unit's rows meet
in one task, and only one number a step comes to the driver.

Most texts have no symbols or repeats at all, which makes plain scatter singular: the variances FLOOR ** 2 are
added to the diagonal, which says below which spread a statistic isn't telling.

Defined cases
-------------
* null text: no words; empty and short texts fail the base rules and are never estimated on.
* null lang or source: values of their own. Repeated rows count as often as they stand there.
* an empty table gives an empty result. Extra columns pass `keep_good` unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import arrays
from .tables import keep, with_fields

U = np.uint64

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Base rules.
LEAST_WORDS, MOST_REPEATED = 50, 50
SUPPORT = 0.75
#: Documents of a language that a source's own ones are weighed against: ten a statistic.
PRIOR = 50
SCALE = 256
#: Least spreads of: log words, log mean word length, root of symbols a word, of duplicate lines a line, of repeated words a word.
#: The root of a share of n things is known to 1 / (2 n ** 0.5): that of 11 lines to 0.15, that of LEAST_WORDS words, which
#: repeat in threes, to 0.12.
FLOOR = (0.5, 0.04, 0.05, 0.15, 0.12)
P = len(FLOOR)
#: Share of a normal population beyond the cut: a customary 0.001, and a hundredth of it, as counts of texts have longer
#: tails than normal ones. Each statistic can reject by itself: the shares, which are bounded, from 72 % of duplicate lines
#: on and from 46 % of repeated words (MOST_REPEATED ends them), less if both are high.
TAIL = 1e-5
STEPS = 25
SALTS = 16

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def base_columns(text: pa.Array) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (those with a word) of every text."""
    out = np.zeros((6, len(text)), np.int64)
    for chunk in arrays.chunks(text):
        start, end, doc = chunk.words()
        is_word = arrays.IS_WORD[chunk.data]

        # A line belongs to one document and ends at \n or with it.
        breaks = np.flatnonzero(chunk.data == 0x0A)
        line_start = np.unique(np.concatenate([chunk.off[:-1], breaks + 1]))
        line_start = line_start[line_start < len(chunk.data)]
        line_start = line_start[chunk.data[line_start] != 0x0A]
        line_end = np.sort(np.concatenate([breaks, chunk.off[1:]]))
        line_end = line_end[np.searchsorted(line_end, line_start, side="right")]
        words_upto = np.zeros(len(is_word) + 1, np.int64)
        np.cumsum(is_word, out=words_upto[1:])
        full = words_upto[line_end] > words_upto[line_start]
        line_start, line_end = line_start[full], line_end[full]
        line_doc = chunk.doc_of(line_start)
        _, first = np.unique(_within(chunk.hashes(line_start, line_end), line_doc), return_index=True)
        n_lines = np.bincount(line_doc, minlength=chunk.n)

        hashes, at = arrays.windows(chunk.hashes(start, end), doc, 3)
        again = at[arrays.repeated(_within(hashes, doc[at]))]
        in_repeat = arrays.covered(again, again + 3, len(doc))

        out[:, chunk.rows] = [
            np.bincount(doc, minlength=chunk.n),
            chunk.per_doc(is_word & ((chunk.data & 0xC0) != 0x80)),
            chunk.per_doc(_SYMBOL[chunk.data]),
            n_lines - np.bincount(line_doc[first], minlength=chunk.n),
            np.bincount(doc[in_repeat], minlength=chunk.n),
            n_lines,
        ]
    return list(out)


def _within(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes that differ between documents."""
    return arrays.mixed(hashes + doc.astype(U) * U(0x9E3779B97F4A7C15))


def _vectors(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) -> np.ndarray:
    words, lines = np.maximum(n_words, 1), np.maximum(n_lines, 1)
    x = [
        np.log(words),
        np.log(np.maximum(word_chars, 1) / words),
        np.sqrt(n_symbols / words),
        np.sqrt(n_dup_lines / lines),
        np.sqrt(n_repeat_words / words),
    ]
    return np.rint(np.stack(x) * SCALE).astype(np.int64)


def measured(docs: DataFrame, columns: list[Column]) -> DataFrame:
    """The given columns of docs, the COUNTS and the vector q (whole numbers) of each text."""
    source = docs.select(*columns, docs["text"].alias("text_"))
    schema = with_fields(source.schema.fields[:-1], ", ".join([*(f"{c} long" for c in COUNTS), "q array<long>"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = base_columns(batch.column(batch.num_columns - 1))
            q = _vectors(*counts)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, q.size + 1, P, dtype=np.int32)), pa.array(q.T.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(c) for c in counts[:5]), flat],
                names=[*batch.schema.names[:-1], *COUNTS, "q"],
            )

    return source.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def chi2(share: float, p: int = P) -> float:
    """Quantile of the chi-square distribution with p degrees (Wilson and Hilferty)."""
    return p * (1 - 2 / (9 * p) + NormalDist().inv_cdf(share) * (2 / (9 * p)) ** 0.5) ** 3


def chi2_below(x: float, p: int) -> float:
    return NormalDist().cdf(((x / p) ** (1 / 3) - (1 - 2 / (9 * p))) / (2 / (9 * p)) ** 0.5)


_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def _distance(q: Column, centre: Column, weights: Column) -> Column:
    """Squared Mahalanobis distance; weights: the upper triangle of the inverse scatter."""
    x = [F.element_at(q, i + 1) / F.lit(float(SCALE)) - F.element_at(centre, i + 1) for i in range(P)]
    return sum(
        (F.element_at(weights, k + 1) * x[i] * x[j] * (1.0 if i == j else 2.0) for k, (i, j) in enumerate(_PAIRS)),
        F.lit(0.0),
    )


def _moments(n: int, s: list[int], ss: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance."""
    mean, cov = np.asarray(s, float) / n, np.zeros((P, P))
    for k, (i, j) in enumerate(_PAIRS):
        cov[i, j] = cov[j, i] = ss[k] / n - mean[i] * mean[j]
    return mean, cov


def estimate(own: tuple, prior: tuple | None) -> tuple[np.ndarray, np.ndarray]:
    """Centre and scatter (in units of the statistics) from counts and moments n, s, ss of a unit, and of its language."""
    mean, cov = _moments(*own)
    if prior is not None:
        mean0, cov0 = _moments(*prior)
        share = own[0] / (own[0] + PRIOR)
        # How far the means are apart isn't scatter: an outlier that is alone in its source must not widen it.
        mean, cov = share * mean + (1 - share) * mean0, share * cov + (1 - share) * cov0
    consistent = SUPPORT / chi2_below(chi2(SUPPORT), P + 2)
    return mean / SCALE, cov * (consistent / SCALE**2) + np.diag(np.square(FLOOR))


def _estimates(rows: DataFrame) -> DataFrame:
    """unit, parent, centre, weights (inverse scatter), logdet of a unit's moments n, s, ss, and of its language's n0, s0, ss0."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for unit, parent, n, s, ss, n0, s0, ss0 in frame.itertuples(index=False):
                centre, scatter = estimate((n, s, ss), None if parent is None else (n0, s0, ss0))
                inverse = np.linalg.inv(scatter)
                out.append((unit, parent, centre.tolist(), [inverse[i, j] for i, j in _PAIRS], float(np.linalg.slogdet(scatter)[1])))
            yield pd.DataFrame(out, columns=["unit", "parent", "centre", "weights", "logdet"])

    rows = rows.select("unit", "parent", "n", "s", "ss", "n0", "s0", "ss0")
    return rows.mapInPandas(run, "unit string, parent string, centre array<double>, weights array<double>, logdet double")


def _joined(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """Rows with their unit's estimate. A unit's rows are dealt over SALTS keys, should the estimates be too many to send."""
    fits = fits.drop("parent").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.hash("q"), F.lit(SALTS))).join(fits, ["unit", "salt"]).drop("salt")


def language_unit() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))


def source_unit() -> Column:
    return F.concat(language_unit(), F.lit("\x1f"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")))


def _start(good: DataFrame) -> DataFrame:
    """Medians and interquartile ranges. The values are whole numbers of a narrow range, so that the exact
    percentiles keep a small table of counts a unit, summed up before it is moved, and not the rows."""
    values = good.select("unit", "parent", F.posexplode("q").alias("k", "v"))
    spread = values.groupBy("unit", "parent", "k").agg(F.expr("percentile(v, array(0.25, 0.5, 0.75))").alias("p"))
    spread = spread.select("unit", "parent", "k", F.col("p")[1].alias("mid"), (F.col("p")[2] - F.col("p")[0]).alias("range"))
    variance = F.pow(F.col("range") / 1.349 / SCALE, 2) + F.element_at(F.array(*[F.lit(f * f) for f in FLOOR]), F.col("k") + 1)
    start = spread.groupBy("unit", "parent").agg(
        F.array_sort(F.collect_list(F.struct("k", (F.col("mid") / SCALE).alias("c"), (1 / variance).alias("w")))).alias("a")
    )  # P rows a unit
    weights = [F.element_at("a", i + 1)["w"] if i == j else F.lit(0.0) for i, j in _PAIRS]
    return start.select("unit", "parent", F.transform("a", lambda e: e["c"]).alias("centre"), F.array(*weights).alias("weights"), F.lit(1e9).alias("logdet"))


def _step(good: DataFrame, fits: DataFrame) -> DataFrame:
    """The estimates from each unit's nearest documents."""
    distance = _distance(F.col("q"), F.col("centre"), F.col("weights"))
    bins = (
        _joined(good, fits)
        .withColumn("bin", F.floor(16 * F.log2(1 + F.greatest(distance, F.lit(0.0)))))
        .groupBy("unit", "parent", "bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.sum(F.element_at("q", i + 1)) for i in range(P)]).alias("s"),
            F.array(*[F.sum(F.element_at("q", i + 1) * F.element_at("q", j + 1)) for i, j in _PAIRS]).alias("ss"),
        )
    )
    # Some hundreds of rows a unit: the bins of a logarithm.
    unit = Window.partitionBy("unit")
    near = bins.withColumn("before", F.sum("n").over(unit.orderBy("bin")) - F.col("n")).withColumn("all", F.sum("n").over(unit))
    moments = (
        near.filter(F.col("before") < F.col("all") * SUPPORT)
        .groupBy("unit", "parent")
        .agg(
            F.sum("n").alias("n"),
            F.array(*[F.sum(F.element_at("s", i + 1)) for i in range(P)]).alias("s"),
            F.array(*[F.sum(F.element_at("ss", k + 1)) for k in range(len(_PAIRS))]).alias("ss"),
        )
    )
    moments = keep(moments, "mcd-moments")
    prior = moments.filter("parent is null").select(F.col("unit").alias("p_"), F.col("n").alias("n0"), F.col("s").alias("s0"), F.col("ss").alias("ss0"))
    return _estimates(moments.join(prior, F.col("parent") == F.col("p_"), "left"))


def fit(good: DataFrame) -> DataFrame:
    """good(lang, source, q): the texts that pass the base rules. -> unit, parent, centre, weights, logdet."""
    level = lambda unit, parent: F.struct(unit.alias("unit"), parent.alias("parent"))
    both = F.array(level(language_unit(), F.lit(None).cast("string")), level(source_unit(), language_unit()))
    good = good.select(F.explode(both).alias("u"), "q").select("u.unit", "u.parent", "q")
    fits = keep(_start(good), "mcd-start")
    for _ in range(STEPS):
        new = _step(good, fits)
        old = fits.select(F.col("unit").alias("u_"), *(F.col(c).alias(f"{c}_") for c in ("centre", "weights", "logdet")))
        better = F.col("logdet") < F.col("logdet_") - 1e-4
        new = new.join(old, F.col("unit") == F.col("u_"))
        picked = [F.when(better, F.col(c)).otherwise(F.col(f"{c}_")).alias(c) for c in ("centre", "weights", "logdet")]
        fits = keep(new.select("unit", "parent", *picked, better.alias("moved")), "mcd-step")
        moved = fits.filter("moved").limit(1).count()
        fits = fits.drop("moved")
        if not moved:
            break
    return fits


def judged(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """rows(lang, source, COUNTS, q, ...) with base_failed, distance and kept.

    A text of a unit without an estimate fails the base rules, as do all others of that unit.
    """
    fits = fits.select(F.col("unit").alias("u_"), "centre", "weights")
    fits = fits.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.join(fits, (source_unit() == F.col("u_")) & (F.pmod(F.hash("q"), F.lit(SALTS)) == F.col("salt_")), "left")
    distance = _distance(F.col("q"), F.col("centre"), F.col("weights"))
    return rows.withColumns({"base_failed": base_failed(), "distance": distance}).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi2(1 - TAIL), F.lit(False))
    )


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the COUNTS, base_failed, distance, kept: a row per document."""
    stats = keep(measured(docs, [F.col(c) for c in ("doc_id", "lang", "source")]), "mcd-stats")
    fits = fit(stats.filter(~base_failed()).select("lang", "source", "q"))
    return judged(stats, fits).select("doc_id", "lang", "source", *COUNTS, "base_failed", "distance", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with all their columns. Texts are measured twice, which moves none of them."""
    stats = keep(measured(docs, [F.col("lang"), F.col("source")]), "mcd-stats")
    fits = fit(stats.filter(~base_failed()).select("lang", "source", "q"))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    rows = judged(measured(docs, [F.col("lang"), F.col("source"), row]), fits)
    return rows.filter("kept").select("row.*")
