"""Mix sources to target weights by nested hash-threshold histograms. DataFrame functions only.

Every document gets a hash. Per source the words are summed by the leading bits of that hash; the
budget's threshold falls in one bucket, and only that bucket is looked at again with the next bits.
After LEVELS passes a threshold of 60 bits is known per source, and the mix is a filter: no sort of
documents, nothing per document on the driver, and the same result on every run.

A source whose target is above its size is repeated: floor(target / size) whole passes over it, and
the threshold picks the documents of the last, partial pass.

Defined cases
-------------
* null or empty text: size 0, taken 0. Null source: a source of its own, last in order.
* null doc_id: hashed like any other value. Repeated rows share a hash and are taken together.
* a source of size 0: target 0. An empty table gives an empty result.
* extra columns are ignored by `mix_plan`; `mix` keeps them, also those that are named like its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import keep, n_words

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
#: Hash bits read per histogram, and the number of histograms.
BITS, LEVELS = 12, 5
#: The rows that one source may put into one task when thresholds are joined by shuffle.
SALTS = 16


def ranked(sources: DataFrame) -> DataFrame:
    """Add `rank` (0, 1, ...; by code point, null last) without bringing all sources into one task."""
    key = F.struct(F.col("source").isNull().alias("last"), F.col("source").alias("name"))
    parts = sources.withColumn("key", key).repartitionByRange("key").withColumn("part", F.spark_partition_id())
    parts = keep(parts.drop("key"), "mix-sources")
    # One row per range, of which there are as many as shuffle partitions.
    before = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    )
    own = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return parts.join(before.select("part", F.coalesce("before", F.lit(0)).alias("before")), "part").select(
        "source", "source_size", (F.col("before") + F.row_number().over(own) - 1).alias("rank")
    )


def with_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """sources(source, source_size) -> plus weight and target.

    The whole of all sizes is shared by weight; a share above `most` times its source's size stops there and
    the excess is shared among the others, until none is above. Each round is one aggregate over the sources.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = keep(ranked(sources).withColumn("weight", w).withColumn("cap", F.col("source_size").cast("double") * most), "mix-weights")
    total = float(rows.agg(F.sum("source_size")).first()[0] or 0)
    level, capped_before = 0.0, -1
    while True:
        stopped = F.col("cap") <= F.col("weight") * F.lit(level)
        capped, held, open_weight = rows.agg(
            F.coalesce(F.sum(F.when(stopped, 1)), F.lit(0)),
            F.coalesce(F.sum(F.when(stopped, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0.0)),
        ).first()
        if capped == capped_before or not open_weight:
            break
        capped_before, level = capped, (total - held) / open_weight
    target = F.when(stopped, F.col("cap")).otherwise(F.col("weight") * F.lit(level))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def _bits(level: int):
    return F.shiftright(F.col("h"), 60 - BITS * (level + 1)).bitwiseAND(F.lit((1 << BITS) - 1))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole passes, and the hash below which a document is taken once more.

    sized(source, size, h); h has 60 bits. Level by level, the words of each bucket of the open range are summed;
    buckets that fit whole are below the threshold, and the first that doesn't fit is opened next. What is left at
    the end is one hash value, taken if that comes nearer to the target.
    """
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets.withColumn("passes", passes).select(
        "source", "source_size", "target", "passes",
        (F.col("target") - F.col("passes") * F.col("source_size")).alias("left"),
        F.lit(0).cast("long").alias("prefix"),
    )
    state = keep(state, "mix-state")
    for level in range(LEVELS):
        if level == 0:
            open_rows = sized
        else:
            hot = state.select(F.col("source").alias("s_"), F.col("prefix").alias("p_"))
            shift = 60 - BITS * level
            open_rows = sized.withColumn("p", F.shiftright("h", shift)).join(
                hot, F.col("source").eqNullSafe(F.col("s_")) & (F.col("p") == F.col("p_"))
            )
        cells = open_rows.groupBy("source", _bits(level).alias("b")).agg(F.sum("size").alias("words"))
        # At most 2 ** BITS rows a source.
        run = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
        cells = cells.withColumn("upto", F.sum("words").over(run)).select(F.col("source").alias("s_"), "b", "words", "upto")
        fits = F.col("upto") <= F.col("left")
        # The open range holds more than what is left, so some bucket does not fit, but for sources of size 0.
        state = (
            state.join(cells, F.col("source").eqNullSafe(F.col("s_")), "left")
            .groupBy("source", "source_size", "target", "passes", "left", "prefix")
            .agg(
                F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0)).alias("used"),
                F.min(F.when(~fits, F.struct("b", "words"))).alias("open"),
            )
            .withColumn("left", F.col("left") - F.col("used"))
        )
        here = F.shiftleft("prefix", BITS) + F.coalesce(F.col("open.b"), F.lit(0))
        if level == LEVELS - 1:
            here += F.when(F.col("open.words") < 2 * F.col("left"), 1).otherwise(0)
        state = state.select("source", "source_size", "target", "passes", "left", here.alias("prefix"))
        state = keep(state, "mix-state")
    return state.select("source", "source_size", "target", "passes", F.col("prefix").alias("threshold"))


def _hash():
    return F.shiftrightunsigned(F.xxhash64(F.lit("mix"), F.col("doc_id")), 4)


def _decided(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows(source, size, h, ...) with source_size, target and copies. A source's rows are dealt over SALTS keys."""
    salted = plan.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("source", "s_")
    salt = F.pmod("h", F.lit(SALTS)).cast("int")
    once_more = F.when(F.col("h") < F.col("threshold"), 1).otherwise(0)
    copies = F.when(F.col("size") > 0, F.least(F.col("passes") + once_more, F.lit(MOST_PASSES))).otherwise(0)
    return (
        rows.withColumn("salt", salt)
        .join(salted, F.col("source").eqNullSafe(F.col("s_")) & (F.col("salt") == F.col("salt_")))
        .withColumn("copies", copies.cast("long"))
    )


def _sized(docs: DataFrame) -> DataFrame:
    return keep(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), _hash().alias("h")), "mix-sized")


def _plan(sized: DataFrame) -> DataFrame:
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return thresholds(sized.select("source", "size", "h"), with_targets(sources))


def mix_plan(docs: DataFrame) -> DataFrame:
    """(doc_id, text, source, ...) -> (doc_id, source, size, source_size, target, copies, taken), a row per document."""
    sized = _sized(docs)
    rows = _decided(sized, _plan(sized))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: the rows of docs that are taken, all their columns, and `mix_copies`, how often each is taken.

    Rows with the same doc_id and source share one decision.
    """
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns if c != "mix_copies"]).alias("row"), "source",
        n_words(F.col("text")).alias("size"), _hash().alias("h"),
    )
    taken = _decided(rows, _plan(_sized(docs))).filter(F.col("copies") > 0)
    return taken.select("row.*", F.col("copies").alias("mix_copies"))
