"""Filter interaction audit: what five filters remove, in each of their 120 orders, by a Walsh-Hadamard transform.

A document's failures are a mask of five bits. Per part and label (all documents, good ones, toxic ones) the 32 signed
parity sums S[u] = sum of (-1) ** bits(u & mask) are one aggregate; as the transform is its own inverse but for a
factor, n[m] = sum of (-1) ** bits(u & m) * S[u] / 32 are exact counts of documents by mask. All else follows from 32
counts a part: what an order removes at a step, and how much of it alone, is a sum over masks; and as each failure of a
document comes first in 120 / failures of all orders, Shapley values need no order.

Copies are found by a digest of 256 bits: the least id of a digest is one aggregate with partial sums in each task, and
an id is joined with it by (digest, id), so that rows of a frequent text don't meet anywhere.

Defined cases
-------------
* null text is empty; an empty text fails A alone, unless it is a copy. null lang is the part "".
* null doc_id: neither a copy nor copied, and without labels. Repeated rows count as often as they stand there; rows of
  one id aren't copies of each other.
* several labels of one id: any of them counts. A null label is none.
* an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import keep

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
#: A, B, C: least words, least share of distinct words, largest share of capitals.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
SYMBOLS = r"[#$%&*|]"
LABELS = ("all", "good", "toxic")


def failures(docs: DataFrame) -> DataFrame:
    """docs -> doc_id, part, digest, mask (bits of A to D)."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    conditions = [
        n < LEAST_WORDS,
        100 * distinct.cast("long") < LEAST_DISTINCT * n.cast("long"),
        100 * capitals.cast("long") > MOST_CAPITALS * F.length(text).cast("long"),
        F.rlike(text, F.lit(SYMBOLS)),
    ]
    mask = F.lit(0)
    for i, failed in enumerate(conditions):
        mask = mask + F.when(failed, 1 << i).otherwise(0)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        mask.alias("mask"),
    )


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bits of A to E), good, toxic of every row."""
    rows = keep(failures(docs), "audit-failures")
    known = rows.filter("doc_id is not null")
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    copied = F.when(F.col("is_first"), 0).otherwise(1 << FILTERS.index("E"))
    no = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    found = known.join(firsts, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    found = found.select("part", (F.col("mask") + copied).alias("mask"), no("good"), no("toxic"))
    return found.unionByName(rows.filter("doc_id is null").select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic")))


def _parity(u: Column | int, m: Column) -> Column:
    """(-1) ** (number of bits that u and m share)."""
    return 1 - 2 * (F.bit_count(m.bitwiseAND(u)) % 2)


def parity_sums(rows: DataFrame) -> DataFrame:
    """masks -> part, label, sums (32 signed parity sums)."""
    labels = F.array(F.lit("all"), *[F.when(F.col(x), x) for x in LABELS[1:]])
    told = rows.select("part", "mask", F.explode(F.array_compact(labels)).alias("label"))
    sums = told.groupBy("part", "label").agg(*[F.sum(_parity(u, F.col("mask")).cast("long")).alias(f"s{u}") for u in range(MASKS)])
    return sums.select("part", "label", F.array(*[f"s{u}" for u in range(MASKS)]).alias("sums"))


def cells(sums: DataFrame) -> DataFrame:
    """parity_sums -> part and, by label, an array of the number of documents of each mask."""
    zero = F.lit(0).cast("long")
    signed = lambda m: F.transform("sums", lambda s, u: s * _parity(u, m))
    count = F.transform(F.sequence(F.lit(0), F.lit(MASKS - 1)), lambda m: F.call_function("div", F.aggregate(signed(m), zero, lambda a, x: a + x), F.lit(MASKS)))
    none = F.array_repeat(zero, MASKS)
    counted = sums.withColumn("count", count)
    return counted.groupBy("part").agg(*[F.coalesce(F.max(F.when(F.col("label") == x, F.col("count"))), none).alias(x) for x in LABELS])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs(doc_id, text, lang), labels(doc_id, quality, toxic) -> a row per part, order of the filters and step."""
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    bit = lambda i: F.call_function("shiftleft", F.lit(1), F.ascii(F.substr("filter_order", i, F.lit(1))) - ord(FILTERS[0]))
    earlier = F.aggregate(F.filter(steps, lambda i: i < F.col("step")), F.lit(0), lambda a, i: a.bitwiseOR(bit(i)))
    rows = cells(parity_sums(masks(docs, labels))).withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(steps))
    rows = rows.withColumns({"own": bit(F.col("step")), "before": earlier})

    def total(label: str, holds, times=lambda m: F.lit(1)) -> Column:
        """Documents whose mask m fulfils holds(m), each counted times(m)."""
        each = F.transform(label, lambda n, m: F.when(holds(m), n * times(m)).otherwise(0))
        return F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)

    fails = lambda m: m.bitwiseAND(F.col("own")) != 0
    gone = lambda m: m.bitwiseAND(F.col("before")) != 0
    here = lambda m: fails(m) & ~gone(m)
    return rows.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        total("all", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total("all", here).alias("removed"),
        total("all", lambda m: fails(m) & gone(m)).alias("redundant"),
        total("all", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        total("all", fails, lambda m: F.call_function("div", F.lit(120), F.bit_count(m))).alias("shapley"),
    )
