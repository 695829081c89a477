"""Benchmark decontamination: MinHash containment search, partitioned by size. DataFrame functions only.

Test items are short, documents long, so that their similarity says nothing; what counts is containment, the share
of an item's distinct 5-word shingles (A-Z in lower case) that a document has.

* Items are partitioned by the power of two of their number of shingles. An item's sketch is its least `m` shingle
  hashes, with m from the partition's largest size: (100 - PERCENT)% of it, and one more. A document that contains
  PERCENT% of an item misses at most that share of its shingles, so it has at least one of the sketch: nothing is
  lost, unlike with a sketch of fixed size.
* A document's sketch are its shingle hashes up to the largest hash in any item's sketch. Where both meet is a candidate.
* Candidates are verified on all shingles: |item and document| / |item|.

The sketches are sent to all executors in blocks of at most MOST_SENT hashes, and so are the shingles of items for the
verification, with one pass over the documents a block. Ids of candidates are sent only if there are few.

Defined cases
-------------
* null and empty texts, and those without words, have no shingles: never contained, never containing.
* a text of under five words has its whole sequence as its one shingle: such an item is only found in a document
  that is that sequence.
* null ids are values like others. Rows that repeat an id and its text give the same pair once; rows of one id with
  different texts are items (or documents) of their own, and their pairs are given separately.
* empty tables give an empty result. Extra columns pass `clean` unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import WORD, keep, lower_ascii

SHINGLE = 5
PERCENT = 75
#: Hashes sent to every executor at once (some 50 MB there), and ids of candidates (some 10 MB).
MOST_SENT = 1_000_000
MOST_IDS = 200_000


def _with_shingles(rows: DataFrame) -> DataFrame:
    """rows(..., text) -> the same without text, exploded to one row per 5-word shingle (h); the whole sequence, if shorter.

    No filter stands here: it would be pushed below joins and split all texts once more.
    """
    others = [c for c in rows.columns if c != "text"]
    words = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(WORD), F.lit(0))
    hashed = rows.select(*others, F.transform(words, lambda w: F.xxhash64(w)).alias("w_"))
    many = F.transform(
        F.sequence(F.lit(0), F.size("w_") - SHINGLE), lambda i: F.xxhash64(*[F.get("w_", i + k) for k in range(SHINGLE)])
    )
    few = F.array(F.xxhash64(F.lit("few"), "w_"))
    return hashed.select(*others, F.explode(F.when(F.size("w_") >= SHINGLE, many).when(F.size("w_") > 0, few)).alias("h"))


def item_sketches(items: DataFrame) -> DataFrame:
    """items(item_id, text, ...) -> item_id, item (key of the row), size, h, in_sketch: all distinct shingles of each item."""
    keyed = items.select("item_id", F.xxhash64("item_id", "text").alias("item"), "text")
    rows = _with_shingles(keyed).distinct()
    own = Window.partitionBy("item")
    rows = rows.withColumn("size", F.count(F.lit(1)).over(own)).withColumn("rank", F.row_number().over(own.orderBy("h")))
    part = F.floor(F.log2("size")).alias("part")
    largest = rows.groupBy(part).agg(F.max("size").alias("largest")).withColumnRenamed("part", "p_")
    missed = F.floor(F.col("largest") * (100 - PERCENT) / 100)
    rows = rows.join(F.broadcast(largest), F.floor(F.log2("size")) == F.col("p_"))  # at most 63 rows
    return rows.select("item_id", "item", "size", "h", (F.col("rank") <= missed + 1).alias("in_sketch"))


def _blocks(hashes: DataFrame) -> list[DataFrame]:
    """Blocks of whole items, of about MOST_SENT rows at most."""
    n = -(-hashes.count() // MOST_SENT)
    return [hashes.filter(F.pmod(F.xxhash64("item", F.lit("block")), F.lit(n)) == k) for k in range(n)] if n > 1 else [hashes]


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, tag (hash of the text), item_id, n_item_shingles, n_shared: pairs with at least PERCENT % containment."""
    items = keep(item_sketches(items), "item-shingles")
    texts = docs.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    found = []
    for block in _blocks(items.filter("in_sketch")):
        bound = block.agg(F.max("h")).first()[0]
        sketch = _with_shingles(texts).filter(F.col("h") <= F.lit(bound if bound is not None else -(1 << 63)))
        found.append(sketch.join(F.broadcast(block.select("h", "item")), "h").select("doc_id", "tag", "item"))
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.unionByName(more)
    candidates = keep(candidates.distinct(), "candidates")

    ids = keep(candidates.select(F.col("doc_id").alias("d_"), F.col("tag").alias("t_")).distinct(), "candidate-ids")
    ids = F.broadcast(ids) if ids.count() <= MOST_IDS else ids
    asked = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("d_")) & (F.col("tag") == F.col("t_")), "left_semi")
    out = None
    for block in _blocks(items):
        shared = _with_shingles(asked).join(F.broadcast(block.select("h", "item", "item_id", "size")), "h").distinct()
        counted = shared.groupBy("doc_id", "tag", "item", "item_id", "size").agg(F.count(F.lit(1)).alias("n_shared"))
        good = counted.filter(100 * F.col("n_shared") >= PERCENT * F.col("size"))
        good = good.join(candidates.select(F.col("doc_id").alias("d_"), F.col("tag").alias("t_"), F.col("item").alias("i_")), (
            F.col("doc_id").eqNullSafe(F.col("d_")) & (F.col("tag") == F.col("t_")) & (F.col("item") == F.col("i_"))
        ), "left_semi")
        good = good.select("doc_id", "tag", "item_id", F.col("size").alias("n_item_shingles"), "n_shared")
        out = good if out is None else out.unionByName(good)
    return out


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs that contain no item."""
    gone = keep(contaminated(docs, items).select(F.col("doc_id").alias("d_"), F.col("tag").alias("t_")).distinct(), "contaminated")
    gone = F.broadcast(gone) if gone.count() <= MOST_IDS else gone
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["d_"]) & (F.xxhash64(docs["text"]) == gone["t_"]), "left_anti")
