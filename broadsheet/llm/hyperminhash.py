"""Near-duplicates by HyperMinHash.

A document's set has the 64-bit hashes of its distinct 5-word shingles. Equal sets are one class, represented by one
row, the class's node; all further work is on these.

* Sketch: a hash's first bits choose a register; of the rest, the least of the register is kept as its number of
  leading zeros (6 bits) and its next 10 bits: 2 bytes a register. Registers that get no hash borrow another's, found
  by a fixed random sequence, so that any register of two sets is equal with the probability of their similarity.
* Bands of ROWS registers are hashed; a band that several nodes have is a bucket. A pair at similarity 0.75 shares none
  of the BANDS buckets with a probability of 1e-6.
* Stars: each member of a bucket is paired with the bucket's least node. The similarity is estimated from the
  registers (equal ones, less those expected to agree by accident); pairs that are below the threshold by more than
  SLACK standard errors go, the others are verified on full sets, and verified links give components.
* Rest: the members of buckets that hold several components are joined with those of other components, exactly but not
  pair by pair. Their shingles are ordered from the rarest to the most common. Two sets can only be similar enough if
  they share one early in that order: shared shingles from place i on can't be more than size - i. So each set shows
  only its rarest shingles, and a shingle joins two sets only if their sizes and its places in both leave room for
  PERCENT. Texts that have a form in common, which is most of them, but nothing rarer, never meet. Pairs that do are
  estimated and verified as above: some of each component first, in DRAWS rounds after which it is joined with what it
  is linked with, then all that are left. So no link between different texts gets lost, as long as they share a bucket.

Hot keys: a star's centre is sent once to each block of TOGETHER members; a shingle's rows are dealt over blocks of
SHOWN; where a class, band or component joins its one row of data, adaptive execution splits the larger side.

Defined cases
-------------
* null or empty text, or one without words: empty set; such a document is its own component and stays.
* under five words: the whole sequence is the one shingle.
* doc_id null: the document is its own component (component_id null) and stays; it is linked with nothing.
* rows that repeat a doc_id are one document, whether their texts are equal or not: what is linked with one of the texts
  is linked with all, they stay or go together, and their component is the same.
* an empty table gives an empty result. Extra columns pass `keep_one` unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrays
from .tables import keep

U = np.uint64
SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
REGISTERS, MANTISSA = 256, 10
ROWS = 5
BANDS = REGISTERS // ROWS
SLACK = 4.5
#: Members that are held against one centre in one go.
TOGETHER = 256
#: Rows of one shingle that a task holds against the others of the shingle.
SHOWN = 1 << 16
#: Rounds in which each component tries this many pairs, before all pairs that are left are gone through.
DRAWS, TRIED = 2, 64

#: Bits of a shingle's hash, of which the first 8 choose the register.
BITS = 64
_REST = BITS - 8


def shingle_sets(chunk: arrays.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of the distinct shingles of a chunk, sorted by both."""
    start, end, doc = chunk.words()
    words = chunk.hashes(start, end)
    found, at = arrays.windows(words, doc, SHINGLE)
    owner = doc[at]
    counts = np.bincount(doc, minlength=chunk.n)
    first = np.cumsum(counts) - counts
    for n in range(1, SHINGLE):
        few = np.flatnonzero(counts == n)
        if len(few):
            total = np.full(len(few), U(n))
            for j in range(n):
                total = arrays.mixed(total + words[first[few] + j])
            found, owner = np.concatenate([found, total]), np.concatenate([owner, few])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], found[new]


def prints(hashes: np.ndarray, off: np.ndarray) -> list[pa.Array]:
    """Two hashes of each set: equal for equal sets."""
    out = []
    for salt in (U(0x243F6A8885A308D3), U(0x13198A2E03707344)):
        total = np.zeros(len(hashes) + 1, U)
        np.cumsum(arrays.mixed(hashes + salt), out=total[1:])
        out.append(pa.array(arrays.signed(total[off[1:]] - total[off[:-1]])))
    return out


def _probes(tries: int) -> np.ndarray:
    at = np.arange(REGISTERS, dtype=U)[:, None] * U(0x9E3779B97F4A7C15) + np.arange(tries, dtype=U) * U(0xD1342543DE82EF95)
    return (arrays.mixed(at + U(1)) % U(REGISTERS)).astype(np.int64)


_TRIES = 4096
_PROBES = _probes(_TRIES)


def registers(doc: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """n rows of REGISTERS registers; rows of empty sets are 0xFFFF."""
    out = np.full((n, REGISTERS), 0xFFFF, np.uint16)
    register = (hashes >> U(_REST)).astype(np.int64)
    cell = doc * REGISTERS + register
    first = np.append(True, cell[1:] != cell[:-1]) if len(cell) else np.zeros(0, bool)
    rest = (hashes[first] & U((1 << _REST) - 1)).astype(np.int64)
    bits = np.frexp(np.where(rest > 0xFF, rest & ~0xFF, rest).astype(np.float64))[1].astype(np.int64)  # bit length; all that a double holds
    zeros = _REST - bits
    below = np.maximum(bits - 1, 0)
    mantissa = np.where(
        below >= MANTISSA, rest >> np.maximum(below - MANTISSA, 0), rest << np.maximum(MANTISSA - below, 0)
    ) & ((1 << MANTISSA) - 1)
    out.ravel()[cell[first]] = (zeros << MANTISSA) | mantissa
    filled = out != 0xFFFF
    row, hole = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for t in range(_TRIES):
        if not len(row):
            break
        source = _PROBES[hole, t]
        ok = filled[row, source]
        out[row[ok], hole[ok]] = out[row[ok], source[ok]]
        row, hole = row[~ok], hole[~ok]
    for r, h in zip(row.tolist(), hole.tolist()):  # not met within all tries: the first that is filled
        out[r, h] = out[r, int(np.argmax(filled[r]))]
    return out


_SKETCH = "doc_id long, n_shingles long, f1 long, f2 long, registers binary"


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ...) -> doc_id, n_shingles, f1, f2 (equal for equal sets), registers (null for empty sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in arrays.chunks(batch.column(1), lower=True):
                for part in _parts(chunk):
                    doc, hashes = shingle_sets(part)
                    n = np.bincount(doc, minlength=part.n)
                    rows = registers(doc, hashes, part.n)
                    width = REGISTERS * 2
                    flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), part.n, [None, pa.py_buffer(rows.tobytes())])
                    flat = pa.array([x if k else None for x, k in zip(flat.to_pylist(), n.tolist())], pa.binary())
                    ids = batch.column(0).slice(part.rows.start, part.n)
                    yield pa.RecordBatch.from_arrays([ids, pa.array(n), *prints(hashes, np.append(0, np.cumsum(n))), flat], names=["doc_id", "n_shingles", "f1", "f2", "registers"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SKETCH)


def _parts(chunk: arrays.Chunk) -> Iterator[arrays.Chunk]:
    """A chunk in pieces of at most 4096 documents."""
    for lo in range(0, chunk.n, 4096):
        hi = min(lo + 4096, chunk.n)
        off = chunk.off[lo : hi + 1]
        yield arrays.Chunk(chunk.data[off[0] : off[-1]], off - off[0], slice(chunk.rows.start + lo, chunk.rows.start + hi))


def _registers_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def accidental(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected share of registers that agree though their hashes differ, of sets with n and m elements."""
    ratio = np.maximum(n, m) / np.maximum(np.minimum(n, m), 1)
    return 0.1699 * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2


def likely(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether sets with this share of equal registers may be linked: the corrected estimate isn't far below."""
    chance = accidental(n, m)
    estimate = (equal - chance) / (1 - chance)
    goal = PERCENT / 100
    error = np.sqrt(goal * (1 - goal) / np.minimum(np.minimum(n, m), REGISTERS))
    return (estimate >= goal - SLACK * error) & (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m))


_PAIRS = "a long, b long"


def _met(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """pairs(a, b) and table(node, columns) -> rows of a, b and b's columns, each block of TOGETHER behind a row of a's own, b null."""
    stars = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / TOGETHER).alias("blocks"))
    members = pairs.join(stars, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block"))
    members = members.join(table.select(F.col("node").alias("b"), *columns), "b").select("a", "block", "b", *columns)
    centres = stars.join(table.select(F.col("node").alias("a"), *columns), "a").select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("long").alias("b"), *columns
    )
    rows = centres.unionByName(members).repartition("a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())
    return rows.select("a", "b", *columns)


def _likely_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """pairs(a, b) whose estimate allows a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # registers and size of the centre that is on
        for batch in batches:
            if not batch.num_rows:
                continue
            regs, n = _registers_of(batch.column(3)), batch.column(2).to_numpy()
            is_centre = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            if last is not None:
                regs, n, is_centre = np.concatenate([last[0][None], regs]), np.append(last[1], n), np.append(True, is_centre)
            skip = len(n) - batch.num_rows
            centre = np.maximum.accumulate(np.where(is_centre, np.arange(len(n)), 0))
            last = regs[centre[-1]], n[centre[-1]]
            at = np.flatnonzero(~is_centre)
            ok = likely((regs[at] == regs[centre[at]]).mean(axis=1), n[at], n[centre[at]])
            rows = pa.array(at[ok] - skip)
            yield pa.RecordBatch.from_arrays([batch.column(i).take(rows) for i in (0, 1)], names=["a", "b"])

    return _met(pairs, nodes, "n_shingles", "registers").mapInArrow(run, _PAIRS)


def _sets(texts: DataFrame) -> DataFrame:
    """texts(doc_id, text) -> doc_id, f1, f2, hashes: the full sets, 8 bytes a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in arrays.chunks(batch.column(1), lower=True):
                for part in _parts(chunk):
                    doc, hashes = shingle_sets(part)
                    off = np.searchsorted(doc, np.arange(part.n + 1))
                    packed = [hashes[a:b].tobytes() for a, b in zip(off, off[1:])]
                    ids = batch.column(0).slice(part.rows.start, part.n)
                    yield pa.RecordBatch.from_arrays([ids, *prints(hashes, off), pa.array(packed, pa.binary())], names=["doc_id", "f1", "f2", "hashes"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, f1 long, f2 long, hashes binary")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if not len(small) or 100 * len(small) < PERCENT * len(large):
        return False
    common = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs(a, b) that are links on their full sets. sets(node, hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = np.zeros(0, U)
        for batch in batches:
            a, b, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for i, data in enumerate(batch.column(2)):
                own = np.frombuffer(data.as_buffer(), U)
                if b[i] is None:
                    centre = own
                elif linked(centre, own):
                    out.append((a[i], b[i]))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return _met(pairs, sets, "hashes").mapInArrow(run, _PAIRS)


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> (node, label): the least node that can be reached, for all nodes of links.

    Labels go along links and then from label to label, so that a chain's length doesn't count but as a logarithm.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct()
    both = keep(both.select(F.col("a").alias("node"), F.col("b").alias("other")), "links")
    labels = keep(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("m"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "m").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        step = step.join(jump, "new").select("node", "label", F.least("new", "far").alias("new"))
        step = keep(step, "labels")
        changed = step.filter(F.col("label") != F.col("new")).limit(1).count()
        labels = step.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def _labelled(rows: DataFrame, labels: DataFrame, by: str) -> DataFrame:
    found = labels.select(F.col("node").alias(by), F.col("label").alias("found"))
    return rows.join(found, by, "left").withColumn("label", F.coalesce("found", by)).drop("found")


def _shown(buckets: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """h, node, label, n, room: the rarest shingles of each member of buckets that hold several components."""
    rows = _labelled(buckets, labels, "node")
    several = rows.groupBy("band").agg((F.min("label") != F.max("label")).alias("several")).filter("several").select("band")
    members = keep(rows.join(several, "band").select("node", "label").distinct(), "rest-members")

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, labels_ = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data = batch.column(2).cast(pa.large_binary())
            n = pc.binary_length(data).to_numpy() // 8
            flat = np.frombuffer(b"".join(data.to_pylist()), np.int64)
            ends = np.cumsum(n)
            lo = 0
            while lo < len(n):  # some 100 000 shingles at a time
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + 100_000, side="right")))
                own = flat[ends[lo] - n[lo] : ends[hi - 1]]
                columns = [own, *(np.repeat(x[lo:hi], n[lo:hi]) for x in (nodes, labels_, n))]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["h", "node", "label", "n"])
                lo = hi

    shingles = members.join(sets.select("node", "hashes"), "node").select("node", "label", "hashes")
    shingles = keep(shingles.mapInArrow(exploded, "h long, node long, label long, n long"), "rest-shingles")
    common = shingles.groupBy("h").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    order = Window.partitionBy("node").orderBy(F.coalesce("times", F.lit(1)), "h")  # the shingles of one text
    placed = shingles.join(common, "h", "left").withColumn("at", F.row_number().over(order) - 1)
    # Shared shingles from place `at` on are `left` at most; with sets of n and m, PERCENT of the union asks for
    # (100 + PERCENT) * shared >= PERCENT * (n + m): so a partner has `room` shingles at most, and PERCENT of n at least.
    left = F.col("n") - F.col("at")
    room = F.floor((100 + PERCENT) * left / PERCENT) - F.col("n")
    shown = placed.filter("times > 1").withColumn("room", room).filter(100 * F.col("room") >= PERCENT * F.col("n"))
    return keep(shown.select("h", "node", "label", "n", "room"), "rest-shown")


def _picked(shown: DataFrame, round_: int) -> DataFrame:
    """Some pairs, TRIED a component: members of a shingle with one of them, drawn by shingle and round. As many rows as shown has."""
    drawn = F.min_by(F.struct("node", "label", "n", "room"), F.xxhash64(F.lit(round_), "h", "node"))
    centres = shown.filter("room >= n").groupBy("h").agg(drawn.alias("c"))
    found = shown.join(centres, "h").filter((F.col("label") != F.col("c.label")) & (F.col("n") <= F.col("c.room")) & (F.col("c.n") <= F.col("room")))
    pairs = found.select("label", "node", F.col("c.node").alias("other")).distinct()
    tried = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64(F.lit(round_), "node", "other")))
    pairs = pairs.withColumn("k", tried).filter(F.col("k") <= TRIED)
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _rest(shown: DataFrame) -> DataFrame:
    """All pairs of different components whose sizes and rarest shingles allow a link."""
    # Of a pair, the smaller set must have room for the larger one: for a set of its own size, at least.
    fits = shown.groupBy("h").agg(F.count(F.lit(1)).alias("all"), F.count(F.when(F.col("room") >= F.col("n"), 1)).alias("small"))
    fits = fits.filter("all > 1 and small > 0").select("h", F.ceil(F.col("small") / SHOWN).alias("blocks"))
    shown = keep(shown.join(fits, "h"), "rest-shown")
    small = shown.filter("room >= n").select(
        "h", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"), *(F.col(c).alias(f"{c}_") for c in ("node", "label", "n", "room"))
    )
    large = shown.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    first = (F.col("n_") < F.col("n")) | ((F.col("n_") == F.col("n")) & (F.col("node_") < F.col("node")))
    allowed = (F.col("n") <= F.col("room_")) & (F.col("n_") <= F.col("room")) & (100 * F.col("n_") >= PERCENT * F.col("n")) & (F.col("label") != F.col("label_"))
    found = large.join(small, ["h", "block"]).filter(first & allowed)
    return found.select(F.least("node", "node_").alias("a"), F.greatest("node", "node_").alias("b")).distinct()


def _joined(labels: DataFrame, more: DataFrame) -> DataFrame:
    """labels(node, label) with the links of `more`: components of components."""
    ends = _labelled(_labelled(more, labels, "a").select(F.col("label").alias("a"), "b"), labels, "b").select("a", F.col("label").alias("b"))
    top = components(ends.filter("a != b"))
    old = _labelled(labels.withColumnRenamed("label", "mid"), top, "mid").select("node", "label")
    return keep(old.unionByName(top.join(labels, "node", "left_anti")), "labels")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row per row of docs."""
    rows = keep(sketches(docs).withColumn("row", F.monotonically_increasing_id()), "sketches")  # numbered once and for all
    full = rows.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = keep(full.groupBy("f1", "f2").agg(F.min("row").alias("node"), F.min("doc_id").alias("least")), "classes")
    nodes = full.join(classes.select("node"), full["row"] == classes["node"])
    nodes = keep(nodes.select("node", "doc_id", "f1", "f2", "n_shingles", "registers"), "nodes")

    band = lambda k: F.xxhash64(F.lit(k), F.substring("registers", 2 * ROWS * k + 1, 2 * ROWS))
    bands = nodes.select("node", F.explode(F.array(*[band(k) for k in range(BANDS)])).alias("band"))
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("centre")).filter("n > 1")
    buckets = keep(bands.join(shared.select("band", "centre"), "band"), "buckets")

    # Only documents of some bucket are compared; their texts are fetched once, and told by their prints if an id has several.
    compared = keep(nodes.join(buckets.select("node").distinct(), "node"), "compared")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(compared.select("doc_id").distinct(), "doc_id")
    sets = keep(compared.join(_sets(texts), ["doc_id", "f1", "f2"]).dropDuplicates(["node"]), "compared-sets")

    stars = buckets.filter("node != centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    links = _verified(keep(_likely_pairs(stars, compared), "stars"), sets)
    labels = components(keep(links.unionByName(_same_id(full, classes)), "star-links"))
    shown = _shown(buckets, labels, sets)
    # Families of near copies that fell apart into many components are put together first, so that few pairs are left to go through.
    for k in range(DRAWS):
        pairs = keep(_picked(shown, k), "rest-picked")
        labels = _joined(labels, keep(_verified(keep(_likely_pairs(pairs, compared), "rest-likely"), sets), "rest-links"))
        shown = keep(_labelled(shown.drop("label"), labels, "node"), "rest-shown")
    pairs = keep(_rest(shown), "rest-pairs")
    labels = _joined(labels, keep(_verified(keep(_likely_pairs(pairs, compared), "rest-likely"), sets), "rest-links"))
    linked_ = labels.join(classes.select("node", "least"), "node")
    least = linked_.groupBy("label").agg(F.min("least").alias("component_id"))
    found = labels.join(least, "label").select("node", "component_id")
    of_class = classes.join(found, "node", "left").select("f1", "f2", F.coalesce("component_id", "least").alias("found"))
    out = rows.join(of_class, ["f1", "f2"], "left").withColumn(
        "component_id", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("found")).otherwise(F.col("doc_id"))
    )
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _same_id(full: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of ids that have several texts."""
    several = full.groupBy("doc_id").agg(F.min("f1").alias("x"), F.max("f1").alias("y"), F.min("f2").alias("z"), F.max("f2").alias("w"))
    several = several.filter("x != y or z != w").select("doc_id")
    own = full.join(several, "doc_id").select("doc_id", "f1", "f2").distinct().join(classes, ["f1", "f2"]).select("doc_id", "node")
    first = own.groupBy("doc_id").agg(F.min("node").alias("a"))
    return first.join(own, "doc_id").filter("a != node").select("a", F.col("node").alias("b"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs that are the first of their component."""
    gone = near_duplicates(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_"], "left_anti")
