"""Boxes on scans: columns by density and the reading order from them; intervals that overlap and nearest places on a line.

`overlapping` and `nearest` are joins for groups of any size. The boxes of one scan meet in one task: they come sorted by
scan, and go through `placed` one scan at a time, where each wide box counts those before it.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Which boxes count as wide, and what is read from the top edge.
NARROW_PERCENTILE, WIDE_RATIO = 0.25, 1.4
PICTURES = ("Photograph or illustration", "Cartoon")
LEAST_CLUSTER = 2
KINDS = ("core", "rest", "wide")


def overlapping(a: DataFrame, b: DataFrame, by: str, width: float) -> DataFrame:
    """Pairs of rows of a and b with one `by` whose intervals [left, right] have a place in common, ends included.

    A range join by bins: an interval stands in all bins of `width` that it touches, bins are joined by equality, and a
    pair counts in the first bin that both touch, so it comes out once. Both have columns `by`, left, right; those of b
    come out with the suffix _b. Intervals whose end is before their start, or null, overlap nothing.
    """
    at = lambda c: F.floor(F.col(c) / width)
    dealt = lambda rows: rows.filter("left <= right").withColumn("bin_", F.explode(F.sequence(at("left"), at("right"))))
    renamed = b.select(by, *[F.col(c).alias(f"{c}_b") for c in b.columns if c != by])
    other = renamed.filter("left_b <= right_b").withColumn("bin_", F.explode(F.sequence(at("left_b"), at("right_b"))))
    pairs = dealt(a).join(other, [by, "bin_"]).filter("left <= right_b and right >= left_b")
    return pairs.filter(F.col("bin_") == F.greatest(at("left"), at("left_b"))).drop("bin_")


def nearest(points: DataFrame, targets: DataFrame, by: str, width: float) -> DataFrame:
    """points(by, x, ...) with `target` (the struct of x, first, value) of the nearest of targets(by, x, first, value); ties go to the least `first`.

    No pairs: points and targets are dealt by `by` and cells of `width`; in a cell the last target before and the first one after
    come from two windows, and beyond it from those of the nearest cells that have targets. A group of any size is
    spread over its cells. Rows without a target in their group, or without x, have null.
    """
    cell = F.floor(F.col("x") / width).alias("cell_")
    own = F.struct(F.col("x"), F.col("first"), F.col("value"))
    there = targets.dropna(subset=["x", by]).select(by, cell, own.alias("t_"))
    # The one of equal places that counts is that of the least `first`: the last in this order from the left, the first from the right.
    low = F.struct(F.col("t_.x"), F.col("t_.first"))
    high = F.struct(F.col("t_.x"), -F.col("t_.first"))
    ends = there.groupBy(by, "cell_").agg(F.min_by("t_", low).alias("low"), F.max_by("t_", high).alias("high"))
    numbered = points.withColumn("cell_", F.when(F.col("x").isNotNull(), cell))
    cells = numbered.select(by, "cell_").distinct().join(ends, [by, "cell_"], "full")
    line = Window.partitionBy(by).orderBy("cell_")
    cells = cells.select(
        F.col(by).alias("by_"), F.col("cell_").alias("c_"),
        F.last("high", True).over(line.rowsBetween(Window.unboundedPreceding, -1)).alias("before_"),
        F.first("low", True).over(line.rowsBetween(1, Window.unboundedFollowing)).alias("after_"),
    )
    rows = numbered.select(by, "cell_", F.col("x").alias("x_"), F.lit(None).cast("long").alias("first_"), F.struct(*points.columns).alias("row_"), F.lit(None).cast(there.schema["t_"].dataType).alias("t_"))
    rows = rows.unionByName(there.select(by, "cell_", F.col("t_.x").alias("x_"), F.col("t_.first").cast("long").alias("first_"), F.lit(None).cast(rows.schema["row_"].dataType).alias("row_"), "t_"))
    inside = Window.partitionBy(by, "cell_")
    left = F.last("t_", True).over(inside.orderBy("x_", F.col("first_").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    right = F.first("t_", True).over(inside.orderBy("x_", F.col("first_").asc_nulls_first()).rowsBetween(0, Window.unboundedFollowing))
    found = rows.withColumns({"left_": left, "right_": right}).filter("row_ is not null")
    found = found.join(cells, (F.col(by) == F.col("by_")) & (F.col("cell_") == F.col("c_")), "left")
    left, right = F.coalesce("left_", "before_"), F.coalesce("right_", "after_")
    told = lambda t: F.when(t.isNotNull(), F.struct(F.abs(t["x"] - F.col("x_")).alias("far"), t["first"].alias("first"), t.alias("t")))
    best = F.least(told(left), told(right))
    return found.select("row_.*", F.when(F.col("x_").isNotNull(), best["t"]).alias("target"))


def clusters(x: list[float]) -> list[int]:
    """The cluster of each place of a sorted list, numbered from the left, or -1 for noise: density clustering in one dimension.

    Neighbours within a cluster of two need no more than their distance, so the mutual reachability of two places is their
    distance, and the spanning tree has the gaps between neighbours as edges. Merged from the least gap, of equal ones
    from the left, they give a tree, of which only parts of LEAST_CLUSTER places or more are clusters; a cluster's excess of
    mass is the sum, over its places, of 1 / gap at which they leave it less that at which it begins, and the set of
    clusters of the largest excess is taken. The whole is never a cluster.
    """
    n = len(x)
    if n < 2:
        return [-1] * n
    # Each span of places is split at its last merged edge; a node of the tree is (first, last place, edge) and its parts.
    edges = sorted(range(n - 1), key=lambda i: (x[i + 1] - x[i], i))
    first, last, top = list(range(n)), list(range(n)), [-1] * n  # first: by a part's last place; last and top edge: by its first
    parts: dict[int, tuple[int, int, int, int]] = {}  # edge -> first, last place, top edges of both sides
    for e in edges:
        a, z = first[e], last[e + 1]
        parts[e] = (a, z, top[a], top[e + 1])
        first[z], last[a], top[a] = a, z, e
    at = lambda e: 1 / (x[e + 1] - x[e]) if x[e + 1] > x[e] else float("inf")
    spans, births, mass, parents = [(0, n - 1)], [0.0], [0.0], [-1]
    stack = [(edges[-1], 0)]
    while stack:
        e, cluster = stack.pop()
        a, z, left, right = parts[e]
        sizes = (e - a + 1, z - e)
        both = min(sizes) >= LEAST_CLUSTER
        leaving = sum(sizes) if both else sum(s for s in sizes if s < LEAST_CLUSTER)
        mass[cluster] += (at(e) - births[cluster]) * leaving
        for edge, span, size in ((left, (a, e), sizes[0]), (right, (e + 1, z), sizes[1])):
            if size >= LEAST_CLUSTER:
                inner = cluster
                if both:
                    inner = len(spans)
                    spans.append(span), births.append(at(e)), mass.append(0.0), parents.append(cluster)
                stack.append((edge, inner))
    best, chosen, below = list(mass), [False] * len(spans), [0.0] * len(spans)
    for c in range(len(spans) - 1, 0, -1):  # parts come after what they are parts of
        chosen[c] = not below[c] > mass[c]
        best[c] = mass[c] if chosen[c] else below[c]
        below[parents[c]] += best[c]
    out, under = [-1] * n, [False] * len(spans)
    for c in range(1, len(spans)):
        under[c] = under[parents[c]] or chosen[parents[c]]
        if chosen[c] and not under[c]:
            for i in range(spans[c][0], spans[c][1] + 1):
                out[i] = spans[c][0]
    number = {k: i for i, k in enumerate(sorted({k for k in out if k >= 0}))}
    return [number.get(k, -1) for k in out]


class _Places:
    """Places on a line with a value each: the value of the nearest one; of equally near ones, that of the first given."""

    def __init__(self, places: list[float], values: list[int]):
        first: dict[float, int] = {}
        for i, p in enumerate(places):
            first.setdefault(p, i)
        self.line = sorted(first)
        self.first, self.values, self.known = first, values, {}

    def nearest(self, x: float) -> int:
        if (found := self.known.get(x)) is None:
            line, right = self.line, bisect_left(self.line, x)
            left = right - 1
            least = min(abs(line[i] - x) for i in (left, right) if 0 <= i < len(line))
            near = []
            while left >= 0 and abs(line[left] - x) == least:
                near.append(self.first[line[left]])
                left -= 1
            while right < len(line) and abs(line[right] - x) == least:
                near.append(self.first[line[right]])
                right += 1
            found = self.known[x] = self.values[min(near)]
        return found


def placed(left: np.ndarray, top: np.ndarray, right: np.ndarray, bottom: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Column and kind (a place in KINDS) of each box of a scan, in the order of their ids."""
    n, width = len(left), right - left
    narrow = width <= np.percentile(width, 100 * NARROW_PERCENTILE) * WIDE_RATIO
    x = (left + right) / 2
    some = np.flatnonzero(narrow)
    core = some[content[some]]
    if len(some) < 2:
        return np.zeros(n, np.int32), np.zeros(n, np.int8)
    core = core if len(core) >= 2 else some

    order = core[np.argsort(x[core], kind="stable")]
    label = np.full(n, -1)
    label[order] = clusters(x[order].tolist())
    sure = core[label[core] >= 0]
    known = _Places(x[sure].tolist(), label[sure].tolist()) if len(sure) else _Places([0.0], [0])
    for i in core[label[core] < 0].tolist():
        label[i] = known.nearest(x[i].item())

    _, first, at = np.unique(label[core], return_index=True, return_inverse=True)
    label[core] = np.argsort(np.argsort(first))[at]  # numbered as they come
    own = lambda boxes: np.split(boxes[np.argsort(label[boxes], kind="stable")], np.cumsum(np.bincount(label[boxes], minlength=len(first)))[:-1])
    columns = own(core)
    centres = _Places([float(np.mean(x[c])) for c in columns], list(range(len(columns))))
    rest = np.flatnonzero(narrow & (label < 0))
    for i in rest.tolist():
        label[i] = centres.nearest(x[i].item())
    columns = [np.concatenate(c) for c in zip(columns, own(rest), strict=True)]

    # Wide boxes join the column they touch that has most boxes above them, earlier wide ones included.
    sides = sorted(range(len(columns)), key=lambda k: float(np.mean(x[columns[k]])))
    lowest, highest = (np.array([f(edge[columns[k]]) for k in sides]) for f, edge in ((np.min, left), (np.max, right)))
    bottoms = [np.sort(bottom[columns[k]]).tolist() for k in sides]
    wide = np.flatnonzero(~narrow)
    for i in wide.tolist():
        touched, upper = np.flatnonzero((left[i] <= highest) & (right[i] >= lowest)).tolist(), top[i].item()
        side = max(touched, key=lambda c: bisect_left(bottoms[c], upper)) if touched else 0  # noqa: B023
        insort(bottoms[side], bottom[i].item())
        label[i] = sides[side]
    columns = [np.concatenate(c) for c in zip(columns, own(wide), strict=True)]

    ranked = sorted(range(len(columns)), key=lambda k: np.mean(x[columns[k]]))
    col, kind = np.zeros(len(columns), np.int32), np.full(n, KINDS.index("rest"), np.int8)
    col[ranked] = np.arange(len(columns))
    kind[core], kind[wide] = KINDS.index("core"), KINDS.index("wide")
    return col[label], kind


def columns(crops: DataFrame) -> DataFrame:
    """crops(scan_id, crop_id, box, category) -> scan_id, crop_id, col (0 is the leftmost by its mean middle), kind (core, rest, wide).

    Boxes of up to 1.4 times the width of the scan's lower quartile are narrow. Narrow boxes of content are clustered by
    their middle (all narrow ones where fewer than two are of content, and without two of these all boxes are one column);
    noise goes to the nearest clustered box, other narrow boxes to the nearest column, wide ones to the column they touch
    that has most boxes above them, or else to the leftmost. Ties go to what comes first by crop_id, and among columns that a
    wide box touches to the leftmost. A task holds the boxes of one scan and of one batch; boxes without four numbers are left out.
    """
    at = lambda i, name: F.get(F.col("box"), F.lit(i)).cast("double").alias(name)
    boxes = crops.select("scan_id", "crop_id", at(0, "left"), at(1, "top"), at(2, "right"), at(3, "bottom"), F.coalesce(F.col("category") == "Content", F.lit(False)).alias("content"))
    boxes = boxes.dropna(subset=["left", "top", "right", "bottom"])
    kinds = {f.name: f.dataType.simpleString() for f in crops.schema.fields}
    names = ["scan_id", "crop_id", "col", "kind"]

    def of_scans(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
        """Whole scans, which begin and end at edges."""
        sides = [table[c].to_numpy() for c in ("left", "top", "right", "bottom")]
        content = table["content"].to_numpy()
        found = [placed(*(c[a:b] for c in sides), content[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        col, kind = (np.concatenate(c) for c in zip(*found, strict=True))
        kind = pa.DictionaryArray.from_arrays(pa.array(kind), pa.array(KINDS)).cast(pa.string())
        whole = [table[c].combine_chunks() for c in names[:2]]
        return pa.RecordBatch.from_arrays([*whole, pa.array(col), kind], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the scan that isn't over yet
        for batch in batches:
            if not batch.num_rows:
                continue
            scan = batch["scan_id"]
            if held and scan[0] != held[-1]["scan_id"][-1]:
                table = pa.Table.from_batches(held)
                yield of_scans(table, np.array([0, len(table)]))
                held = []
            # The first box of each scan; null is a scan, too.
            new = pc.fill_null(pc.not_equal(scan[1:], scan[:-1]), False).to_numpy(zero_copy_only=False) | np.diff(scan.is_null().to_numpy(zero_copy_only=False))
            first = np.flatnonzero(new) + 1
            held.append(batch)
            if len(first):
                before = sum(b.num_rows for b in held[:-1])
                table = pa.Table.from_batches([*held[:-1], batch.slice(0, first[-1])])
                yield of_scans(table, np.concatenate([[0], first + before]))
                held = [batch.slice(first[-1])]
        if held:
            table = pa.Table.from_batches(held)
            yield of_scans(table, np.array([0, len(table)]))

    dealt = boxes.repartition("scan_id").sortWithinPartitions("scan_id", "crop_id", "left", "top", "right", "bottom", "content")
    return dealt.mapInArrow(run, f"scan_id {kinds['scan_id']}, crop_id {kinds['crop_id']}, col int, kind string")


def reading_order(crops: DataFrame) -> DataFrame:
    """crops(scan_id, crop_id, scan_width, box, category, text) with `col` and reading_order 1, 2, ... on each scan.

    Left edges are put into 10 parts of the scan's width (12 over 40 boxes, 15 over 80); in one the order is from the top, by the middle of a
    box but the upper edge of a picture, and texts that begin in lower case come after others at the same height. What
    remains equal goes by column from the left, and in it from the top; two boxes alone that stand side by side go from the left, others
    from the top, and of two equal ones the later goes first.
    """
    at = lambda i: F.get(F.col("box"), F.lit(i)).cast("double")
    scan = Window.partitionBy("scan_id")
    keyed = crops.join(columns(crops), ["scan_id", "crop_id"]).withColumns({"_x": (at(0) + at(2)) / 2, "_m": (at(1) + at(3)) / 2, "_n": F.count(F.lit(1)).over(scan)})
    picture = F.coalesce(F.col("category").isin(*PICTURES), F.lit(False))
    goes_on = F.when(F.coalesce(F.col("text").rlike(r"^\s*\p{Ll}"), F.lit(False)), 1).otherwise(0)
    parts = F.when(F.col("_n") > 80, 15).when(F.col("_n") > 40, 12).otherwise(10)
    spread = lambda c: F.max(c).over(scan) - F.min(c).over(scan)
    beside: Column = (F.col("_n") == 2) & (spread("_m") < spread("_x") * 0.5)
    keyed = keyed.withColumns(
        {"_b": (at(0) / F.col("scan_width") * parts).cast("int"), "_y": F.when(picture, at(1)).otherwise(F.col("_m")), "_c": goes_on,
         "_t": F.when(beside, F.col("_x")).when(F.col("_n") == 2, F.col("_m")).otherwise(F.col("col").cast("double"))}
    )
    place = {"core": 0, "rest": 1, "wide": 2}
    kind = F.element_at(F.create_map(*[F.lit(v) for kv in place.items() for v in kv]), F.col("kind"))
    pair = F.col("_n") == 2
    order = scan.orderBy("_b", "_y", "_c", "_t", "_m", F.when(pair, 0).otherwise(kind), F.when(pair, -F.col("crop_id")).otherwise(F.col("crop_id")))
    return keyed.withColumn("reading_order", F.row_number().over(order)).drop("_x", "_m", "_n", "_b", "_y", "_c", "_t", "kind")
