"""Operators on ordered rows: batches, packing, transitions, markers, reading order."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Items that `lightest_first` deals at most.
MOST_ITEMS = 1_000_000


def numbered(rows: DataFrame, order: str, name: str = "pos") -> DataFrame:
    """Rows with their place 0, 1, ... in the order of a unique column, without bringing them into one task.

    Ranges of the column are numbered apart; the sum of the sizes of the ranges before it is added to each.
    """
    dealt = rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("_part", F.spark_partition_id())
    dealt = dealt.withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row a partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    out = dealt.join(F.broadcast(starts), F.col("_part") == F.col("_p"))
    return out.withColumn(name, F.col("_start") + F.col("_at")).drop("_part", "_p", "_at", "_start")


def batches(rows: DataFrame, order: str, size: int) -> DataFrame:
    """batch 0, 1, ... of `size` rows each in the order of a unique column."""
    return numbered(rows, order).withColumn("batch", F.floor(F.col("pos") / size)).drop("pos")


def _ranged(rows: DataFrame, keys: list[str], ranges: int) -> DataFrame:
    """rows with `range_`, 0, 1, ... in the order of keys, of about equal numbers of rows; the same each time it is read."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    key = F.struct(*keys)
    dealt = rows.select(key.alias("key_")).repartitionByRange(ranges, "key_").groupBy(F.spark_partition_id()).agg(F.min("key_").alias("key_"))
    first = sorted((r["key_"] for r in dealt.collect()), key=lambda k: tuple((v is not None, v) for v in k))  # a key a range
    if not first:
        return rows.withColumn("range_", F.lit(0))
    bounds = F.array(*[F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(keys, k, strict=True)]) for k in first])
    return rows.withColumn("range_", F.size(F.filter(bounds, lambda b: b <= key)))


def _after(total: np.ndarray, limit: int) -> np.ndarray:
    """For each group the first one that isn't in the chunk that begins with it; total: sums up to and with each group."""
    before = np.concatenate([[0], total[:-1]])
    too_much = np.searchsorted(total, before + limit, side="right")
    some = np.searchsorted(total, before, side="right") + 1  # a chunk of nothing takes any group
    return np.minimum(np.maximum(too_much, some), len(total))


def _left_by_range(sizes: np.ndarray, limit: int) -> list[tuple[int, int, int]]:
    """What a range makes of the sum of the chunk that is open before it.

    (above, sum left, chunks begun), by `above`: the first row is for a sum of 0, others for sums over `above`, up to the next row's. A row that
    begins no chunk leaves the open sum and its own. A chunk can only begin first within the first `limit` of the range, so there are few.
    """
    total = np.cumsum(sizes)
    n, after = len(sizes), _after(total, limit)
    left, begun = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    for j in range(n - 1, -1, -1):
        k = after[j]
        left[j], begun[j] = (total[-1] - total[j] + sizes[j], 1) if k == n else (left[k], begun[k] + 1)
    k = int(after[0])
    out = [(-1, int(total[-1]) if k == n else int(left[k]), 0 if k == n else int(begun[k]))]
    places = [j for j in range(n) if (j == 0 or total[j] > total[j - 1]) and total[j] - sizes[j] < limit]
    if total[-1] < limit:
        out.append((0, int(total[-1]), 0))
    out += [(max(0, limit - int(total[j])), int(left[j]), int(begun[j])) for j in reversed(places)]
    return out


def packed(groups: DataFrame, partition: str, order: str, size: str, limit: int, ranges: int = 64) -> DataFrame:
    """Whole groups into chunks, in order: a chunk is closed when the next group would pass the limit; a larger group stands alone.

    Where a chunk begins depends on all before it. Groups are dealt into ranges of their order, and each range tells what sum it
    leaves for every sum it can be entered with, which is a table of at most limit + 2 rows. A partition's tables, one a
    range, are gone through in order; then each range, which knows now what it begins with, numbers its groups. No task
    holds more than a range, or the tables of one partition. A null size is 0; partition and order together are unique.
    """
    kinds = {f.name: f.dataType.simpleString() for f in groups.schema.fields}
    rows = _ranged(groups.select(partition, order, F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size_")), [partition, order], ranges)
    nulls_first = [(partition, "ascending", "at_start"), (order, "ascending", "at_start")]

    def by_partition(table: pa.Table) -> Iterator[tuple[object, np.ndarray, pa.Table]]:
        table = table.take(pc.sort_indices(table, sort_keys=[(c, o) for c, o, _ in nulls_first], null_placement="at_start"))
        code = pc.rank(table[partition], tiebreaker="dense", null_placement="at_start").to_numpy()
        starts = np.flatnonzero(np.diff(code, prepend=0))
        for a, z in zip(starts.tolist(), [*starts[1:].tolist(), len(table)], strict=True):
            yield table[partition][a].as_py(), table["size_"].to_numpy()[a:z], table.slice(a, z - a)

    def told(table: pa.Table) -> pa.Table:
        found = [(name, *row) for name, sizes, _ in by_partition(table) for row in _left_by_range(sizes, limit)]
        columns = list(zip(*found, strict=True)) or [()] * 4
        fields = [table.schema.field(partition).type, pa.int64(), pa.int64(), pa.int64()]
        data = [pa.array(c, t) for c, t in zip(columns, fields, strict=True)]
        return pa.table([pa.array(np.full(len(found), table["range_"][0].as_py()), pa.int32()), *data], names=["range_", partition, "above", "left_", "begun"])

    def entered(table: pa.Table) -> pa.Table:
        """The sum and chunk that each range of a partition begins with."""
        table = table.sort_by([("range_", "ascending"), ("above", "ascending")])
        where, above, left, begun = (table[c].to_numpy() for c in ("range_", "above", "left_", "begun"))
        starts = np.flatnonzero(np.diff(where, prepend=-1)).tolist()
        carry, chunk, out = 0, 0, []
        for a, z in zip(starts, [*starts[1:], len(table)], strict=True):
            out.append((where[a], carry, chunk))
            i = a + int(np.searchsorted(above[a:z], carry, side="left")) - 1
            carry, chunk = (int(left[i]) + (carry if begun[i] == 0 else 0), chunk + int(begun[i]))
        columns = list(zip(*out, strict=True))
        name = table[partition][0].as_py()
        return pa.table([pa.array([name] * len(out), table.schema.field(partition).type), *(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True))], names=[partition, "range_", "carry", "chunk"])

    def chunked(table: pa.Table, begins: pa.Table) -> pa.Table:
        known = {r[partition]: (r["carry"], r["chunk"]) for r in begins.to_pylist()}
        parts = []
        for name, sizes, own in by_partition(table):
            carry, chunk = known[name]
            total = np.cumsum(sizes)
            after = _after(total, limit)
            first = int(np.searchsorted(total, limit - carry, side="right")) if carry else int(after[0])
            begins_here = np.zeros(len(sizes) + 1, np.int64)
            while first < len(sizes):
                begins_here[first] = 1
                first = int(after[first])
            number = chunk + np.cumsum(begins_here[:-1])
            parts.append(own.select([partition, order]).append_column("chunk", pa.array(number, pa.int64())))
        return pa.concat_tables(parts)

    tables = rows.groupBy("range_").applyInArrow(told, f"range_ int, {partition} {kinds[partition]}, above long, left_ long, begun long")
    begins = tables.groupBy(partition).applyInArrow(entered, f"{partition} {kinds[partition]}, range_ int, carry long, chunk long")
    return rows.groupBy("range_").cogroup(begins.groupBy("range_")).applyInArrow(chunked, f"{partition} {kinds[partition]}, {order} {kinds[order]}, chunk long")


def transitions(rows: DataFrame, partition: str, order: list[str], state: str) -> DataFrame:
    """Rows whose state differs from the one before; rows without a state neither count nor separate."""
    before = F.lag(state).over(Window.partitionBy(partition).orderBy(*order))
    return rows.filter(F.col(state).isNotNull()).withColumn("_before", before).filter("_before is null or _before != " + state).drop("_before")


def tumbling(rows: DataFrame, ts: str, width: str, start: str, aggregates: dict[str, Column]) -> DataFrame:
    """Aggregates, by name, of the windows of a fixed width."""
    windows = rows.groupBy(F.window(ts, width, startTime=start).alias("w")).agg(*[c.alias(name) for name, c in aggregates.items()])
    return windows.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *aggregates)


def pages(samples: DataFrame, by: str, ts: str, key: str, hours: int = 3) -> DataFrame:
    """samples with page (0, 1, ...), start, end and is_edge: windows of some hours that share the samples at their edges.

    Pages begin with the hour of a group's first sample and go on while they begin before its last. A page has the samples
    from its start to its end, both included, the last one before it and the first one after it (is_edge), so that a page
    without samples has the two around it. Equal times go by key. Only one row a page, with its first and last samples, is ordered by group.
    """
    width = hours * 3_600_000_000
    spans = samples.filter(F.col(ts).isNotNull()).groupBy(by).agg(F.date_trunc("hour", F.min(ts)).alias("zero_"), F.max(ts).alias("last_"))
    since = lambda c: F.unix_micros(F.col(c).cast("timestamp")) - F.unix_micros(F.col("zero_").cast("timestamp"))
    spans = spans.withColumn("pages_", F.ceil(since("last_") / width)).drop("last_")
    at = samples.withColumn("row_", F.struct(*samples.columns)).join(spans, by).withColumn("us_", since(ts))
    at = at.withColumns({"home_": F.call_function("div", "us_", F.lit(width)), "inner_": F.col("us_") % width != 0, "order_": F.struct("us_", key)})

    own = at.withColumn("page", F.explode(F.array_compact(F.array("home_", F.when(~F.col("inner_"), F.col("home_") - 1))))).filter("page between 0 and pages_ - 1")
    own = own.select("row_", "page", "zero_", F.lit(False).alias("is_edge"))

    homes = at.groupBy(by, F.col("home_").alias("page")).agg(
        F.max_by("row_", "order_").alias("last_"), F.min_by("row_", "order_").alias("first_"), F.min_by("row_", F.when(F.col("inner_"), F.col("order_"))).alias("first_inner_"), F.max("inner_").alias("has_inner_")
    )
    grid = spans.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pages_")))).join(homes, [by, "page"], "left")
    line = Window.partitionBy(by).orderBy("page")
    inner = F.when(F.col("has_inner_"), F.col("first_inner_"))
    before = F.last("last_", True).over(line.rowsBetween(Window.unboundedPreceding, -1))
    after = F.coalesce(F.lead(inner).over(line), F.first("first_", True).over(line.rowsBetween(2, Window.unboundedFollowing)))
    edges = grid.withColumns({"before_": before, "after_": after}).filter("page < pages_")
    edges = edges.withColumn("row_", F.explode(F.array_compact(F.array("before_", "after_"))))
    found = own.unionByName(edges.select("row_", "page", "zero_", F.lit(True).alias("is_edge")))
    start = lambda k: F.timestamp_micros(F.unix_micros(F.col("zero_").cast("timestamp")) + (F.col("page") + k) * width)
    return found.select("row_.*", "page", start(0).alias("start"), start(1).alias("end"), "is_edge")


def reading_order(crops: DataFrame) -> DataFrame:
    """crops(scan_id, crop_id, scan_width, box, category, text) with reading_order 1, 2, ... on each scan.

    Left edges are put into 10 columns (12 over 40 boxes, 15 over 80), and within one the order is from the top:
    by the middle of a box, but the upper edge of a picture; texts that begin in lower case come after others at
    the same height. What remains equal goes by the middle of the box, then by crop_id.
    """
    scan = Window.partitionBy("scan_id")
    at = lambda i: F.get(F.col("box"), F.lit(i))
    n = F.count(F.lit(1)).over(scan)
    columns = F.when(n > 80, 15).when(n > 40, 12).otherwise(10)
    bucket = (at(0) / F.col("scan_width") * columns).cast("int")
    picture = F.coalesce(F.col("category").isin("Photograph or illustration", "Cartoon"), F.lit(False))
    y = F.when(picture, at(1)).otherwise((at(1) + at(3)) / 2)
    goes_on = F.when(F.coalesce(F.col("text").rlike(r"^\s*\p{Ll}"), F.lit(False)), 1).otherwise(0)
    keyed = crops.withColumns({"_b": bucket, "_y": y, "_c": goes_on, "_x": (at(0) + at(2)) / 2})
    order = scan.orderBy("_b", "_y", "_c", "_x", "crop_id")
    return keyed.withColumn("reading_order", F.row_number().over(order)).drop("_b", "_y", "_c", "_x")


def lightest_first(items: DataFrame, bins: int) -> DataFrame:
    """items(key, weight) -> key, bin: heaviest first, each into the bin with the least weight (the lowest if several).

    Each choice depends on all before it, so one task makes them, by a heap. For plans over devices: over MOST_ITEMS raise an error.
    """

    def dealt(frame: pd.DataFrame) -> pd.DataFrame:
        if len(frame) > MOST_ITEMS:
            raise ValueError(f"more than {MOST_ITEMS} items: deal groups of them")
        frame = frame.sort_values(["weight", "key"], ascending=[False, True], kind="stable")
        loads, out = [(0.0, k) for k in range(bins)], []
        for weight in frame["weight"].tolist():
            load, k = loads[0]
            heapq.heapreplace(loads, (load + weight, k))
            out.append(k)
        return pd.DataFrame({"key": frame["key"], "bin": out})

    rows = items.select(F.col("key").cast("string").alias("key"), F.coalesce(F.col("weight").cast("double"), F.lit(1.0)).alias("weight"))
    return rows.groupBy(F.lit("all").alias("all_")).applyInPandas(dealt, "key string, bin int")


def streaks(rows: DataFrame, partition: str, order: list[str], failed: Column) -> DataFrame:
    """partition, length, first (place of its first row): the runs of consecutive failures, such as a circuit breaker counts."""
    by = Window.partitionBy(partition).orderBy(*order)
    placed = rows.select(partition, F.row_number().over(by).alias("at"), failed.alias("failed"))
    bad = placed.filter("failed").withColumn("island", F.col("at") - F.row_number().over(Window.partitionBy(partition).orderBy("at")))
    return bad.groupBy(partition, "island").agg(F.count(F.lit(1)).alias("length"), F.min("at").alias("first")).drop("island")
