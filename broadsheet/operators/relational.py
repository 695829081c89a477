"""Filters, joins, nests and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def within(rows: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """Rows whose key is in keys; a key that stands there twice changes nothing."""
    return rows.join(keys, list(on), "left_semi")


def unprocessed(issues: DataFrame, artefacts: DataFrame, key: str = "issue_id") -> DataFrame:
    """Issues none of whose crops has the artefact: one that has some counts as done."""
    return issues.join(artefacts.select(key).distinct(), key, "left_anti")


def incomplete(issues: DataFrame, tables: dict[str, DataFrame], key: str = "issue_id") -> DataFrame:
    """missing (table), n (issues without a row there); tables that every issue has are left out."""
    parts = [unprocessed(issues, t, key).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("missing"), "n") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, parts).filter("n > 0")


def record_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("label"), "n") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def satellites(crops: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Crops with a struct of each satellite table's row, null where there is none. Satellites have one row a crop."""
    for name, table in tables.items():
        columns = [c for c in table.columns if c != "crop_id"]
        crops = crops.join(table.select("crop_id", F.struct(*columns).alias(name)), "crop_id", "left")
    return crops


def nested(rows: DataFrame, by: list[str], order: list[Column], fields: list[str], name: str) -> DataFrame:
    """One row per key, with its rows' fields as an ordered list."""
    keys = [o.alias(f"o{i}") for i, o in enumerate(order)]
    item = F.struct(*keys, F.struct(*fields).alias("item"))
    return rows.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["item"]).alias(name))


def scans_nested(crops: DataFrame) -> DataFrame:
    """crops(scan_id, crop_id, reading_order, ...) nested by scan in reading order, unordered ones first."""
    fields = [c for c in crops.columns if c != "scan_id"]
    return nested(crops, ["scan_id"], [F.coalesce(F.col("reading_order"), F.lit(0)), F.col("crop_id")], fields, "crops")


def deduplicated_entities(entities: DataFrame) -> DataFrame:
    """entities(crop_id, tag, text, score, pos): the best spelling of each (crop, tag, lower-case text).

    A higher score wins, an equal one keeps the earlier spelling; the key keeps the place of its first occurrence.
    """
    rows = entities.withColumn("key", F.lower("text"))
    key = Window.partitionBy("crop_id", "tag", "key")
    return (
        rows.withColumn("rank", F.row_number().over(key.orderBy(F.desc("score"), "pos")))
        .withColumn("first_pos", F.min("pos").over(key))
        .filter("rank = 1")
        .select("crop_id", "tag", "text", "score", "first_pos")
    )


def upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows, and the old ones whose key isn't among them."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)
