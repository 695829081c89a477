"""Sinks. Tables are overwritten by partition, so a step that runs twice leaves the same rows."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def overwrite_partitions(rows: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that rows has, and no other."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def dependents(tables: dict[str, list[str]], table: str) -> list[str]:
    """Tables that depend on one, by their keys, those that nothing else depends on first. tables: name -> columns.

    A table depends on "scan" if it has a column scan_id. Tables whose keys lead back to themselves raise an error.
    """
    above = {name: [p for p in tables if p != name and f"{p}_id" in columns] for name, columns in tables.items()}
    order: list[str] = []

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name in path:
            raise ValueError(f"keys lead from {name} back to it: {' > '.join(path)}")
        for below in sorted(t for t, parents in above.items() if name in parents):
            visit(below, (*path, name))
        if name not in order:
            order.append(name)

    visit(table, ())
    return order[:-1]


def _files(spark: SparkSession, path: str):
    """A path's file system, and a maker of paths."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def overwrite_cascading(rows: DataFrame, base: str, table: str, by: str, tables: dict[str, list[str]]) -> None:
    """Replace the partitions that rows has, and drop those of all tables that depend on it: all of that, or nothing.

    Tables are folders of base, partitioned by one column. Rows are written aside first. Then a note of what is to be done is
    left in base, and partitions are dropped and moved; if that is interrupted, `finish` does the rest, and does it before
    anything else is replaced here. One writer a base at a time.
    """
    spark = rows.sparkSession
    finish(spark, base)
    aside = f"{base}/_aside-{uuid.uuid4().hex}"
    rows.write.partitionBy(by).parquet(aside)
    files, at = _files(spark, base)
    parts = sorted(s.getPath().getName() for s in files.listStatus(at(aside)) if s.isDirectory())
    note = {"aside": aside, "table": table, "parts": parts, "drop": dependents(tables, table)}
    out = files.create(at(f"{base}/replacing.tmp"), True)
    out.write(json.dumps(note).encode())
    out.close()
    if not files.rename(at(f"{base}/replacing.tmp"), at(f"{base}/replacing.note")):
        raise RuntimeError(f"another writer is at work in {base}")
    finish(spark, base)


def finish(spark: SparkSession, base: str) -> bool:
    """Do what an interrupted `overwrite_cascading` left to do; false if there is nothing. Each part can be done twice."""
    files, at = _files(spark, base)
    if not files.exists(at(f"{base}/replacing.note")):
        return False
    note = json.loads(spark.read.text(f"{base}/replacing.note", wholetext=True).first()[0])
    for part in note["parts"]:
        for table in note["drop"]:  # those that depend on others go first, so that nothing points to what is gone
            files.delete(at(f"{base}/{table}/{part}"), True)
        fresh, place = at(f"{note['aside']}/{part}"), at(f"{base}/{note['table']}/{part}")
        if files.exists(fresh):  # else it was moved before
            files.delete(place, True)
            files.mkdirs(place.getParent())
            if not files.rename(fresh, place):
                raise RuntimeError(f"could not move {fresh} to {place}")
    files.delete(at(note["aside"]), True)
    files.delete(at(f"{base}/replacing.note"), False)
    return True


def export_chunks(rows: DataFrame, plan: DataFrame, key: str, path: str, corpus: str, rows_per_group: int = 10) -> DataFrame:
    """Rows as zstd Parquet in a folder per chunk, and a manifest per chunk; returns the manifests.

    The plan says which chunk a key belongs to; a chunk is written by one task, as one file.
    """
    dealt = rows.join(plan.select(key, "chunk"), key).repartition("chunk").sortWithinPartitions("chunk", key)
    options = {"compression": "zstd", "parquet.block.row.count.limit": str(rows_per_group), "partitionOverwriteMode": "dynamic"}
    dealt.write.mode("overwrite").options(**options).partitionBy("chunk").parquet(f"{path}/{corpus}")
    written = rows.sparkSession.read.parquet(f"{path}/{corpus}").groupBy("chunk").agg(F.count(F.lit(1)).alias("row_count"))
    keys = plan.groupBy("chunk").agg(F.array_sort(F.collect_list(key)).alias(f"{key}s"))  # a chunk's keys
    manifests = keys.join(written, "chunk", "left").select(
        F.lit(corpus).alias("corpus"), F.col("chunk").alias("chunk_index"), f"{key}s", F.coalesce("row_count", F.lit(0)).alias("row_count"),
        chunk_name(F.lit(corpus), F.col("chunk")).alias("name"),
    )
    manifests.write.mode("overwrite").json(f"{path}/{corpus}-manifests")
    return manifests


def chunk_name(corpus: Column, chunk: Column) -> Column:
    return F.format_string("%s-part-%05d", corpus, chunk)


def chunks_to_build(plan: DataFrame, manifests: DataFrame, key: str) -> DataFrame:
    """Chunks without a manifest of the very same keys, and the last complete one, which is always built again."""
    wanted = plan.groupBy("chunk").agg(F.array_sort(F.collect_list(key)).alias("keys"))
    have = manifests.select(F.col("chunk_index").alias("c_"), F.col(f"{key}s").alias("k_"))
    complete = wanted.join(have, (F.col("chunk") == F.col("c_")) & (F.col("keys") == F.col("k_")), "left_semi").select("chunk")
    last = complete.agg(F.max("chunk").alias("chunk")).filter("chunk is not null")
    return wanted.select("chunk").join(complete, "chunk", "left_anti").unionByName(last)


def dump_issues(issues: DataFrame, path: str) -> None:
    """Nested issues as one JSON object each."""
    issues.write.mode("overwrite").json(path)


def backup(spark: SparkSession, source: str, target: str) -> bool:
    """Copy a table, and say whether the copy has its rows: counts and summed hashes of both."""
    rows = spark.read.parquet(source)
    rows.write.mode("overwrite").parquet(target)
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return mark(rows) == mark(spark.read.parquet(target))
