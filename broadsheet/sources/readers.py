"""Sources."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import records
from ..functions.text import casefolded


def archives(spark: SparkSession, path: str) -> DataFrame:
    """path, archive_filename, archive_size_bytes and the fields of the name of every *.tar.gz; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar.gz").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    named = files.select("path", name.alias("archive_filename"), F.col("length").alias("archive_size_bytes"))
    return named.withColumn("fields", records.archive_fields(F.col("archive_filename"))).select("path", "archive_filename", "archive_size_bytes", "fields.*")


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """path, page (1, 2, ... by member name), scan_filename and content of each regular file. One archive at a time is in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                with tarfile.open(fileobj=io.BytesIO(content.as_py()), mode="r:gz") as archive:
                    members = sorted((m for m in archive.getmembers() if m.isfile()), key=lambda m: m.name)
                    for page, member in enumerate(members, 1):
                        yield pa.RecordBatch.from_pylist(
                            [{"path": name, "page": page, "scan_filename": member.name.rsplit("/", 1)[-1], "content": archive.extractfile(member).read()}],
                            schema=pa.schema([("path", pa.string()), ("page", pa.int32()), ("scan_filename", pa.string()), ("content", pa.binary())]),
                        )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar.gz").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, "path string, page int, scan_filename string, content binary")


def with_metadata(issues: DataFrame, metadata: DataFrame) -> DataFrame:
    """Issues with what is known of their newspaper; unknown ones stay. metadata has a row per newspaper_id."""
    return issues.join(metadata, "newspaper_id", "left")


def thesaurus(lines: DataFrame) -> DataFrame:
    """value (one JSON object a line, with its number as `line`) -> term, category: of a term given twice, the last one."""
    parsed = lines.select("line", F.from_json("value", schemas.THESAURUS_LINE).alias("x"))
    terms = F.concat(F.array("x.keyword"), F.coalesce("x.related_terms", F.array().cast("array<string>")))
    rows = parsed.select("line", "x.category", F.posexplode(terms).alias("pos", "term")).filter("term is not null")
    return rows.groupBy(casefolded(F.col("term")).alias("term")).agg(F.max_by("category", F.struct("line", "pos")).alias("category"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (0, 1, ...) and value. A file is one row before it is split: for logs and dictionaries, not for data."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.split("value", "\r?\n").alias("lines"))
    return whole.select("file", F.posexplode("lines").alias("line", "value"))


def blobs(keys: DataFrame, store: DataFrame, key: str = "key") -> DataFrame:
    """Keys with their content from a stored table (key, content); missing ones are null and count as such downstream."""
    return keys.join(store, key, "left")
