"""Listing of archives, and what a service knows about newspapers, fetched once and kept with its age.

No service can be reached from here: a `Folder` stands in for one, and any object with its two methods can take its place.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions import records

#: Attempts before an error is raised, with a pause of 1, 2, ... times PAUSE seconds between them.
ATTEMPTS, PAUSE = 3, 1.0
#: Days that what was found is believed; that there is nothing is believed for good.
DAYS = 7


class Service(Protocol):
    def item(self, key: str) -> dict | None:
        """What is known about a key, None if there is nothing; errors are raised."""

    def listed(self, prefix: str) -> Iterator[tuple[str, int]]:
        """Names with a prefix and their sizes."""


class Folder:
    """A local folder: <key>.json are items, other files are listed by their path below it."""

    def __init__(self, path: str):
        self.path = path

    def item(self, key: str) -> dict | None:
        try:
            with open(os.path.join(self.path, f"{key}.json"), encoding="utf-8") as file:
                return json.load(file)
        except FileNotFoundError:
            return None

    def listed(self, prefix: str) -> Iterator[tuple[str, int]]:
        for folder, _, names in os.walk(self.path):
            for name in names:
                full = os.path.join(folder, name)
                key = os.path.relpath(full, self.path).replace(os.sep, "/")
                if key.startswith(prefix):
                    yield key, os.path.getsize(full)


def tried(call: Callable, pause: float = PAUSE):
    """What the call returns, after up to ATTEMPTS attempts."""
    for attempt in range(1, ATTEMPTS + 1):
        try:
            return call()
        except Exception:
            if attempt == ATTEMPTS:
                raise
            time.sleep(attempt * pause)


# --- listing ---------------------------------------------------------------------------------------------------------


class Prefix(InputPartition):
    def __init__(self, prefix: str):
        super().__init__(prefix)


class _Listing(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.pause = options["path"], float(options.get("pause", PAUSE))
        self.prefixes = json.loads(options.get("prefixes", '[""]'))

    def partitions(self) -> list[Prefix]:
        return [Prefix(p) for p in self.prefixes]

    def read(self, partition: Prefix) -> Iterator[tuple[str, int]]:
        found = tried(lambda: list(Folder(self.path).listed(partition.value)), self.pause)  # names of a prefix
        yield from (x for x in found if x[0].endswith(".tar.gz"))


class ArchiveListing(DataSource):
    """spark.read.format("archive_listing"): archive_filename and archive_size_bytes of every *.tar.gz; contents aren't read.

    Options: path; prefixes, a JSON array: names are listed prefix by prefix, each by a task. Prefixes don't begin with one another.
    """

    @classmethod
    def name(cls) -> str:
        return "archive_listing"

    def schema(self) -> str:
        return "archive_filename string, archive_size_bytes long"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Listing(self.options)


def listed_archives(spark: SparkSession, path: str, prefixes: list[str] | None = None) -> DataFrame:
    prefixes = sorted(set(prefixes or [""]))
    if any(b.startswith(a) for a, b in zip(prefixes, prefixes[1:])):
        raise ValueError("a prefix begins with another one: their names would be listed twice")
    spark.dataSource.register(ArchiveListing)
    return spark.read.format("archive_listing").options(path=path, prefixes=json.dumps(prefixes)).load()


# --- lookup ----------------------------------------------------------------------------------------------------------

_KEPT = "newspaper_id string, item string, fetched timestamp"


def _kept(spark: SparkSession, cache: str) -> DataFrame:
    """The latest row of each key."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _KEPT)
    newest = Window.partitionBy("newspaper_id").orderBy(F.col("fetched").desc(), F.col("item").asc_nulls_last())
    return spark.read.schema(_KEPT).parquet(cache).withColumn("rank", F.row_number().over(newest)).filter("rank = 1").drop("rank")


def looked_up(ids: DataFrame, service: Service, cache: str, ignore_cache: bool = False, pause: float = PAUSE, tasks: int = 32) -> DataFrame:
    """ids(newspaper_id) -> newspaper_id and item (JSON, null if there is none), a row per distinct id.

    Only what isn't kept, or is too old, is asked for, each id once, by up to `tasks` tasks at a time; the answers, misses too, are
    appended to the cache, a Parquet folder, before they are used. An id for which all attempts fail ends the job, and nothing is kept of its run.
    """
    spark = ids.sparkSession
    wanted = ids.select("newspaper_id").filter("newspaper_id is not null").distinct()
    believed = _kept(spark, cache).filter(F.col("item").isNull() | (F.col("fetched") > F.current_timestamp() - F.make_interval(days=F.lit(DAYS))))
    missing = wanted if ignore_cache else wanted.join(believed, "newspaper_id", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            items = [tried(lambda key=key: service.item(key), pause) for key in keys]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x if x is None else json.dumps(x) for x in items], pa.string())], names=["newspaper_id", "item"])

    fetched = missing.repartition(tasks, "newspaper_id").mapInArrow(run, "newspaper_id string, item string")
    fetched.withColumn("fetched", F.current_timestamp()).write.mode("append").parquet(cache)
    return wanted.join(_kept(spark, cache), "newspaper_id").select("newspaper_id", "item")


_ITEM = (
    "title string, location array<string>, location_city array<string>, location_state array<string>, location_country array<string>,"
    " dates_of_publication string, created_published array<string>, language array<string>, access_restricted boolean"
)


def metadata(items: DataFrame, countries: dict[str, str], languages: dict[str, str]) -> DataFrame:
    """looked_up -> newspaper_id, title, city, state, country, publisher, year_start, year_end, language, loc_access_restricted, for what was found.

    countries and languages: codes of three letters by lower-case name or other code.
    """
    rows = items.filter("item is not null").select("newspaper_id", F.from_json("item", _ITEM).alias("x"))
    place = lambda kind: records.earliest_in(F.coalesce(f"x.location_{kind}", F.array().cast("array<string>")), F.coalesce("x.location", F.array().cast("array<string>")))
    state = place("state")
    years = records.year_range(F.coalesce("x.dates_of_publication", F.lit("")))
    name = F.lower(F.trim(F.get("x.language", F.lit(0))))
    known = F.create_map(*[F.lit(v) for kv in languages.items() for v in kv]) if languages else F.lit(None).cast("map<string,string>")
    return rows.select(
        "newspaper_id", F.coalesce("x.title", F.lit("")).alias("title"), F.initcap(F.trim(place("city"))).alias("city"),
        F.coalesce(records.state_code(state), F.substring(F.upper(F.trim(state)), 1, 2)).alias("state"),
        records.place_code(place("country"), countries, 3).alias("country"),
        F.coalesce(F.get("x.created_published", F.lit(0)), F.lit("")).alias("publisher"), years["year_start"].alias("year_start"), years["year_end"].alias("year_end"),
        F.coalesce(F.try_element_at(known, name), F.lit("")).alias("language"), F.col("x.access_restricted").alias("loc_access_restricted"),
    )
