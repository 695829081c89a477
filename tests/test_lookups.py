"""Listing and lookup against a folder that stands in for a service."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from broadsheet.sources import lookups


class Counting(lookups.Folder):
    """Notes each call in a folder, and fails as often as told."""

    def __init__(self, path, notes, fails=0):
        super().__init__(path)
        self.notes, self.fails = notes, fails

    def item(self, key):
        before = len([n for n in os.listdir(self.notes) if n.startswith(f"{key}.")])
        open(os.path.join(self.notes, f"{key}.{before}.{os.getpid()}"), "w").close()
        if before < self.fails:
            raise OSError("no answer")
        return super().item(key)

    def calls(self):
        return sorted(n.split(".")[0] for n in os.listdir(self.notes))


@pytest.fixture
def place(tmp_path):
    for name in ("items", "notes"):
        (tmp_path / name).mkdir()
    for k in range(5):
        (tmp_path / "items" / f"sn{k}.json").write_text(json.dumps({"title": f"Paper {k}"}))
    return tmp_path


def ids(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "newspaper_id string").repartition(3)


def items(df):
    return {r["newspaper_id"]: r["item"] and json.loads(r["item"])["title"] for r in df.collect()}


def test_each_key_is_asked_for_once(spark, place):
    service, cache = Counting(str(place / "items"), str(place / "notes")), str(place / "cache")
    assert items(lookups.looked_up(ids(spark, "sn0", "sn1", "none", "sn0", None), service, cache)) == {"sn0": "Paper 0", "sn1": "Paper 1", "none": None}
    assert service.calls() == ["none", "sn0", "sn1"]
    assert items(lookups.looked_up(ids(spark, "sn1", "sn2", "none"), service, cache)) == {"sn1": "Paper 1", "sn2": "Paper 2", "none": None}
    assert service.calls() == ["none", "sn0", "sn1", "sn2"]
    assert items(lookups.looked_up(ids(spark), service, cache)) == {}
    # What is old is asked for again, that there was nothing isn't.
    old = spark.read.parquet(cache).withColumn("fetched", F.col("fetched") - F.expr("interval 8 days"))
    old.write.parquet(str(place / "old"))
    assert items(lookups.looked_up(ids(spark, "sn0", "none"), service, str(place / "old"))) == {"sn0": "Paper 0", "none": None}
    assert service.calls().count("sn0") == 2 and service.calls().count("none") == 1
    assert items(lookups.looked_up(ids(spark, "none"), service, cache, ignore_cache=True)) == {"none": None}
    assert service.calls().count("none") == 2


def test_three_attempts(spark, place):
    cache = str(place / "cache")
    assert items(lookups.looked_up(ids(spark, "sn3"), Counting(str(place / "items"), str(place / "notes"), 2), cache, pause=0)) == {"sn3": "Paper 3"}
    (place / "more").mkdir()
    with pytest.raises(Exception, match="no answer"):
        lookups.looked_up(ids(spark, "sn4"), Counting(str(place / "items"), str(place / "more"), 99), cache, pause=0)
    assert spark.read.parquet(cache).count() == 1


def test_listing(spark, place):
    for name in ("a/x_1.tar.gz", "a/x_2.tar.gz", "b/y.tar.gz", "b/y.txt", "c.tar.gz"):
        file = place / "bucket" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"z" * len(name))
    want = {("a/x_1.tar.gz", 12), ("a/x_2.tar.gz", 12), ("b/y.tar.gz", 10), ("c.tar.gz", 8)}
    found = lookups.listed_archives(spark, str(place / "bucket"))
    assert {tuple(r) for r in found.collect()} == want
    found = lookups.listed_archives(spark, str(place / "bucket"), ["b/", "a/", "none"])
    assert found.rdd.getNumPartitions() == 3
    assert {tuple(r) for r in found.collect()} == {x for x in want if "/" in x[0]}
    with pytest.raises(ValueError):
        lookups.listed_archives(spark, str(place / "bucket"), ["a", "a/x"])


def test_metadata(spark):
    item = {
        "title": "The Sun", "location": ["united states", "ohio", "new york", "troy"], "location_city": ["albany", "troy"], "location_state": ["New York", "Ohio"],
        "location_country": ["United States"], "dates_of_publication": "1890-19??", "created_published": ["Troy, J. Doe", "x"], "language": ["English ", "German"], "access_restricted": False,
    }
    rows = spark.createDataFrame([("a", json.dumps(item)), ("b", "{}"), ("c", None)], "newspaper_id string, item string")
    found = {r["newspaper_id"]: tuple(r)[1:] for r in lookups.metadata(rows, {"united states": "USA"}, {"english": "eng"}).collect()}
    assert found == {"a": ("The Sun", "Troy", "OH", "USA", "Troy, J. Doe", 1890, None, "eng", False), "b": ("", "", "", "", "", None, None, "", None)}
