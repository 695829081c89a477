"""Replacing partitions of a table and of what depends on it."""

from __future__ import annotations

import pytest

from broadsheet import schemas
from broadsheet.sources import writers

names = lambda ddl: [c.strip().split()[0] for c in ddl.split(", ")]
TABLES = {"issue": names(schemas.ISSUE), "scan": names(schemas.SCAN), "crop": names(schemas.CROP), "crop_language": names(schemas.CROP_LANGUAGE), "crop_ner": ["crop_id", "per_entities"]}


def test_order():
    assert writers.dependents(TABLES, "crop") == ["crop_language", "crop_ner"]
    assert writers.dependents(TABLES, "issue") == ["crop_language", "crop_ner", "crop", "scan"]
    assert writers.dependents(TABLES, "crop_ner") == []
    with pytest.raises(ValueError):
        writers.dependents({"a": ["b_id"], "b": ["a_id"]}, "a")


def stored(spark, base, table):
    return sorted((r["batch"], r["id"]) for r in spark.read.schema("id long, batch int").parquet(f"{base}/{table}").collect())


@pytest.fixture
def base(spark, tmp_path):
    for table in ("scan", "crop", "crop_language", "crop_ner"):
        spark.createDataFrame([(i, i % 3) for i in range(9)], "id long, batch int").write.partitionBy("batch").parquet(f"{tmp_path}/{table}")
    return str(tmp_path)


def test_cascade(spark, base):
    writers.overwrite_cascading(spark.createDataFrame([(100, 1), (101, 7)], "id long, batch int"), base, "crop", "batch", TABLES)
    others = [(i % 3, i) for i in range(9) if i % 3 != 1]
    assert stored(spark, base, "crop") == sorted([*others, (1, 100), (7, 101)])
    assert stored(spark, base, "crop_language") == stored(spark, base, "crop_ner") == sorted(others)
    assert stored(spark, base, "scan") == sorted((i % 3, i) for i in range(9))
    assert not writers.finish(spark, base)


def test_a_failing_write_changes_nothing(spark, base):
    from pyspark.sql import functions as F

    bad = spark.createDataFrame([(1, 1)], "id long, batch int").withColumn("id", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        writers.overwrite_cascading(bad, base, "crop", "batch", TABLES)
    for table in ("crop", "crop_language"):
        assert len(stored(spark, base, table)) == 9


@pytest.mark.parametrize("calls", range(1, 6))
def test_an_interrupted_replacement_is_finished(spark, base, monkeypatch, calls):
    """Whichever file operation is the last one, the next call ends up with the same tables."""
    real, left = writers._files, [calls]

    class Failing:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            def call(*args):
                if name in ("delete", "rename", "mkdirs") and args[0].getName() != "replacing.tmp":
                    left[0] -= 1
                    if left[0] < 0:
                        raise OSError("gone")
                return getattr(self.files, name)(*args)

            return call

    monkeypatch.setattr(writers, "_files", lambda s, p: (lambda f, at: (Failing(f), at))(*real(s, p)))
    rows = spark.createDataFrame([(100, 1), (101, 2)], "id long, batch int")
    with pytest.raises(OSError):
        writers.overwrite_cascading(rows, base, "crop", "batch", TABLES)
    monkeypatch.setattr(writers, "_files", real)
    assert writers.finish(spark, base)
    assert stored(spark, base, "crop") == [(0, 0), (0, 3), (0, 6), (1, 100), (2, 101)]
    assert stored(spark, base, "crop_language") == [(0, 0), (0, 3), (0, 6)]
