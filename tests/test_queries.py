"""Every registered query with SQL against DuckDB on the same tables."""

from __future__ import annotations

import duckdb
import pytest

from broadsheet.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(frame):
    columns = sorted(frame.columns)
    frame = frame[columns].astype(object)
    return columns, sorted((tuple(None if x != x or x is None else x for x in row) for row in frame.where(frame.notna(), None).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    got = plain(catalog.QUERIES[name](spark, SF).toPandas())
    want = plain(duck.execute(catalog.ORACLE_SQL[name]).df())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_other_queries_run(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_crops_are_dealt_by_their_number(spark, duck, monkeypatch):
    """More rows give more tasks, not larger ones; nothing is grouped by scan before scans are dealt."""
    monkeypatch.setattr(catalog, "TASK_ROWS", 100)
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    found = catalog.category_area_by_year(spark, SF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"hashpartitioning(l_orderkey#" in plan and f", {-(-rows // 100)}), REPARTITION_BY_NUM" in plan
    assert "hashpartitioning(scan_id" not in plan
    assert plain(found.toPandas()) == plain(duck.execute(catalog.ORACLE_SQL["category_area_by_year"]).df())
