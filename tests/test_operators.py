"""Operators on small tables with null, tie and fan-out rows."""

from __future__ import annotations

import io
import json
import tarfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from broadsheet import schemas
from broadsheet.operators import aggregates, dictionary, models, relational, sequences
from broadsheet.plans import logs, run_view
from broadsheet.sources import readers, writers
from broadsheet.streaming import live


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_packing(spark):
    sizes = spark.createDataFrame([(1, i, n) for i, n in enumerate([100, 100, 100, 250, 300, 10])], "corpus int, id long, n int")
    out = sequences.packed(sizes, "corpus", "id", "n", 250).orderBy("id").collect()
    assert [r["chunk"] for r in out] == [0, 0, 1, 2, 3, 4]
    assert sequences.packed(sizes.limit(0), "corpus", "id", "n", 250).count() == 0


def test_bins(spark):
    items = spark.createDataFrame([("a", 5), ("b", 4), ("c", 3), ("d", 3)], "key string, weight int")
    assert rows(sequences.lightest_first(items, 2), "key", "bin") == [("a", 0), ("b", 1), ("c", 1), ("d", 0)]


def test_batches_cover_all(spark):
    ids = spark.range(0, 5000).repartition(7)
    out = sequences.batches(ids, "id", 64)
    assert out.filter(F.col("batch") != F.floor(F.col("id") / 64)).count() == 0
    assert out.count() == 5000


def test_histograms(spark):
    of = lambda values: rows(aggregates.histogram(spark.createDataFrame([(float(v),) for v in values], "v double"), "v"), "bin", "n")
    assert of(range(8)) == [(0, 2), (1, 2), (2, 2), (3, 2)]
    assert of([1, 1, 1]) == [(0, 3)]
    assert of([5]) == [(0, 1)]
    assert of([]) == []


def test_median_and_deviation(spark):
    def stats(values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(*aggregates.spread(F.col("v"))).first()

    assert stats([1.0, 2.0, 4.0, 8.0])["median"] == 3.0
    assert stats([1.0, 2.0, 4.0])["median"] == 2.0
    assert stats([None])["median"] is None
    assert stats([1.0])["deviation"] == 0.0


def test_coverage_counts_overlaps_twice(spark):
    scans = spark.createDataFrame([(1, 100, 100), (2, None, 5)], "scan_id long, width int, height int")
    crops = spark.createDataFrame([(1, 2500.0), (1, 2500.0), (2, 1.0)], "scan_id long, area double")
    assert rows(aggregates.coverage(scans, crops, F.col("area")), "scan_id", "coverage") == [(1, 50.0)]


def test_eta(spark):
    at = datetime.fromtimestamp
    data = [("completed", at(0), at(100)), ("completed", at(0), at(200)), ("pending", None, None), ("running", at(940), None)]
    batches = spark.createDataFrame(data, "status string, started timestamp, ended timestamp")
    out = aggregates.eta(batches, F.timestamp_seconds(F.lit(1000))).first()
    assert (out["mean_seconds"], out["eta_seconds"]) == (150.0, 240.0)
    assert aggregates.eta(batches.limit(2), F.timestamp_seconds(F.lit(1000))).first()["eta_seconds"] is None


def test_entities(spark):
    data = [(1, "LOC", "Boston", 0.9, 0), (1, "LOC", "BOSTON", 0.95, 1), (1, "PER", "Boston", 0.9, 2), (2, "LOC", "Ulm", 0.9, 0), (2, "LOC", "ULM", 0.9, 1)]
    out = relational.deduplicated_entities(spark.createDataFrame(data, "crop_id int, tag string, text string, score double, pos int"))
    assert rows(out, "crop_id", "tag", "text") == [(1, "LOC", "BOSTON"), (1, "PER", "Boston"), (2, "LOC", "Ulm")]


def test_reading_order(spark):
    def order(width, boxes, categories=None, texts=None):
        data = [(1, i, width, [float(v) for v in b], (categories or ["Content"] * len(boxes))[i], (texts or [None] * len(boxes))[i]) for i, b in enumerate(boxes)]
        df = spark.createDataFrame(data, "scan_id int, crop_id int, scan_width int, box array<double>, category string, text string")
        return [r["crop_id"] for r in sequences.reading_order(df).orderBy("reading_order").collect()]

    assert order(300, [[0, 100, 100, 200], [200, 110, 300, 210]]) == [0, 1]
    assert order(300, [[200, 0, 300, 100], [0, 50, 100, 150]]) == [1, 0]
    assert order(1000, [[0, 100, 90, 900], [0, 200, 90, 300]], ["Photograph or illustration", "Content"]) == [0, 1]
    assert order(1000, [[0, 0, 90, 10], [0, 0, 90, 10]], None, ["and so on", "The"]) == [1, 0]


def test_transitions_skip_missing_states(spark):
    data = [("a", 1, "x"), ("a", 2, None), ("a", 3, "x"), ("a", 4, "y")]
    out = sequences.transitions(spark.createDataFrame(data, "k string, t int, s string"), "k", ["t"], "s")
    assert rows(out, "t") == [(1,), (4,)]


def test_run_view_counts_once(spark):
    make = lambda data, schema: spark.createDataFrame(data, schema)
    issue = make([(1, 1930), (2, 1931), (3, None)], "id long, year int")
    scan = make([(10, 1), (20, 2), (30, 3)], "id long, issue_id long")
    crop = make([(100, 10, 1000), (200, 20, 1001), (300, 30, 1003), (400, 30, None)], "id long, scan_id long, pipeline_batch_item_id long")
    batch = make([(7, 1), (8, 1), (9, 2)], "id long, pipeline_run_id long")
    item = make([(1000, 7, 1), (1001, 7, 2), (1002, 8, 2), (1003, 9, 3)], "id long, pipeline_batch_id long, issue_id long")
    view = run_view.RunView.of(crop, scan, issue, item, batch, 1)
    assert tuple(view.counts().first()) == (2, 2, 2)
    assert rows(view.before(1931).crops, "crop_id") == [(100,)]
    planned = run_view.plan_run(issue, make([(2,)], "issue_id long"), 1)
    assert rows(planned, "id", "batch") == [(1, 0), (3, 1)]


def test_batches_that_may_run(spark):
    day = 86400
    at = lambda s: datetime.fromtimestamp(s)
    data = [(1, None, None, False), (2, at(0), at(5), False), (3, at(0), None, False), (4, at(0), at(5), True), (5, at(3 * day), None, None)]
    batches = spark.createDataFrame(data, "id long, started_date timestamp, ended_date timestamp, has_crashed boolean")
    free = run_view.free_batches(batches, F.timestamp_seconds(F.lit(3 * day + 60)), day)
    assert rows(free, "id") == [(1,), (3,), (4,)]


def test_streaks(spark):
    data = [("a", i, f) for i, f in enumerate([True, True, False, True, None, True])]
    out = sequences.streaks(spark.createDataFrame(data, "k string, t int, f boolean"), "k", ["t"], F.col("f"))
    assert rows(out, "length", "first") == [(1, 4), (1, 6), (2, 1)]


def test_throughput_has_a_total(spark):
    done = spark.createDataFrame([(1, 60.0, 1, 2, 3), (2, 60.0, 3, 2, 1)], "batch int, seconds double, issues int, scans int, crops int")
    out = {r["batch"]: r for r in logs.throughput(done).collect()}
    assert (out[1]["issues_per_minute"], out[None]["issues_per_minute"], out[None]["scans_per_hour"]) == (1.0, 2.0, 120.0)


def test_thesaurus(spark):
    lines = [(0, json.dumps({"category": "Places", "keyword": "New York", "related_terms": ["York", "war"]})), (1, json.dumps({"category": "Topics", "keyword": "war", "related_terms": []}))]
    terms = readers.thesaurus(spark.createDataFrame(lines, "line int, value string"))
    assert rows(terms, "term", "category") == [("new york", "Places"), ("war", "Topics"), ("york", "Places")]
    texts = spark.createDataFrame([(1, "New York war, WAR"), (2, "hello"), (3, " "), (4, None)], "id long, t string")
    out = {r["id"]: r for r in dictionary.matched(texts, "id", "t", terms).collect()}
    assert out[1]["matches"] == {"Places": {"new york": 1}, "Topics": {"war": 2}}
    assert (out[1]["match_count"], out[1]["term_count"]) == (3, 2)
    assert (out[2]["matches"], out[2]["match_count"]) == ({}, 0)
    assert out[3]["matches"] is None and out[4]["match_count"] is None
    totals = aggregates.term_totals(spark.createDataFrame(list(out.values())), "matches")
    assert rows(totals, "term", "n") == [("new york", 1), ("war", 2)]


@pytest.mark.parametrize("model", [models.RuleClassifier, models.RuleEntities, models.RuleSubjects, models.HashEmbedding])
def test_models_are_total(spark, model):
    texts = spark.createDataFrame([(1, "The Boston Herald and the Globe"), (2, ""), (3, None)], "id long, t string")
    out = models.applied(texts, "id", "t", model)
    assert out.count() == 3
    assert len(out.columns) == 1 + len(model().empty)


def test_archives(spark, tmp_path):
    with tarfile.open(tmp_path / "sn1_1915030201.tar.gz", "w:gz") as archive:
        for name in ("b.jp2", "a.jp2"):
            info = tarfile.TarInfo(name)
            info.size = 3
            archive.addfile(info, io.BytesIO(name[:3].encode()))
    found = readers.archives(spark, str(tmp_path)).first()
    assert (found["newspaper_id"], found["year"], found["archive_size_bytes"] > 0) == ("sn1", 1915, True)
    assert rows(readers.archive_members(spark, str(tmp_path)), "page", "scan_filename") == [(1, "a.jp2"), (2, "b.jp2")]


def test_chunks_and_manifests(spark, tmp_path):
    plan = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "issue_id long, chunk long")
    scans = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "d")], "issue_id long, x string")
    manifests = writers.export_chunks(scans, plan, "issue_id", str(tmp_path), "news")
    assert rows(manifests, "name", "row_count") == [("news-part-00000", 2), ("news-part-00001", 2)]
    changed = plan.unionByName(spark.createDataFrame([(4, 1)], "issue_id long, chunk long"))
    assert rows(writers.chunks_to_build(changed, manifests, "issue_id"), "chunk") == [(0,), (1,)]
    assert rows(writers.chunks_to_build(plan, manifests, "issue_id"), "chunk") == [(1,)]


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, x string, batch_id int")
    writers.overwrite_partitions(old, path, "batch_id")
    new = spark.createDataFrame([(3, "c", 2)], "id long, x string, batch_id int")
    for _ in range(2):
        writers.overwrite_partitions(new, path, "batch_id")
    assert rows(spark.read.parquet(path), "id") == [(1,), (3,)]
    assert writers.backup(spark, path, str(tmp_path / "copy"))
    assert rows(relational.upserted(old.drop("batch_id"), spark.createDataFrame([(2, "z")], "id long, x string"), "id"), "id", "x") == [(1, "a"), (2, "z")]


LOG = """=== Environment configuration ===
KEY = some=value
=================================
2025-01-01 00:00:00.000 | INFO     | cli:run - START RUN#3
2025-01-01 00:00:01.000 | INFO     | cli:run - START RUN#3 BATCH#1 NODE#n1
2025-01-01 00:00:02.000 | INFO     | cli:run - START step01-cache RUN#3 BATCH#1 NODE#n1
2025-01-01 00:00:03.000 | WARNING  | step:x - slow
2025-01-01 00:00:04.000 | INFO     | step:x - step01_cache took 1.5s
2025-01-01 00:00:05.000 | INFO     | cli:run - END step01-cache RUN#3 BATCH#1 NODE#n1 - 3s
2025-01-01 00:00:06.000 | WARNING  | cli:run - orphan
2025-01-01 00:00:07.000 | INFO     | cli:run - RESOURCE_SAMPLE step= batch=None ram_pct=1.5 cpu_pct=2.0 vram_pcts=0:45.2
2025-01-01 00:00:08.000 | INFO     | cli:run - END RUN#3 BATCH#1 NODE#n1 - 7s
2025-01-01 00:00:09.000 | INFO     | cli:run - START RUN#3 BATCH#2 NODE#n1
not a log line"""


def test_logs(spark, tmp_path):
    (tmp_path / "run.log").write_text(LOG)
    lines = readers.numbered_lines(spark, str(tmp_path))
    events = logs.parsed(lines)
    assert events.count() == 10
    assert rows(logs.environment(lines), "key", "value") == [("KEY", "some=value")]
    assert rows(logs.batches(events), "batch", "status") == [(1, "success"), (2, "pending")]
    assert rows(logs.steps(events), "batch", "step", "number", "seconds") == [(1, "step01-cache", 1, 1.5)]
    assert rows(logs.messages(events), "step", "message", "n") == [("step01-cache", "slow", 1), (None, "orphan", 1)]
    assert rows(logs.message_groups(events), "step", "number", "step_total", "message", "n") == [("Other", None, 1, "orphan", 1), ("step01-cache", 1, 1, "slow", 1)]
    sample = logs.samples(events).first()
    assert (sample["step"], sample["batch"], sample["vram_pcts"]) == (None, None, {"0": 45.2})
    assert rows(logs.step_durations(logs.steps(events)), "step", "total", "n") == [("step01-cache", 1.5, 1)]


def test_log_counts(spark):
    said = [
        ("cli:run", "START RUN#4"), ("cli:run", "START RUN#4 BATCH#2 NODE#n"), ("cli:run", "START step01-cache RUN#4 BATCH#2 NODE#n"),
        ("commands.steps.step01:run:9", "A (1890): archive downloaded, 12 scans extracted."), ("commands.steps.step01:run:9", "B (1891): 3 scans already in cache. Skipping."),
        ("cli:run", "C (1892): archive downloaded, 99 scans extracted."), ("cli:run", "END step01-cache RUN#4 BATCH#2 NODE#n - 1s"),
        ("commands.steps.step02:run:9", "7 crops across 1 scans"), ("cli:run", "START step02-crop RUN#4 BATCH#2 NODE#n"), ("commands.steps.step02:run:9", "40 crops across 15 scans"),
        ("cli:run", "END RUN#4 BATCH#2 NODE#n - 9s"), ("cli:run", "Batches processed: 1"), ("cli:run", "Batches crashed: 0"), ("cli:run", "END RUN#4 - 11s"),
    ]
    lines = [("f", i, f"2025-01-01 00:00:{i:02d}.000 | INFO     | {source} - {message}") for i, (source, message) in enumerate(said)]
    events = logs.parsed(spark.createDataFrame(lines, "file string, line int, value string"))
    assert rows(logs.finished(events), "batch", "seconds", "issues", "scans", "crops") == [(2, 9.0, 2, 15, 40)]
    assert rows(logs.runs(events), "run", "took", "dry_run", "processed", "crashed", "skipped") == [(4, "11s", False, 1, 0, None)]
    assert logs.finished(events.limit(0)).count() == logs.runs(events.limit(0)).count() == 0


def test_streaming_equals_batch(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{source}/events.parquet")
    stream = live.windowed(live.read_events(spark, source, table.schema))
    query = stream.writeStream.format("memory").queryName("live_windows").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    total = spark.sql("select sum(n) as n from live_windows").first()["n"]
    assert total == table.count()


def test_schemas_are_usable(spark):
    for name in ("ISSUE", "SCAN", "CROP", "CROP_OCR", "CROP_THESAURUS", "PIPELINE_BATCH"):
        assert spark.createDataFrame([], getattr(schemas, name)).count() == 0
