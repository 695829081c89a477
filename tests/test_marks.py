"""Spans of a stream of log lines equal those of the batch job, however the lines are dealt."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from broadsheet.plans import logs
from broadsheet.streaming import live, marks


def log_lines(rng):
    line = lambda s, text: f"2024-03-01 {7 + s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}.250 | INFO     | commands.run - {text}"
    out = []
    for batch in range(1, 9):
        at = batch * 400
        out.append(line(at, f"START RUN#1 BATCH#{batch} NODE#n{batch % 3}"))
        for k in range(3):
            out.append(line(at + 10 + 60 * k, f"START step{k:02d}-part RUN#1 BATCH#{batch} NODE#n{batch % 3}"))
            if (batch, k) != (4, 2):
                out.append(line(at + 50 + 60 * k, f"END step{k:02d}-part RUN#1 BATCH#{batch} NODE#n{batch % 3} - 40s"))
        if batch not in (4, 8):
            out.append(line(at + 300, f"END RUN#1 BATCH#{batch} NODE#n{batch % 3}"))
        out.append("not a line of a log")
    out.append(line(3300, "START RUN#1 BATCH#2 NODE#n9"))  # begun again
    return out


@pytest.mark.parametrize("files, late, shuffled", [(1, "0 seconds", False), (2, "0 seconds", False), (7, "0 seconds", False), (7, "2 hours", True)])
def test_spans(spark, tmp_path, files, late, shuffled):
    """Files in order; and in any order, if they may come that late. Nothing times out then, as the clock hasn't come so far."""
    marks.use_store(spark)
    rng = random.Random(files)
    lines = log_lines(rng)
    for k in range(files):
        part = tmp_path / "in" / f"{k}"
        part.mkdir(parents=True)
        own = lines[k * len(lines) // files : (k + 1) * len(lines) // files]
        (part / "run.log").write_text("\n".join(own) + "\n")
        at = 1_700_000_000 + 10 * (k * 3 % 7 if shuffled else k)
        os.utime(part / "run.log", (at, at))  # files are read in order of their time
    stream = spark.readStream.option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").text(str(tmp_path / "in"))
    stream = stream.select(F.lit("run.log").alias("file"), F.lit(0).alias("line"), "value")
    spans = marks.spans(logs.parsed(stream), seconds=1000, late=late)
    out = spans.writeStream.foreachBatch(lambda df, k: df.withColumn("k", F.lit(k)).write.mode("append").parquet(str(tmp_path / "out")))
    out.outputMode("update").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()

    rows = spark.read.parquet(str(tmp_path / "out"))
    last = {(r["batch"], r["step"]): r for r in rows.orderBy("k").collect()}
    batch = spark.createDataFrame([("run.log", i, v) for i, v in enumerate(lines)], "file string, line int, value string")
    events = logs.parsed(batch)
    want = {(r["batch"], ""): (r["node"], r["started"], r["ended"]) for r in logs.batches(events).collect()}
    assert {k: (r["node"], r["started"], r["ended"]) for k, r in last.items() if k[1] == ""} == want
    want = {(r["batch"], r["step"]): (r["started"], r["ended"]) for r in logs.steps(events).filter("batch is not null").collect()}
    assert {k: (r["started"], r["ended"]) for k, r in last.items() if k[1]} == want
    status = {k: r["status"] for k, r in last.items()}
    assert {k for k, s in status.items() if s != "completed"} == {(4, ""), (4, "step02-part"), (8, "")}
    assert status[4, ""] == status[4, "step02-part"] == ("running" if shuffled else "timed out")
    assert status[8, ""] == "running"


def test_live_lines_have_the_columns(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = live.log_lines(spark, str(tmp_path / "in"))
    assert marks.marks(logs.parsed(lines)).columns == ["file", "batch", "step", "node", "mark", "ts"]
