"""Analytics of run logs: lines with marks to batches, steps, samples and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import records

#: The forms of log lines.
LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3}) \| (\w+)\s+\| (.+?) - (.+)"
BATCH = r"^(START|END) RUN#(\d+) BATCH#(\d+) NODE#(.+?)(?: - (.+))?\s*$"
STEP = r"^(START|END) (step\d+-[\w-]+) RUN#(\d+) BATCH#(\d+) NODE#(.+?)(?: - (.+))?\s*$"
RUN = r"^(START|END) RUN#(\d+)(?: - (.+))?\s*$"
TOOK = r"(step\d+_\w+) took ([\d.]+)s"
SUMMARY = r"Batches (processed|crashed|skipped): (\d+)"
CACHED = r".+? \(.+?\): (?:archive downloaded, (\d+) scans extracted\.|(\d+) scans already in cache\. Skipping\.)"
CROPPED = r"(\d+) crops across (\d+) scans"
STEP_SOURCE = "commands.steps."
DRY_RUN = "Dry run mode:"
SAMPLE = r"RESOURCE_SAMPLE step=([\w-]*) batch=(\d+|None) ram_pct=([\d.]+) cpu_pct=([\d.]+) vram_pcts=(\S*)"


def _group(column: Column, pattern: str, i: int) -> Column:
    return F.nullif(F.regexp_extract(column, pattern, i), F.lit(""))


def parsed(lines: DataFrame) -> DataFrame:
    """lines(file, line, value) -> file, line, ts, level, source, message: the lines of that form."""
    value = F.rtrim("value")
    rows = lines.filter(value.rlike(LINE))
    return rows.select(
        "file", "line", F.to_timestamp(F.regexp_extract(value, LINE, 1), "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"),
        F.regexp_extract(value, LINE, 2).alias("level"), F.regexp_extract(value, LINE, 3).alias("source"), F.trim(F.regexp_extract(value, LINE, 4)).alias("message"),
    )


def environment(lines: DataFrame) -> DataFrame:
    """file, key, value of the environment blocks: lines between a headline and a rule."""
    rule = F.when(F.rtrim("value") == "=== Environment configuration ===", True).when(F.rtrim("value").rlike("^={33}$"), False)
    inside = F.last(rule, ignorenulls=True).over(Window.partitionBy("file").orderBy("line"))
    rows = lines.withColumn("inside", inside).filter(F.col("inside") & F.contains("value", F.lit("=")) & ~F.col("value").startswith("==="))
    return rows.select("file", F.trim(F.substring_index("value", "=", 1)).alias("key"), F.trim(F.regexp_replace("value", "^[^=]*=", "")).alias("value"))


def batches(events: DataFrame) -> DataFrame:
    """file, batch, node, started, ended, status: success with an end, else pending."""
    m = F.col("message")
    marks = events.filter(m.rlike(BATCH)).select(
        "file", F.regexp_extract(m, BATCH, 3).cast("int").alias("batch"), F.regexp_extract(m, BATCH, 4).alias("node"), F.regexp_extract(m, BATCH, 1).alias("mark"), "ts"
    )
    grouped = marks.groupBy("file", "batch").agg(
        F.min_by("node", "ts").alias("node"), F.max(F.when(F.col("mark") == "START", F.col("ts"))).alias("started"), F.max(F.when(F.col("mark") == "END", F.col("ts"))).alias("ended")
    )
    return grouped.withColumn("status", F.when(F.col("ended").isNotNull(), "success").otherwise("pending"))


def steps(events: DataFrame) -> DataFrame:
    """file, batch, step, number, started, ended, seconds: seconds from the line that names them, else from the marks."""
    m = F.col("message")
    marks = events.select(
        "file", "ts", "line",
        F.regexp_extract(m, STEP, 1).alias("mark"), _group(m, STEP, 2).alias("step"), _group(m, STEP, 4).cast("int").alias("batch"),
        records.step_name(_group(m, TOOK, 1)).alias("timed"), _group(m, TOOK, 2).cast("double").alias("took"),
    ).filter("step is not null or timed is not null")
    # A line that names seconds belongs to the batch that is on at that point of its file.
    on = F.last("batch", ignorenulls=True).over(Window.partitionBy("file").orderBy("line"))
    marks = marks.withColumn("batch", on).withColumn("step", F.coalesce("step", "timed"))
    out = marks.groupBy("file", "batch", "step").agg(
        F.min(F.when(F.col("mark") == "START", F.col("ts"))).alias("started"), F.max(F.when(F.col("mark") == "END", F.col("ts"))).alias("ended"), F.max_by("took", F.when(F.col("took").isNotNull(), F.col("line"))).alias("took")
    )
    seconds = F.coalesce("took", F.col("ended").cast("double") - F.col("started").cast("double"))
    return out.select("file", "batch", "step", records.step_number(F.col("step")).alias("number"), "started", "ended", seconds.alias("seconds"))


def samples(events: DataFrame) -> DataFrame:
    m = F.col("message")
    return events.filter(m.rlike(SAMPLE)).select(
        "file", "line", "ts", _group(m, SAMPLE, 1).alias("step"), F.nullif(F.regexp_extract(m, SAMPLE, 2), F.lit("None")).cast("int").alias("batch"),
        F.regexp_extract(m, SAMPLE, 3).cast("double").alias("ram_pct"), F.regexp_extract(m, SAMPLE, 4).cast("double").alias("cpu_pct"),
        records.per_device(F.regexp_extract(m, SAMPLE, 5)).alias("vram_pcts"),
    )


def messages(events: DataFrame) -> DataFrame:
    """file, level, step (null outside of steps), message, n: warnings and errors by the step they were logged in."""
    m = F.col("message")
    mark = F.when(m.rlike(STEP), F.struct(F.regexp_extract(m, STEP, 1).alias("mark"), F.regexp_extract(m, STEP, 2).alias("step")))
    last = F.last(mark, ignorenulls=True).over(Window.partitionBy("file").orderBy("line"))
    rows = events.withColumn("last", last).filter(F.col("level").isin("WARNING", "ERROR"))
    return rows.groupBy("file", "level", F.when(F.col("last.mark") == "START", F.col("last.step")).alias("step"), "message").agg(F.count(F.lit(1)).alias("n"))


def message_groups(events: DataFrame) -> DataFrame:
    """file, step, number, step_total, level, message, n: warnings and errors as a report lists them, step by step.

    What isn't said by a step, all there are of a message less those of steps, stands under "Other", which has no number; a step's
    total counts both levels.
    """
    counted = messages(events)
    whole = counted.groupBy("file", "level", "message").agg(F.sum("n").alias("whole"), F.coalesce(F.sum(F.when(F.col("step").isNotNull(), F.col("n"))), F.lit(0)).alias("of_steps"))
    rest = whole.select("file", "level", F.lit("Other").alias("step"), "message", (F.col("whole") - F.col("of_steps")).alias("n")).filter("n > 0")
    both = counted.filter("step is not null").unionByName(rest)
    total = F.sum("n").over(Window.partitionBy("file", "step"))
    number = F.when(F.col("step") != "Other", records.step_number(F.col("step")))
    return both.select("file", "step", number.alias("number"), total.alias("step_total"), "level", "message", "n")


def runs(events: DataFrame) -> DataFrame:
    """file, run, started, ended, took, dry_run, processed, crashed, skipped: the last of each that the file names."""
    m = F.col("message")
    latest = lambda value: F.max_by(value, F.when(value.isNotNull(), F.col("line")))
    mark, kind = F.regexp_extract(m, RUN, 1), F.regexp_extract(m, SUMMARY, 1)
    summed = [latest(F.when(kind == name, F.regexp_extract(m, SUMMARY, 2).cast("int"))).alias(name) for name in ("processed", "crashed", "skipped")]
    return events.groupBy("file").agg(
        latest(F.when(mark == "START", F.regexp_extract(m, RUN, 2).cast("int"))).alias("run"),
        latest(F.when(mark == "START", F.col("ts"))).alias("started"), latest(F.when(mark == "END", F.col("ts"))).alias("ended"),
        latest(F.when(mark == "END", F.trim(_group(m, RUN, 3)))).alias("took"), F.bool_or(F.contains(m, F.lit(DRY_RUN))).alias("dry_run"), *summed,
    )


def counted(events: DataFrame) -> DataFrame:
    """file, batch, issues, scans, crops: what the first two steps of a batch say they have done."""
    m = F.col("message")
    mark = F.when(m.rlike(STEP), F.struct(F.regexp_extract(m, STEP, 1).alias("mark"), F.regexp_extract(m, STEP, 2).alias("step"), F.regexp_extract(m, STEP, 4).cast("int").alias("batch")))
    on = F.last(mark, ignorenulls=True).over(Window.partitionBy("file").orderBy("line"))
    own = events.withColumn("on", on).filter((F.col("level") == "INFO") & F.contains("source", F.lit(STEP_SOURCE)) & (F.col("on.mark") == "START"))
    within = lambda step: F.contains("on.step", F.lit(step))
    scans = F.coalesce(_group(m, CACHED, 1), _group(m, CACHED, 2)).cast("long")
    return own.groupBy("file", F.col("on.batch").alias("batch")).agg(
        F.count(F.when(within("step01"), scans)).alias("issues"), F.coalesce(F.sum(F.when(within("step01"), scans)), F.lit(0)).alias("scans"),
        F.coalesce(F.sum(F.when(within("step02"), _group(m, CROPPED, 1).cast("long"))), F.lit(0)).alias("crops"),
    )


def finished(events: DataFrame) -> DataFrame:
    """file, batch, seconds, issues, scans, crops: batches with a start and a later end."""
    seconds = F.col("ended").cast("double") - F.col("started").cast("double")
    done = batches(events).withColumn("seconds", seconds).filter("seconds > 0").select("file", "batch", "seconds")
    return done.join(counted(events), ["file", "batch"], "left").fillna(0, ["issues", "scans", "crops"])


def step_durations(steps_: DataFrame) -> DataFrame:
    return steps_.groupBy("step").agg(F.sum("seconds").alias("total"), F.avg("seconds").alias("mean"), F.count("seconds").alias("n"))


def throughput(done: DataFrame) -> DataFrame:
    """done(batch, seconds, issues, scans, crops): per minute and hour, a row a batch and one (batch null) for all."""
    rolled = done.rollup("batch").agg(*[F.sum(c).alias(c) for c in ("seconds", "issues", "scans", "crops")])
    rates = [F.try_divide(F.col(c) * k, "seconds").alias(f"{c}_per_{name}") for c in ("issues", "scans", "crops") for k, name in ((60.0, "minute"), (3600.0, "hour"))]
    return rolled.select("batch", "seconds", *rates)
