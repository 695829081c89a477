"""Aggregates of a run: statistics, shares, histograms, top lists, agreement, terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spread(value: Column) -> list[Column]:
    """n, mean, median, sample deviation (0 under two values), least and greatest."""
    return [
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.median(value).alias("median"),
        F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("deviation"), F.min(value).alias("least"), F.max(value).alias("greatest"),
    ]


def top(rows: DataFrame, by: str, n: int, count: Column | None = None) -> DataFrame:
    """The n most frequent values; ties by value, since the first one seen means nothing in a distributed table."""
    counted = rows.groupBy(by).agg((F.count(F.lit(1)) if count is None else count).alias("n"))
    return counted.orderBy(F.desc("n"), by).limit(n)


def histogram(rows: DataFrame, value: str, most: int = 50) -> DataFrame:
    """bin, n: equal bins by Sturges' rule, the last closed; empty bins are left out. Three numbers are joined back, no rows moved."""
    v = F.col(value).cast("double")
    rows = rows.select(v.alias("v")).filter("v is not null")
    limits = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("all"))
    bins = F.when(F.col("all") > 1, F.least(F.lit(most), F.greatest(F.lit(1), F.ceil(F.log2("all") + 1)))).otherwise(1).cast("int")
    limits = limits.withColumn("bins", bins).withColumn("hi", F.when(F.col("lo") == F.col("hi"), F.col("lo") + 1).otherwise(F.col("hi")))
    place = F.floor((F.col("v") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / F.col("bins")))
    binned = rows.crossJoin(F.broadcast(limits))  # one row
    return binned.groupBy(F.least(place, F.col("bins") - 1).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def histograms(rows: DataFrame, by: str, value: str, most: int = 50) -> DataFrame:
    """by, bin, lo, hi, n: a histogram of each group, such as the confidences of each category, with bins as in `histogram`.

    A group's limits are one aggregate; they are joined to counts of distinct values, so that a large group's rows don't meet.
    """
    counted = rows.select(by, F.col(value).cast("double").alias("v")).filter(f"v is not null and `{by}` is not null").groupBy(by, "v").agg(F.count(F.lit(1)).alias("k"))
    limits = counted.groupBy(by).agg(F.min("v").alias("least"), F.max("v").alias("most"), F.sum("k").alias("all"))
    bins = F.when(F.col("all") > 1, F.least(F.lit(most), F.greatest(F.lit(1), F.ceil(F.log2("all") + 1)))).otherwise(1).cast("int")
    limits = limits.withColumn("bins", bins).withColumn("width", F.when(F.col("least") == F.col("most"), 1.0 / F.col("bins")).otherwise((F.col("most") - F.col("least")) / F.col("bins")))
    placed = counted.join(limits, by).withColumn("bin", F.least(F.floor((F.col("v") - F.col("least")) / F.col("width")), F.col("bins") - 1).cast("int"))
    edge = lambda k: F.col("least") + (F.col("bin") + k) * F.col("width")
    return placed.groupBy(by, "bin").agg(F.first(edge(0)).alias("lo"), F.first(edge(1)).alias("hi"), F.sum("k").alias("n"))


def shares(counts: DataFrame, group: str, n: str = "n") -> DataFrame:
    """Percent of each row in its group; 0 if the group's total is."""
    total = F.sum(n).over(Window.partitionBy(group))
    return counts.withColumn("share", F.coalesce(F.try_divide(100.0 * F.col(n), total), F.lit(0.0)))


def stacked(counts: DataFrame, group: str, order: str, n: str = "n") -> DataFrame:
    """Running share within the group, as an area chart stacks them."""
    run = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(n).over(Window.partitionBy(group))
    return counts.withColumn("upto", F.coalesce(F.try_divide(100.0 * F.sum(n).over(run), total), F.lit(0.0)))


def coverage(scans: DataFrame, crops: DataFrame, area: Column) -> DataFrame:
    """scan_id, coverage: summed areas of its crops in percent of the scan's; overlaps count twice."""
    summed = crops.select("scan_id", area.alias("area")).filter("area > 0").groupBy("scan_id").agg(F.sum("area").alias("area"))
    full = scans.select("scan_id", (F.col("width") * F.col("height")).alias("full")).filter("full > 0")
    return summed.join(full, "scan_id").select("scan_id", (F.lit(100.0) * F.col("area") / F.col("full")).alias("coverage"))


def coverage_by_year(covered: DataFrame, years: DataFrame) -> DataFrame:
    """covered(scan_id, coverage), years(scan_id, year) -> the spread of coverage by year; scans without a year are left out."""
    return covered.join(years.filter("year is not null"), "scan_id").groupBy("year").agg(*spread(F.col("coverage")))


def crops_per_scan(crops: DataFrame, by: str) -> DataFrame:
    """crops(scan_id, by) -> by, crops, and the spread of their number on scans that have some."""
    per = crops.groupBy("scan_id", by).agg(F.count(F.lit(1)).alias("crops"))
    return per.groupBy(by).agg(F.sum("crops").alias("crops"), *spread(F.col("crops")))


def agreement(rows: DataFrame, image: str, text: str, final: str) -> DataFrame:
    same = lambda a, b: F.sum(F.when(F.col(a) == F.col(b), 1).otherwise(0))
    return rows.agg(
        F.count(F.lit(1)).alias("n"), same(image, text).alias("image_text"), same(final, image).alias("final_image"), same(final, text).alias("final_text")
    )


def term_totals(matches: DataFrame, column: str, *by: str) -> DataFrame:
    """matches(map of category to map of term to count): term, n; one term of several categories adds up."""
    terms = matches.select(*by, F.explode(column).alias("category", "terms")).select(*by, F.explode("terms").alias("term", "k"))
    return terms.groupBy(*by, "term").agg(F.sum("k").alias("n"))


def per_scan_by_year(values: DataFrame, value: str) -> DataFrame:
    """values(year, scan_id, value): sum of value by year, over the year's distinct scans (1 if none)."""
    by_year = values.groupBy("year").agg(F.sum(value).alias("total"), F.countDistinct("scan_id").alias("scans"))
    return by_year.select("year", "total", "scans", (F.col("total") / F.greatest("scans", F.lit(1))).alias("per_scan"))


def category_area(crops: DataFrame) -> DataFrame:
    """crops(scan_id, year, category, area, full): by year and category, percent of the scan's full area.

    by_scan: the mean over the scans that have the category of what its crops cover there together; by_crop: over crops.
    """
    share = F.col("area").cast("double") / F.col("full") * 100
    rows = crops.filter("area is not null and category is not null and year is not null and full > 0")
    scans = rows.groupBy("scan_id", "year", "category").agg(F.sum(share).alias("share"), F.count(F.lit(1)).alias("n"))
    sums = scans.groupBy("year", "category").agg(F.count(F.lit(1)).alias("scans"), F.sum("n").alias("crops"), F.sum("share").alias("share"))
    return sums.select("year", "category", "scans", "crops", (F.col("share") / F.col("scans")).alias("by_scan"), (F.col("share") / F.col("crops")).alias("by_crop"))


def eta(batches: DataFrame, now: Column) -> DataFrame:
    """batches(status, started, ended): mean seconds of a completed batch, and seconds until all are done; null if none are left."""
    seconds = lambda a, b: b.cast("double") - a.cast("double")
    mean = batches.filter("status = 'completed'").agg(F.avg(seconds(F.col("started"), F.col("ended"))).alias("mean"))
    left = F.when(F.col("status") == "pending", F.col("mean")).when(
        F.col("status") == "running", F.greatest(F.lit(0.0), F.col("mean") - seconds(F.col("started"), now))
    )
    joined = batches.crossJoin(F.broadcast(mean))  # one row
    return joined.agg(F.first("mean").alias("mean_seconds"), F.nullif(F.sum(left), F.lit(0.0)).alias("eta_seconds"))


def sample_bounded(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """A uniform sample of at most n rows; a sampling operator, so it depends on the seed."""
    return rows.orderBy(F.rand(seed)).limit(n)


def progress(done: DataFrame, total: DataFrame, by: str | None = None) -> DataFrame:
    """Percent of total rows that are done, over all or by a column; 0 where there is nothing to do."""
    keys = [by] if by else []
    n = total.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"))
    d = done.groupBy(*keys).agg(F.count(F.lit(1)).alias("done"))
    both = n.join(d, keys, "left") if by else n.crossJoin(d)  # one row each
    share = F.coalesce(F.try_divide(100.0 * F.coalesce("done", F.lit(0)), "total"), F.lit(0.0))
    return both.select(*keys, "total", F.coalesce("done", F.lit(0)).alias("done"), share.alias("percent"))
