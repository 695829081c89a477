"""The crops of a run, with the year of their issue, and what the statistics need of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import records
from ..operators import relational, sequences

#: Fixed value: issues before this year are a slice of their own.
CUTOFF = 1931


@dataclass(frozen=True)
class RunView:
    crops: DataFrame  # crop_id, scan_id, issue_id, year

    @staticmethod
    def of(crop: DataFrame, scan: DataFrame, issue: DataFrame, item: DataFrame, batch: DataFrame, run_id: int) -> RunView:
        """Crops that belong to some batch item of the run, each once, though its issue may be in several batches."""
        items = item.join(batch.filter(F.col("pipeline_run_id") == run_id).select(F.col("id").alias("pipeline_batch_id")), "pipeline_batch_id")
        own = crop.join(items.select(F.col("id").alias("pipeline_batch_item_id")), "pipeline_batch_item_id", "left_semi")
        scans = scan.select(F.col("id").alias("scan_id"), "issue_id")
        issues = issue.select(F.col("id").alias("issue_id"), "year")
        return RunView(own.select(F.col("id").alias("crop_id"), "scan_id").join(scans, "scan_id").join(issues, "issue_id"))

    def before(self, year: int = CUTOFF) -> RunView:
        return RunView(self.crops.filter(F.col("year") < year))

    def only(self, satellite: DataFrame) -> DataFrame:
        """The satellite's rows of these crops, with year."""
        return satellite.join(self.crops.select("crop_id", "year"), "crop_id")

    def counts(self) -> DataFrame:
        """Distinct issues, scans and crops. Fan-out doesn't count twice."""
        return self.crops.agg(F.countDistinct("issue_id").alias("issues"), F.countDistinct("scan_id").alias("scans"), F.countDistinct("crop_id").alias("crops"))

    def record_counts(self, tables: dict[str, DataFrame]) -> DataFrame:
        keys = self.crops.select("crop_id")
        return relational.record_counts({name: relational.within(t, keys, "crop_id") for name, t in tables.items()})


def plan_run(issues: DataFrame, done: DataFrame | None, size: int) -> DataFrame:
    """issue id -> batch, in order of id; issues that were in a run before are left out first (append mode)."""
    left = issues.select("id") if done is None else issues.select("id").join(done.select(F.col("issue_id").alias("id")).distinct(), "id", "left_anti")
    return sequences.batches(left, "id", size)


def free_batches(batches: DataFrame, now, timeout_seconds: float) -> DataFrame:
    """Batches that may be run: never started, crashed, or started too long ago without an end."""
    late = records.timed_out(F.col("started_date"), F.col("ended_date"), now, timeout_seconds)
    return batches.filter(F.col("started_date").isNull() | F.coalesce(F.col("has_crashed"), F.lit(False)) | late)
