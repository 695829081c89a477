"""Histograms by group and coverage by year, by hand."""

from __future__ import annotations

import math
import random

import pytest

from broadsheet.operators import aggregates


def test_histograms(spark):
    rng = random.Random(1)
    groups = {"a": [rng.random() for _ in range(300)], "b": [0.5], "c": [0.25] * 40, "d": [0.0, 1.0], "e": []}
    rows = [(g, v, "x") for g, values in groups.items() for v in values] + [("e", None, "x"), (None, 0.5, "x")]
    got = {(r["g"], r["bin"]): (r["n"], r["lo"], r["hi"]) for r in aggregates.histograms(spark.createDataFrame(rows, "g string, v double, bin string").repartition(3), "g", "v").collect()}
    want = {}
    for g, values in groups.items():
        if values:
            bins = min(50, max(1, math.ceil(math.log2(len(values)) + 1))) if len(values) > 1 else 1
            lo, hi = min(values), max(values) if min(values) < max(values) else min(values) + 1
            width = (hi - lo) / bins
            for v in values:
                k = min(math.floor((v - lo) / width), bins - 1)
                want[g, k] = (want.get((g, k), (0,))[0] + 1, lo + k * width, lo + (k + 1) * width)
    assert got.keys() == want.keys()
    for k, (n, lo, hi) in want.items():
        assert got[k] == (n, pytest.approx(lo), pytest.approx(hi))


def test_coverage_by_year(spark):
    covered = spark.createDataFrame([(1, 10.0), (2, 30.0), (3, 5.0), (4, 7.0)], "scan_id int, coverage double")
    years = spark.createDataFrame([(1, 1900), (2, 1900), (3, 1901), (4, None)], "scan_id int, year int")
    got = {r["year"]: (r["n"], r["mean"], r["deviation"]) for r in aggregates.coverage_by_year(covered, years).collect()}
    assert got == {1900: (2, 20.0, pytest.approx(200**0.5)), 1901: (1, 5.0, 0.0)}
    crops = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b")], "scan_id int, kind string")
    assert {(r["kind"], r["crops"], r["n"], r["mean"]) for r in aggregates.crops_per_scan(crops, "kind").collect()} == {("a", 3, 2, 1.5), ("b", 1, 1, 1.0)}
