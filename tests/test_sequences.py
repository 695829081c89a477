"""Packing and pages over ranges against loops over lists."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from broadsheet.operators import sequences


def brute_chunks(sizes, limit):
    chunk, total, out = 0, 0, []
    for n in sizes:
        if total > 0 and total + n > limit:
            chunk, total = chunk + 1, 0
        total += n
        out.append(chunk)
    return out


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_packed(spark, ranges):
    rng = random.Random(ranges)
    rows, want = [], {}
    for corpus, most, n in (("a", 3, 300), ("b", 90, 200), ("c", 0, 20), ("d", 500, 60), (None, 40, 50), ("e", 7, 1)):
        sizes = [rng.choice((0, rng.randint(0, most), rng.randint(0, most))) for _ in range(n)]
        ids = sorted(rng.sample(range(10_000), n))
        rows += [(corpus, i, None if s == 0 and rng.random() < 0.5 else s) for i, s in zip(ids, sizes)]
        want |= {(corpus, i): c for i, c in zip(ids, brute_chunks(sizes, 100))}
    rng.shuffle(rows)
    got = sequences.packed(spark.createDataFrame(rows, "corpus string, id long, n long").repartition(5), "corpus", "id", "n", 100, ranges).collect()
    assert len(got) == len(rows)
    assert {(r["corpus"], r["id"]): r["chunk"] for r in got} == want


@pytest.mark.parametrize("case", range(300))
def test_ranges_tell_what_they_leave(case):
    """For every open sum, a range leaves what a loop leaves."""
    import numpy as np

    rng = random.Random(case)
    limit = rng.randint(1, 12)
    sizes = [rng.choice((0, 1, rng.randint(0, 15))) for _ in range(rng.randint(1, 12))]
    table = sorted(sequences._left_by_range(np.array(sizes), limit))
    assert len(table) <= limit + 2
    for carry in range(30):
        total, begun = carry, 0
        for n in sizes:
            if total > 0 and total + n > limit:
                total, begun = 0, begun + 1
            total += n
        row = [r for r in table if r[0] < carry][-1] if carry else table[0]
        assert (row[1] + (carry if row[2] == 0 else 0), row[2]) == (total, begun), (sizes, limit, carry)


def test_pages(spark):
    """Samples on the ends of pages, pages without samples, equal times, a group of one sample, one that begins and ends with the hour."""
    zero, rng = datetime(2024, 3, 1, 7), random.Random(5)
    times = {"a": [zero + timedelta(minutes=rng.randint(3, 3000)) for _ in range(40)], "b": [zero + timedelta(hours=h) for h in (0, 3, 3, 6, 15, 18)], "c": [zero], "d": [zero + timedelta(minutes=1), zero + timedelta(days=2)]}
    rows = [(g, t, i) for g, ts in times.items() for i, t in enumerate(ts)] + [("a", None, 99)]
    got = {(r["g"], r["page"], r["i"], r["is_edge"], r["start"], r["end"]) for r in sequences.pages(spark.createDataFrame(rows, "g string, t timestamp, i int").repartition(3), "g", "t", "i").collect()}
    want = set()
    for g, ts in times.items():
        ordered = sorted((t, i) for i, t in enumerate(ts))
        start, page = ordered[0][0].replace(minute=0, second=0, microsecond=0), 0
        while start < ordered[-1][0]:
            end = start + timedelta(hours=3)
            inside = [(t, i) for t, i in ordered if start <= t <= end]
            before, after = [x for x in ordered if x[0] < start][-1:], [x for x in ordered if x[0] > end][:1]
            want |= {(g, page, i, edge, start, end) for part, edge in ((inside, False), (before + after, True)) for _, i in part}
            start, page = end, page + 1
    assert got == want
