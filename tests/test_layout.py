"""Columns, overlaps, nearest places and reading order against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from broadsheet.operators import layout


def brute_clusters(x):
    """Clusters of a sorted list by recursion on its spans: (mass, chosen spans) of each."""

    def split(a, z):
        """The last edge that joins the places a..z: of the largest gaps the last."""
        return max(range(a, z), key=lambda i: (x[i + 1] - x[i], i))

    def best(a, z, birth):
        """Largest excess of mass of the cluster a..z or of those in it."""
        spans, mass, lo, hi = [(a, z)], 0.0, a, z
        while hi > lo:
            e = split(lo, hi)
            at = 1 / (x[e + 1] - x[e]) if x[e + 1] > x[e] else float("inf")
            left, right = e - lo + 1, hi - e
            if left >= 2 and right >= 2:
                mass += (left + right) * (at - birth)
                (m1, s1), (m2, s2) = best(lo, e, at), best(e + 1, hi, at)
                return (m1 + m2, s1 + s2) if m1 + m2 > mass else (mass, spans)
            if left == right == 1:
                mass += 2 * (at - birth)
                break
            mass += at - birth
            lo, hi = (e + 1, hi) if left == 1 else (lo, e)
        return mass, spans

    out = [-1] * len(x)
    lo, hi = 0, len(x) - 1
    while hi > lo:  # the whole is no cluster: the first split into two clusters counts
        e = split(lo, hi)
        if e - lo >= 1 and hi - e >= 2:
            at = 1 / (x[e + 1] - x[e])
            spans = sorted(best(lo, e, at)[1] + best(e + 1, hi, at)[1])
            for k, (a, z) in enumerate(spans):
                out[a : z + 1] = [k] * (z - a + 1)
            break
        if e - lo == 0 and hi - e == 1:
            break
        lo, hi = (e + 1, hi) if e == lo else (lo, e)
    return out


def test_clusters():
    rng = random.Random(1)
    for case in range(1000):
        n = rng.randint(0, 40)
        if case % 3:
            x = [rng.choice((0, 100, 230, 400)) + rng.gauss(0, rng.choice((1, 10, 60))) for _ in range(n)]
        else:  # equal places and gaps
            x = [float(rng.randint(0, rng.choice((5, 30, 200)))) for _ in range(n)]
        x.sort()
        assert layout.clusters(x) == brute_clusters(x), x
    assert layout.clusters([0, 1, 10, 11, 50.0]) == [0, 0, 1, 1, -1]
    assert layout.clusters([0.0] * 30_000) == [-1] * 30_000
    assert set(layout.clusters([float(i * i) for i in range(30_000)])) == {-1}


def brute_order(width, boxes):
    """Ids of boxes (id, left, top, right, bottom, category, text) as the page is read; wide boxes see all that stands in a column so far."""
    x = {b[0]: (b[1] + b[3]) / 2 for b in boxes}
    y = {b[0]: (b[2] + b[4]) / 2 for b in boxes}
    by_id = {b[0]: b for b in boxes}
    ids = [b[0] for b in boxes]
    if len(ids) == 2:
        a, b = ids
        beside = abs(y[a] - y[b]) < abs(x[a] - x[b]) * 0.5
        order = [a, b] if (x[a] < x[b] if beside else y[a] < y[b]) else [b, a]
    else:
        limit = np.percentile([b[3] - b[1] for b in boxes], 25) * 1.4
        narrow = [i for i in ids if by_id[i][3] - by_id[i][1] <= limit]
        core = [i for i in narrow if by_id[i][5] == "Content"]
        columns, wide = {0: list(ids)}, []
        if len(narrow) >= 2:
            core, wide = (core if len(core) >= 2 else narrow), [i for i in ids if i not in narrow]
            ordered = sorted(core, key=lambda i: x[i])
            label = dict(zip(ordered, brute_clusters([x[i] for i in ordered])))
            sure = [i for i in core if label[i] >= 0]
            columns = {}
            for i in core:
                own = label[i] if label[i] >= 0 else label[sure[int(np.argmin([abs(x[j] - x[i]) for j in sure]))]] if sure else 0
                columns.setdefault(own, []).append(i)
            centre = {k: np.mean([x[i] for i in v]) for k, v in columns.items()}
            for i in narrow:
                if i not in core:
                    columns[min(centre, key=lambda k: abs(centre[k] - x[i]))].append(i)
            sides = sorted(((np.mean([x[i] for i in v]), min(by_id[i][1] for i in v), max(by_id[i][3] for i in v), k) for k, v in columns.items()), key=lambda s: s[0])
            for i in wide:
                b = by_id[i]
                touched = [(sum(by_id[j][4] < b[2] for j in columns[k]), -c, k) for c, lo, hi, k in sides if b[1] <= hi and b[3] >= lo]
                columns[max(touched, key=lambda t: t[:2])[2] if touched else sides[0][3]].append(i)
        order = [i for v in sorted(columns.values(), key=lambda v: np.mean([x[i] for i in v])) for i in sorted(v, key=lambda i: y[i])]
    parts = 15 if len(ids) > 80 else 12 if len(ids) > 40 else 10

    def key(i):
        b = by_id[i]
        text = (b[6] or "").strip()
        return int(b[1] / width * parts), b[2] if b[5] in layout.PICTURES else y[i], int(bool(text) and text[0].islower())

    return sorted(order, key=key)


def random_scan(rng):
    """Boxes in columns, wide ones, noise, pictures; also pages of one, two, or only wide boxes, and many at the same place."""
    n = rng.choice((1, 2, 2, 3, 5, 12, 30, 60, 100))
    boxes = []
    for i in range(n):
        left = rng.choice((0, 210, 420, 640)) + rng.choice((0, 0, rng.randint(0, 15), rng.randint(0, 90)))
        width = rng.choice((180, 180, 190, 200, 420, 830)) if n > 3 else rng.choice((10, 300))
        top = rng.choice((rng.randint(0, 900), 100, 300))
        boxes.append((i * 3 + 1, float(left), float(top), float(left + width), float(top + rng.randint(5, 80)), rng.choice(("Content", "Content", "Content", "Advert", "Cartoon", None)), rng.choice(("Text", "more", " and", None, ""))))
    return boxes


def test_reading_order(spark):
    rng = random.Random(7)
    scans = {k: random_scan(rng) for k in range(250)}
    rows = [(k, b[0], 900.0, list(b[1:5]), b[5], b[6]) for k, boxes in scans.items() for b in boxes]
    rng.shuffle(rows)
    crops = spark.createDataFrame(rows, "scan_id long, crop_id long, scan_width double, box array<double>, category string, text string").repartition(6)
    got: dict = {}
    for r in layout.reading_order(crops).collect():
        got.setdefault(r["scan_id"], []).append((r["reading_order"], r["crop_id"]))
    for k, boxes in scans.items():
        assert [i for _, i in sorted(got[k])] == brute_order(900.0, boxes), boxes
    assert layout.reading_order(crops.limit(0)).count() == 0
    kinds = {r["kind"] for r in layout.columns(crops).collect()}
    assert kinds == {"core", "rest", "wide"}


def test_boxes_without_numbers_are_left_out(spark):
    crops = spark.createDataFrame([(1, 1, [0.0, 0.0, 5.0, 5.0], "Content"), (1, 2, None, "Content"), (1, 3, [1.0, None, 2.0, 3.0], None), (2, 4, [], None)], "scan_id long, crop_id long, box array<double>, category string")
    assert [tuple(r) for r in layout.columns(crops).collect()] == [(1, 1, 0, "core")]


@pytest.mark.parametrize("width", [1.0, 7.5, 1000.0])
def test_overlapping(spark, width):
    rng = random.Random(3)
    make = lambda n: [(rng.randint(0, 3), i, float(a := rng.randint(-50, 50)), float(a + rng.choice((-1, 0, 1, 5, 40)))) for i in range(n)]
    a, b = make(200), make(60)
    a += [(None, 900, 0.0, 1.0), (0, 901, None, 1.0), a[0]]
    frame = lambda rows: spark.createDataFrame(rows, "scan_id int, i int, left double, right double").repartition(3)
    got = sorted((r["i"], r["i_b"]) for r in layout.overlapping(frame(a), frame(b), "scan_id", width).collect())
    well = lambda r: None not in r and r[2] <= r[3]
    assert got == sorted((p[1], q[1]) for p in a for q in b if well(p) and well(q) and p[0] == q[0] and p[2] <= q[3] and p[3] >= q[2])


@pytest.mark.parametrize("width", [0.5, 10.0, 1e6])
def test_nearest(spark, width):
    rng = random.Random(4)
    points = [(rng.randint(0, 4), i, float(rng.randint(-60, 60)) / 2) for i in range(300)] + [(1, 900, None), (None, 901, 1.0)]
    targets = [(rng.randint(0, 3), float(rng.randint(-60, 60)) / 2, i, f"t{i}") for i in rng.sample(range(1000), 80)] + [(1, None, 0, "none"), (None, 1.0, 1, "none")]
    found = layout.nearest(spark.createDataFrame(points, "g int, i int, x double").repartition(3), spark.createDataFrame(targets, "g int, x double, first long, value string").repartition(2), "g", width)
    got = {r["i"]: r["target"] and r["target"]["value"] for r in found.collect()}
    for g, i, x in points:
        near = [(abs(t[1] - x), t[2], t[3]) for t in targets if x is not None and t[0] == g is not None and t[1] is not None]
        assert got[i] == (min(near)[2] if near else None), (g, i, x)
    assert len(got) == len(points)


def test_scans_go_one_by_one_whatever_the_batches(spark):
    """No scan is collected into a row, and scans that end inside a batch, at its end or after many of them are whole."""
    rng = random.Random(9)
    rows = [(k, b[0], list(b[1:5]), b[5]) for k in [*range(40), None] for b in random_scan(rng)]
    crops = spark.createDataFrame(rows, "scan_id long, crop_id long, box array<double>, category string").repartition(3)
    assert "collect_list" not in layout.columns(crops)._jdf.queryExecution().toString()
    key, found = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(key)
    try:
        for n in (1, 7, 10_000):
            spark.conf.set(key, n)
            found.append(sorted((tuple(r) for r in layout.columns(crops).collect()), key=repr))
    finally:
        spark.conf.set(key, before)
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)


def test_reading_order_collects_no_scan(spark):
    crops = spark.createDataFrame([(1, 1, 9.0, [0.0, 0.0, 5.0, 5.0], "Content", "a")], "scan_id long, crop_id long, scan_width double, box array<double>, category string, text string")
    found = layout.reading_order(crops)
    assert "collect_list" not in found._jdf.queryExecution().toString()
    assert [r["reading_order"] for r in found.collect()] == [1]
