"""Operators 2, 7, 8 and 10 against brute force."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import anchors, arrays, decontamination, hyperminhash, seed_extend, suffix_index

from . import brute
from .conftest import sentence


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_near_duplicates(odd, pairs_of):
    want = brute.components(pairs_of)
    found = hyperminhash.near_duplicates(odd).collect()
    assert len(found) == len(pairs_of)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_near_duplicates_in_blocks(odd, pairs_of, monkeypatch):
    monkeypatch.setattr(hyperminhash, "SHOWN", 2)
    monkeypatch.setattr(hyperminhash, "TOGETHER", 2)
    want = brute.components(pairs_of)
    found = {r["doc_id"]: r["component_id"] for r in hyperminhash.near_duplicates(odd).collect() if r["doc_id"] is not None}
    assert found == {d: c for d, (_, c) in want.items()}


def test_ids_with_several_texts(spark):
    """What is linked with one text of an id is linked with all of them."""
    rng = random.Random(5)
    a, b, c = (sentence(rng, 80) for _ in range(3))
    near = lambda t: " ".join(["zz", *t.split()[1:]])
    rows = [(5, a), (5, b), (3, near(a)), (9, near(b)), (7, c), (8, c), (1, "short"), (2, None)]
    for _ in range(2):
        found = hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
        assert {(r["doc_id"], r["component_id"], r["kept"]) for r in found} == {
            (5, 3, False), (3, 3, True), (9, 3, False), (7, 7, True), (8, 7, False), (1, 1, True), (2, 2, True)
        }
        rows.reverse()


def test_texts_of_one_form_are_found_out(spark):
    """Four fifths of each text is one form: most pairs share buckets, none of them is alike, but for those planted."""
    rng = random.Random(6)
    form = [sentence(rng, 16) for _ in range(10)]
    rows = [(i, " ".join(x + " " + sentence(rng, 4) for x in form)) for i in range(300)]
    for i in range(0, 60, 3):  # near copies of several degrees
        w = rows[i][1].split()
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(len(w))] = "yy"
        rows.append((1000 + i, " ".join(w)))
    want = brute.components(rows)
    found = {r["doc_id"]: r["component_id"] for r in hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {d: c for d, (_, c) in want.items()}


def test_chains_of_links_are_one_component(spark):
    n = 200
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "a long, b long")
    labels = {r["node"]: r["label"] for r in hyperminhash.components(links).collect()}
    assert labels == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(5)
    for size, share in ((40, 0.8), (400, 0.75), (4000, 0.9)):
        union = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2))
        a = union[: int(len(union) * (1 + share) / 2)]
        b = union[len(union) - len(a) :]
        true = len(np.intersect1d(a, b)) / len(union)
        both = np.stack([hyperminhash.registers(np.zeros(len(x), np.int64), np.sort(x), 1)[0] for x in (a, b)])
        assert abs((both[0] == both[1]).mean() - true) < 5 * (true * (1 - true) / min(len(a), hyperminhash.REGISTERS)) ** 0.5 + 0.01


def test_keep_one_keeps_all_columns(odd):
    out = hyperminhash.keep_one(odd)
    assert out.columns == odd.columns
    assert out.filter("doc_id is null").count() == 2


def test_seed_extend(odd, pairs_of):
    found = got(seed_extend.cut(odd), "row.doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert found == sorted(brute.without_word_repeats(pairs_of), key=repr)
    out = seed_extend.without_repeats(odd)
    assert out.columns == odd.columns
    assert out.count() == len(pairs_of)


def test_cut_texts_come_once_and_go_in_pieces():
    """A batch of 8 MB of text, null and empty ones too: a text isn't sent beside its row, and no batch is much over a chunk."""
    texts = [None, "", *[f"w{i} " * (arrays.CHUNK // 16) for i in range(10, 40)], None, " a  b "]
    row = pa.array([{"spans": "x", "text": t, "doc_id": i} for i, t in enumerate(texts)])
    spans = pa.array([None] * 33 + [[{"start": 0, "size": 1}]], pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int32())])))
    out = list(seed_extend._without([pa.RecordBatch.from_arrays([row, spans], names=["row", "spans_"])]))
    assert len(out) > 5 and max(b.column(3).nbytes for b in out) < 2 * arrays.CHUNK
    found = pa.Table.from_batches(out).to_pylist()
    assert [r["row"]["doc_id"] for r in found] == list(range(34))
    assert [r["kept"] for r in found] == [" ".join((t or "").split()) for t in texts[:33]] + ["b"]
    assert [r["n_removed"] for r in found] == [0] * 33 + [1]


def test_suffix_index(odd, pairs_of):
    found = got(suffix_index.cut(odd), "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert found == sorted(brute.without_byte_repeats(pairs_of), key=repr)


@pytest.mark.parametrize("crowd", [0, 3])
def test_crowded_anchors_give_the_same(odd, pairs_of, monkeypatch, crowd):
    monkeypatch.setattr(anchors, "CROWD", crowd)
    assert got(seed_extend.cut(odd), "row.doc_id", "n_removed") == sorted(((d, n) for d, _, n, _ in brute.without_word_repeats(pairs_of)), key=repr)
    assert got(suffix_index.cut(odd), "row.doc_id", "n_removed") == sorted(((d, n) for d, _, n, _, _ in brute.without_byte_repeats(pairs_of)), key=repr)


@pytest.mark.parametrize("size", [40, 90])
def test_a_run_of_bytes_in_many_texts_is_no_crowd(spark, monkeypatch, size):
    """Windows go one by one only around runs of over FINER bytes; in the end the texts are the same."""
    monkeypatch.setattr(anchors, "CROWD", 1)
    rng = random.Random(5)
    run = sentence(rng, 60)[:size]
    rows = [(i, f"{sentence(rng, 30)[:120]}{run}{sentence(rng, 30)[:120]}") for i in range(40)]
    rows += [(40 + i, rows[i][1][20:240]) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = anchors.tagged(docs)
    found = anchors.sifted(anchors.phrases(texts, suffix_index.RULE), suffix_index.RULE)
    crowded = [f.filter(F.col("state") == anchors.CROWDED).count() for f in (found, suffix_index._divided(texts, found))]
    assert crowded[0] > 0 and (crowded[1] == 0) == (size < suffix_index.FINER)
    assert got(suffix_index.cut(docs), "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)) == sorted(brute.without_byte_repeats(rows), key=repr)


def repeating(times, unit):
    """A text that repeats a block many times, and others that share short runs with it, some of them a whole window."""
    rng = random.Random(17)
    block = sentence(rng, 60).split()
    rows = [(1, " ".join(block * times))]
    for i in range(28):
        w = sentence(rng, 120).split()
        for k in range(0, 100, 9):
            at = rng.randrange(50)
            w[k : k + unit] = block[at : at + unit]
        if i % 7 == 0:
            at = rng.randrange(40)
            w[110:] = block[at : at + 15]
        rows.append((2 + i, " ".join(w)))
    return rows


@pytest.mark.parametrize(("times", "records", "parts"), [(5000, 10_000, 1), (6000, 10_000, 8), (700, 100, 1), (700, 10, 8)])
def test_a_text_that_repeats_a_block(spark, times, records, parts):
    rows = repeating(times, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert got(seed_extend.cut(docs), "row.doc_id", "n_words", "n_removed", F.sha2("kept", 256)) == sorted(brute.without_word_repeats(rows), key=repr)
        want = sorted(brute.without_byte_repeats(rows[1:] + [(1, rows[0][1][:60_000])]), key=repr)
        docs = docs.withColumn("text", F.substring("text", 1, 60_000))
        assert got(suffix_index.cut(docs), "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("step", [1, 3, 40, 1000])
def test_extension_in_small_batches(step):
    """Routes that go on over batches give what one batch gives, and what comparing all pairs gives."""
    rng = np.random.default_rng(4)
    n = 600
    route, doc = rng.integers(0, 5, n), rng.integers(0, 60, n)
    order = np.lexsort((doc, route))
    route, doc = route[order], doc[order]
    lead, right = rng.integers(0, 9, n), rng.integers(0, 9, n)
    words = [[int(x) for x in rng.integers(0, 2, a)] + [7] * 5 + [int(x) for x in rng.integers(0, 2, b)] for a, b in zip(lead, right)]

    def extended(step):
        own, out = seed_extend.Extension(), set()
        for lo in range(0, n, step):
            part = slice(lo, lo + step)
            columns = [route[part], doc[part], np.arange(n)[part].astype(np.int32), np.zeros(n, np.int64)[part], lead[part].astype(np.int32)]
            found = own(pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(words[part], pa.list_(pa.int64()))], names=list("abcdef")))
            for _, tag, start, size in zip(*(c.to_pylist() for c in found.columns)):
                out |= {(tag, start + k) for k in range(size - 12)}
        return out

    want = set()
    for i in range(n):
        for j in range(n):
            if route[i] == route[j] and doc[j] < doc[i]:
                a = next((k for k in range(min(lead[i], lead[j])) if words[i][lead[i] - 1 - k] != words[j][lead[j] - 1 - k]), min(lead[i], lead[j]))
                m = min(right[i], right[j])
                b = next((k for k in range(m) if words[i][lead[i] + 5 + k] != words[j][lead[j] + 5 + k]), m)
                want |= {(i, lead[i] - k) for k in range(max(0, 8 - b), a + 1)}
    assert extended(step) == want


def test_sifter_in_small_batches():
    rng = np.random.default_rng(2)
    n = 3000
    rows = {"anchor": rng.integers(0, 40, n), "phrase": rng.integers(0, 4, n), "doc_id": rng.integers(0, 500, n), "start": rng.integers(0, 5, n)}
    rows |= {"size": np.full(n, 100, np.int32), "tag": np.zeros(n, np.int32)}
    order = np.lexsort((rows["start"], rows["doc_id"], rows["phrase"], rows["anchor"]))
    rows = {k: v[order] for k, v in rows.items()}

    def sift(step, crowd):
        old, anchors.CROWD = anchors.CROWD, crowd
        try:
            own, out = anchors._Sifter(True), []
            for lo in range(0, n, step):
                out.append(own({k: v[lo : lo + step] for k, v in rows.items()}))
            if own.kept is not None:
                out.append(own({k: v[:0] for k, v in own.kept.items()}, over=True))
        finally:
            anchors.CROWD = old
        out = [x for x in out if x is not None]
        done = np.concatenate([x["state"] for x in out]) == anchors.DECIDED
        return sorted(zip(*(np.concatenate([x[k] for x in out])[done].tolist() for k in ("anchor", "doc_id", "start"))))

    whole = sift(n, 10**9)
    assert whole == sift(7, 10**9) == sift(50, 20) == sift(13, 0)


def test_suffix_family_levels():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 6000).astype(np.uint8)
    family, seen = suffix_index.SuffixFamily(10), set()
    for lo in range(0, 5700, 300):
        starts = np.arange(lo, lo + 300)
        found = family.add(data, starts)
        for s, f in zip(starts, found):
            key = data[s : s + 10].tobytes()
            assert f == (key in seen)
            seen.add(key)
    sizes = [len(x) for x in family.levels]
    assert sum(sizes) == len(seen)
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))


def test_decontamination(spark, odd, pairs_of, monkeypatch):
    base = [t for _, t in pairs_of if t]
    w = base[8].split()
    items = [(1, base[0]), (2, " ".join(base[1].split()[10:40])), (3, "one two THREE"), (4, None), (5, ""), (6, " ".join(w[:12] + ["qq"] + w[13:40])), (7, "never seen in any of these texts at all")]
    items += [(2, " ".join(base[1].split()[10:40])), (None, " ".join(base[2].split()[:20]))]
    table = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, h string")
    want = sorted(set(brute.contained(pairs_of, items)), key=repr)
    columns = ("doc_id", "item_id", "n_item_shingles", "n_shared")
    assert got(decontamination.contaminated(odd, table), *columns) == want
    monkeypatch.setattr(decontamination, "MOST_SENT", 10)
    monkeypatch.setattr(decontamination, "MOST_IDS", 1)
    assert got(decontamination.contaminated(odd, table), *columns) == want
    out = decontamination.clean(odd, table)
    assert out.columns == odd.columns
    hit = {d for d, *_ in want}
    assert {r["doc_id"] for r in out.collect()} == {d for d, _ in pairs_of} - hit | ({None} if None in {d for d, t in pairs_of if not t} else set())


@pytest.mark.parametrize("run", [hyperminhash.near_duplicates, seed_extend.cut, suffix_index.cut])
def test_empty_tables(odd, run):
    assert run(odd.limit(0)).count() == 0


def test_decontamination_of_empty_tables(odd):
    items = odd.select(F.col("doc_id").alias("item_id"), "text")
    assert decontamination.contaminated(odd.limit(0), items).count() == 0
    assert decontamination.contaminated(odd, items.limit(0)).count() == 0
