"""Counts of byte-pair tokens against a library that knows the same vocabulary."""

from __future__ import annotations

import base64
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from broadsheet.operators import byte_pairs
from broadsheet.plans.catalog import VOCABULARY

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    make = lambda pattern: tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return make(r"(?s:.+)"), make(byte_pairs.PATTERN.removeprefix("(?U)"))


def random_text(rng, n):
    return "".join(rng.choice(["the ", "ing", "tion", "a", "é", "ß", "日本", "\n", "  ", " ", "'s", "'re", "42", "…", "-", " ", "\t", "😀", "zq"]) for _ in range(n))


def test_pieces_one_by_one(library, monkeypatch):
    rng = random.Random(2)
    words = ["a" * n for n in (1, 2, 3, 4, 5, 127, 128, 129, 130, 131, 3000)] + [random_text(rng, rng.randint(1, 90)) for _ in range(800)] + ["the", "the", ""]
    want = [len(x) for x in library[0].encode_ordinary_batch(words, num_threads=1)]
    merges = byte_pairs.Merges(VOCABULARY)
    assert merges.counts(pa.array(words)).tolist() == want
    assert merges.counts(pa.array(words).slice(5, 300)).tolist() == want[5:305]
    assert merges.counts(pa.array([], pa.string())).tolist() == []
    monkeypatch.setattr(byte_pairs, "LONG", 3)
    monkeypatch.setattr(byte_pairs, "GROUP", 10)
    assert merges.counts(pa.array(words)).tolist() == want


def test_texts(spark, library):
    rng = random.Random(3)
    texts = [random_text(rng, rng.randint(0, 200)) for _ in range(300)] + [None, "", " ", "\n\n  \n", "x" * 100_000, "It's 12'000'ths   of it"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3)
    got = byte_pairs.counted(rows.select("id", F.length("t").alias("n"), byte_pairs.pieces(F.col("t")).alias("p")), "id", "p", VOCABULARY)
    assert got.columns == ["id", "n", "n_tokens"]
    got = {r["id"]: (r["n"], r["n_tokens"]) for r in got.collect()}
    assert got == {i: (None if t is None else len(t), len(library[1].encode_ordinary(t)) if t else None) for i, t in enumerate(texts)}
    assert byte_pairs.counted(rows.limit(0).select("id", byte_pairs.pieces(F.col("t")).alias("p")), "id", "p", VOCABULARY).count() == 0


def test_words_by_themselves(spark, library):
    rng = random.Random(4)
    lists = [["".join(rng.choice(["the", "ing", "é", "'s", "42", "_", "日"]) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 30))] for _ in range(100)]
    rows = spark.createDataFrame(list(enumerate(lists)), "id int, w array<string>").select("id", byte_pairs.pieces_of_words(F.col("w")).alias("p"))
    got = {r["id"]: r["n_tokens"] for r in byte_pairs.counted(rows, "id", "p", VOCABULARY).collect()}
    assert got == {i: sum(len(library[1].encode_ordinary(w)) for w in words) or None for i, words in enumerate(lists)}


def test_no_piece_is_shuffled(spark):
    rows = spark.createDataFrame([(1, ["the", " the", "the"]), (2, None), (3, [])], "id int, p array<string>")
    found = byte_pairs.counted(rows, "id", "p", VOCABULARY)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in found.collect()) == [(1, 3), (2, None), (3, None)]
