"""Languages by trigrams: by hand, and on texts that aren't trained on."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import languages
from broadsheet.plans import catalog


def grams(text):
    out = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        out.update(f" {word} "[i : i + 3] for i in range(len(word)))
    return out


def test_by_hand(spark):
    rows = [("eng", "The cat, the hat"), ("deu", "Der Hut! Die Katze 12"), ("deu", "dïe"), ("eng", None), (None, "xyz"), ("fra", "")]
    model = languages.fitted(spark.createDataFrame(rows, "l string, t string").repartition(3), "l", "t")
    want = {"eng": grams(rows[0][1]), "deu": grams(rows[1][1]) + grams(rows[2][1])}
    assert {(r["language"], r["gram"], r["n"], r["total"]) for r in model.collect()} == {(k, g, n, sum(c.values())) for k, c in want.items() for g, n in c.items()}
    texts = {1: "the cat", 2: "Die Hütte", 3: "zzz", 4: "", 5: None, 6: "12 !", 7: "The hut " * 50, 8: "a"}
    found = languages.detected(spark.createDataFrame(list(texts.items()), "id int, t string"), "id", "t", model)
    size = len(set(want["eng"]) | set(want["deu"])) + 1
    for r in found.collect():
        own = grams(texts[r["id"]] or "")
        if not own:
            assert r["language_code"] is r["confidence_score"] is None
            continue
        score = {k: sum(n * math.log((c[g] + 0.5) / (sum(c.values()) + 0.5 * size)) for g, n in own.items()) for k, c in want.items()}
        best = max(sorted(score), key=score.get)
        assert r["language_code"] == best
        assert r["confidence_score"] == pytest.approx(1 / sum(math.exp(s - score[best]) for s in score.values()), abs=1e-4)
    none = languages.detected(spark.createDataFrame([(1, "the")], "id int, t string"), "id", "t", model.limit(0)).first()
    assert tuple(none) == (1, None, None)


def test_held_out(spark):
    found = catalog.QUERIES["language_of_text"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", F.length("text").alias("size"))
    told = found.filter("held_out").join(docs, "doc_id").filter("size >= 200")
    right = told.agg(F.avg((F.col("lang") == F.col("language_code")).cast("int")), F.count(F.lit(1))).first()
    print(right)
    assert right[1] > 200 and right[0] >= 0.97


def test_the_model_is_fitted_once(spark):
    """The rows of a model are read once, though their languages are counted before they are sent."""
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = [("en", " th", 3, 5), ("en", "the", 2, 5), ("fr", " le", 4, 4)]
    model = spark.createDataFrame(rows, "language string, gram string, n long, total long")
    texts = spark.createDataFrame([(1, "the the"), (2, "le"), (3, None)], "id int, t string")
    found = languages.detected(texts, "id", "t", model.mapInArrow(seen, model.schema))
    assert reads.value == len(rows)
    assert {r["id"]: r["language_code"] for r in found.collect()} == {1: "en", 2: "fr", 3: None}


@pytest.mark.parametrize("cells", [languages.MOST_CELLS, 0])
def test_texts_are_scored_in_groups(monkeypatch, cells):
    """As many calls as groups of texts; scores are the sums trigram by trigram, also of texts in slices and of alphabets without a table."""
    rng = random.Random(6)
    word = lambda letters="abßé𝒳ク": "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))
    counts = {k: grams(" ".join(word() for _ in range(200))) for k in ("a", "b", "c")}
    rows = [(k, g, n, sum(c.values())) for k, c in counts.items() for g, n in c.items()] + [("c", "xy", 1, sum(counts["c"].values()))]
    texts = [" ".join(word("abßé𝒳クqЖ") for _ in range(rng.randint(0, 40))) + rng.choice(("", " 12_ ", "\u3000\u00a0q", "-a,")) for _ in range(300)] + [None, "", "b", "é a" * 900]
    monkeypatch.setattr(languages, "MOST_CELLS", cells)
    monkeypatch.setattr(languages, "GROUP", 2000)
    model = languages.Model(rows)
    groups = list(languages._groups(texts))
    got = [x for group in groups for x in model.best(group)]
    assert sum(groups, []) == texts and len(groups) < 40 and (model.keys is None) == (cells > 0)
    size = len(set(g for _, g, _, _ in rows)) + 1
    for text, (code, share) in zip(texts, got):
        own = grams(text or "")
        score = {k: sum(n * math.log((c[g] + 0.5) / (sum(c.values()) + 0.5 * size)) for g, n in own.items()) for k, c in counts.items()}
        if own:
            best = max(score.values())
            assert score[code] == pytest.approx(best) and share == pytest.approx(1 / sum(math.exp(s - best) for s in score.values()), abs=1e-4)
        else:
            assert code is share is None
