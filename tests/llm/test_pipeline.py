"""The pipeline's stages, each on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    columns = docs.columns
    rows = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    stages = [f for _, f in corpus_pipeline.STAGES]
    assert len(stages) == 5

    before = rows(docs)
    docs = stages[0](spark, docs, SF).cache()
    after = rows(docs)
    base = {d for d, t in before.items() if (c := brute.counts(t))[0] >= 50 and 100 * c[4] <= 50 * c[0]}
    assert set(after) <= base
    assert all(labels.get(d) == 0 for d in base - set(after) if d in labels)
    assert all(labels[d] == 1 for d in after if d in labels)

    before, docs = after, stages[1](spark, docs, SF).cache()
    after = rows(docs)
    assert set(after) == {c for _, c in brute.components(list(before.items())).values()}

    before, docs = after, stages[2](spark, docs, SF).cache()
    after = rows(docs)
    assert {d: n for d, _, n, _ in brute.without_word_repeats(list(before.items()))} == {
        d: len(brute.words(before[d])) - len(brute.words(after[d])) for d in before
    }
    assert docs.filter(F.col("n_chars") != F.length("text")).count() == 0

    before, docs = after, stages[3](spark, docs, SF).cache()
    after = rows(docs)
    assert set(after) == set(before) - {d for d, *_ in brute.contained(list(before.items()), items)}
    assert docs.columns == columns

    last = stages[4](spark, docs, SF)
    assert last.columns == [*columns, "mix_copies"]
    assert {r["doc_id"] for r in last.collect()} <= set(after)
    assert last.filter("mix_copies < 1 or mix_copies > 3").count() == 0


def test_stages_on_odd_rows(spark, odd):
    """Null ids and texts, copies, long texts, repeated rows, and columns named like the stages' own, through all stages."""
    import corpus_pipeline

    columns, docs = odd.columns, odd
    texts = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    before = texts(docs)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == (columns if k < 4 else [*columns, "mix_copies"])
        after = texts(docs)
        if k == 0:
            assert all(t is not None and len(brute.words(t)) >= 50 for _, t in after) and {d for d, _ in after} <= {d for d, _ in before}
            assert None in {d for d, _ in after}
        elif k == 1:
            ids = {d: c for d, (_, c) in brute.components([x for x in before if x[0] is not None]).items()}
            assert {d for d, _ in after if d is not None} == set(ids.values())
            assert [d for d, _ in after].count(None) == [d for d, _ in before].count(None)
        elif k == 2:
            known = dict(x for x in after if x[0] is not None)
            for d, n, gone, _ in brute.without_word_repeats([x for x in dict(before).items() if x[0] is not None]):
                assert len(brute.words(known[d])) == n - gone
        elif k == 3:
            assert after == before  # none of them holds a test item
        else:
            assert {x[0] for x in after} <= {x[0] for x in before}
            assert docs.filter("mix_copies is null or mix_copies not between 1 and 3").count() == 0
        assert docs.filter(" or ".join(f"`{c}` != 'x'" for c in columns if c not in ("doc_id", "text", "lang", "source", "n_chars"))).count() == 0
        before = after
    assert before


def test_stages_on_an_empty_table(spark, odd):
    import corpus_pipeline

    docs = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
    assert docs.columns == [*odd.columns, "mix_copies"]


def test_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
