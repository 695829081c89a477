from __future__ import annotations

import random

import pytest

#: Names that operators use for columns of their own.
CLASHING = "row tag spans kept h size salt unit q rep label band k n anchor state copies target source_size gone_ d_ t_ block centre"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING.split())


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgéß") for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls everywhere, empty, blank and very long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(3)
    base = [sentence(rng, rng.randint(60, 160)) for _ in range(40)]
    passage, line = sentence(rng, 30), sentence(rng, 12)
    texts = [*base, None, "", "  \t\n ", "one", "one two three", "One Two three", "a b c d e", "A B C D E"]
    texts += base[:5]  # copies
    for b in base[5:15]:  # near copies of several degrees
        w = b.split(" ")
        for share in (0.01, 0.03, 0.06):
            texts.append(" ".join("zz" + x if rng.random() < share else x for x in w))
    texts += [sentence(rng, 30) + " " + passage + " " + sentence(rng, 20) for _ in range(6)]
    texts += ["\n".join([line] * 6), "x " * 300, "word " * 40 + passage, sentence(rng, 20000), base[3] + "\n" + base[3]]
    texts += ["#" * 50 + " " + sentence(rng, 80), "é" * 120, "ab" * 400]
    langs, sources = ["en", "de", None], ["a", "b", "c", None]
    rows = [(i * 7 % 1009, t, langs[i % 3], sources[i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], rows[50]]  # rows that stand there twice
    rows += [(None, base[0], "en", "a", 1), (None, None, None, None, None)]
    return [r + tuple("x" for _ in CLASHING.split()) for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def pairs_of(odd):
    return [(r["doc_id"], r["text"]) for r in odd.collect()]
