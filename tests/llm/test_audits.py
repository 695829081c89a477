"""Operators 11 to 13 against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from broadsheet.llm import divergence, filter_audit, license_scan

from . import brute
from .conftest import sentence


def brute_audit(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    rows = []
    for d, t, lang in docs:
        t = t or ""
        w = brute.words(t)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": d is not None and first[t] < d,
        }
        own = [x for x in labels if d is not None and x[0] == d]
        rows.append((lang or "", {f for f in fails if fails[f]}, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                here = [r for r in mine if f in r[1] and not r[1] & set(order[: step - 1])]
                shapley[f] += len(here)
                out[part, "".join(order), step] = [
                    sum(not r[1] & set(order[:step]) for r in mine),
                    len(here),
                    sum(f in r[1] for r in mine) - len(here),
                    sum(r[1] == {f} for r in mine),
                    sum(r[2] for r in here),
                    sum(r[3] for r in here),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


LABELS = "doc_id long, quality int, toxic int, part string, mask int"


def test_filter_audit(spark, odd):
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in odd.collect()]
    ids = sorted({d for d, _, _ in docs if d is not None})
    labels = [(d, i % 2, i % 3 // 2, "x", 1) for i, d in enumerate(ids) if i % 5]
    labels += [(ids[1], 1, None, None, None), (ids[1], 0, 1, None, None), (None, 1, 1, None, None), (10**9, 1, 1, None, None)]
    got = filter_audit.audit(odd, spark.createDataFrame(labels, LABELS)).collect()
    want = brute_audit(docs, labels)
    assert len(got) == len(want) == 600 * len({d[2] or "" for d in docs})
    assert {(r[0], r[1], r[2]): list(r[3:]) for r in got} == want


def test_filter_audit_of_an_empty_table(spark, odd):
    assert filter_audit.audit(odd.limit(0), spark.createDataFrame([], LABELS)).count() == 0
    got = filter_audit.audit(odd, spark.createDataFrame([], LABELS)).agg({"good_lost": "max", "toxic_lost": "max"}).first()
    assert tuple(got) == (0, 0)


def test_transform_is_inverted_exactly(spark):
    """Counts by mask come back from parity sums, for each label."""
    rows = [("p", m, m % 3 == 0, m == 31) for m in range(32) for _ in range(m * m % 7)] + [("q", 5, False, True)]
    got = {r["part"]: r for r in filter_audit.cells(filter_audit.parity_sums(spark.createDataFrame(rows, "part string, mask int, good boolean, toxic boolean"))).collect()}
    for part in ("p", "q"):
        for label, at in (("all", None), ("good", 2), ("toxic", 3)):
            assert list(got[part][label]) == [sum(r[0] == part and r[1] == m and (at is None or r[at]) for r in rows) for m in range(32)]


def brute_divergence(docs):
    """docs: (text, lang, source) -> rows of the operator, all numbers by Python's own."""
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), a or "", s or "") for t, a, s in docs]
    out = set()
    for lang in {d[1] for d in docs}:
        frequency = Counter(w for words, a, _ in docs if a == lang for w in set(words))
        kept = [w for w, n in frequency.items() if n >= 3]
        of = {s: Counter() for _, a, s in docs if a == lang}
        for words, a, s in docs:
            if a == lang:
                of[s].update(words)
        whole = sum(of.values(), Counter())

        def p(counts):
            total = sum(counts[w] for w in kept)
            return {w: 1 + 10**9 * (counts[w] + 1) // (total + len(kept)) for w in kept}

        mine, q = {s: p(c) for s, c in of.items()}, p(whole)
        for s in of:
            pairs = [(sum((mine[s][w] - x) ** 2 // x for w, x in mine[t].items()), t) for t in of if t != s]
            terms = [((mine[s][w] - q[w]) ** 2 // q[w], w) for w in kept if of[s][w] and mine[s][w] > q[w]]
            for part, rows, most in (("pair", pairs, None), ("term", terms, 200)):
                rows.sort(key=lambda r: (-r[0], r[1].encode()))
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(rows[:most], 1)}
    return out


def uneven_docs():
    """Terms whose frequencies depend on the source, more than 200 of them that are equally telling, a language of one source, one of no kept terms."""
    rng = random.Random(12)
    common = ["".join(rng.choice("abcdeéßФ") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    rows = []
    for i in range(90):
        source = f"s{i % 7}"
        words = [rng.choice(common[: 20 + 5 * (i % 7)]) for _ in range(rng.randint(0, 80))]
        rows.append((i, " ".join(words) + rng.choice([".", "!X,", "\n", "1"]) + ("Ab" if i % 3 else "aB"), "en", source))
    rows += [(200 + i, " ".join(f"only{chr(97 + j // 26)}{chr(97 + j % 26)}" for j in range(260)), "en", "wide") for i in range(4)]
    rows += [(300 + i, "a b c a-b", "one", "x") for i in range(3)] + [(400, "q", "none", "x"), (401, "r 12 #", "none", "y"), (402, None, "none", "z"), (403, "", "en", "mute")]
    return rows + [(None, "a b", None, None), (None, "a b", "", "k"), (500, "a\0b a", None, "k"), (500, "a\0b a", None, "k")]


@pytest.mark.parametrize("few, size", [(divergence.MOST_SENT, divergence.PART), (0, 500)])
def test_divergence(spark, monkeypatch, few, size):
    """Also with parts of 500 bytes, groups of few postings and joins by shuffle."""
    monkeypatch.setattr(divergence, "MOST_SENT", few)
    monkeypatch.setattr(divergence, "PART", size)
    monkeypatch.setattr(divergence, "POSTINGS", size)
    rows = uneven_docs()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, term string").repartition(3)
    got = divergence.divergence(docs).collect()
    want = brute_divergence([r[1:] for r in rows])
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert divergence.divergence(docs.limit(0)).count() == 0


def test_divergence_of_odd_rows(odd):
    want = brute_divergence([(r["text"], r["lang"], r["source"]) for r in odd.collect()])
    assert {tuple(r) for r in divergence.divergence(odd).collect()} == want


def brute_licenses(text):
    """All but doc_id of a row, by trying every notice at every place."""
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    words = [w.decode() for w in words]
    stands = lambda phrase, x: words[max(x, 0) : x + len(phrase.split())] == phrase.split() and x >= 0
    hits = [(i, label) for phrase, label in license_scan.PHRASES.items() for i in range(len(words)) if stands(phrase, i)]
    near = range(-license_scan.SLACK, license_scan.SLACK + 1)
    found = []
    for notice in license_scan.NOTICES:
        own = notice.text.split()
        at = [len(notice.text[: f" {notice.text} ".index(f" {p} ")].split()) for p in notice.phrases]
        for x in range(-len(own), len(words)):
            if stands(notice.phrases[0], x + at[0]) and all(any(stands(p, x + y + d) for d in near) for p, y in zip(notice.phrases, at)):
                share = sum(any(0 <= x + j + d < len(words) and words[x + j + d] == w for d in near) for j, w in enumerate(own)) / len(own)
                if share >= license_scan.LEAST_SHARE:
                    found.append((notice.label, share))
    starts, base = [i for i, _ in hits], {x for _, x in hits}
    score = 1.0 if base else max((s for _, s in found), default=0.0)
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | {x for x, _ in found})), pytest.approx(score)


def licensed_texts():
    rng = random.Random(13)
    noise = lambda n: sentence(rng, n)
    texts = [noise(a) + ". " + notice.text.upper() + " -- " + noise(b) for notice in license_scan.NOTICES for a, b in ((0, 0), (58, 9), (700, 300))]
    for notice in license_scan.NOTICES:  # words left out, put in, and changed
        words = notice.text.split()
        texts.append(noise(20) + " " + " ".join(w for i, w in enumerate(words) if i != len(words) // 2))
        texts.append(" ".join(words[:3]) + " indeed " + " ".join(words[3:]))
        texts.append(noise(4) + " " + " ".join(words[len(words) // 2 :]))
    texts += ["GNU General Public License", "under the MIT", "license", "the MIT license", "version 2 of the apache license", "cc-by-nc cc by nc,CC BY/NC"]
    texts += ["license version 3 " * 3000, "under the mit license " * 50, "under  the\n\tMIT.License", "underthe mit license", "under the mit licenseé", None, "", "0"]
    both = [n.text for n in license_scan.NOTICES[:4]]
    return [*texts, "; ".join(both), noise(30) + ", ".join(reversed(both))]


def test_license_scan(spark, odd):
    texts = licensed_texts()
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[0], "x"), (3, texts[3], "x")]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, labels string").repartition(3)).collect()
    assert len(got) == len(rows)
    of = {r["doc_id"]: r for r in got}
    for i, text in enumerate(texts):
        assert tuple(of[i])[1:8] == brute_licenses(text), text
    for i, notice in enumerate(license_scan.NOTICES):
        for k in range(3):
            assert notice.label in of[3 * i + k]["labels"].split(",")
            assert any(p["label"] == notice.label and p["share"] == 1 for p in of[3 * i + k]["places"])
    assert of[None]["labels"] == of[0]["labels"] != ""
    for r in license_scan.scan(odd).collect():
        assert r["labels"] == "" and r["score"] == 0
    assert license_scan.scan(odd.limit(0)).count() == 0


def test_every_notice_has_its_phrases(spark):
    with pytest.raises(ValueError):
        license_scan.scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"), [license_scan.Notice("x", "a b c", ("b d",))], {"b d": "y"})
