"""Operators 1, 3, 4, 5, 6 and 9: brute force, round trips and held-out accuracy."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import arrays, mixing, mlm_scoring, outliers, token_counts, toxicity, wrapper

from . import brute
from .conftest import sentence


# --- quality rules ---------------------------------------------------------------------------------------------------


def test_counts(odd, pairs_of):
    found = sorted((tuple(r) for r in outliers.quality(odd).select("doc_id", *outliers.COUNTS, "base_failed").collect()), key=repr)
    want = []
    for d, t in pairs_of:
        c = brute.counts(t)
        want.append((d, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert found == sorted(want, key=repr)


def test_outliers_go_and_clean_texts_stay(spark):
    rng = random.Random(9)
    clean = [(i, sentence(rng, rng.randint(60, 400)), "en", f"s{i % 3}") for i in range(900)]
    junk = [(1000 + i, " | ".join(sentence(rng, 100).split()), "en", f"s{i % 3}") for i in range(60)]
    docs = spark.createDataFrame([(*r, "x") for r in clean + junk], "doc_id long, text string, lang string, source string, unit string")
    kept = {r["doc_id"] for r in outliers.keep_good(docs).collect()}
    assert kept == {i for i, *_ in clean}
    assert outliers.keep_good(docs).columns == docs.columns
    again = {r["doc_id"]: r["distance"] for r in outliers.quality(docs).collect()}
    assert again == {r["doc_id"]: r["distance"] for r in outliers.quality(docs.repartition(7)).collect()}


def odd_in_one(rng):
    """Texts that are usual but for one of the five statistics."""
    pairs = [sentence(rng, 2) for _ in range(100)]
    lines = pairs * 8  # seven in eight are duplicates
    rng.shuffle(lines)
    words = sentence(rng, 151).split()
    again = sentence(rng, 74).split()
    return {
        "words": sentence(rng, 60_000),
        "length": " ".join(w * 4 for w in sentence(rng, 150).split()),
        "symbols": " | ".join(sentence(rng, 150).split()),
        "lines": "\n".join(lines),
        "repeats": " ".join(again + words + again),  # 49.5 % of the words, in one line
    }


def test_each_statistic_rejects(spark):
    rng = random.Random(10)
    clean = [(i, sentence(rng, rng.randint(60, 400)), "en", "s") for i in range(400)]
    planted = odd_in_one(rng)
    rows = clean + [(1000 + i, t, "en", "s") for i, t in enumerate(planted.values())]
    found = outliers.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    found = found.collect()
    assert not any(r["base_failed"] for r in found)
    assert {r["doc_id"] for r in found if r["kept"]} == {i for i, *_ in clean}


def verdicts(rows):
    """(lang, source, vector, passes the base rules) -> kept, by the same estimates in numpy over lists."""
    pairs = [(i, j) for i in range(5) for j in range(i, 5)]
    units: dict = {}
    for lang, source, q, good in rows:
        if good:
            units.setdefault((lang,), []).append(q)
            units.setdefault((lang, source), []).append(q)
    units = {k: np.array(v, float) for k, v in units.items()}
    far = lambda x, fit: np.einsum("ni,ij,nj->n", x / 256 - fit[0], fit[1], x / 256 - fit[0])
    fits = {}
    for u, x in units.items():
        low, mid, high = np.percentile(x, [25, 50, 75], axis=0)
        fits[u] = mid / 256, np.diag(1 / (((high - low) / 1.349 / 256) ** 2 + np.square(outliers.FLOOR))), 1e9
    moved = True
    while moved:
        near, moved = {}, False
        for u, x in units.items():
            bins = np.floor(16 * np.log2(1 + np.maximum(far(x, fits[u]), 0)))
            x = x[np.array([(bins < b).sum() < 0.75 * len(x) for b in bins])]
            near[u] = len(x), x.sum(axis=0), [(x[:, i] * x[:, j]).sum() for i, j in pairs]
        for u in units:
            centre, scatter = outliers.estimate(near[u], near[u[:1]] if len(u) == 2 else None)
            logdet = np.linalg.slogdet(scatter)[1]
            if logdet < fits[u][2] - 1e-4:
                fits[u], moved = (centre, np.linalg.inv(scatter), logdet), True
    cut = outliers.chi2(1 - outliers.TAIL)
    return [good and bool(far(np.array([q], float), fits[lang, source])[0] <= cut) for lang, source, q, good in rows]


def test_verdicts_equal_those_of_numpy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    stats = outliers.measured(docs, [F.col("doc_id"), F.col("lang"), F.col("source")]).withColumn("failed", outliers.base_failed()).collect()
    want = verdicts([(r["lang"], r["source"], r["q"], not r["failed"]) for r in stats])
    found = {r["doc_id"]: r["kept"] for r in outliers.quality(docs).collect()}
    assert found == {r["doc_id"]: k for r, k in zip(stats, want)}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert not any(found[d] for d, q in labels.items() if q == 0)
    failed = {r["doc_id"] for r in stats if r["failed"]}
    good = [found[d] for d, q in labels.items() if q == 1 and d not in failed]
    assert sum(good) >= 0.99 * len(good)


def test_small_sources_are_judged_by_their_language(spark):
    """Sources of one to five texts, and one whose own style only its number of texts makes usual."""
    rng = random.Random(21)
    rows = [(i, sentence(rng, rng.randint(60, 400)), "en", "large") for i in range(300)]
    rows += [(1000 + i, sentence(rng, rng.randint(60, 400)), "en", f"s{i % 20}") for i in range(60)]
    rows += [(2000, " | ".join(sentence(rng, 100).split()), "en", "s1"), (2001, " | ".join(sentence(rng, 100).split()), "en", "alone")]
    rows += [(3000 + i, " # ".join(" ".join(sentence(rng, 200).split()[k : k + 5]) for k in range(0, 200, 5)), "en", "signs") for i in range(80)]
    found = {r["doc_id"]: r["kept"] for r in outliers.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [d for d, k in found.items() if not k and d < 2000] == []
    assert not found[2000] and not found[2001]
    assert all(found[d] for d in found if d >= 3000)


def test_quality_of_an_empty_table(odd):
    assert outliers.quality(odd.limit(0)).count() == 0
    assert outliers.quality(odd.filter("length(text) < 5")).filter("kept").count() == 0


def test_chi_square():
    assert abs(outliers.chi2(0.95, 5) - 11.07) < 0.05
    assert abs(outliers.chi2_below(11.07, 5) - 0.95) < 0.002


# --- mixing ----------------------------------------------------------------------------------------------------------


def targets_by_hand(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s: 3.0 * sizes[s] for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return capped | share
        capped |= over


def test_mix(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(1, 60), rng.choice(["a", "a", "a", "b", "c", "d", None, "tiny"] if i > 5 else ["tiny"]), "x") for i in range(4000)]
    rows = [r for r in rows if r[2] != "tiny" or r[0] < 200] + [(-1, None, "a", "x"), (-2, "", "empty", "x"), (None, "w w", "b", "x"), rows[7], rows[7]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, h string")
    sizes: dict = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    found = mixing.mix_plan(docs).collect()
    assert len(found) == len(rows)
    want, taken = targets_by_hand(sizes), dict.fromkeys(sizes, 0)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9)
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, n in taken.items():
        assert abs(n - want[s]) <= 60, s
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, mixing.mix_plan(docs.repartition(9)).collect()), key=repr)
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "mix_copies"]
    assert out.agg(F.sum(F.col("mix_copies") * F.size(F.filter(F.split("text", " "), lambda x: x != "")))).first()[0] == sum(taken.values())
    assert mixing.mix_plan(docs.limit(0)).count() == 0


# --- token counts ----------------------------------------------------------------------------------------------------


def test_token_counts(odd, pairs_of):
    vocabulary = token_counts.Vocabulary.load(token_counts.VOCABULARY)
    known: dict = {}

    def count(word):
        if word not in known:
            known[word] = token_counts.best_count(token_counts.MARK.encode() + word, vocabulary)
        return known[word]

    want = sorted(((d, len(w := brute.words(t)), sum(map(count, w))) for d, t in pairs_of), key=repr)
    assert sorted((tuple(r) for r in token_counts.token_counts(odd).collect()), key=repr) == want


def test_trie_equals_single_words():
    vocabulary = token_counts.Vocabulary(["▁", "▁a", "a", "b", "ab", "▁ab", "bab", "é", "aa", "x" * 70])
    words = ["a", "ab", "abab", "aaaa", "bbb", "é", "éa", "ü", "x" * 70, "x" * 200, "ab" * 40, "a\0", "a\0\0"]
    text = pa.array([w for w in words] + [" ".join(words)])
    n, tokens = token_counts.Counter(vocabulary)(text)
    single = [token_counts.best_count(token_counts.MARK.encode() + w.encode(), vocabulary) for w in words]
    assert tokens.tolist() == [*single, sum(single)]
    assert n.tolist() == [1] * len(words) + [len(words)]


# --- language model --------------------------------------------------------------------------------------------------


def network(scale=0.3):
    rng = np.random.default_rng(0)
    return {k: rng.normal(0, scale, s) for k, s in mlm_scoring.SHAPES.items()}


def test_probabilities_add_up():
    w = network()
    ids, doc = np.array([5, 0, 9, 3]), np.zeros(4, np.int64)
    total = 0.0
    for word in range(mlm_scoring.EDGE):
        ids[1] = word
        total += float(np.exp(mlm_scoring.log_probabilities(w, ids[:3], doc[:3])[1]))
    assert abs(total - 1) < 1e-3


def by_hand(w, ids):
    """Log-probability of each word of one text, word by word."""
    out = []
    for i, own in enumerate(ids):
        x = []
        for step in (-2, -1, 1, 2):
            x += w["embed"][ids[i + step] if 0 <= i + step < len(ids) else mlm_scoring.EDGE].tolist()
        hidden = [math.tanh(sum(v * w["mix"][k, j] for k, v in enumerate(x)) + w["mix_bias"][j]) for j in range(mlm_scoring.HIDDEN)] + [1.0]
        kind, word = divmod(own, mlm_scoring.CLASS_SIZE)
        total = 0.0
        for layer, at in ((w["to_class"], kind), (w["to_word"][kind], word)):
            z = [sum(h * layer[k, j] for k, h in enumerate(hidden)) for j in range(layer.shape[1])]
            total += z[at] - math.log(sum(math.exp(v) for v in z))
        out.append(total)
    return out


def test_log_probabilities_by_hand():
    w = network()
    ids = np.random.default_rng(1).integers(0, mlm_scoring.EDGE, 12)
    got = mlm_scoring.log_probabilities(w, np.append(ids, ids[:5]), np.repeat([0, 1], [12, 5]))
    assert np.allclose(got, by_hand(w, ids.tolist()) + by_hand(w, ids[:5].tolist()), atol=1e-9)


def test_gradients_are_those_of_the_loss():
    trainer = mlm_scoring.Trainer(network())
    trainer.w = {k: v.astype(np.float64) for k, v in network().items()}
    rng = np.random.default_rng(2)
    ids, doc = rng.integers(0, mlm_scoring.EDGE, 40), np.repeat([0, 1], 20)
    at = np.arange(0, 40, 2)
    loss = lambda: -mlm_scoring.log_probabilities(trainer.w, ids, doc)[at].mean()
    for name, gradient in trainer.gradients(ids, doc, at).items():
        flat = trainer.w[name].reshape(-1)
        for k in np.argsort(-np.abs(gradient).ravel())[:5]:
            old = flat[k]
            flat[k] = old + 1e-5
            up = loss()
            flat[k] = old - 1e-5
            down = loss()
            flat[k] = old
            assert abs((up - down) / 2e-5 - gradient.ravel()[k]) < 1e-6, name


def test_pseudo_likelihood(spark, odd, pairs_of):
    rng = random.Random(1)
    chain = {w: f"w{(i * 7 + 3) % 40}" for i, w in enumerate(f"w{i}" for i in range(40))}

    def walk(n):
        w = f"w{rng.randrange(40)}"
        out = []
        for _ in range(n):
            out.append(w)
            w = chain[w]
        return " ".join(out)

    good = [(i, walk(200)) for i in range(400)]
    docs = spark.createDataFrame(good, "doc_id long, text string")
    first = mlm_scoring.first_model(docs)
    rows = mlm_scoring.numbered(docs, first)
    model = mlm_scoring.fit(rows, first)
    mixed_up = spark.createDataFrame([(i, " ".join(rng.sample(t.split(), 200))) for i, t in good[:50]], "doc_id long, text string")
    mean = lambda rows, m: mlm_scoring.score(rows, m).agg(F.sum("log_probability") / F.sum("n_tokens")).first()[0]
    assert abs(mean(rows, first) - math.log(1 / 40)) < 0.1
    assert mean(rows, model) > mean(rows, first) + 0.5
    assert mean(rows, model) > mean(mlm_scoring.numbered(mixed_up, first), model) + 0.5
    found = sorted(((r["doc_id"], r["n_tokens"]) for r in mlm_scoring.pseudo_likelihood(odd).collect()), key=repr)
    assert found == sorted(((d, len(brute.words(t))) for d, t in pairs_of), key=repr)
    assert mlm_scoring.pseudo_likelihood(odd.limit(0)).count() == 0


def test_scores_do_not_depend_on_the_partitions(spark, odd, monkeypatch):
    monkeypatch.setattr(mlm_scoring, "PART", 5000)
    scored = lambda df: sorted((tuple(r) for r in mlm_scoring.pseudo_likelihood(df).collect()), key=repr)
    assert scored(odd.coalesce(1)) == scored(odd.repartition(6, "text"))


def test_copies_of_a_text_are_spread(spark, monkeypatch):
    """Half of all rows are one text: no part is much larger than another."""
    monkeypatch.setattr(mlm_scoring, "PART", 5000)
    rng = random.Random(9)
    rows = [(i, sentence(rng, 100) if i % 2 else "one text that is copied again and again " * 12) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    parts = [r["n"] for r in mlm_scoring.numbered(docs, mlm_scoring.first_model(docs)).groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()]
    assert len(parts) > 30 and max(parts) <= 2 * sorted(parts)[len(parts) // 2]


def test_rare_words_share_their_bucket(spark):
    rare = [f"r{i}" for i in range(mlm_scoring.FREQUENT + 1500)]
    rows = [(i, w) for i, w in enumerate(rare)]
    rows += [(-1, " ".join(rare[: mlm_scoring.FREQUENT] * 3)), (-2, " ".join(rare[-100:]))]  # 4032 frequent words; 100 that occur twice
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = mlm_scoring.first_model(docs)
    words = docs.filter("doc_id >= 0")
    found = {r["doc_id"]: r["log_probability"] for r in mlm_scoring.score(mlm_scoring.numbered(words, model), model).collect()}
    # In one context, the words of the corpus have all probability but the little kept for others: buckets aren't counted twice.
    assert 0.85 < sum(map(math.exp, found.values())) < 1
    bucket = lambda w: model.ids_of(mlm_scoring.tokens(next(arrays.chunks(pa.array([w]))))[0])[0]
    once = {bucket(rare[i]): found[i] for i in range(mlm_scoring.FREQUENT, len(rare) - 100)}
    twice = {bucket(rare[i]): found[i] for i in range(len(rare) - 100, len(rare))}
    both = set(once) & set(twice)
    assert both and all(abs(twice[b] - once[b] - math.log(2)) < 1e-3 for b in both)
    unseen = [(i, f"never{i}") for i in range(50)]
    never = spark.createDataFrame(unseen, "doc_id long, text string")
    for r in mlm_scoring.score(mlm_scoring.numbered(never, model), model).collect():
        b = bucket(unseen[r["doc_id"]][1])
        assert b not in once or r["log_probability"] < once[b]


def test_counts_that_are_sent_and_joined_give_the_same(spark, odd, monkeypatch):
    """Known words aren't joined, and scores are those of a join of all."""
    docs = odd.select("doc_id", F.concat_ws(" ", "text", F.lit(" ".join(f"r{i % 5000}" for i in range(7500)))).alias("text"))

    def scored(most):
        monkeypatch.setattr(mlm_scoring, "MOST_KNOWN", most)
        first = mlm_scoring.first_model(docs)
        rows = mlm_scoring.numbered(docs, first)
        joined = rows.agg(F.sum(F.size("words"))).first()[0]
        return len(first.known), joined, sorted((tuple(r) for r in mlm_scoring.score(rows, first).collect()), key=repr)

    none, some, every = scored(0), scored(5500), scored(1 << 18)
    assert none[0] == 0 < some[0] <= 5500 < every[0]
    assert none[1] > some[1] > 0 == every[1]
    for other in (some, every):  # rows are dealt otherwise, so single-precision sums differ in their last digits
        assert [r[:2] for r in none[2]] == [r[:2] for r in other[2]]
        assert all(math.isclose(a[2], b[2], rel_tol=1e-7) for a, b in zip(none[2], other[2]))


def test_word_counts_of_many_batches(spark, odd, pairs_of, monkeypatch):
    """Tasks that sort held words together, keep them or hand them on count as one that holds all."""
    want = sorted(Counter(w for _, t in pairs_of for w in brute.words(t, True)).values())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        for most in (300, 3000):
            monkeypatch.setattr(mlm_scoring, "MOST_COUNTED", most)
            assert sorted(r["n"] for r in mlm_scoring.word_counts(odd).collect()) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rounds_cover_all_words():
    seen = []

    class Trainer(mlm_scoring.Trainer):
        def _batch(self, ids, doc, at):
            seen.extend(at.tolist())

    rng = np.random.default_rng(5)
    ids, doc = rng.integers(0, mlm_scoring.EDGE, 20_000), np.sort(rng.integers(0, 300, 20_000))
    for k in range(mlm_scoring.ROUNDS):
        Trainer({}).learn(ids, doc, k)
    assert sorted(seen) == list(range(20_000))


# --- toxicity --------------------------------------------------------------------------------------------------------


def test_toxicity(spark, odd):
    rng = random.Random(2)
    bad = ["foulword", "nastyword", "vileword"]
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 0
        w = sentence(rng, rng.randint(20, 300)).split()
        if toxic:
            for _ in range(rng.randint(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", "s", "ing", ","]))
        rows.append((i, " ".join(w), rng.choice(["en", "de"])))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([*labels, (None, 1), (5000, None)], "doc_id long, toxic int")
    found = toxicity.toxicity(docs, marks).join(marks, "doc_id").filter("held_out").collect()
    wrong = sum((r["score"] >= 0.7) != bool(r["toxic"]) for r in found)
    assert wrong <= 0.03 * len(found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)
    assert toxicity.toxicity(odd, marks).count() == odd.count()
    assert toxicity.toxicity(odd.limit(0), marks).count() == 0
    assert {r["predicted"] for r in toxicity.toxicity(odd, marks.limit(0)).collect()} == {0}


def test_held_out_is_one_in_three(spark):
    import zlib

    found = spark.range(0, 300).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in found)


# --- pages -----------------------------------------------------------------------------------------------------------

SHELL = """<!DOCTYPE html><html><head><title>T {i}</title><style>p{{x}}</style><script>var a="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home {i}</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
{main}<aside>Side {i}</aside><div id="comments"><p>Reader {i} says</p></div><form><p>Sign</p></form><footer>&copy; {i}</footer></body></html>"""


@pytest.mark.parametrize("most", [0, wrapper.MOST_SENT])
def test_pages(spark, monkeypatch, most):
    monkeypatch.setattr(wrapper, "MOST_SENT", most)
    rng = random.Random(6)
    rows, want = [], {}
    for i in range(60):
        paragraphs = [sentence(rng, 30) for _ in range(rng.randint(1, 5))]
        inside = f"<h1>Head {i}</h1>" + "".join(f"<p>{p} &amp; <b>x<br>y" if i % 2 else f"<p>{p} &amp; <b>x</b>\n y</p>" for p in paragraphs)
        share = '<div class="share">Share this</div><p>Always the same closing line</p>'
        main = f"<article>{inside}{share}</article>" if i < 40 else f'<div class="post-body">{inside}</div>'
        rows.append((i, f"http://{'a' if i < 40 else 'b'}.example/{i}", SHELL.format(i=i, main=main), "x"))
        want[i] = " ".join([f"Head {i}", *(f"{p} & x y" for p in paragraphs)])
    rows += [(100, None, None, "x"), (101, "nonsense", "", "x"), (102, "http://c.example", "plain <b>text</b> < 3", "x"), (103, "http://c.example", "<p>" * 3000 + "deep", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    found = {r["page_id"]: r["text"] for r in wrapper.main_texts(pages).collect()}
    assert len(found) == len(rows)
    assert {i: found[i] for i in want} == want
    assert (found[100], found[101], found[102], found[103]) == ("", "", "plain text < 3", "deep")
    assert wrapper.main_texts(pages.limit(0)).count() == 0


def alone(source):
    return wrapper.Content(None, {}).text(wrapper.read_page(source), "host")


def test_all_names_of_an_element_count():
    many = "align border bg center col flex font gap grid items"
    page = f'<div class="{many} sidebar">Aside</div><div class="{many}"><p>Text of it</p></div><div class="{many} widget-area">More</div>'
    assert alone(page) == "Text of it"
    assert alone(f'<div class="{many} story">Told</div><p>Other</p>') == "Told"
    # A name isn't believed if it would take away most of the page.
    assert alone(f'<div class="content-sidebar-wrap"><p>{"All of the text. " * 9}</p></div><div class="x">Few</div>').startswith("All of the text.")


@pytest.mark.parametrize("pages", [1, 2, 3, 40])
@pytest.mark.parametrize("paragraphs", [3, 100])
def test_pages_with_neutral_names(spark, pages, paragraphs):
    """Menus, top stories, notices and comments that no name tells from the article."""
    rng = random.Random(8)
    rows, want = [], {}
    for i in range(pages):
        text = [f"Head {i}", *(sentence(rng, 30) for _ in range(paragraphs))]
        stories = "".join(f'<div><a href="/{k}">{sentence(rng, 8)}</a></div>' for k in range(6))
        comments = "".join(f"<div><p>{sentence(rng, 9)}</p></div>" for _ in range(rng.randint(1, 4)))
        closing = "<p>Always the same closing line</p>" if pages > 2 else ""
        main = f"<h1>{text[0]}</h1>" + "".join(f"<p>{p}</p>" for p in text[1:]) + closing
        source = f'<body><div class="k1">{stories}</div><div class="k2">{main}</div><div class="k3">{comments}</div><div class="k1">{stories}</div></body>'
        rows.append((i, f"http://n{pages}.example/{i}", source))
        want[i] = " ".join(text)
    found = {r["page_id"]: r["text"] for r in wrapper.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == want


@pytest.mark.parametrize("element", ["div", "p", "b", "li", "section"])
def test_deep_pages(element):
    assert alone(f"<{element}>" * 10_000 + "deep") == "deep"
    assert alone(f"<{element}>" * 10_000 + "deep" + f"</{element}>" * 10_000) == "deep"


@pytest.mark.parametrize("piece", ['<a "', '<a ="', "<a =\">", "<a ='\">", "<", "<b>", "<!--", "<p x='", "</b>", "<script>", "< p>", "&amp"])
def test_hostile_pages_take_time_in_proportion(piece):
    import time

    began = time.process_time()
    for tail in ("", ">", '">', "x"):
        alone(piece * 20_000 + tail)
    assert time.process_time() - began < 8


#: Pages whose parts have names that say nothing, or say it in passing; {a}: the article's paragraphs, {r}: records of other texts.
SHAPES = {
    "page-wide form": '<body><form id="aspnetForm"><input type="hidden"><div class="k0"><label>Search</label><select><option>All</option></select></div><div class="k2">{a}</div><div class="k3"><p>Short</p></div></form></body>',
    "side effects": '<body><div class="k2">{first}<div class="side-effects">{a}</div></div></body>',
    "side effects in an article": '<body><nav><p>Menu</p></nav><article>{first}<div class="side-effects">{a}</div></article></body>',
    "many comments": '<body><div class="k2">{a}</div><div class="k3">{r}</div></body>',
    "teasers in front": '<body><div class="k3">{r}</div><div class="k2">{a}</div></body>',
    "comments in sections": '<body><section>{a}</section><section>{r}</section></body>',
    "references": '<body><div class="k0"><p>Menu</p></div><article>{a}{links}</article></body>',
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_parts_told_by_their_slots(spark, shape):
    rng = random.Random(len(shape))
    rows, want = [], {}
    for i in range(40):
        text = [sentence(rng, rng.randint(30, 60)) for _ in range(rng.randint(4, 6))]
        first = [f"Head {i}", *(sentence(rng, 50) for _ in range(6))] if "{first}" in SHAPES[shape] else []
        links = [f"{sentence(rng, 4)} {k}" for k in range(5)] if "{links}" in SHAPES[shape] else []
        records = "".join(f'<div class="k5"><div><b>{sentence(rng, 1)}</b></div><p>{sentence(rng, rng.randint(8, 20))}</p></div>' for _ in range(rng.randint(20, 40)))
        paragraphs = lambda x: "".join(f"<p>{p}</p>" for p in x)
        parts = {"a": paragraphs(text), "first": paragraphs(first), "r": records, "links": "<ul>" + "".join(f'<li><a href="/{k}">{x}</a></li>' for k, x in enumerate(links)) + "</ul>"}
        rows.append((i, f"http://x.example/{i}", SHAPES[shape].format(**parts)))
        want[i] = " ".join([*first, *text, *links])
    found = {r["page_id"]: r["text"] for r in wrapper.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == want


def test_small_forms_go():
    form = "<form><p>Sign up for more of it</p><label>Name</label></form>"
    assert alone(f"<div><p>{'Text of the page. ' * 5}</p>{form}</div>") == ("Text of the page. " * 5).strip()
    assert alone(f"<form><div><p>{'Text of the page. ' * 5}</p></div><button>Send</button>{form}</form>") == ("Text of the page. " * 5).strip()


def test_many_distinct_siblings():
    """The time of an alignment is nearly in proportion to the number of siblings, also if each has a name of its own."""
    import time
    import tracemalloc

    name = lambda k: "".join(chr(97 + int(d)) for d in str(k))
    page = lambda ids: wrapper.read_page("<dl>" + "".join(f'<dt id="{name(k)}">T</dt>' for k in ids) + "</dl>")
    one, two = page(range(20_000)), page(range(10_000, 30_000))
    trees = [wrapper.tree_of(p.form()[0], *[[1] * len(p.labels)] * 4)[0] for p in (one, two)]
    began = time.process_time()
    wrapper.merge(*trees)
    assert time.process_time() - began < 5
    assert len(trees[0].children[0].children) == 30_000
    tracemalloc.start()
    wrapper.merge(trees[0], wrapper.tree_of(two.form()[0], *[[1] * len(two.labels)] * 4)[0])
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()


def test_wrappers_do_not_depend_on_the_order(spark, monkeypatch):
    monkeypatch.setattr(wrapper, "FAN", 3)
    rng = random.Random(12)
    rows = []
    for i in range(120):
        parts = rng.sample([f'<div class="{c}">{sentence(rng, 12)}</div>' for c in "qrstuvw"], rng.randint(1, 7))
        rows.append((i, "http://one.example/", f"<article><p>{sentence(rng, 40)}</p></article>" + "".join(parts)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("h"))
    tree = lambda df: [tuple(r) for r in wrapper.wrappers(wrapper._read(df)).collect()]
    first = tree(pages.repartition(2))
    assert len(first) == 1 and first == tree(pages.repartition(7, "html"))
    assert first[0][2][0] == 120


def test_tree_matching():
    def tree(x):
        lines, stack = [], [(x, 0)]
        while stack:
            (label, *children), depth = stack.pop()
            lines.append(f"{depth} {label}")
            stack += [(c, depth + 1) for c in reversed(children)]
        return wrapper.tree_of("\n".join(lines), *([[1] * len(lines)] * 4))[0]

    def best(a, b):  # of all order-keeping matches
        if a.label != b.label:
            return 0
        def rows(i, j):
            if i == len(a.children) or j == len(b.children):
                return 0
            return max(rows(i + 1, j), rows(i, j + 1), best(a.children[i], b.children[j]) + rows(i + 1, j + 1) if a.children[i].label == b.children[j].label else 0)
        return 1 + rows(0, 0)

    a, b = tree(["a", ["b"], ["c", ["d"]], ["e"]]), tree(["a", ["c", ["d"], ["f"]], ["e"], ["b"]])
    assert len(wrapper.aligned(a, b)) == 4
    assert [x.label for x, _ in wrapper.aligned(a, b)].count("d") == 1
    rng = random.Random(3)
    grown = lambda depth: [rng.choice("abc"), *(grown(depth - 1) for _ in range(rng.randint(0, 3) if depth else 0))]
    for _ in range(60):
        a, b = tree(["r", *(grown(2) for _ in range(3))]), tree(["r", *(grown(2) for _ in range(3))])
        assert len(wrapper.aligned(a, b)) == best(a, b)
    wrapper.merge(a, b)
    form, pages, *_ = wrapper.form_of(a)
    assert pages[0] == 2 and form.startswith("0 r")


# --- arrays ----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_words_of_chunks(pairs_of, size):
    texts = [t for _, t in pairs_of if t is None or len(t) < 3000]
    found: list = [[] for _ in texts]
    for chunk in arrays.chunks(pa.array(texts), size=size):
        for s, e, d in zip(*chunk.words()):
            found[chunk.rows.start + d].append(chunk.data[s:e].tobytes())
    assert found == [brute.words(t) for t in texts]


def test_hashes_are_of_the_span_alone():
    chunk = next(arrays.chunks(pa.array(["abc abc xabc", "abc"])))
    start, end, _ = chunk.words()
    h = chunk.hashes(start, end)
    assert h[0] == h[1] == h[3] != h[2]
