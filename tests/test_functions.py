"""Column functions against values worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import records, text


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    return spark.createDataFrame([tuple(v for _, v in values.values()) or (1,)], schema).select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    ("image", "i", "words", "t", "want"),
    [
        (None, None, None, None, None), ("Content", 0.9, None, None, "Content"), (None, None, "Empty", 1.0, "Empty"),
        ("Content", 0.6, "Other", 0.6, "Other"), (records.PHOTO, 0.51, "Content", 0.99, records.PHOTO), (records.PHOTO, 0.5, "Content", 0.99, "Content"),
        ("Empty", 0.41, "Content", 0.99, "Empty"), ("Empty", 0.4, "Content", 0.99, "Content"), ("Content", 0.1, "Empty", 1.0, "Content"),
        ("Content", None, "Other", None, "Other"),
    ],
)
def test_final_category(spark, image, i, words, t, want):
    out = records.final_category(F.col("image"), F.col("i"), F.col("words"), F.col("t"))
    assert one(spark, out, image=("string", image), i=("double", i), words=("string", words), t=("double", t)) == want


@pytest.mark.parametrize(
    ("code", "confidence", "words", "issue", "want"),
    [("ENG", 0.9, 100, None, "ENG"), ("FRA", 0.49, 100, "eng", "ENG"), ("FRA", 0.5, 30, "eng", "FRA"), ("FRA", 0.9, 29, "eng", "ENG"), ("ENG", 0.9, 100, "xyz", "XYZ"), ("ENG", 0.9, 1, "", "ENG")],
)
def test_issue_language(spark, code, confidence, words, issue, want):
    known = F.array(F.lit("ENG"), F.lit("FRA"))
    values = {"c": ("string", code), "p": ("double", confidence), "n": ("int", words), "i": ("string", issue)}
    assert one(spark, records.issue_language(F.col("c"), F.col("p"), F.col("n"), F.col("i"), known), **values) == want
    exported = one(spark, records.exported_language(F.col("c"), F.col("p"), F.col("n"), F.col("i"), known), **values)
    assert exported["code"] == want
    assert exported["confidence"] == (confidence if want == code else None)


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("NEWS FROM\nABROAD\nIt rained to-\nday.", "# NEWS FROM ABROAD\nIt rained today."), (" ".join(["no"] * 10), "no"), (" ".join(["no"] * 9), " ".join(["no"] * 9)),
        ("." * 30, ""), ("." * 29, "." * 29), ("", ""), (None, ""), ("A\n\n\nB\n\nlow", "# A B\n\nlow"), ("\n  HEAD\nx", "\n#   HEAD\nx"), ("# HEAD", "# HEAD"), ("1234", "1234"),
    ],
)
def test_clean_recognised(spark, given, want):
    assert one(spark, text.clean_recognised(F.col("t")), t=("string", given)) == want


def test_metrics(spark):
    texts = [(0, "The cat. The dog."), (1, "  "), (2, None), (3, "One thing. ONE thing. one\u200b thing.")]
    found = text.metrics(spark.createDataFrame(texts, "id int, t string"), "t").orderBy("id").collect()
    assert tuple(found[0])[2:] == (17, 4, 3, 75.0, 2, 2)
    assert tuple(found[1])[2:] == tuple(found[2])[2:] == (None,) * 6
    assert tuple(found[3])[2:] == (33, 6, 2, 33.33, 3, 1)


def test_flags(spark):
    flags = lambda t: (one(spark, text.has_table(F.col("t")), t=("string", t)), one(spark, text.has_markdown(F.col("t")), t=("string", t)))
    assert flags("a | b\n|---|---|") == (True, False)
    assert flags("<TABLE border=1>") == (True, False)
    assert flags("# Head") == flags("x\n- item") == flags("**a\nb**") == flags("```") == (False, True)
    assert flags("a [link](http://x) and\n    - indented") == flags(None) == (False, False)



def test_flatten(spark):
    assert one(spark, text.flatten(F.col("t")), t=("string", "<p>a &amp; b co-\nop</p><script>x<y</script>")) == "a & b coop "
    assert one(spark, text.guarded_pieces(F.col("t"), 11, 2), t=("string", "a b c d e f g")) == ["a b", "c d", "e f"]
    assert one(spark, text.guarded_pieces(F.col("t")), t=("string", " ")) == []


def test_places_and_keys(spark):
    assert one(spark, records.right_state(F.lit("Boston"), F.lit("NY"))) == "MA"
    assert one(spark, records.right_state(F.lit("boston"), F.lit("NY"))) == "NY"
    assert [one(spark, records.state_code(F.lit(x))) for x in ("New York", " ny ", "Nowhere")] == ["NY", "NY", None]
    assert one(spark, records.place_code(F.lit(" Bavaria"), {}, 3)) == "BAV"
    assert one(spark, records.earliest_in(F.array(F.lit("Boston"), F.lit("Suffolk")), F.array(F.lit("suffolk"), F.lit("boston")))) == "Suffolk"
    for given, want in (("1890-1910", (1890, 1910)), ("1890-", (1890, None)), ("18??-1910", (None, 1910)), ("1890", (None, None))):
        assert tuple(one(spark, records.year_range(F.lit(given)))) == want
    assert one(spark, records.issue_key(F.lit("sn1"), F.lit("2020010101"))) == "sn1_2020010101"
    assert one(spark, records.issue_key(F.col("a"), F.lit("x")), a=("string", None)) == "x"
    assert one(spark, records.issue_key(F.lit(""), F.lit(""))) is None
    assert [one(spark, records.page_number(F.lit(x))) for x in ("0001.jp2", "page_012.tif", "cover.jpg")] == [1, 12, None]


def test_archive_names(spark):
    assert one(spark, records.archive_fields(F.lit("sn84_1915030201.tar.gz"))).asDict() == {
        "newspaper_id": "sn84", "edition_slug": "1915030201", "year": 1915, "month": 3, "day": 2, "edition_number": 1,
    }
    with pytest.raises(Exception, match="not an archive"):
        one(spark, records.archive_fields(F.col("n")), n=("string", "nonsense.zip"))


def test_geometry(spark):
    box = F.array(*[F.lit(float(x)) for x in (0, 0, 50, 50)])
    assert one(spark, records.box_area(box)) == 2500
    assert one(spark, records.box_area(F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)))) is None
    assert one(spark, records.box_size(F.array(*[F.lit(x) for x in (0.9, 0.0, 10.9, 5.0)]))).asDict() == {"width": 10, "height": 5}
    assert one(spark, records.megapixels(F.lit(2000), F.lit(1000), 1.5e6)) == 1.4999
    assert one(spark, records.megapixels(F.lit(1000), F.lit(1000), 1.5e6)) == 1.0
    full = F.array(*[F.lit(float(x)) for x in (0, 240, 960, 720)])
    assert one(spark, records.from_letterbox(full, F.lit(1920), F.lit(960))) == [0.0, 0.0, 1920.0, 960.0]


def test_formats(spark):
    assert one(spark, records.per_device(F.lit("0:45.2,1:67.8"))) == {"0": 45.2, "1": 67.8}
    assert one(spark, records.per_device(F.lit("")) ) == {}
    assert one(spark, records.step_name(F.lit("step01_cache"))) == "step01-cache"
    assert [one(spark, records.step_number(F.lit(x))) for x in ("step01-cache", "other")] == [1, 0]
    assert [one(spark, records.seconds_text(F.lit(x))) for x in (5.9, 65.0, 3661.0)] == ["5s", "1m 5s", "1h 1m 1s"]
    assert one(spark, records.escape_markup(F.lit("<a & 'b'>"))) == "&lt;a &amp; &#x27;b&#x27;&gt;"


def test_language_codes(spark):
    assert [one(spark, records.short_language(F.col("c")), c=("string", x)) for x in ("fra", "XYZ", None)] == ["fr", "en", "en"]
    known = F.array(F.lit("deu"), F.lit("eng"))
    assert [one(spark, records.known_or(F.col("c"), known, "eng"), c=("string", x)) for x in ("deu", "lat", None)] == ["deu", "eng", "eng"]


def test_digits_at_the_ends_of_sentences_and_headings_stay(spark):
    flat = " ".join(f"{i} is not {i}0!" for i in range(12)) + " 10"
    assert one(spark, text.sentences(F.col("t")), t=("string", flat)) == [f"{i} is not {i}0!" for i in range(12)] + ["10"]
    assert one(spark, text.glue_headings(F.col("t")), t=("string", " 0 NEWS 0 \n 1 WEST 1\n\n2 EAST 2 \nand so on")) == "0 NEWS 0 1 WEST 1 2 EAST 2\nand so on"


def test_flat_text_with_and_without_signs_of_markup(spark):
    texts = ["plain\ntext", "a-\nb", "a -\n B", "x &amp; y-\nz", "<p>one</p>two", "-", "", None, "fish &lt;b&gt; <b>chips</b>-  and", "<"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    whole = F.replace(F.regexp_replace(text.strip_markup(F.col("t")), r"-\s+(?=[a-z])", ""), F.lit("\n"), F.lit(" "))
    flat = rows.select("t", text.flatten(F.col("t")).alias("got"), whole.alias("want"))
    assert [r["got"] for r in flat.collect()] == [r["want"] for r in flat.collect()]
    assert "CASE WHEN" in flat._jdf.queryExecution().toString()
