"""Export rows against a loop over scans and crops."""

from __future__ import annotations

import datetime
import random

import duckdb
import pytest
from pyspark.sql import types as T

from broadsheet import schemas
from broadsheet.plans import catalog, export

ANALYSIS = ", ".join(f"{c} {'boolean' if 'has' in c else 'double' if 'score' in c or 'ratio' in c else 'int'}" for c in export.ANALYSIS)
DDL = {
    "ocr": schemas.CROP_OCR, "token_count": schemas.CROP_TOKEN_COUNT, "text_analysis": f"crop_id long, {ANALYSIS}", "classification": schemas.CROP_CLASSIFICATION,
    "language": schemas.CROP_LANGUAGE, "ner": schemas.CROP_NER, "subject": schemas.CROP_SUBJECT, "thesaurus": schemas.CROP_THESAURUS,
    "text_embedding": "crop_id long, vlm_embedding array<float>", "image_embedding": schemas.CROP_EMBEDDING,
}


def value(rng, kind):
    if isinstance(kind, T.ArrayType):
        return [value(rng, kind.elementType) for _ in range(rng.randint(0, 3))]
    if isinstance(kind, T.MapType):
        return {f"k{i}": value(rng, kind.valueType) for i in range(rng.randint(0, 2))}
    if isinstance(kind, T.StructType):
        return {f.name: value(rng, f.dataType) for f in kind}
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return rng.randint(0, 8) / 8
    return {"boolean": rng.random() < 0.5, "string": rng.choice(("ENG", "text of it", "", None, "FRA"))}.get(kind.simpleString(), rng.randint(0, 60))


def test_export(spark):
    rng = random.Random(4)
    issue_of = lambda i: {"id": i, "corpus": "c", "newspaper_id": rng.choice(("sn1", "", None)), "newspaper_id_type": "lccn", "edition_slug": rng.choice(("1900010101", None)), "city": rng.choice(("Boston", "Lawrence", "", None)), "state": rng.choice(("NY", "NH", "", None)), "country": rng.choice(("USA", "", None)), "year": 1900, "month": 1, "day": 2, "edition_number": 1, "language": rng.choice(("fra", "eng", "", None))}
    issues = [issue_of(i) for i in range(12)]
    scans = [{"id": 100 + k, "issue_id": k % 12, "scan_filename": rng.choice((f"p{k:03d}.jp2", "cover.jp2")), "width": 10, "height": None, "content": bytes([k])} for k in range(30)]
    crops = [{"id": 1000 + k, "scan_id": 100 + rng.randint(0, 25), "reading_order": rng.choice((None, 1, 2, 3)), "bbox_xyxy": [1.0, 2.0, 3.0, 4.0], "confidence_score": 0.5} for k in range(120)]
    found, frames = {}, {}
    for name, ddl in DDL.items():
        frames[name] = spark.createDataFrame([], ddl)
        kinds = [f for f in frames[name].schema if f.name != "crop_id"]
        found[name] = {c["id"]: {f.name: value(rng, f.dataType) for f in kinds} for c in crops if rng.random() < 0.7}
        frames[name] = spark.createDataFrame([{"crop_id": k, **v} for k, v in found[name].items()], frames[name].schema).repartition(2)
    make = lambda rows, ddl: spark.createDataFrame([{**dict.fromkeys(n.split()[0] for n in ddl.split(", ")), **r} for r in rows], ddl)
    simple = "id long, scan_id long, reading_order int, bbox_xyxy array<double>, confidence_score double"
    out = export.export(make(issues, schemas.ISSUE), make(scans, "id long, issue_id long, scan_filename string, width int, height int, content binary"), make(crops, simple), frames, "loc", ["ENG", "FRA"])
    assert out.columns == ["issue_id", "scan_id", *export.COLUMNS] and len(export.COLUMNS) == 43
    got = {r["scan_id"]: r.asDict(recursive=True) for r in out.collect()}
    assert len(got) == len(scans)

    for scan in scans:
        row, issue = got[scan["id"]], issues[scan["issue_id"]]
        own = sorted((c for c in crops if c["scan_id"] == scan["id"]), key=lambda c: (c["reading_order"] or 0, c["id"]))
        assert bytes(row["scan_image"]["bytes"]) == scan["content"] and row["scan_image"]["path"] is None
        assert row["issue_id_src"] == ("_".join(x for x in (issue["newspaper_id"], issue["edition_slug"]) if x) or None)
        wrong = {("Boston", "NY"): "MA", ("Lawrence", "NH"): "MA"}
        assert row["state_gen"] == (wrong.get((issue["city"], issue["state"]), issue["state"]) or None)
        assert (row["city_gen"], row["country_gen"], row["language_ext"]) == (issue["city"] or None, issue["country"] or None, issue["language"])
        assert row["page_number_gen"] == (int(scan["scan_filename"][1:4]) if scan["scan_filename"] != "cover.jp2" else None)
        assert [row[c] for c in ("scan_width_src", "scan_height_src", "year_ext", "edition_ext", "metadata_source_gen")] == [10, None, 1900, 1, "loc"]
        lists = {c: row[c] for c in export.COLUMNS[18:]}
        assert all(len(x) == len(own) for x in lists.values())
        for k, crop in enumerate(own):
            has = {name: found[name].get(crop["id"]) for name in DDL}
            one = {c: x[k] for c, x in lists.items()}
            of = lambda name, field: has[name] and has[name][field]  # noqa: B023, E731
            assert one["crop_bbox_gen"] == crop["bbox_xyxy"] and one["crop_bbox_conf_gen"] == 0.5
            assert one["crop_vlm_ocr_gen"] == ({"ENG": "# ENG", "FRA": "# FRA"}.get(of("ocr", "vlm_text"), of("ocr", "vlm_text")) or None)  # cleaned: lines in capitals are headings
            assert one["crop_tesseract_ocr_gen"] == {"text": of("ocr", "tesseract_text"), "metadata": of("ocr", "tesseract_metadata")}
            assert (one["crop_vlm_ocr_token_count_gen"], one["crop_tesseract_ocr_token_count_gen"]) == (of("token_count", "vlm_token_count"), of("token_count", "tesseract_token_count"))
            assert one["crop_text_analysis_gen"] == has["text_analysis"]
            assert [one[f"crop_classification{x}"] for x in ("_gen", "_image_only_gen", "_image_only_conf_gen", "_text_only_gen", "_text_only_conf_gen")] == [
                of("classification", f) for f in ("final_category", "image_category", "image_confidence_score", "text_category", "text_confidence_score")
            ]
            code, confidence = of("language", "language_code"), of("language", "confidence_score")
            final = code
            if code and issue["language"]:
                n = of("text_analysis", "vlm_word_count") or 0
                doubt = issue["language"].upper() not in ("ENG", "FRA") or (confidence or 0) < 0.5 or n < 30
                final = issue["language"].upper() if doubt else code
            assert (one["crop_language_gen"], one["crop_language_conf_gen"]) == (final, confidence if final == code else None)
            for kind in ("per", "loc", "org"):
                assert one[f"crop_ner_{kind}_gen"] == (of("ner", f"{kind}_entities") or []) and one[f"crop_ner_{kind}_conf_gen"] == (of("ner", f"{kind}_confidence_scores") or [])
            assert one["crop_subject_gen"] == (of("subject", "ranked_labels") or []) and one["crop_subject_conf_gen"] == (of("subject", "scores") or [])
            as_lists = lambda m: None if m is None else [{"category": c, "terms": [{"term": t, "count": n} for t, n in x.items()]} for c, x in m.items()]
            want = has["thesaurus"] and {f: as_lists(v) if f.endswith("matches") else v for f, v in has["thesaurus"].items()}
            assert one["crop_chronam_thesauri_matches_exp"] == want
            assert (one["crop_text_embeddings"], one["crop_image_embeddings"]) == (of("text_embedding", "vlm_embedding"), of("image_embedding", "embedding"))


def test_some_columns_need_some_satellites(spark):
    """Columns of some satellites, with no other ones given, are what they are among all."""
    issues = spark.createDataFrame([{**dict.fromkeys(n.split()[0] for n in schemas.ISSUE.split(", ")), "id": 1, "language": "fra"}], schemas.ISSUE)
    scans = spark.createDataFrame([(5, 1, "p1.jp2", 2, 3, b"x")], "id long, issue_id long, scan_filename string, width int, height int, content binary")
    crops = spark.createDataFrame([(7, 5, 2, [0.0], 0.5), (8, 5, 1, [1.0], 0.25)], "id long, scan_id long, reading_order int, bbox_xyxy array<double>, confidence_score double")
    rng, frames = random.Random(1), {}
    for name, ddl in DDL.items():
        empty = spark.createDataFrame([], ddl)
        frames[name] = spark.createDataFrame([{"crop_id": 7, **{f.name: value(rng, f.dataType) for f in empty.schema if f.name != "crop_id"}}], empty.schema)
    every = export.export(issues, scans, crops, frames, "loc", ["ENG"]).first()
    for column in ("crop_language_gen", "crop_vlm_ocr_gen", "crop_chronam_thesauri_matches_exp", "language_ext"):
        own = {name: frames[name] for name in export.needed([column])}
        assert export.export(issues, scans, crops, own, "loc", ["ENG"], [column]).collect() == [(1, 5, every[column])], column
    assert export.needed(export.COLUMNS) == list(export.SATELLITES)
    with pytest.raises(ValueError, match="nothing"):
        export.export(issues, scans, crops, frames, "loc", ["ENG"], ["nothing"])


def test_lists_of_orders_with_many_lines(spark, tmp_path):
    """Ids of crops belong to one order, also from line 8 on; text that isn't asked for isn't cleaned."""
    lines = [(order, part, part, number, flag, "O") for order, number, part, flag in ((1, 9, 70, "A"), (2, 1, 31, "N"), (2, 17, 44, "R"), (4, 1, 5, "A"), (4, 1, 45, "N"))]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    day = datetime.datetime(1995, 2, 3)
    spark.createDataFrame([(k, 10 * k, day) for k in (1, 2, 3, 4)], "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    duck = duckdb.connect()
    duck.execute("SET TimeZone = 'UTC'")
    for name in ("lineitem", "orders"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = catalog.export_lists(spark, str(tmp_path))
    assert sorted(tuple(r) for r in found.collect()) == sorted(duck.execute(catalog.ORACLE_SQL["export_lists"]).fetchall())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "{29,}" not in plan and plan.count("Join LeftOuter") <= 6
