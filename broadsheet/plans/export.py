"""The export row: a scan with its issue's fields and, crop by crop in reading order, lists of all that is known about them.

Satellites are joined by crop, a crop becomes one struct, structs are nested by scan once, and each list is a projection of
them; so 25 lists cost one shuffle by scan. Spark prunes no fields of structs that are collected, nor a join that adds a
row's fields; so whoever wants some columns says which, and what only the others need is neither joined nor computed.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import records, text
from ..operators import relational

#: The columns of an export row, in order. Those from crop_bbox_gen on are lists, an element a crop.
COLUMNS = (
    "scan_image corpus issue_id_src newspaper_id_src newspaper_id_type_gen page_number_gen scan_filename_src scan_width_src scan_height_src"
    " year_ext month_ext day_ext edition_ext metadata_source_gen city_gen state_gen country_gen language_ext"
    " crop_bbox_gen crop_bbox_conf_gen crop_vlm_ocr_gen crop_tesseract_ocr_gen crop_vlm_ocr_token_count_gen crop_tesseract_ocr_token_count_gen"
    " crop_text_analysis_gen crop_classification_gen crop_classification_image_only_gen crop_classification_image_only_conf_gen"
    " crop_classification_text_only_gen crop_classification_text_only_conf_gen crop_language_gen crop_language_conf_gen"
    " crop_ner_per_gen crop_ner_per_conf_gen crop_ner_loc_gen crop_ner_loc_conf_gen crop_ner_org_gen crop_ner_org_conf_gen"
    " crop_subject_gen crop_subject_conf_gen crop_chronam_thesauri_matches_exp crop_text_embeddings crop_image_embeddings"
).split()
#: The fields of a crop's text analysis.
ANALYSIS = [
    *(f"{kind}_{name}" for kind in ("tesseract", "vlm") for name in ("tokenizability_score", "char_count", "word_count", "word_count_unique", "word_type_token_ratio", "sentence_count", "sentence_count_unique")),
    "vlm_has_table", "vlm_has_markdown",
]
SATELLITES = ("ocr", "token_count", "text_analysis", "classification", "language", "ner", "subject", "thesaurus", "text_embedding", "image_embedding")
#: The satellites that each list is made of; the boxes are the crop's own.
NEEDED = {
    "crop_bbox": (), "crop_vlm_ocr_token_count": ("token_count",), "crop_tesseract_ocr_token_count": ("token_count",), "crop_vlm_ocr": ("ocr",), "crop_tesseract_ocr": ("ocr",),
    "crop_text_analysis": ("text_analysis",), "crop_classification": ("classification",), "crop_language": ("language", "text_analysis"), "crop_ner": ("ner",),
    "crop_subject": ("subject",), "crop_chronam": ("thesaurus",), "crop_text_embeddings": ("text_embedding",), "crop_image_embeddings": ("image_embedding",),
}


def matches(found: Column) -> Column:
    """category -> term -> n as a list of (category, terms (term, count)); null stays null, nothing found is an empty list."""
    terms = lambda m: F.transform(F.map_entries(m), lambda t: F.struct(t["key"].alias("term"), t["value"].alias("count")))
    return F.transform(F.map_entries(found), lambda c: F.struct(c["key"].alias("category"), terms(c["value"]).alias("terms")))


def _crop(language: Column, detectable: list[str]) -> dict[str, Column]:
    """What the lists of an export row have of each crop; columns are named after satellites."""
    given = F.col("language.language_code")
    known = F.array(*[F.lit(x) for x in detectable]) if detectable else F.array().cast("array<string>")
    code = records.issue_language(given, F.coalesce("language.confidence_score", F.lit(0.0)), F.coalesce("text_analysis.vlm_word_count", F.lit(0)), language, known)
    code = F.when(F.coalesce(given, F.lit("")) == "", given).otherwise(code)
    confidence = F.when(code.eqNullSafe(given), F.col("language.confidence_score"))
    listed = lambda c: F.coalesce(c, F.array())
    thesaurus = F.struct(
        matches(F.col("thesaurus.tesseract_matches")).alias("tesseract_matches"), "thesaurus.tesseract_match_count", "thesaurus.tesseract_term_count",
        matches(F.col("thesaurus.vlm_matches")).alias("vlm_matches"), "thesaurus.vlm_match_count", "thesaurus.vlm_term_count",
    )
    some = lambda name, value: F.when(F.col(name).isNotNull(), value)
    return {
        "crop_bbox_gen": F.col("bbox_xyxy"), "crop_bbox_conf_gen": F.col("confidence_score"),
        "crop_vlm_ocr_gen": F.when(F.col("ocr.vlm_text") != "", text.clean_recognised(F.col("ocr.vlm_text"))),
        "crop_tesseract_ocr_gen": F.struct(F.col("ocr.tesseract_text").alias("text"), F.col("ocr.tesseract_metadata").alias("metadata")),
        "crop_vlm_ocr_token_count_gen": F.col("token_count.vlm_token_count"), "crop_tesseract_ocr_token_count_gen": F.col("token_count.tesseract_token_count"),
        "crop_text_analysis_gen": some("text_analysis", F.struct(*[F.col(f"text_analysis.{c}").alias(c) for c in ANALYSIS])),
        "crop_classification_gen": F.col("classification.final_category"),
        "crop_classification_image_only_gen": F.col("classification.image_category"), "crop_classification_image_only_conf_gen": F.col("classification.image_confidence_score"),
        "crop_classification_text_only_gen": F.col("classification.text_category"), "crop_classification_text_only_conf_gen": F.col("classification.text_confidence_score"),
        "crop_language_gen": code, "crop_language_conf_gen": confidence,
        **{f"crop_ner_{k}_gen": listed(F.col(f"ner.{k}_entities")) for k in ("per", "loc", "org")},
        **{f"crop_ner_{k}_conf_gen": listed(F.col(f"ner.{k}_confidence_scores")) for k in ("per", "loc", "org")},
        "crop_subject_gen": listed(F.col("subject.ranked_labels")), "crop_subject_conf_gen": listed(F.col("subject.scores")),
        "crop_chronam_thesauri_matches_exp": some("thesaurus", thesaurus),
        "crop_text_embeddings": F.col("text_embedding.vlm_embedding"), "crop_image_embeddings": F.col("image_embedding.embedding"),
    }


def needed(columns: Collection[str]) -> list[str]:
    """The satellites that these columns are made of."""
    names = {s for c in columns for start, own in NEEDED.items() if c.startswith(start) for s in own}
    return [s for s in SATELLITES if s in names]


def export(
    issues: DataFrame, scans: DataFrame, crops: DataFrame, found: dict[str, DataFrame], metadata_source: str, detectable: list[str], columns: Collection[str] = tuple(COLUMNS)
) -> DataFrame:
    """A row of `columns`, some or all of COLUMNS, per scan, with issue_id and scan_id in front.

    issues, scans (with `content`, the bytes of the image) and crops have the columns of the schemas; found: the satellites of
    SATELLITES that the columns need, each with crop_id and one row a crop at most. A scan without crops has empty lists; a crop without a satellite
    has null there, or an empty list of entities and labels. Crops without reading order come first, equal ones by id.
    """
    if unknown := set(columns) - set(COLUMNS):
        raise ValueError(f"not columns of an export row: {sorted(unknown)}")
    issue = issues.select(F.col("id").alias("issue_id"), F.struct(*[c for c in issues.columns if c != "id"]).alias("issue"))
    pages = scans.select(F.col("id").alias("scan_id"), "issue_id", "scan_filename", "width", "height", "content").join(issue, "issue_id")
    languages = pages.select("scan_id", F.col("issue.language").alias("issue_language"))
    own = crops.select(F.col("id").alias("crop_id"), "scan_id", "reading_order", "bbox_xyxy", "confidence_score")
    rows = relational.satellites(own, {k: found[k] for k in needed(columns)}).join(languages, "scan_id")
    fields = {name: c for name, c in _crop(F.col("issue_language"), detectable).items() if name in columns}
    rows = rows.select("scan_id", "crop_id", "reading_order", *[c.alias(name) for name, c in fields.items()])
    nested = relational.nested(rows, ["scan_id"], [F.coalesce("reading_order", F.lit(0)), F.col("crop_id")], list(fields), "crops")
    kind = {f.name: f.dataType for f in nested.schema.fields}["crops"]
    rows = pages.join(nested, "scan_id", "left").withColumn("crops", F.coalesce("crops", F.array().cast(kind)))

    some = lambda c: F.nullif(c, F.lit(""))
    city, state = F.coalesce("issue.city", F.lit("")), F.coalesce("issue.state", F.lit(""))
    scalars = {
        "scan_image": F.struct(F.col("content").alias("bytes"), F.lit(None).cast("string").alias("path")), "corpus": F.col("issue.corpus"),
        "issue_id_src": records.issue_key(F.col("issue.newspaper_id"), F.col("issue.edition_slug")), "newspaper_id_src": F.col("issue.newspaper_id"),
        "newspaper_id_type_gen": F.col("issue.newspaper_id_type"), "page_number_gen": records.page_number(F.col("scan_filename")), "scan_filename_src": F.col("scan_filename"),
        "scan_width_src": F.col("width"), "scan_height_src": F.col("height"), "year_ext": F.col("issue.year"), "month_ext": F.col("issue.month"), "day_ext": F.col("issue.day"),
        "edition_ext": F.col("issue.edition_number"), "metadata_source_gen": F.lit(metadata_source), "city_gen": some(city), "state_gen": some(records.right_state(city, state)),
        "country_gen": some(F.col("issue.country")), "language_ext": F.col("issue.language"),
    }
    lists = {name: F.col(f"crops.{name}") for name in fields}
    every = scalars | lists
    return rows.select("issue_id", "scan_id", *[every[c].alias(c) for c in COLUMNS if c in columns])
