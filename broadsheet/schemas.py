"""Schemas of the tables, as DDL: issue > scan > crop > what is known about a crop, and runs > batches > items."""

from __future__ import annotations

ISSUE = (
    "id long, corpus string, archive_filename string, archive_size_bytes long, newspaper_id string, newspaper_id_type string,"
    " edition_slug string, edition_slug_type string, title string, city string, state string, country string, publisher string,"
    " year int, month int, day int, edition_number int, year_start int, year_end int, language string, loc_access_restricted boolean"
)
SCAN = "id long, issue_id long, scan_filename string, width int, height int, phash string"
CROP = (
    "id long, scan_id long, pipeline_batch_item_id long, bbox_xyxy array<double>, confidence_score double, reading_order int, width int, height int"
)
CROP_OCR = (
    "crop_id long, tesseract_text string, tesseract_metadata array<struct<text:string,conf:float,bbox_xyxy:array<int>>>, vlm_text string,"
    " vlm_metadata struct<prompt_tokens:int,completion_tokens:int,finish_reason:string>"
)
CROP_CLASSIFICATION = (
    "crop_id long, image_category string, image_confidence_score double, text_category string, text_confidence_score double, final_category string"
)
CROP_LANGUAGE = "crop_id long, language_code string, confidence_score double"
CROP_TOKEN_COUNT = "crop_id long, tesseract_token_count int, vlm_token_count int"
CROP_NER = (
    "crop_id long, per_entities array<string>, loc_entities array<string>, org_entities array<string>, per_confidence_scores array<double>,"
    " loc_confidence_scores array<double>, org_confidence_scores array<double>"
)
CROP_SUBJECT = "crop_id long, ranked_labels array<string>, scores array<double>"
CROP_THESAURUS = (
    "crop_id long, tesseract_matches map<string,map<string,int>>, vlm_matches map<string,map<string,int>>, tesseract_match_count int,"
    " tesseract_term_count int, vlm_match_count int, vlm_term_count int"
)
CROP_EMBEDDING = "crop_id long, embedding array<float>"
PIPELINE_RUN = "id long, corpus string, items_total int, items_per_batch int, batches_total int, created_date timestamp"
PIPELINE_BATCH = (
    "id long, pipeline_run_id long, node_name string, created_date timestamp, started_date timestamp, ended_date timestamp, has_crashed boolean"
)
PIPELINE_BATCH_ITEM = "id long, pipeline_batch_id long, issue_id long"
THESAURUS_LINE = "category string, keyword string, related_terms array<string>"
