"""Review sheets, canonical CSV, and merging of what reviewers decided."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.schema import LETTERS, REVIEW_STATUSES

# Columns of the two CSV formats.
REVIEW_COLUMNS = [
    "question_id", "group_id", "shared_material", "question", "option_A", "option_B", "option_C", "option_D", "answer", "answer_status", "source_name",
    "source_url", "year", "province", "exam_type", "duplicate_status", "parse_status", "review_status", "reviewer", "notes", "review_snapshot_hash",
]
CANONICAL_COLUMNS = [
    "schema_version", "record_version", "question_id", "group_id", "shared_material", "raw_question", "normalized_question", "question",
    "raw_option_A", "raw_option_B", "raw_option_C", "raw_option_D", "option_A", "option_B", "option_C", "option_D", "answer", "answer_explanation", "answer_status",
    "has_image", "image_paths_json", "source_id", "source_name", "source_url", "paper_title", "year", "province", "exam_type", "page_number", "retrieved_at",
    "source_records_json", "answer_evidence_json", "duplicate_status", "parse_status", "review_status", "image_dependency", "issues_json", "collector", "reviewer", "notes",
    "raw_file", "content_hash", "ordered_hash", "permutation_hash", "license_status", "normalization_changes_json",
]
SOURCE_KEYS = ("exam_type", "page_number", "paper_title", "province", "retrieved_at", "site_name", "source_id", "url", "year")


def snapshot_hash() -> Column:
    """SHA-256 of the protected fields as JSON with sorted keys; what reviewers may change is not in it."""
    source = F.struct(*(F.col(f"source.{k}").alias(k) for k in SOURCE_KEYS))
    row = F.struct(
        F.col("answer"), F.col("quality.answer_status"), F.col("quality.duplicate_status"), F.col("group_id"), F.struct(*(F.col(f"options.{x}").alias(x) for x in LETTERS)).alias("options"),
        F.col("quality.parse_status"), F.col("question"), F.col("question_id"), F.col("shared_material"), source.alias("source"),
    )
    return F.sha2(T.json(row), 256)


def review_rows(records: DataFrame) -> DataFrame:
    """The sheet: one row of 21 text columns per record, safe for spreadsheets."""
    at = {
        **{f"option_{x}": F.col(f"options.{x}") for x in LETTERS}, "source_name": F.col("source.site_name"), "source_url": F.col("source.url"),
        **{c: F.col(f"source.{c}") for c in ("year", "province", "exam_type")},
        **{c: F.col(f"quality.{c}") for c in ("answer_status", "duplicate_status", "parse_status", "review_status", "reviewer", "notes")}, "review_snapshot_hash": snapshot_hash(),
    }
    return records.select(*(T.csv_safe(at[c] if c in at else F.col(c)).alias(c) for c in REVIEW_COLUMNS))


def canonical_rows(records: DataFrame) -> DataFrame:
    """46 text columns per record; nested parts are compact JSON."""
    at = {
        **{f"raw_option_{x}": F.col(f"raw_options.{x}") for x in LETTERS}, **{f"option_{x}": F.col(f"options.{x}") for x in LETTERS},
        "has_image": F.initcap(F.col("has_image").cast("string")), "source_name": F.col("source.site_name"), "source_url": F.col("source.url"),
        **{c: F.col(f"source.{c}") for c in ("source_id", "paper_title", "year", "province", "exam_type", "page_number", "retrieved_at")},
        **{c: F.col(f"quality.{c}") for c in ("answer_status", "duplicate_status", "parse_status", "review_status", "image_dependency", "collector", "reviewer", "notes")},
        **{c: F.col(f"provenance.{c}") for c in ("raw_file", "content_hash", "ordered_hash", "permutation_hash", "license_status")},
        **{f"{c}_json": T.json(F.coalesce(c, F.array())) for c in ("image_paths", "source_records", "answer_evidence")},
        "issues_json": T.json(F.col("quality.issues")), "normalization_changes_json": T.json(F.col("provenance.normalization_changes")),
    }
    return records.select(*(T.csv_safe(at[c] if c in at else F.col(c)).alias(c) for c in CANONICAL_COLUMNS))


def merge_outcomes(records: DataFrame, sheet: DataFrame, line: str = "line") -> DataFrame:
    """sheet rows with outcome: merged, or the first of duplicate, unknown, stale and invalid that applies.

    The first row of an id counts, even if it fails. Of records with one id the last (by _ord) is meant. Cells are
    restored, an empty status is pending.
    """
    of = [F.col("sheet")] if "sheet" in sheet.columns else []
    cells = sheet.select(*of, F.col(line).alias("line"), *(T.csv_restore(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in REVIEW_COLUMNS))
    nth = F.row_number().over(Window.partitionBy("question_id").orderBy(*of, "line"))
    known = records.groupBy("question_id").agg(F.max_by(snapshot_hash(), "_ord").alias("_now"))
    status = F.when(F.col("review_status") == "", "pending").otherwise(F.col("review_status"))
    rows = cells.withColumn("_nth", nth).withColumn("review_status", status).join(known, "question_id", "left")
    outcome = (
        F.when(F.col("_nth") > 1, "duplicate").when(F.col("_now").isNull(), "unknown").when(F.col("review_snapshot_hash") != F.col("_now"), "stale")
        .when(~F.col("review_status").isin(*REVIEW_STATUSES), "invalid").otherwise("merged")
    )
    return rows.withColumn("outcome", outcome).drop("_nth", "_now")


def merge_review(records: DataFrame, sheet: DataFrame, line: str = "line") -> DataFrame:
    """records with the reviewers' status, name and notes, and a version more where a row was merged."""
    good = merge_outcomes(records, sheet, line).filter("outcome = 'merged'").select("question_id", F.col("review_status").alias("_s"), F.col("reviewer").alias("_r"), F.col("notes").alias("_n"))
    last = records.groupBy("question_id").agg(F.max("_ord").alias("_last"))
    out = records.join(last, "question_id", "left").join(good, "question_id", "left").withColumn("_hit", F.col("_s").isNotNull() & (F.col("_ord") == F.col("_last")))
    q = F.col("quality")
    merged = q.withField("review_status", F.col("_s")).withField("reviewer", F.col("_r")).withField("notes", F.col("_n"))
    out = out.withColumn("quality", F.when(F.col("_hit"), merged).otherwise(q)).withColumn("record_version", F.coalesce("record_version", F.lit(1)) + F.col("_hit").cast("int"))
    return out.select(*records.columns)


def merge_summary(outcomes: DataFrame) -> DataFrame:
    """One row: input_rows, merged, skipped."""
    merged = F.count_if(F.col("outcome") == "merged")
    return outcomes.agg(F.count("*").alias("input_rows"), merged.alias("merged"), (F.count("*") - merged).alias("skipped"))


def merge_errors(outcomes: DataFrame) -> DataFrame:
    """(line, message) of rows that were not merged."""
    qid = F.col("question_id")
    what = {"duplicate": "duplicate question_id ", "unknown": "unknown question_id ", "stale": "stale review snapshot for "}
    text = F.coalesce(*(F.when(F.col("outcome") == k, F.concat(F.lit(v), qid)) for k, v in what.items()), F.concat(F.lit("invalid review_status '"), F.col("review_status"), F.lit("'")))
    return outcomes.filter("outcome <> 'merged'").select("line", F.concat(F.lit("line "), F.col("line").cast("string"), F.lit(": "), text).alias("message"))


def backfill_answers(records: DataFrame, cache: DataFrame, images: DataFrame, source_id: str, url_prefix: str) -> DataFrame:
    """Records of a source without an answer take a cached one, if the image it was read from is still the same.

    cache: (qid, answer, explanation, image_sha256); images: (qid, sha256).
    """
    usable = cache.filter(F.col("answer").isin(*LETTERS)).join(images, (cache["qid"] == images["qid"]) & (cache["image_sha256"] == images["sha256"])).select(cache["qid"].alias("_q"), cache["answer"].alias("_a"), F.coalesce(cache["explanation"], F.lit("")).alias("_e"), "sha256")
    qid = F.col("provenance.source_question_number")
    wanted = (F.col("source.source_id") == source_id) & (F.coalesce("answer", F.lit("")) == "") & qid.rlike(r"^[0-9]+$")
    out = records.join(usable, wanted & (qid == F.col("_q")), "left").withColumn("_hit", F.col("_q").isNotNull())
    fields = {
        "source_id": F.lit(source_id), "answer": F.col("_a"), "official": F.lit(False), "reliable": F.lit(False), "evidence_url": F.concat(F.lit(url_prefix), F.col("_q"), F.lit(".html")),
        "raw_file": F.lit(None).cast("string"), "page_number": F.lit(None).cast("int"), "source_question_number": F.col("_q"), "raw_answer": F.lit(None).cast("string"),
        "image_name": F.concat("_q", F.lit(".png")), "image_sha256": F.col("sha256"), "extraction_method": F.lit("tesseract_ocr"), "needs_review": F.lit(True),
    }
    evidence = F.array(F.struct(*(v.alias(k) for k, v in fields.items())))
    note = F.array(F.struct(F.lit("ocr_answer_unreviewed").alias("code"), F.lit("warning").alias("severity"), F.lit("OCR 候选答案尚未人工核对原图").alias("message")))
    q = F.col("quality")
    filled = q.withField("answer_status", F.lit("single_source")).withField("review_status", F.lit("pending")).withField("issues", F.concat(F.coalesce(q["issues"], F.slice(note, 1, 0)), note))
    hit = F.col("_hit")
    out = out.withColumns({
        "answer": F.when(hit, F.col("_a")).otherwise(F.col("answer")), "answer_explanation": F.when(hit, F.col("_e")).otherwise(F.col("answer_explanation")),
        "answer_evidence": F.when(hit, evidence).otherwise(F.col("answer_evidence")), "quality": F.when(hit, filled).otherwise(q), "record_version": F.col("record_version") + hit.cast("int"),
    })
    return out.select(*records.columns)
