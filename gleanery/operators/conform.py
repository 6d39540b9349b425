"""The record format: whole records from parts, and what does not conform to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from gleanery.schema import ANSWER_STATUSES, CRAWLER_VERSION, DUPLICATE_STATUSES, LETTERS, LICENSE_STATUSES, RECORD, REVIEW_STATUSES, SCHEMA_VERSION

# The defaults of a record that are not empty, and its further closed sets.
DEFAULTS = {
    "schema_version": SCHEMA_VERSION, "record_version": 1, "has_image": False, "quality.answer_status": "unchecked", "quality.duplicate_status": "unchecked", "quality.parse_status": "pending",
    "quality.review_status": "pending", "quality.image_dependency": "unknown", "provenance.crawler_version": CRAWLER_VERSION, "provenance.license_status": "unknown",
}
PARSE_STATUSES = ("pending", "parsed", "valid", "needs_review", "failed")
IMAGE_DEPENDENCIES = ("unknown", "not_image_dependent", "image_dependent", "needs_review")
NULLABLE = ("source.year", "source.page_number", "provenance.ocr_confidence", "provenance.source_question_number")


def _merged(kind: S.DataType, given: Column | None, have: S.DataType | None, path: str) -> Column:
    """The value at a path: of a struct, field by field, what is given or the default; of all else, what is given if anything is."""
    if isinstance(kind, S.StructType):
        theirs = have if isinstance(have, S.StructType) else S.StructType()
        names = theirs.fieldNames()
        parts = (_merged(f.dataType, given[f.name] if f.name in names else None, theirs[f.name].dataType if f.name in names else None, f"{path}.{f.name}").alias(f.name) for f in kind.fields)
        return F.struct(*parts)
    none = [] if isinstance(kind, S.ArrayType) else "" if isinstance(kind, S.StringType) else None
    value = DEFAULTS.get(path, None if path in NULLABLE else none)
    default = F.array().cast(kind) if value == [] and isinstance(kind, S.ArrayType) else F.lit(value).cast(kind)
    return default if given is None else F.coalesce(given.cast(kind), default)


def build_records(parts: DataFrame) -> DataFrame:
    """Whole records from rows that have some of a record's columns, and of its structs some of the fields: what is given replaces
    the default, a struct field by field. A null counts as not given. Other columns are left out."""
    have = {f.name: f.dataType for f in parts.schema.fields}
    full = S.StructType.fromDDL(RECORD)
    return parts.select(*(_merged(f.dataType, F.col(f"`{f.name}`") if f.name in have else None, have.get(f.name), f.name).alias(f.name) for f in full.fields))


def nonconforming(records: DataFrame) -> DataFrame:
    """(question_id, path) of every field of a record that the format does not allow: missing values, patterns, closed sets and
    ranges. One pass, without a shuffle."""
    text = (
        "shared_material", "raw_question", "normalized_question", "question", "answer_explanation", *(f"{o}.{x}" for o in ("raw_options", "options") for x in LETTERS),
        *(f"source.{c}" for c in ("source_id", "site_name", "url", "paper_title", "province", "exam_type", "retrieved_at")), *(f"labels.{c}" for c in ("primary_ability", "history_scope", "historical_period", "knowledge_point", "material_type")),
        *(f"quality.{c}" for c in ("collector", "reviewer", "notes")), *(f"provenance.{c}" for c in ("raw_file", "content_hash", "ordered_hash", "permutation_hash")),
    )
    sets = {
        "schema_version": (SCHEMA_VERSION,), "answer": ("", *LETTERS), "quality.answer_status": ANSWER_STATUSES, "quality.duplicate_status": ("unchecked", *DUPLICATE_STATUSES), "quality.parse_status": PARSE_STATUSES,
        "quality.review_status": REVIEW_STATUSES, "quality.image_dependency": IMAGE_DEPENDENCIES, "provenance.crawler_version": (CRAWLER_VERSION,), "provenance.license_status": LICENSE_STATUSES,
    }
    lists = ("answer_evidence", "image_paths", "source_records", "quality.issues", "provenance.normalization_changes")
    fails = lambda ok: ~F.coalesce(ok, F.lit(False))
    rules = {p: F.col(p).isNull() for p in (*text, *lists, "has_image")} | {p: fails(F.col(p).isin(*v)) for p, v in sets.items()}
    rules |= {
        "record_version": fails(F.col("record_version") >= 1), "question_id": fails(F.col("question_id").rlike(r"\ACHIS_[0-9]{6}\z")), "group_id": fails(F.col("group_id").rlike(r"\AGROUP_[A-Za-z0-9_-]+\z")),
        "image_paths[]": F.exists("image_paths", lambda p: p.isNull()), "provenance.ocr_confidence": ~F.coalesce(F.col("provenance.ocr_confidence").between(0, 1), F.lit(True)),
        "answer_evidence[].answer": F.exists("answer_evidence", lambda e: fails(e["answer"].isin(*LETTERS))), "answer_evidence[].source_id": F.exists("answer_evidence", lambda e: e["source_id"].isNull()),
    }
    found = F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(p)) for p, c in rules.items())), lambda x: x.isNotNull())
    return records.select("question_id", F.explode(found).alias("path"))


def stale_report(report: DataFrame, published: DataFrame) -> DataFrame:
    """(metric, key, now, then) of the cells in which a published report (metric, key, n) differs from a fresh one."""
    both = report.select("metric", "key", F.col("n").alias("now")).join(published.select("metric", "key", F.col("n").alias("then")), ["metric", "key"], "full")
    return both.filter(~F.col("now").eqNullSafe(F.col("then")))
