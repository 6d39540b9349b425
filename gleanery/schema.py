"""The question record and its closed sets of values."""

SOURCE = "struct<source_id:string,site_name:string,url:string,paper_title:string,year:int,province:string,exam_type:string,page_number:int,retrieved_at:string>"
OPTIONS = "struct<A:string,B:string,C:string,D:string>"
ISSUES = "array<struct<code:string,severity:string,message:string>>"
EVIDENCE = (
    "array<struct<source_id:string,answer:string,official:boolean,reliable:boolean,evidence_url:string,raw_file:string,page_number:int,"
    "source_question_number:string,raw_answer:string,image_name:string,image_sha256:string,extraction_method:string,needs_review:boolean>>"
)
RECORD = (
    f"schema_version string, record_version int, question_id string, group_id string, shared_material string, raw_question string, "
    f"normalized_question string, question string, raw_options {OPTIONS}, options {OPTIONS}, answer string, answer_explanation string, "
    f"answer_evidence {EVIDENCE}, has_image boolean, image_paths array<string>, source {SOURCE}, source_records array<{SOURCE}>, "
    "labels struct<primary_ability:string,history_scope:string,historical_period:string,knowledge_point:string,material_type:string>, "
    f"quality struct<answer_status:string,duplicate_status:string,parse_status:string,review_status:string,image_dependency:string,"
    f"issues:{ISSUES},collector:string,reviewer:string,notes:string>, "
    "provenance struct<raw_file:string,content_hash:string,ordered_hash:string,permutation_hash:string,crawler_version:string,"
    "license_status:string,normalization_changes:array<struct<field:string,before:string,after:string>>,ocr_confidence:double,"
    "source_question_number:string>"
)

# The closed sets and defaults of the record format.
SCHEMA_VERSION, CRAWLER_VERSION = "0.1.0", "v0.1"
LETTERS = ("A", "B", "C", "D")
ANSWER_STATUSES = ("verified", "single_source", "unchecked", "missing", "conflict", "invalid")
REVIEW_STATUSES = ("pending", "approved", "rejected", "needs_revision")
DUPLICATE_STATUSES = ("unique", "suspected_duplicate", "reordered_duplicate", "exact_duplicate")
LICENSE_STATUSES = ("allowed", "research_only", "unknown", "restricted")
SOURCE_STATUSES = ("draft", "pending_review", "approved", "disabled", "rejected")
SOURCE_TYPES = ("html", "pdf", "mixed")
MODES = ("direct", "cot")
ABILITIES = ("FACT", "TIME", "SOURCE", "REASON")


def record_document() -> dict:
    """The record format as a JSON-schema document: types from RECORD, closed sets and patterns from the values above. Options and
    labels are closed, everything else may hold more fields."""
    from pyspark.sql import types as S

    names = {S.StringType: "string", S.IntegerType: "integer", S.LongType: "integer", S.BooleanType: "boolean", S.DoubleType: "number"}
    nullable = {"source.year", "source.page_number", "source_records.year", "source_records.page_number", "provenance.ocr_confidence"}
    optional = {"provenance.ocr_confidence", "provenance.source_question_number", *(f"answer_evidence.{f.name}" for f in S.DataType.fromDDL(EVIDENCE).elementType.fields[2:])}
    rules = {
        "schema_version": {"const": SCHEMA_VERSION}, "provenance.crawler_version": {"const": CRAWLER_VERSION}, "record_version": {"minimum": 1}, "provenance.ocr_confidence": {"minimum": 0, "maximum": 1},
        "question_id": {"pattern": "^CHIS_[0-9]{6}$"}, "group_id": {"pattern": "^GROUP_[A-Za-z0-9_-]+$"}, "answer": {"enum": ["", *LETTERS]}, "answer_evidence.answer": {"enum": [*LETTERS]},
        "quality.answer_status": {"enum": [*ANSWER_STATUSES]}, "quality.duplicate_status": {"enum": ["unchecked", *DUPLICATE_STATUSES]}, "quality.review_status": {"enum": [*REVIEW_STATUSES]},
        "quality.parse_status": {"enum": ["pending", "parsed", "valid", "needs_review", "failed"]}, "quality.image_dependency": {"enum": ["unknown", "not_image_dependent", "image_dependent", "needs_review"]},
        "provenance.license_status": {"enum": [*LICENSE_STATUSES]},
    }

    def of(kind: S.DataType, path: str) -> dict:
        if path in ("quality.issues", "provenance.normalization_changes"):
            return {"type": "array", "items": {"type": "object"}}
        if isinstance(kind, S.ArrayType):
            return {"type": "array", "items": of(kind.elementType, path)}
        if isinstance(kind, S.StructType):
            at = lambda f: f"{path}.{f.name}".lstrip(".")
            known = [f for f in kind.fields if at(f) not in {"provenance.source_question_number", *(x for x in optional if x.startswith("answer_evidence.") and x.split(".")[1] not in ("official", "reliable", "evidence_url"))}]
            closed = {"additionalProperties": False} if path in ("raw_options", "options", "labels") else {}
            return {"type": "object", "required": [f.name for f in kind.fields if at(f) not in optional], "properties": {f.name: of(f.dataType, at(f)) for f in known}, **closed}
        if "const" in rules.get(path, {}) or ("enum" in rules.get(path, {}) and path != "answer"):
            return dict(rules[path])
        name = names[type(kind)]
        return {"type": [name, "null"] if path in nullable else name, **rules.get(path, {})}

    return {"$schema": "https://json-schema.org/draft/2020-12/schema", **of(S.StructType.fromDDL(RECORD), "")}
