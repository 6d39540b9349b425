"""Queries over records as JSON lines, whose fields are open: keys, types and values come from the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.operators.json_schema import violations
from gleanery.operators.open_records import OPEN, open_lines, open_records
from gleanery.operators.validate import validate_records
from gleanery.schema import record_document
from gleanery.sources.files import table

KEYS = "ABCDEF"

#: The parts of a record that vary: at most six pieces of a text as options and evidence, with letters as keys.
PARTS_SQL = r"""
parts AS (
  SELECT 'CHIS_' || lpad(CAST(doc_id AS VARCHAR), 6, '0') AS question_id, text, lang, n_chars, substr(text, 1, 3) AS head, upper(substr(text, 1, 1)) AS answer,
    string_split(text, '. ')[1:6] AS pieces, string_split('ABCDEF', '')[1:len(string_split(text, '. ')[1:6])] AS letters, CAST(regexp_extract(text, '[0-9]{1,4}') AS VARCHAR) AS digits
  FROM documents),
told AS (SELECT *, to_json(map(letters, pieces)) AS options, to_json(list_transform(pieces, lambda x: {'source_id': lang, 'answer': upper(substr(x, 1, 1))})) AS evidence FROM parts)
"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): documents as JSON lines of records. Sentences make options of one to six keys and evidence, the first
    characters the group and the answer, digits the year (a number, or the language where there are none)."""
    docs = table(spark, f"{sf_dir}/documents.parquet")
    text, lang = F.col("text"), F.col("lang")
    pieces = F.slice(F.split(text, r"\. "), 1, len(KEYS))
    options = F.map_from_arrays(F.slice(F.array(*map(F.lit, KEYS)), F.lit(1), F.size(pieces)), pieces)
    digits = F.regexp_extract(text, "[0-9]{1,4}", 0)
    year = F.when(digits != "", digits.cast("int").cast("variant")).otherwise(lang.cast("variant"))
    none = F.lit("")
    source = F.struct(*(none.alias(c) for c in ("source_id", "site_name", "paper_title", "province", "exam_type", "retrieved_at")), F.lit("https://x.example/").alias("url"), year.alias("year"), F.lit(1).alias("page_number"), F.col("source").alias("shelf"))
    labels = F.create_map(*(x for c in ("primary_ability", "history_scope", "historical_period", "knowledge_point", "material_type") for x in (F.lit(c), none)))
    labels = F.when(lang == "fr", F.map_concat(labels, F.create_map(F.lit("language"), lang))).otherwise(labels)
    quality = F.struct(*(F.lit(v).alias(c) for c, v in (("answer_status", "unchecked"), ("duplicate_status", "unchecked"), ("parse_status", "pending"), ("review_status", "pending"), ("image_dependency", "unknown"), ("collector", ""), ("reviewer", ""), ("notes", ""))), F.array().cast("array<struct<code:string>>").alias("issues"))
    license_ = F.when(lang == "en", "allowed").when(lang == "de", "research_only").otherwise(lang)
    provenance = F.struct(*(none.alias(c) for c in ("raw_file", "content_hash", "ordered_hash", "permutation_hash")), F.lit("v0.1").alias("crawler_version"), license_.alias("license_status"), F.array().cast("array<struct<field:string>>").alias("normalization_changes"), (F.col("n_chars") / 1000.0).cast("double").alias("ocr_confidence"))
    evidence = F.transform(pieces, lambda x: F.struct(lang.alias("source_id"), T.capital(F.substring(x, 1, 1)).alias("answer")))
    record = F.struct(
        F.lit("0.1.0").alias("schema_version"), F.col("n_chars").cast("long").alias("record_version"), F.concat(F.lit("CHIS_"), F.lpad(F.col("doc_id").cast("string"), 6, "0")).alias("question_id"), F.concat(F.lit("GROUP_"), F.substring(text, 1, 3)).alias("group_id"),
        none.alias("shared_material"), text.alias("raw_question"), text.alias("normalized_question"), text.alias("question"), options.alias("raw_options"), options.alias("options"), T.capital(F.substring(text, 1, 1)).alias("answer"), none.alias("answer_explanation"),
        evidence.alias("answer_evidence"), F.lit(False).alias("has_image"), F.array().cast("array<string>").alias("image_paths"), source.alias("source"), F.array().cast("array<struct<x:string>>").alias("source_records"), labels.alias("labels"), quality.alias("quality"),
        provenance.alias("provenance"), lang.alias("language"), F.col("n_chars").alias("length"),
    )
    return docs.select(F.to_json(record).alias("value"))


def option_key_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of options by the keys that the objects have: four letters, no fewer and no more."""
    found = validate_records(open_records(lines(spark, sf_dir)), latest_year=2026)
    issues = found.select("question_id", F.explode("quality.issues").alias("i")).select("question_id", "i.code", "i.message")
    return issues.filter(F.col("code").isin("invalid_option_keys", "empty_options", "duplicate_options"))


def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the record format's JSON-schema document does not allow, by path and keyword."""
    return violations(open_records(lines(spark, sf_dir)), record_document(), OPEN, "question_id")


def open_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read, changed (answer and option A in lower case) and written again: what the typed record cannot hold is there."""
    records = open_records(lines(spark, sf_dir))
    changed = records.withColumn("answer", T.small_letters(F.col("answer"))).withColumn("options", F.col("options").withField("A", T.small_letters(F.col("options.A"))))
    got = lambda path: F.try_variant_get("v", path, "string")
    return open_lines(changed).select(F.parse_json("value").alias("v")).select(
        got("$.question_id").alias("question_id"), got("$.language").alias("language"), F.try_variant_get("v", "$.length", "long").alias("length"), got("$.labels.language").alias("label"), got("$.answer").alias("answer"),
        F.sha2(got("$.options.A"), 256).alias("a"), F.sha2(got("$.options.E"), 256).alias("e"), F.sha2(got("$.raw_options.F"), 256).alias("f"), got("$.source.year").alias("year"), got("$.answer_evidence[0].answer").alias("first"),
    )


def _listed(*cases: str) -> str:
    return "[" + ", ".join(f"CASE WHEN {when} THEN {{'path': '{path}', 'keyword': '{word}'}} END" for when, path, word in (c.split(" => ") for c in cases)) + "]"


FORM_SQL = _listed(
    "n_chars IS NULL => $.record_version => required", "n_chars < 1 => $.record_version => minimum", "text IS NULL => $.group_id => required", "NOT regexp_matches(head, '^[A-Za-z0-9_-]+\\n?$') => $.group_id => pattern",
    "text IS NULL => $.raw_question => required", "text IS NULL => $.normalized_question => required", "text IS NULL => $.question => required", "text IS NULL => $.raw_options => required", "text IS NULL => $.options => required",
    "text IS NULL => $.answer => required", "text IS NULL => $.answer_evidence => required", "answer NOT IN ('', 'A', 'B', 'C', 'D') => $.answer => enum", "coalesce(digits, '') = '' AND lang IS NOT NULL => $.source.year => type",
    "coalesce(digits, '') = '' AND lang IS NULL => $.source.year => required", "lang = 'fr' => $.labels.language => additionalProperties", "lang NOT IN ('en', 'de') => $.provenance.license_status => enum",
    "lang IS NULL => $.provenance.license_status => required", "n_chars / 1000.0 < 0 => $.provenance.ocr_confidence => minimum", "n_chars / 1000.0 > 1 => $.provenance.ocr_confidence => maximum",
)

VIOLATIONS_SQL = rf"""
WITH {PARTS_SQL},
fixed AS (SELECT question_id, unnest({FORM_SQL}) AS v FROM told),
keyed AS (
  SELECT question_id, field, unnest(list_concat(
    list_transform(list_filter(['A', 'B', 'C', 'D'], lambda x: NOT list_contains(json_keys(options), x)), lambda x: {{'path': '$.' || field || '.' || x, 'keyword': 'required'}}),
    list_transform(list_filter(json_keys(options), lambda x: x NOT IN ('A', 'B', 'C', 'D')), lambda x: {{'path': '$.' || field || '.' || x, 'keyword': 'additionalProperties'}}))) AS v
  FROM told, (VALUES ('options'), ('raw_options')) f(field) WHERE options IS NOT NULL),
pieces AS (
  SELECT question_id, unnest(list_transform(range(json_array_length(evidence)::BIGINT), lambda i: CASE WHEN json_extract_string(evidence, '$[' || i || '].answer') NOT IN ('A', 'B', 'C', 'D') THEN {{'path': '$.answer_evidence[' || i || '].answer', 'keyword': 'enum'}} END)) AS v
  FROM told WHERE evidence IS NOT NULL),
nameless AS (SELECT question_id, unnest(list_transform(range(json_array_length(evidence)::BIGINT), lambda i: {{'path': '$.answer_evidence[' || i || '].source_id', 'keyword': 'required'}})) AS v FROM told WHERE evidence IS NOT NULL AND lang IS NULL),
every AS (SELECT question_id, v FROM fixed UNION ALL SELECT question_id, v FROM keyed UNION ALL SELECT question_id, v FROM pieces UNION ALL SELECT question_id, v FROM nameless)
SELECT question_id, v.path AS path, v.keyword AS keyword FROM every WHERE v IS NOT NULL
"""

OPTIONS_SQL = rf"""
WITH {PARTS_SQL},
stripped AS (SELECT question_id, len(json_keys(options)) AS n, list_transform(pieces, lambda x: regexp_replace(x, '^[\s\x0b]+|[\s\x0b]+$', '', 'g')) AS p, letters FROM told),
issues AS (
  SELECT question_id, unnest([
    CASE WHEN n IS DISTINCT FROM 4 THEN {{'code': 'invalid_option_keys', 'message': 'Options must be exactly A, B, C and D'}} END,
    CASE WHEN n = 4 AND list_contains(p, '') THEN {{'code': 'empty_options', 'message': 'Empty options: ' || array_to_string(list_filter(list_transform([1, 2, 3, 4], lambda i: CASE WHEN p[i] = '' THEN letters[i] END), lambda x: x IS NOT NULL), ', ')}} END,
    CASE WHEN n = 4 AND len(list_filter(p, lambda x: x <> '')) > len(list_distinct(list_filter(p, lambda x: x <> ''))) THEN {{'code': 'duplicate_options', 'message': 'Two or more options have the same text'}} END]) AS i
  FROM stripped)
SELECT question_id, i.code AS code, i.message AS message FROM issues WHERE i IS NOT NULL
"""

ROUND_SQL = rf"""
WITH {PARTS_SQL}
SELECT question_id, lang AS language, n_chars AS length, CASE WHEN lang = 'fr' THEN lang END AS label, lower(answer) AS answer, sha256(lower(pieces[1])) AS a, sha256(pieces[5]) AS e, sha256(pieces[6]) AS f,
  CASE WHEN coalesce(digits, '') <> '' THEN CAST(CAST(digits AS INTEGER) AS VARCHAR) ELSE lang END AS year, upper(substr(pieces[1], 1, 1)) AS first
FROM told
"""

QUERIES = {"option_key_issues": option_key_issues, "schema_violations": schema_violations, "open_round_trip": open_round_trip}
ORACLE = {"option_key_issues": OPTIONS_SQL, "schema_violations": VIOLATIONS_SQL, "open_round_trip": ROUND_SQL}
