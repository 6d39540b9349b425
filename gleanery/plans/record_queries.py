"""Queries over the question view: normalising, validating, duplicates, reports, reviews. SQL beside each."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.operators import dedup, integrity, normalize, review, validate
from gleanery.plans.views import RECORD_SQL, flat, records, with_q
from gleanery.schema import LETTERS
from gleanery.sources.files import table

LATEST = 2027
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


R = with_q  # shorthand


@query(R(r"SELECT id, trim(regexp_replace(question, '\s+', ' ', 'g')) AS clean FROM q"))
def norm_text(spark, d):
    q = flat(spark, d)
    dirty = F.concat(F.lit(" １２． "), F.translate("question", "abc", "ａｂｃ"), F.lit("​&nbsp;　"))
    return q.select("id", T.normal_text(dirty, number=True).alias("clean"))


@query(R(r"SELECT id, trim(regexp_replace(A, '\s+', ' ', 'g')) AS a, trim(regexp_replace(B, '\s+', ' ', 'g')) AS b FROM q"))
def option_prefix(spark, d):
    return flat(spark, d).select("id", T.option_text(F.concat(F.lit("Ａ．"), F.col("A"))).alias("a"), T.option_text(F.concat(F.lit(" b) "), F.col("B"))).alias("b"))


PREFIX = r"^\s*[A-DＡ-Ｄa-dａ-ｄ]\s*[.．、:：)）]\s*"


@query(R(rf"""
SELECT id, field, before, after FROM (
  SELECT id, 'question' AS field, '3. ' || question AS before, trim(regexp_replace(question, '\s+', ' ', 'g')) AS after FROM q
  UNION ALL SELECT id, 'options.A', A, trim(regexp_replace(trim(regexp_replace(A, '\s+', ' ', 'g')), '{PREFIX}', '')) FROM q
  UNION ALL SELECT id, 'options.B', B, trim(regexp_replace(trim(regexp_replace(B, '\s+', ' ', 'g')), '{PREFIX}', '')) FROM q
  UNION ALL SELECT id, 'answer', lower(answer), answer FROM q) WHERE before <> after
"""))
def change_log(spark, d):
    r = records(spark, d).withColumns({"raw_question": F.concat(F.lit("3. "), F.col("question")), "answer": F.lower("answer"), "raw_options": F.struct(F.col("options.A").alias("A"), F.col("options.B").alias("B"), F.lit("").alias("C"), F.lit("").alias("D"))})
    n = normalize.normalize_records(r)
    return n.select(F.col("_ord").alias("id"), F.explode("provenance.normalization_changes").alias("c")).select("id", "c.*")


@query(R("SELECT id, ordered_hash, permutation_hash FROM r", RECORD_SQL))
def record_hashes(spark, d):
    n = normalize.with_hashes(records(spark, d))
    return n.select(F.col("_ord").alias("id"), "provenance.ordered_hash", "provenance.permutation_hash")


PAIR_SQL = """
status AS (SELECT *, CASE WHEN answer = '' THEN 2 WHEN NOT told THEN 3 WHEN official THEN 5 ELSE 4 END AS ar,
  CASE license_status WHEN 'allowed' THEN 3 WHEN 'research_only' THEN 2 WHEN 'unknown' THEN 1 ELSE 0 END AS lr,
  trim(CASE answer WHEN 'A' THEN A WHEN 'B' THEN B WHEN 'C' THEN C WHEN 'D' THEN D ELSE '' END) AS chosen,
  json_object('A', A, 'B', B, 'C', C, 'D', D)::VARCHAR AS options, json_object('source_id', source_id, 'site_name', 'site', 'url', url, 'paper_title', '', 'year', year, 'province', '', 'exam_type', '', 'page_number', NULL, 'retrieved_at', '')::VARCHAR AS source FROM r),
  pairs AS (SELECT l.question_id AS question_id_1, r.question_id AS question_id_2, l.ordered_hash = r.ordered_hash AS same, 1.0::DOUBLE AS similarity,
  l.question AS question_1, r.question AS question_2, l.options AS options_1, r.options AS options_2, l.source AS source_1, r.source AS source_2, 'pending' AS human_status,
  CASE WHEN (-l.ar, -l.lr, l.question_id) <= (-r.ar, -r.lr, r.question_id) THEN l.question_id ELSE r.question_id END AS suggested_keep,
  CASE WHEN l.chosen = '' OR r.chosen = '' THEN 'unknown' WHEN l.chosen = r.chosen THEN 'equivalent' ELSE 'conflict' END AS answer_equivalence
  FROM status l JOIN status r ON l.permutation_hash = r.permutation_hash AND l.id < r.id)
"""


def _validated(spark, d):
    return validate.validate_records(records(spark, d), LATEST)


def _answered(spark, d):
    """Records with their answer status, which decides on which of two is kept."""
    return records(spark, d).withColumn("quality", F.col("quality").withField("answer_status", validate.answer_status()))


def _flat_pairs(pairs):
    return pairs.select(*(T.json(F.col(c)).alias(c) if c[:-2] in ("options", "source") else F.col(c) for c in pairs.columns))


@query(R("SELECT * EXCLUDE (same), 'exact_duplicate' AS duplicate_type FROM pairs WHERE same", RECORD_SQL, PAIR_SQL))
def exact_pairs(spark, d):
    return _flat_pairs(dedup.exact_pairs(_answered(spark, d)))


@query(R("SELECT * EXCLUDE (same), 'reordered_duplicate' AS duplicate_type FROM pairs WHERE NOT same", RECORD_SQL, PAIR_SQL))
def reordered_pairs(spark, d):
    return _flat_pairs(dedup.reordered_pairs(_answered(spark, d)))


DUP_SQL = """
dup AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY ordered_hash) > 1 THEN 'exact_duplicate'
  WHEN min(ordered_hash) OVER (PARTITION BY permutation_hash) <> max(ordered_hash) OVER (PARTITION BY permutation_hash) THEN 'reordered_duplicate' ELSE 'unique' END AS duplicate_status FROM r)
"""


@query(R("SELECT duplicate_status, count(*) AS n FROM dup GROUP BY 1", RECORD_SQL, DUP_SQL))
def duplicate_status(spark, d):
    out = dedup.duplicate_statuses(records(spark, d))
    return out.groupBy(F.col("quality.duplicate_status").alias("duplicate_status")).agg(F.count("*").alias("n"))


@query(R("SELECT question_id, duplicate_status FROM dup", RECORD_SQL, DUP_SQL))
def duplicate_status_rows(spark, d):
    return dedup.duplicate_statuses(records(spark, d)).select("question_id", F.col("quality.duplicate_status").alias("duplicate_status"))


@query()
def suspected_pairs(spark, d):
    """Records, whole documents as questions and their pieces as options, that are similar. The sequence ratio is not SQL; tests hold
    this against the nested loop."""
    return dedup.suspected_pairs(records(spark, d)).select("question_id_1", "question_id_2", "similarity", "suggested_keep", "answer_equivalence")


@query()
def suspected_turns(spark, d):
    """Turns of conversations as questions, and each fifth conversation's once more with a mark at the end. The
    sequence ratio is not SQL; tests hold this against the nested loop."""
    turns = table(spark, f"{d}/conversations.parquet").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text", "conv_id")
    turns = turns.unionByName(turns.filter("conv_id % 5 = 0").withColumns({"id": F.col("id") + 1_000_000_000_000, "text": F.concat("text", F.lit("？"))}))
    fields = {"question_id": F.col("id").cast("string"), "question": F.col("text"), "normalized_question": F.col("text"), "shared_material": F.lit(""), "answer": F.lit("A"), "_ord": F.col("id")}
    fields |= {"options": F.struct(*(F.lit(x.lower()).alias(x) for x in LETTERS)), "source": F.struct(F.lit("s").alias("source_id"))}
    fields |= {"quality": F.struct(F.lit("verified").alias("answer_status")), "provenance": F.struct(F.lit("allowed").alias("license_status"))}
    r = normalize.with_hashes(turns.select(*(c.alias(n) for n, c in fields.items())))
    return dedup.suspected_pairs(r).select("question_id_1", "question_id_2", "similarity", "suggested_keep", "answer_equivalence")


ISSUE_SQL = f"""
rules AS (SELECT *,
  list_filter([CASE WHEN trim(A) = '' THEN 'A' END, CASE WHEN trim(B) = '' THEN 'B' END, CASE WHEN trim(C) = '' THEN 'C' END, CASE WHEN trim(D) = '' THEN 'D' END], lambda x: x IS NOT NULL) AS empty,
  list_filter([trim(A), trim(B), trim(C), trim(D)], lambda x: x <> '') AS filled,
  CASE answer WHEN 'A' THEN A WHEN 'B' THEN B WHEN 'C' THEN C WHEN 'D' THEN D END AS pointed,
  min(shared_material) OVER (PARTITION BY group_id) <> max(shared_material) OVER (PARTITION BY group_id) AS mixed FROM r),
issued AS (SELECT *, list_filter([
  CASE WHEN trim(question) = '' THEN ['empty_question', 'error', 'Question text is empty'] END,
  CASE WHEN len(empty) > 0 THEN ['empty_options', 'error', 'Empty options: ' || array_to_string(empty, ', ')] END,
  CASE WHEN len(filled) > len(list_distinct(filled)) THEN ['duplicate_options', 'error', 'Two or more options have the same text'] END,
  CASE WHEN pointed = '' THEN ['missing_answer_option', 'error', 'Answer points to a missing option'] END,
  CASE WHEN NOT regexp_matches(url, '^https?://[^/?#]') THEN ['invalid_source_url', 'error', 'A traceable HTTP(S) source URL is required'] END,
  CASE WHEN year NOT BETWEEN 1900 AND {LATEST} THEN ['invalid_year', 'warning', 'Year must be between 1900 and {LATEST}'] END,
  CASE WHEN ocr_confidence < 0.8 THEN ['low_ocr_confidence', 'warning', 'OCR confidence is below 0.80'] END,
  CASE WHEN has_image THEN ['unprocessed_image', 'warning', 'Image reference has no saved local asset'] END,
  CASE WHEN mixed THEN ['inconsistent_group_material', 'error', 'Records in the same group have different shared material'] END], lambda x: x IS NOT NULL) AS issues,
  CASE WHEN answer = '' THEN 'missing' WHEN NOT told THEN 'unchecked' WHEN official THEN 'verified' ELSE 'single_source' END AS answer_status,
  CASE WHEN NOT has_image THEN 'not_image_dependent' ELSE 'needs_review' END AS image_dependency FROM rules),
v AS (SELECT *, CASE WHEN len(list_filter(issues, lambda x: x[2] = 'error')) > 0 THEN 'failed' WHEN len(issues) > 0 THEN 'needs_review' ELSE 'valid' END AS parse_status FROM issued)
"""
V = (RECORD_SQL, ISSUE_SQL)


@query(R("SELECT question_id, i[1] AS code, i[2] AS severity, i[3] AS message FROM (SELECT question_id, unnest(issues) AS i FROM v)", *V))
def issues_exploded(spark, d):
    return _validated(spark, d).select("question_id", F.explode("quality.issues").alias("i")).select("question_id", "i.*")


@query(R("SELECT question_id, answer_status, image_dependency, parse_status FROM v", *V))
def record_statuses(spark, d):
    return _validated(spark, d).select("question_id", "quality.answer_status", "quality.image_dependency", "quality.parse_status")


@query(R("""
SELECT 'total' AS metric, '' AS key, count(*) AS n FROM v UNION ALL SELECT 'structurally_valid', '', count(*) FILTER (parse_status = 'valid') FROM v
UNION ALL SELECT 'qualified', '', count(*) FILTER (parse_status = 'valid' AND answer_status = 'verified' AND image_dependency <> 'image_dependent') FROM v
UNION ALL SELECT 'missing_answer', '', count(*) FILTER (answer_status = 'missing') FROM v UNION ALL SELECT 'parse_failed', '', count(*) FILTER (parse_status = 'failed') FROM v
UNION ALL SELECT 'image_dependent', '', 0 UNION ALL SELECT 'by_source', source_id, count(*) FROM v GROUP BY 2
UNION ALL SELECT 'by_year', coalesce(CAST(year AS VARCHAR), 'unknown'), count(*) FROM v GROUP BY 2
UNION ALL SELECT 'issue_counts', i[1], count(*) FROM (SELECT unnest(issues) AS i FROM v) GROUP BY 2
""", *V))
def validation_summary(spark, d):
    return validate.validation_summary(_validated(spark, d))


REPORT_SQL = """
f AS (SELECT v.*, dup.duplicate_status FROM v JOIN dup ON v.id = dup.id)
"""


@query(R("""
SELECT 'total' AS metric, '' AS key, count(*) AS n FROM f
UNION ALL SELECT 'qualified', '', count(*) FILTER (parse_status = 'valid' AND answer_status = 'verified' AND review_status = 'approved' AND duplicate_status = 'unique' AND image_dependency <> 'image_dependent') FROM f
UNION ALL SELECT 'missing_answer', '', count(*) FILTER (answer_status = 'missing') FROM f UNION ALL SELECT 'verified_answer', '', count(*) FILTER (answer_status = 'verified') FROM f
UNION ALL SELECT 'parse_failed', '', count(*) FILTER (parse_status = 'failed') FROM f UNION ALL SELECT 'suspected_duplicate', '', 0
UNION ALL SELECT 'exact_duplicate', '', count(*) FILTER (duplicate_status = 'exact_duplicate') FROM f UNION ALL SELECT 'image_dependent', '', 0
UNION ALL SELECT 'needs_human_review', '', count(*) FILTER (review_status IN ('pending', 'needs_revision')) FROM f
UNION ALL SELECT 'by_source', source_id, count(*) FROM f GROUP BY 2 UNION ALL SELECT 'by_year', coalesce(CAST(year AS VARCHAR), 'unknown'), count(*) FROM f GROUP BY 2
UNION ALL SELECT 'answer_statuses', answer_status, count(*) FROM f GROUP BY 2 UNION ALL SELECT 'parse_statuses', parse_status, count(*) FROM f GROUP BY 2
UNION ALL SELECT 'review_statuses', review_status, count(*) FROM f GROUP BY 2 UNION ALL SELECT 'duplicate_statuses', duplicate_status, count(*) FROM f GROUP BY 2
UNION ALL SELECT 'rejection_reasons', code, count(*) FROM (SELECT unnest(CASE WHEN len(issues) = 0 THEN ['unspecified'] ELSE list_transform(issues, lambda x: x[1]) END) AS code FROM f WHERE review_status = 'rejected') GROUP BY 2
""", *V, DUP_SQL, REPORT_SQL))
def quality_report(spark, d):
    return validate.quality_report(dedup.duplicate_statuses(_validated(spark, d)))


SNAP_SQL = """
snap AS (SELECT id, question_id, sha256(json_object('answer', answer, 'answer_status', 'unchecked', 'duplicate_status', 'unchecked', 'group_id', group_id,
  'options', json_object('A', A, 'B', B, 'C', C, 'D', D), 'parse_status', 'pending', 'question', question, 'question_id', question_id, 'shared_material', shared_material,
  'source', json_object('exam_type', '', 'page_number', NULL, 'paper_title', '', 'province', '', 'retrieved_at', '', 'site_name', 'site', 'source_id', source_id, 'url', url, 'year', year))::VARCHAR) AS hash FROM r)
"""


@query(R("SELECT question_id, hash FROM snap", RECORD_SQL, SNAP_SQL))
def review_snapshot(spark, d):
    return records(spark, d).select("question_id", review.snapshot_hash().alias("hash"))


SAFE = "CASE WHEN regexp_matches({0}, '^[=+@-]') THEN '''' || {0} ELSE {0} END"


@query(R(f"""
SELECT r.question_id, group_id, shared_material, {SAFE.format('question')} AS question, {SAFE.format('A')} AS option_A, {SAFE.format('B')} AS option_B, {SAFE.format('C')} AS option_C, {SAFE.format('D')} AS option_D, answer,
  'unchecked' AS answer_status, 'site' AS source_name, url AS source_url, coalesce(CAST(CAST(year AS INTEGER) AS VARCHAR), '') AS year, '' AS province, '' AS exam_type, 'unchecked' AS duplicate_status, 'pending' AS parse_status, review_status,
  '' AS reviewer, '' AS notes, hash AS review_snapshot_hash FROM r JOIN snap ON r.id = snap.id
""", RECORD_SQL, SNAP_SQL))
def review_rows(spark, d):
    return review.review_rows(records(spark, d))


SHEET_SQL = """
sheet AS (
  SELECT r.id AS line, CASE WHEN r.id % 13 = 4 THEN 'X' || r.question_id ELSE r.question_id END AS question_id, CASE WHEN r.id % 7 = 3 THEN 'stale' ELSE hash END AS hash,
    CASE WHEN r.id % 11 = 5 THEN 'bad' WHEN r.id % 11 = 6 THEN '' ELSE 'approved' END AS status FROM r JOIN snap ON r.id = snap.id
  UNION ALL SELECT r.id + 5000000000, r.question_id, hash, 'rejected' FROM r JOIN snap ON r.id = snap.id WHERE r.id % 17 = 2),
outcome AS (SELECT line, s.question_id, CASE status WHEN '' THEN 'pending' ELSE status END AS review_status,
  CASE WHEN row_number() OVER (PARTITION BY s.question_id ORDER BY line) > 1 THEN 'duplicate' WHEN snap.hash IS NULL THEN 'unknown' WHEN s.hash <> snap.hash THEN 'stale' WHEN status NOT IN ('', 'pending', 'approved', 'needs_revision', 'rejected') THEN 'invalid' ELSE 'merged' END AS outcome
  FROM sheet s LEFT JOIN snap ON s.question_id = snap.question_id)
"""


def _sheet(r):
    rows = review.review_rows(r.drop("line")).withColumn("line", F.lpad(F.regexp_extract("question_id", r"(\d+)", 1), 10, "0").cast("long"))
    i = F.col("line")
    marked = rows.withColumns({
        "question_id": F.when(i % 13 == 4, F.concat(F.lit("X"), F.col("question_id"))).otherwise(F.col("question_id")), "review_snapshot_hash": F.when(i % 7 == 3, "stale").otherwise(F.col("review_snapshot_hash")),
        "review_status": F.when(i % 11 == 5, "bad").when(i % 11 == 6, "").otherwise("approved"),
    })
    again = rows.filter(i % 17 == 2).withColumns({"line": i + 5_000_000_000, "review_status": F.lit("rejected")})
    return marked.unionByName(again)


M = (RECORD_SQL, SNAP_SQL, SHEET_SQL)


@query(R("SELECT line, question_id, outcome FROM outcome", *M))
def review_outcomes(spark, d):
    r = records(spark, d)
    return review.merge_outcomes(r, _sheet(r)).select("line", "question_id", "outcome")


@query(R("SELECT r.question_id, coalesce(o.review_status, r.review_status) AS review_status, CASE WHEN o.line IS NULL THEN 1 ELSE 2 END AS record_version FROM r LEFT JOIN outcome o ON r.question_id = o.question_id AND o.outcome = 'merged'", *M))
def review_merge(spark, d):
    r = records(spark, d)
    return review.merge_review(r, _sheet(r)).select("question_id", "quality.review_status", "record_version")


@query(R("SELECT count(*) AS input_rows, count(*) FILTER (outcome = 'merged') AS merged, count(*) FILTER (outcome <> 'merged') AS skipped FROM outcome", *M))
def merge_summary(spark, d):
    r = records(spark, d)
    return review.merge_summary(review.merge_outcomes(r, _sheet(r)))


@query(R("""
SELECT line, 'line ' || CAST(line AS VARCHAR) || ': ' || CASE outcome WHEN 'duplicate' THEN 'duplicate question_id ' || question_id WHEN 'unknown' THEN 'unknown question_id ' || question_id
  WHEN 'stale' THEN 'stale review snapshot for ' || question_id ELSE 'invalid review_status ''' || review_status || '''' END AS message FROM outcome WHERE outcome <> 'merged'
""", *M))
def merge_errors(spark, d):
    r = records(spark, d)
    return review.merge_errors(review.merge_outcomes(r, _sheet(r)))


@query(R("""
SELECT '0.1.0' AS schema_version, '1' AS record_version, question_id, group_id, shared_material, {Q} AS raw_question, {Q} AS normalized_question, {Q} AS question,
  {A} AS raw_option_A, {B} AS raw_option_B, {C} AS raw_option_C, {D} AS raw_option_D, {A} AS option_A, {B} AS option_B, {C} AS option_C, {D} AS option_D, answer, '' AS answer_explanation, 'unchecked' AS answer_status,
  CASE WHEN has_image THEN 'True' ELSE 'False' END AS has_image, '[]' AS image_paths_json, source_id, 'site' AS source_name, url AS source_url, '' AS paper_title, coalesce(CAST(year AS VARCHAR), '') AS year,
  '' AS province, '' AS exam_type, '' AS page_number, '' AS retrieved_at, '[]' AS source_records_json,
  CASE WHEN told AND answer <> '' THEN '[' || json_object('source_id', source_id, 'answer', answer, 'official', official, 'reliable', reliable, 'evidence_url', '', 'raw_file', '', 'page_number', NULL, 'source_question_number', '',
    'raw_answer', '', 'image_name', NULL, 'image_sha256', NULL, 'extraction_method', NULL, 'needs_review', NULL)::VARCHAR || ']' ELSE '[]' END AS answer_evidence_json,
  'unchecked' AS duplicate_status, 'pending' AS parse_status, review_status, 'unknown' AS image_dependency, '[]' AS issues_json, 'c' AS collector, '' AS reviewer, '' AS notes,
  'raw/' || source_id AS raw_file, sha256(source_id) AS content_hash, ordered_hash, permutation_hash, license_status, '[]' AS normalization_changes_json FROM r
""".format(Q=SAFE.format("question"), **{x: SAFE.format(x) for x in LETTERS}), RECORD_SQL))
def canonical_flat(spark, d):
    return review.canonical_rows(records(spark, d))


@query(R("""
SELECT r.question_id, CASE WHEN hit THEN p ELSE r.answer END AS answer, CASE WHEN hit THEN 2 ELSE 1 END AS record_version FROM (
  SELECT *, CASE WHEN id % 3 = 0 THEN 'A' WHEN id % 3 = 1 THEN 'C' ELSE 'E' END AS p, answer = '' AND source_id = 'src0' AND id % 3 < 2 AND id % 4 <> 1 AS hit FROM r) r
""", RECORD_SQL))
def answer_backfill(spark, d):
    r = records(spark, d)
    ids = flat(spark, d).select("id")
    qid = F.col("id").cast("string")
    letter = F.when(F.col("id") % 3 == 0, "A").when(F.col("id") % 3 == 1, "C").otherwise("E")
    cache = ids.select(qid.alias("qid"), letter.alias("answer"), F.lit("why").alias("explanation"), F.sha2(qid, 256).alias("image_sha256"))
    images = ids.select(qid.alias("qid"), F.sha2(F.when(F.col("id") % 4 == 1, F.concat(qid, F.lit("x"))).otherwise(qid), 256).alias("sha256"))
    return review.backfill_answers(r, cache, images, "src0", "https://site.example/q").select("question_id", "answer", "record_version")


@query(R("""
SELECT "check", item FROM (
  SELECT 'incomplete' AS "check", question_id AS item FROM r WHERE answer = '' OR trim(A) = '' OR trim(B) = '' OR trim(C) = '' OR trim(D) = ''
  UNION ALL SELECT 'manifest_hash', question_id FROM r WHERE source_id = 'src1' UNION ALL SELECT 'not_in_manifest', question_id FROM r WHERE source_id = 'src2'
  UNION ALL SELECT DISTINCT 'missing_file', 'raw/' || source_id FROM r WHERE source_id = 'src3'
  UNION ALL SELECT DISTINCT 'raw_bytes', 'raw/' || source_id FROM r WHERE source_id = 'src1'
  UNION ALL SELECT 'unreferenced', 'raw/extra')
""", RECORD_SQL))
def integrity_checks(spark, d):
    r = records(spark, d)
    seen = r.select(F.col("source.source_id").alias("s")).distinct()
    good = F.sha2("s", 256)
    manifest = seen.filter("s <> 'src2'").select(F.concat(F.lit("raw/"), F.col("s")).alias("raw_file"), F.when(F.col("s") == "src1", F.sha2(F.lit("x"), 256)).otherwise(good).alias("content_hash"))
    files = seen.filter("s <> 'src3'").select(F.concat(F.lit("raw/"), F.col("s")).alias("path"), good.alias("sha256")).unionByName(spark.range(1).select(F.lit("raw/extra").alias("path"), F.lit("h").alias("sha256")))
    return integrity.violations(r, manifest, files)


@query(R("""SELECT 'duplicate_id' AS "check", sha256(question) AS item FROM r GROUP BY 2 HAVING count(*) > 1""", RECORD_SQL))
def repeated_ids(spark, d):
    """Records with their question's fingerprint as id, which equal questions share."""
    r = records(spark, d).withColumn("question_id", F.sha2("question", 256))
    files = r.select(F.col("provenance.raw_file").alias("path"), F.col("provenance.content_hash").alias("sha256")).distinct()
    return integrity.violations(r, files.select(F.col("path").alias("raw_file"), F.col("sha256").alias("content_hash")), files).filter("check = 'duplicate_id'")


def told(text):
    return F.when(F.col("id") % 4 == 0, F.concat(F.lit("参考答案： "), F.lower("answer"), F.lit(" "), text)).when(F.col("id") % 4 == 1, F.col("answer")).when(F.col("id") % 4 == 2, F.concat(F.lit("故选"), F.col("answer"), F.lit("。答案: B"))).otherwise(F.concat(text, F.lit("\n答案："), F.col("answer")))


TOLD_SQL = """
told AS (SELECT *, CASE id % 4 WHEN 0 THEN '参考答案： ' || lower(answer) || ' ' || question WHEN 1 THEN answer WHEN 2 THEN '故选' || answer || '。答案: B' ELSE question || chr(10) || '答案：' || answer END AS told FROM q WHERE answer <> '')
"""


@query(R(r"""
SELECT id, upper(CASE WHEN regexp_matches(told, '(?:参考)?答案\s*[:：]?\s*([A-Da-d])') THEN regexp_extract(told, '(?:参考)?答案\s*[:：]?\s*([A-Da-d])', 1) ELSE regexp_extract(told, '^\s*([A-Da-d])\s*$', 1) END) AS letter,
  array_to_string(list_sort(list_distinct(list_concat(regexp_extract_all(told, '故选[：:\s]*([A-D])', 1), regexp_extract_all(told, '答案[：:\s]+([A-D])', 1)))), ',') AS claims FROM told
""", TOLD_SQL))
def answer_extract(spark, d):
    q = flat(spark, d).filter("answer <> ''").withColumn("told", told(F.col("question")))
    return q.select("id", T.answer_of(F.col("told")).alias("letter"), F.array_join(T.answer_claims(F.col("told")), ",").alias("claims"))


#: Records that break rules which no whole document breaks: each rule by the rest of the id.
BROKEN_SQL = """
b AS (SELECT id, id % 12 AS k, 'T' || CAST(id AS VARCHAR) AS t FROM q),
w AS (SELECT id, CASE k WHEN 0 THEN 'other' ELSE t END AS question, t AS normalized, CASE k WHEN 1 THEN '' ELSE 'g' || CAST(id AS VARCHAR) END AS group_id,
  k = 2 AS no_options, CASE k WHEN 3 THEN 'E' WHEN 4 THEN '' ELSE 'A' END AS answer, CASE k WHEN 5 THEN t || chr(65533) ELSE '' END AS material, k IN (7, 8) AS has_image,
  CASE k WHEN 7 THEN '如图' ELSE '' END AS cue, k = 6 AS conflict, k = 9 AS two_reliable, k = 10 AS one_reliable, k FROM b)
"""


def _broken(spark, d):
    k, t = F.col("_ord") % 12, F.concat(F.lit("T"), F.col("_ord").cast("string"))
    r = records(spark, d)
    types = {f.name: f.dataType for f in r.schema.fields}
    option = F.struct(*(F.lit(x).alias(x) for x in LETTERS))
    told = lambda *rows: F.array(*(F.struct(F.lit(s).alias("source_id"), F.lit(a).alias("answer"), F.lit(False).alias("official"), F.lit(r).alias("reliable")) for s, a, r in rows))
    whole = lambda e: F.transform(e, lambda x: F.struct(*(x[n] if n in ("source_id", "answer", "official", "reliable") else F.lit(None).cast(ty) for n, ty in ((f.name, f.dataType) for f in types["answer_evidence"].elementType.fields)))).cast(types["answer_evidence"])
    kept = F.array(F.struct(F.lit("kept").alias("code"), F.lit("warning").alias("severity"), F.lit("from before").alias("message")))
    evidence = F.when(k == 6, whole(told(("s1", "A", True), ("s2", "b", True)))).when(k == 9, whole(told(("s1", "A", True), ("s2", "A", True), ("s2", "A", False)))).when(k == 10, whole(told(("s1", "A", True), ("s1", "A", True)))).otherwise(F.array().cast(types["answer_evidence"]))
    material = F.concat(F.when(k == 5, F.concat(t, F.lit("\ufffd"))).otherwise(""), F.when(k == 7, "如图").otherwise(""))
    return r.withColumns({
        "question": F.when(k == 0, "other").otherwise(t), "normalized_question": t, "group_id": F.when(k == 1, "").otherwise(F.concat(F.lit("g"), F.col("_ord").cast("string"))), "options": F.when(k != 2, option),
        "answer": F.when(k == 3, "E").when(k == 4, "").otherwise("A"), "answer_evidence": evidence, "shared_material": material, "has_image": k.isin(7, 8), "image_paths": F.array(F.lit("images/a.png")),
        "quality": F.col("quality").withField("issues", F.when(k == 11, kept).otherwise(F.slice(kept, 1, 0))), "provenance": F.col("provenance").withField("ocr_confidence", F.lit(0.9)),
        "source": F.col("source").withField("url", F.lit("HTTPS://x.example/")).withField("year", F.lit(2000)),
    })


@query(R("""
SELECT id, coalesce(array_to_string(list_filter([CASE WHEN k = 11 THEN 'kept' END, CASE WHEN question <> normalized THEN 'question_normalization_mismatch' END, CASE WHEN group_id = '' THEN 'missing_group_id' END,
  CASE WHEN no_options THEN 'invalid_option_keys' END, CASE WHEN answer = 'E' THEN 'invalid_answer' END, CASE WHEN k = 5 THEN 'abnormal_unicode' END], lambda x: x IS NOT NULL), ','), '') AS codes,
  CASE WHEN answer = '' THEN 'missing' WHEN answer = 'E' THEN 'invalid' WHEN conflict THEN 'conflict' WHEN two_reliable THEN 'verified' WHEN one_reliable THEN 'single_source' ELSE 'unchecked' END AS answer_status,
  CASE WHEN NOT has_image THEN 'not_image_dependent' WHEN cue <> '' THEN 'image_dependent' ELSE 'needs_review' END AS image_dependency,
  CASE WHEN k IN (0, 1, 2, 3) THEN 'failed' WHEN k IN (5, 11) THEN 'needs_review' ELSE 'valid' END AS parse_status FROM w
""", BROKEN_SQL))
def broken_records(spark, d):
    """The rules and statuses that no document of the view fires: one broken field for each rest of the id."""
    v = validate.validate_records(_broken(spark, d), LATEST)
    codes = F.array_join(F.transform("quality.issues", lambda x: x["code"]), ",")
    return v.select(F.col("_ord").alias("id"), codes.alias("codes"), "quality.answer_status", "quality.image_dependency", "quality.parse_status")
