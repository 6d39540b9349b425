"""Views of the driver tables as records, runs, sheets and logs, once in Spark and once in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from gleanery.functions import text as T
from gleanery.schema import CRAWLER_VERSION, LETTERS, RECORD, SCHEMA_VERSION
from gleanery.sources.files import table


EXACT, SWAPPED = 1_000_000_000, 2_000_000_000

#: Flat questions: every whole document as stem and, at '. ', as options (the last has all that is left), an exact clone of each fiftieth, and one with options A and B swapped of others.
Q_SQL = f"""
lab AS (SELECT doc_id, min(quality) AS quality, min(toxic) AS toxic FROM labels GROUP BY doc_id),
base AS (
  SELECT d.doc_id AS id, d.text AS question,
    split_part(d.text, '. ', 1) AS A, split_part(d.text, '. ', 2) AS B, split_part(d.text, '. ', 3) AS C, array_to_string(string_split(d.text, '. ')[4:], '. ') AS D,
    CASE d.doc_id % 5 WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'C' WHEN 4 THEN 'D' ELSE '' END AS answer,
    CASE WHEN d.doc_id % 20 = 0 THEN 'm' ELSE '' END AS shared_material, d.doc_id AS origin, d.source, d.lang, l.quality, l.toxic
  FROM documents d LEFT JOIN lab l ON d.doc_id = l.doc_id),
q AS (
  SELECT * FROM base
  UNION ALL SELECT id + {EXACT}, question, A, B, C, D, answer, shared_material, origin, source, lang, quality, toxic FROM base WHERE id % 50 = 0
  UNION ALL SELECT id + {SWAPPED}, question, B, A, C, D, CASE answer WHEN 'A' THEN 'B' WHEN 'B' THEN 'A' ELSE answer END, shared_material, origin, source, lang, quality, toxic FROM base WHERE id % 50 = 1)
"""


def with_q(sql: str, *more: str) -> str:
    return "WITH " + ",\n".join([Q_SQL, *more]) + "\n" + sql


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, f"{sf_dir}/documents.parquet"), table(spark, f"{sf_dir}/labels.parquet")
    lab = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("toxic").alias("toxic"))
    part = lambda i: F.split_part("text", F.lit(". "), F.lit(i))
    pieces = F.split("text", r"\. ")
    rest = F.array_join(F.slice(pieces, F.lit(4), F.greatest(F.size(pieces) - 3, F.lit(0))), ". ")
    m = F.col("doc_id") % 5
    base = docs.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("id"), F.col("text").alias("question"), *(part(i).alias(x) for i, x in enumerate("ABC", 1)), rest.alias("D"),
        F.when(m == 1, "A").when(m == 2, "B").when(m == 3, "C").when(m == 4, "D").otherwise("").alias("answer"),
        F.when(F.col("doc_id") % 20 == 0, "m").otherwise("").alias("shared_material"), F.col("doc_id").alias("origin"), "source", "lang", "quality", "toxic",
    )
    exact = base.filter("id % 50 = 0").withColumn("id", F.col("id") + EXACT)
    swapped = base.filter("id % 50 = 1").withColumn("id", F.col("id") + SWAPPED).withColumns({"A": F.col("B"), "B": F.col("A"), "answer": F.when(F.col("answer") == "A", "B").when(F.col("answer") == "B", "A").otherwise(F.col("answer"))})
    return base.unionByName(exact).unionByName(swapped)


#: The record fields that queries read, as SQL over q.
RECORD_SQL = """
r AS (
  SELECT id, 'CHIS_' || lpad(CAST(id AS VARCHAR), 10, '0') AS question_id, 'GROUP_' || CAST(origin // 3 AS VARCHAR) AS group_id, question, A, B, C, D, answer, shared_material,
    source AS source_id, CASE WHEN origin % 7 = 0 THEN NULL ELSE CAST(1890 + origin % 150 AS INTEGER) END AS year, origin % 4 = 0 AS has_image,
    CASE WHEN origin % 9 = 0 THEN 'ftp://x/' || CAST(origin AS VARCHAR) ELSE 'https://site.example/' || CAST(origin AS VARCHAR) END AS url,
    quality = 1 AS official, toxic = 0 AS reliable, quality IS NOT NULL AS told,
    CASE lang WHEN 'en' THEN 'allowed' WHEN 'de' THEN 'research_only' WHEN 'fr' THEN 'restricted' ELSE 'unknown' END AS license_status,
    CASE origin % 6 WHEN 0 THEN 'approved' WHEN 1 THEN 'rejected' WHEN 2 THEN 'needs_revision' ELSE 'pending' END AS review_status,
    CASE WHEN origin % 11 = 0 THEN 0.5 WHEN origin % 11 = 1 THEN 0.9 END AS ocr_confidence,
    sha256(json_object('options', json_array(A, B, C, D), 'question', question, 'shared_material', shared_material)::VARCHAR) AS ordered_hash,
    sha256(json_object('options', list_sort([A, B, C, D]), 'question', question, 'shared_material', shared_material)::VARCHAR) AS permutation_hash
  FROM q)
"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as question records with hashes and _ord."""
    q = flat(spark, sf_dir)
    origin = F.col("origin")
    text = lambda v: F.lit(v).cast("string")
    options = F.struct(*LETTERS)
    source = F.struct(
        F.col("source").alias("source_id"), text("site").alias("site_name"), F.concat(F.when(origin % 9 == 0, "ftp://x/").otherwise("https://site.example/"), origin.cast("string")).alias("url"), text("").alias("paper_title"),
        F.when(origin % 7 != 0, (1890 + origin % 150).cast("int")).alias("year"), text("").alias("province"), text("").alias("exam_type"), F.lit(None).cast("int").alias("page_number"), text("").alias("retrieved_at"),
    )
    none = lambda t: F.lit(None).cast(t)
    one = F.struct(
        F.col("source").alias("source_id"), F.col("answer"), (F.col("quality") == 1).alias("official"), (F.col("toxic") == 0).alias("reliable"), text("").alias("evidence_url"), text("").alias("raw_file"), none("int").alias("page_number"),
        text("").alias("source_question_number"), text("").alias("raw_answer"), none("string").alias("image_name"), none("string").alias("image_sha256"), none("string").alias("extraction_method"), none("boolean").alias("needs_review"),
    )
    types = {f.name: f.dataType for f in S.StructType.fromDDL(RECORD).fields}
    evidence = F.when(F.col("quality").isNotNull() & (F.col("answer") != ""), F.array(one)).otherwise(F.array()).cast(types["answer_evidence"])
    m6, m11 = origin % 6, origin % 11
    quality = F.struct(
        text("unchecked").alias("answer_status"), text("unchecked").alias("duplicate_status"), text("pending").alias("parse_status"),
        F.when(m6 == 0, "approved").when(m6 == 1, "rejected").when(m6 == 2, "needs_revision").otherwise("pending").alias("review_status"), text("unknown").alias("image_dependency"),
        F.array().alias("issues"), text("c").alias("collector"), text("").alias("reviewer"), text("").alias("notes"),
    ).cast(types["quality"])
    args = (F.col("shared_material"), F.col("question"), options)
    license_ = F.when(F.col("lang") == "en", "allowed").when(F.col("lang") == "de", "research_only").when(F.col("lang") == "fr", "restricted").otherwise("unknown")
    provenance = F.struct(
        F.concat(F.lit("raw/"), F.col("source")).alias("raw_file"), F.sha2(F.col("source"), 256).alias("content_hash"), T.ordered_hash(*args).alias("ordered_hash"), T.permutation_hash(*args).alias("permutation_hash"), text(CRAWLER_VERSION).alias("crawler_version"),
        license_.alias("license_status"), F.array().alias("normalization_changes"), F.when(m11 == 0, 0.5).when(m11 == 1, 0.9).alias("ocr_confidence"), F.col("id").cast("string").alias("source_question_number"),
    ).cast(types["provenance"])
    return q.select(
        text(SCHEMA_VERSION).alias("schema_version"), F.lit(1).alias("record_version"), F.concat(F.lit("CHIS_"), F.lpad(F.col("id").cast("string"), 10, "0")).alias("question_id"), F.concat(F.lit("GROUP_"), F.floor(origin / 3).cast("string")).alias("group_id"),
        "shared_material", F.col("question").alias("raw_question"), F.col("question").alias("normalized_question"), "question", options.alias("raw_options"), options.alias("options"), "answer", text("").alias("answer_explanation"),
        evidence.alias("answer_evidence"), (origin % 4 == 0).alias("has_image"), F.array().cast("array<string>").alias("image_paths"), source.cast(types["source"]).alias("source"), F.array().cast(types["source_records"]).alias("source_records"),
        F.struct(*(text("").alias(c) for c in ("primary_ability", "history_scope", "historical_period", "knowledge_point", "material_type"))).alias("labels"), quality.alias("quality"), provenance.alias("provenance"), F.col("id").alias("_ord"),
    )


#: Results of models on as many questions as sixteenths of the events: each pair of events is a question's two modes, and what eight
#: models leave over is a ninth's, whose other questions are pending.
RES_SQL = """
n AS (SELECT greatest(count(*) // 16, 1) AS k FROM events),
res AS (
  SELECT 'M' || CAST((event_id // 2) // k AS VARCHAR) AS model, (event_id // 2) % k AS question_id, CASE event_id % 2 WHEN 0 THEN 'direct' ELSE 'cot' END AS mode, event_id,
    CASE WHEN event_type IN ('click', 'purchase') THEN 'correct' WHEN event_type = 'view' THEN 'incorrect' WHEN event_type = 'error' THEN 'api_error' ELSE 'format_error' END AS status
  FROM events, n),
items AS (SELECT range AS question_id, ['FACT', 'TIME', 'SOURCE', 'REASON'][CAST(range % 4 + 1 AS INTEGER)] AS ability, range % 5 = 0 AS image FROM range((SELECT k FROM n)))
"""


def results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(results, items) of the view; the one number k comes from a count."""
    events = table(spark, f"{sf_dir}/events.parquet")
    k = max(events.count() // 16, 1)
    pair = F.floor(F.col("event_id") / 2)
    t = F.col("event_type")
    res = events.select(
        F.concat(F.lit("M"), F.floor(pair / k).cast("string")).alias("model"), (pair % k).alias("question_id"), F.when(F.col("event_id") % 2 == 0, "direct").otherwise("cot").alias("mode"), "event_id",
        F.when(t.isin("click", "purchase"), "correct").when(t == "view", "incorrect").when(t == "error", "api_error").otherwise("format_error").alias("status"), F.lit(True).alias("gold_ok"), F.lit("").alias("prediction"),
    )
    i = F.col("id")
    items = spark.range(k).select(i.alias("question_id"), F.element_at(F.array(*(F.lit(a) for a in ("FACT", "TIME", "SOURCE", "REASON"))), (i % 4 + 1).cast("int")).alias("ability"), (i % 5 == 0).alias("image"))
    return res, items


#: A crawl log: attempts, successes and failures by type of event.
LOG_SQL = """
log AS (
  SELECT 's' || CAST(user_id % 3 AS VARCHAR) AS source_id, 'u' || CAST(user_id AS VARCHAR) AS url, event_id AS seq, ts AS updated_at,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'success' WHEN event_type = 'error' THEN 'failure' ELSE 'attempt' END AS kind,
    'f' || CAST(event_id AS VARCHAR) AS raw_file, 'e' || CAST(event_id AS VARCHAR) AS message, CASE WHEN event_type IN ('purchase', 'signup') THEN 200 WHEN event_type = 'error' THEN 500 + event_id % 5 END AS http_status,
    'h' || CAST(event_id AS VARCHAR) AS content_hash, 'T' || CAST(event_id % 3 AS VARCHAR) AS error_type FROM events)
"""


def crawl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    return table(spark, f"{sf_dir}/events.parquet").select(
        F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")).alias("source_id"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"), F.col("event_id").alias("seq"), F.col("ts").alias("updated_at"),
        F.when(t.isin("purchase", "signup"), "success").when(t == "error", "failure").otherwise("attempt").alias("kind"), F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("raw_file"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("message"),
        F.when(t.isin("purchase", "signup"), 200).when(t == "error", 500 + F.col("event_id") % 5).cast("int").alias("http_status"), F.concat(F.lit("h"), F.col("event_id").cast("string")).alias("content_hash"), F.concat(F.lit("T"), (F.col("event_id") % 3).cast("string")).alias("error_type"),
    )
