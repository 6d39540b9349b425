"""Queries over whole runs, their configurations and messages, and over exam sources. SQL beside each."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.operators import conform, runs, validate
from gleanery.operators import evaluation as E
from gleanery.operators import ingest as I
from gleanery.plans.ingest_queries import LAST, LINE_SQL
from gleanery.plans.record_queries import LATEST
from gleanery.plans.views import LOG_SQL, RECORD_SQL, RES_SQL, crawl_log, flat, records, results, with_q
from gleanery.schema import LETTERS
from gleanery.sources.files import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def register(fn):
        QUERIES[fn.__name__] = fn
        ORACLE[fn.__name__] = sql
        return fn

    return register


#: The items with labels, modules and pictures.
ITEM_SQL = RES_SQL + """,
it AS (SELECT question_id, ability AS ai_primary_ability, CASE WHEN question_id % 7 = 0 THEN 'TIME' ELSE '' END AS primary_ability, image, CASE WHEN question_id % 3 = 0 THEN '' ELSE 'm' || CAST(question_id % 3 AS VARCHAR) END AS knowledge_module FROM items)
"""


def _items(items):
    i = F.col("question_id")
    return items.select(
        i, F.col("ability").alias("ai_primary_ability"), F.when(i % 7 == 0, "TIME").otherwise("").alias("primary_ability"), F.when(F.col("image"), F.array(F.lit("images/a.png"))).otherwise(F.array().cast("array<string>")).alias("image_paths"),
        F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("m"), (i % 3).cast("string"))).alias("knowledge_module"),
    )


@query("WITH " + ITEM_SQL + """,
g AS (SELECT question_id, 'all' AS grouping, '' AS value FROM it UNION ALL SELECT question_id, 'ability', CASE primary_ability WHEN '' THEN ai_primary_ability ELSE primary_ability END FROM it
  UNION ALL SELECT question_id, 'modality', CASE WHEN image THEN 'image' ELSE 'text' END FROM it UNION ALL SELECT question_id, 'module', CASE knowledge_module WHEN '' THEN '未标注' ELSE knowledge_module END FROM it),
planned AS (SELECT grouping, value, count(*) AS planned FROM g GROUP BY ALL),
got AS (SELECT model, grouping, value, mode, count(*) AS attempted, count(*) FILTER (status = 'correct') AS correct, count(*) FILTER (status = 'incorrect') AS incorrect, count(*) FILTER (status = 'format_error') AS format_error, count(*) FILTER (status = 'api_error') AS api_error
  FROM res JOIN g USING (question_id) GROUP BY ALL),
two AS (SELECT model, grouping, value, question_id, max(status) FILTER (mode = 'direct') AS d, max(status) FILTER (mode = 'cot') AS c FROM res JOIN g USING (question_id) GROUP BY ALL HAVING d IS NOT NULL AND c IS NOT NULL),
paired AS (SELECT model, grouping, value, count(*) AS pairs, count(*) FILTER (c = 'correct' AND d <> 'correct') AS improved, count(*) FILTER (d = 'correct' AND c <> 'correct') AS degraded FROM two GROUP BY ALL)
SELECT model, grouping, value, mode, planned, coalesce(attempted, 0) AS attempted, planned - coalesce(attempted, 0) AS pending, coalesce(correct, 0) AS correct, coalesce(incorrect, 0) AS incorrect, coalesce(format_error, 0) AS format_error, coalesce(api_error, 0) AS api_error,
  round(correct / attempted, 6) AS accuracy_over_attempted, coalesce(pairs, 0) AS pairs, coalesce(improved, 0) AS improved, coalesce(degraded, 0) AS degraded, round((improved - degraded) / pairs, 6) AS delta
FROM (SELECT * FROM (SELECT DISTINCT model FROM res), (SELECT unnest(['direct', 'cot']) AS mode), planned) x LEFT JOIN got USING (model, grouping, value, mode) LEFT JOIN paired USING (model, grouping, value)
""")
def group_summary(spark, d):
    res, items = results(spark, d)
    out = runs.group_summary(_items(items), res).withColumns({c: F.round(c, 6) for c in ("accuracy_over_attempted", "delta")})
    return out.select("model", "grouping", "value", "mode", "planned", "attempted", "pending", "correct", "incorrect", "format_error", "api_error", "accuracy_over_attempted", "pairs", "improved", "degraded", "delta")


@query("WITH " + RES_SQL + """
SELECT model, count(*) AS responses, count(*) FILTER (mode = 'direct') = any_value(k) AND count(*) FILTER (mode = 'cot') = any_value(k) AS complete, CAST(sum(CASE WHEN event_id % 9 > 0 THEN event_id % 100 ELSE 0 END) AS BIGINT) AS prompt_tokens,
  CAST(sum(event_id % 10) AS BIGINT) AS completion_tokens, CAST(sum(event_id % 110) AS BIGINT) AS total_tokens, coalesce(string_agg(DISTINCT CASE event_id % 4 WHEN 0 THEN NULL ELSE 'r' || CAST(event_id % 4 AS VARCHAR) END, ',' ORDER BY CASE event_id % 4 WHEN 0 THEN NULL ELSE 'r' || CAST(event_id % 4 AS VARCHAR) END), '') AS response_models,
  count(*) FILTER (event_id % 5 = 0) AS native_reasoning_responses FROM res, n GROUP BY model
""")
def run_report(spark, d):
    res, items = results(spark, d)
    e = F.col("event_id")
    usage = F.struct(F.when(e % 9 > 0, e % 100).alias("prompt_tokens"), (e % 10).alias("completion_tokens"), (e % 110).alias("total_tokens"))
    rows = res.withColumns({"usage": usage, "response_model": F.when(e % 4 == 0, "").otherwise(F.concat(F.lit("r"), (e % 4).cast("string"))), "native_reasoning_present": F.when(e % 5 == 0, True)})
    return runs.run_report(rows, items.count())


@query("WITH " + RES_SQL + """,
m AS (SELECT CASE question_id % 3 WHEN 0 THEN 'unknown' ELSE 'k' || CAST(question_id % 3 AS VARCHAR) END AS k, CASE question_id % 2 WHEN 0 THEN 'unknown' ELSE 'a' END AS a, CASE WHEN question_id % 5 = 0 THEN 'human_reviewed' ELSE 'pending' END AS s FROM items)
SELECT 'label_status' AS metric, s AS key, count(*) AS n FROM m GROUP BY 2 UNION ALL SELECT 'knowledge_module_methods', k, count(*) FROM m GROUP BY 2 UNION ALL SELECT 'ability_methods', a, count(*) FROM m GROUP BY 2
UNION ALL SELECT 'knowledge_module_review_statuses', 'unknown', count(*) FROM m
""")
def label_provenance(spark, d):
    i = F.col("question_id")
    items = results(spark, d)[1].select(
        i, F.when(i % 3 > 0, F.concat(F.lit("k"), (i % 3).cast("string"))).alias("knowledge_module_method"), F.when(i % 2 == 1, "a").alias("ability_label_method"), F.lit(None).cast("string").alias("knowledge_module_review_status"),
        F.when(i % 5 == 0, "human_reviewed").when(i % 5 == 1, "ai").alias("label_review_status"),
    )
    return runs.label_provenance(items)


@query("WITH " + RES_SQL + """
SELECT question_id, mode, model, CASE event_id % 5 WHEN 0 THEN 'api_error' WHEN 1 THEN 'truncated' WHEN 2 THEN 'refused' WHEN 3 THEN CASE WHEN mode = 'cot' THEN 'format_error' WHEN question_id % 4 = 1 THEN 'correct' ELSE 'incorrect' END ELSE CASE WHEN mode = 'direct' THEN 'format_error' WHEN question_id % 4 = 2 THEN 'correct' ELSE 'incorrect' END END AS status,
  CASE WHEN event_id % 5 = 3 AND mode = 'direct' THEN 'B' WHEN event_id % 5 = 4 AND mode = 'cot' THEN 'C' END AS prediction FROM res
""")
def rescored_results(spark, d):
    """Responses scored anew: none, cut off, refused, one line and two lines."""
    res, items = results(spark, d)
    e = F.col("event_id") % 5
    raw = F.struct(F.when(e == 1, "length").otherwise("stop").alias("finish_reason"), F.when(e == 2, "no").alias("refusal"), F.when(e == 4, "思考\n答案：C").otherwise("答案: b").alias("content"))
    rows = res.select("question_id", "mode", "model", F.when(e != 0, raw).alias("raw"))
    return runs.rescored(rows, items.select("question_id", F.element_at(F.array(*map(F.lit, LETTERS)), (F.col("question_id") % 4 + 1).cast("int")).alias("answer")))


@query("""
WITH c AS (SELECT event_id, [NULL, 400, 401, 404, 408, 425, 429, 500, 503, 504, 422, NULL][CAST(event_id % 12 + 1 AS BIGINT)] AS status, CASE WHEN event_id % 12 = 11 THEN '' WHEN event_id % 12 = 0 THEN 'connection_or_timeout' ELSE 'http' END AS error,
  [NULL, 5, 90][CAST(event_id % 3 + 1 AS BIGINT)] AS after, CAST(event_id // 12 % 4 AS INTEGER) AS attempt FROM events),
f AS (SELECT *, coalesce(status IN (408, 429, 500, 502, 503, 504), false) OR error = 'connection_or_timeout' AS retryable, coalesce(after, CAST(pow(2, attempt) AS INTEGER)) AS w FROM c)
SELECT event_id, retryable, retryable AND attempt < 2 AND w <= 60 AS again, CASE WHEN retryable AND attempt < 2 AND w <= 60 THEN w END AS wait, coalesce(status IN (400, 401, 402, 403, 404, 422), false) OR (error <> '' AND coalesce(after, 0) > 60) AS stop,
  CASE WHEN status BETWEEN 200 AND 299 THEN 'success' WHEN status IN (408, 425, 429, 500, 502, 503, 504) THEN 'retry' ELSE 'failed' END AS crawl FROM f
""")
def call_outcomes(spark, d):
    e = F.col("event_id")
    of = lambda values, i: F.element_at(F.array(*(F.lit(v).cast("int") for v in values)), (i + 1).cast("int"))
    rows = table(spark, f"{d}/events.parquet").select(
        "event_id", of([None, 400, 401, 404, 408, 425, 429, 500, 503, 504, 422, None], e % 12).alias("status"), F.when(e % 12 == 11, "").when(e % 12 == 0, "connection_or_timeout").otherwise("http").alias("error"),
        of([None, 5, 90], e % 3).alias("after"), (F.floor(e / 12) % 4).cast("int").alias("attempt"),
    )
    out = runs.call_outcome(F.col("status"), F.col("error"), F.col("after"), F.col("attempt"))
    return rows.select("event_id", out.alias("o"), I.crawl_outcome(F.col("status")).alias("crawl")).select("event_id", "o.*", "crawl")


ENDPOINTS = ["https://a.example/v1/chat/completions", "https://a.example/v1/chat/completions/", "http://a.example/chat/completions", "http://127.0.0.1:8000/chat/completions", "https://u:p@a.example/chat/completions", "https://a.example/chat/completions?x=1", "https://a.example/chat", "no url"]


@query(f"""
WITH c AS (SELECT event_id, CAST(event_id % {len(ENDPOINTS)} AS INTEGER) AS e, CAST(event_id // {len(ENDPOINTS)} % 7 AS INTEGER) AS k FROM events)
SELECT event_id, array_to_string(list_filter([CASE WHEN e IN (2, 4, 5, 6, 7) THEN 'endpoint' END, CASE WHEN k = 1 THEN 'model' END, CASE WHEN k = 2 THEN 'api_key_env' END, CASE WHEN k = 3 THEN 'parameters' END,
  CASE WHEN k = 4 THEN 'max_tokens' END, CASE WHEN k = 5 THEN 'two lengths' END, CASE WHEN k = 6 THEN 'timing' END], lambda x: x IS NOT NULL), ',') AS problems FROM c
""")
def config_problems(spark, d):
    e, k = F.col("event_id") % len(ENDPOINTS), F.floor(F.col("event_id") / len(ENDPOINTS)) % 7
    parameters = F.when(k == 3, F.create_map(F.lit("stream"), F.lit("true"))).when(k == 4, F.create_map(F.lit("max_tokens"), F.lit("0"))).when(k == 5, F.create_map(F.lit("max_tokens"), F.lit("9"), F.lit("max_completion_tokens"), F.lit("9"))).otherwise(F.create_map(F.lit("temperature"), F.lit("0")))
    rows = table(spark, f"{d}/events.parquet").select(
        "event_id", F.element_at(F.array(*map(F.lit, ENDPOINTS)), (e + 1).cast("int")).alias("endpoint"), F.when(k == 1, "REPLACE_ME").otherwise("m").alias("model"), F.when(k == 2, "9x").alias("api_key_env"), parameters.alias("parameters"),
        F.when(k == 6, 0.0).otherwise(60.0).alias("timeout_seconds"), F.lit(0.5).alias("min_interval_seconds"), F.lit(2).alias("retries"),
    )
    return rows.select("event_id", F.array_join(runs.config_problems(), ",").alias("problems"))


@query("WITH " + RES_SQL + """,
told AS (SELECT e.user_id, r.* FROM res r JOIN events e USING (event_id)),
runs AS (SELECT 'r' || CAST(user_id AS VARCHAR) AS run, user_id, arg_min(model, event_id) AS model, count(DISTINCT mode) AS modes, bool_or(status = 'api_error') AS failed, arg_max(status, event_id) AS last FROM told GROUP BY user_id),
ids AS (SELECT user_id, question_id, count(*) AS n FROM told WHERE status = 'correct' GROUP BY ALL),
checked AS (SELECT r.*, coalesce(i.most, 2) AS most, count(*) OVER (PARTITION BY model) AS runs FROM runs r LEFT JOIN (SELECT user_id, max(n) AS most FROM ids GROUP BY user_id) i USING (user_id))
SELECT run, unnest(list_filter([CASE WHEN last = 'format_error' THEN 'dataset' END, CASE WHEN modes < 2 THEN 'modes' END, CASE WHEN most > 1 THEN 'question_ids' END, CASE WHEN failed THEN 'prompts' END, CASE WHEN runs > 1 THEN 'repeated model' END], lambda x: x IS NOT NULL)) AS problem FROM checked
""")
def manifest_problems(spark, d):
    """A manifest for each user's log of results: the questions it got right (twice, or none, is a problem), the modes that it has,
    a data set that its last result names, a prompt that errors changed, and the model it began with."""
    res, items = results(spark, d)
    told = res.join(table(spark, f"{d}/events.parquet").select("event_id", "user_id"), "event_id")
    seen = F.array_sort(F.collect_set("mode"), lambda a, b: F.when(a == "direct", -1).when(b == "direct", 1).otherwise(0))
    rows = told.groupBy("user_id").agg(
        F.when(F.max_by("status", "event_id") == "format_error", "other").otherwise("h").alias("dataset_sha256"), F.collect_list(F.when(F.col("status") == "correct", F.col("question_id"))).alias("question_ids"), seen.alias("modes"),
        F.create_map(F.lit("direct"), F.lit("p1"), F.lit("cot"), F.when(F.bool_or(F.col("status") == "api_error"), "other").otherwise("p2")).alias("prompts"), F.min_by("model", "event_id").alias("model"),
    )
    rows = rows.select(F.concat(F.lit("r"), F.col("user_id").cast("string")).alias("run"), "dataset_sha256", "question_ids", "modes", F.lit("https://x").alias("endpoint"), "model", F.lit("{}").alias("parameters"), "prompts")
    return runs.manifest_problems(rows, items, "h", {"direct": "p1", "cot": "p2"})


@query(with_q("""
SELECT id, CASE WHEN shared_material <> '' THEN '材料：' || chr(10) || shared_material || chr(10) || chr(10) ELSE '' END || '题目：' || chr(10) || question || chr(10) || chr(10) || 'A. ' || A || chr(10) || 'B. ' || B || chr(10) || 'C. ' || C || chr(10) || 'D. ' || D AS said,
  CASE WHEN id % 3 = 0 THEN 'images/' || CAST(id AS VARCHAR) || '.png@' || sha256(A) ELSE '' END AS images FROM q
"""))
def prompt_messages(spark, d):
    q = flat(spark, d)
    picture = F.col("id") % 3 == 0
    one = lambda c: F.when(picture, F.array(c)).otherwise(F.array().cast("array<string>"))
    item = F.struct("shared_material", "question", F.struct(*LETTERS).alias("options"), one(F.concat(F.lit("images/"), F.col("id").cast("string"), F.lit(".png"))).alias("image_paths"), one(F.sha2("A", 256)).alias("image_sha256"))
    said = q.select("id", runs.messages(F.lit("be brief"), item)[1].alias("m"))
    return said.select("id", F.col("m.text").alias("said"), F.array_join(F.transform("m.images", lambda x: F.concat(x["path"], F.lit("@"), x["sha256"])), ",").alias("images"))


@query("""
SELECT doc_id AS question_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'data:image/' || CASE WHEN doc_id % 2 = 0 THEN 'png' ELSE 'jpeg' END || ';base64,' || base64(encode(text)) END AS url, doc_id % 4 = 0 AS missing FROM documents
""")
def image_payloads(spark, d):
    docs = table(spark, f"{d}/documents.parquet").select("doc_id", "text")
    i, content = F.col("doc_id"), F.col("text").cast("binary")
    path = F.concat(F.lit("images/"), i.cast("string"), F.when(i % 2 == 0, ".png").otherwise(".jpg"))
    refs = docs.select(i.alias("question_id"), F.lit(0).alias("place"), path.alias("path"), F.sha2(content, 256).alias("sha256"))
    files = docs.select(path.alias("path"), F.when(i % 4 == 0, F.lit(b"other")).otherwise(content).alias("content"))
    return runs.encoded_images(refs, files, "m").select("question_id", "url", "missing")


@query(with_q("""
SELECT 'CHIS_' || lpad(CAST(id AS VARCHAR), 10, '0') AS question_id, '' AS group_id, '0.1.0' AS schema_version, 1 AS record_version, json_object('A', A, 'B', '', 'C', '', 'D', '')::VARCHAR AS options, '[]' AS image_paths,
  json_object('source_id', source, 'site_name', '', 'url', '', 'paper_title', '', 'year', NULL, 'province', '', 'exam_type', '', 'page_number', NULL, 'retrieved_at', '')::VARCHAR AS source,
  json_object('answer_status', 'unchecked', 'duplicate_status', 'unchecked', 'parse_status', 'pending', 'review_status', CASE WHEN id % 2 = 0 THEN 'approved' ELSE 'pending' END, 'image_dependency', 'unknown', 'issues', json('[]'), 'collector', '', 'reviewer', '', 'notes', '')::VARCHAR AS quality FROM q
"""))
def built_records(spark, d):
    """Whole records from an id, one option, the source's id and, for half of them, a review status."""
    i = F.col("id")
    parts = flat(spark, d).select(
        F.concat(F.lit("CHIS_"), F.lpad(i.cast("string"), 10, "0")).alias("question_id"), F.struct("A").alias("options"), F.struct(F.col("source").alias("source_id")).alias("source"),
        F.when(i % 2 == 0, F.struct(F.lit("approved").alias("review_status"))).alias("quality"),
    )
    out = conform.build_records(parts)
    return out.select("question_id", "group_id", "schema_version", "record_version", *(T.json(F.col(c)).alias(c) for c in ("options", "image_paths", "source", "quality")))


@query(with_q("""
SELECT id, path FROM (SELECT id, unnest(list_filter([CASE WHEN id >= 1000000 THEN 'question_id' END, CASE id % 6 WHEN 0 THEN 'answer' WHEN 1 THEN 'quality.parse_status' WHEN 2 THEN 'question' WHEN 3 THEN 'provenance.ocr_confidence' WHEN 4 THEN 'group_id' END], lambda x: x IS NOT NULL)) AS path FROM r)
""", RECORD_SQL))
def format_violations(spark, d):
    r, i = records(spark, d), F.col("_ord")
    k = i % 6
    r = r.withColumns({
        "question_id": F.concat(F.lit("CHIS_"), F.when(i < 1_000_000, F.lpad(i.cast("string"), 6, "0")).otherwise(i.cast("string"))), "answer": F.when(k == 0, "E").otherwise("A"), "question": F.when(k != 2, F.col("question")),
        "quality": F.col("quality").withField("parse_status", F.when(k == 1, "x").otherwise("valid")), "provenance": F.col("provenance").withField("ocr_confidence", F.when(k == 3, 1.5)), "group_id": F.when(k == 4, "G").otherwise("GROUP_1"),
        "answer_evidence": F.slice("answer_evidence", 1, 0),
    })
    ids = F.regexp_replace("question_id", "CHIS_0*(?=.)", "").cast("long")
    return conform.nonconforming(r).select(ids.alias("id"), "path")


@query(with_q("SELECT 'total' AS metric, '' AS key, count(*) AS now, CAST(0 AS BIGINT) AS then FROM q UNION ALL SELECT 'gone', 'x', NULL, 1"))
def stale_summary(spark, d):
    fresh = validate.validation_summary(validate.validate_records(records(spark, d), LATEST))
    published = fresh.withColumn("n", F.when(F.col("metric") == "total", F.lit(0).cast("long")).otherwise(F.col("n"))).unionByName(spark.range(1).select(F.lit("gone").alias("metric"), F.lit("x").alias("key"), F.lit(1).cast("long").alias("n")))
    return conform.stale_report(fresh, published)


STEM = r"regexp_replace(regexp_replace({0}, '^\d+[.、．\s]*(（[^）]+）|\([^)]+\))?\s*', ''), '^\s+|\s+$', '', 'g')"
OPTION = r"regexp_replace(regexp_replace({0}, '^\(?([A-D])\)?[.、．\s]*', ''), '^\s+|\s+$', '', 'g')"
TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


@query(with_q(rf"""
SELECT 'CHIS_' || lpad(CAST(id AS VARCHAR), 6, '0') AS question_id, 'GROUP_AGIEVAL_' || CAST(year AS VARCHAR) || '_' || lpad(CAST(id AS VARCHAR), 4, '0') AS group_id, {STEM.format("'12．（4分）' || question")} AS question, {OPTION.format("'(A)' || A")} AS a, {OPTION.format("'(D) ' || D")} AS d,
  CASE WHEN id % 6 = 1 THEN 'C' ELSE 'A' END AS answer, year, CASE id % 4 WHEN 0 THEN '江苏' WHEN 2 THEN '北京' ELSE '全国' END AS province, shared_material FROM (SELECT *, [2015, 2018, 1998, 2018][CAST(id % 4 + 1 AS BIGINT)] AS year FROM q WHERE id % 6 NOT IN (0, 2))
"""))
def agieval_items(spark, d):
    """Lines of JSON: some with three options or without a letter, which are left out, some with the letter under another name."""
    i = F.col("id")
    options = F.array(*(F.concat(F.lit("(A)" if x == "A" else f"({x}) "), F.col(x)) for x in LETTERS))
    line = F.struct(
        F.concat(F.lit("12．（4分）"), F.col("question")).alias("question"), F.col("shared_material").alias("passage"), F.when(i % 6 == 0, F.slice(options, 1, 3)).otherwise(options).alias("options"), F.when(i % 6 == 1, "").when(i % 6 == 2, "E").otherwise("A").alias("label"), F.lit("C").alias("answer"),
        F.struct(F.when(i % 4 == 0, "2015年江苏卷").when(i % 4 == 2, "北京卷1998").when(i % 4 == 3, "x").alias("source")).alias("other"),
    )
    out = I.get_adapter("agieval_adapter")(flat(spark, d).select(i.alias("idx"), F.to_json(line).alias("json")))
    return out.select("question_id", "group_id", "question", F.col("options.A").alias("a"), F.col("options.D").alias("d"), "answer", "year", "province", "shared_material")


def _gaokao_items(spark, d):
    q = flat(spark, d)
    line = F.concat(F.lit("1. "), F.col("question"), F.lit("\nA. "), F.col("A"), F.lit(" B、"), F.col("B"), F.lit("\nC．"), F.col("C"), F.lit("  D. "), F.col("D"))
    answers = F.when(F.col("answer") == "", F.array().cast("array<string>")).otherwise(F.array("answer", F.lit("x")))
    year = F.when(F.col("id") % 2 == 0, "2013").otherwise("x")
    pictures = F.when(F.col("id") % 3 == 0, F.array(F.lit("p/q.png"))).otherwise(F.array().cast("array<string>"))
    return q.select(F.col("id").alias("idx"), line.alias("question"), answers.alias("answer"), year.alias("year"), F.lit(" why ").alias("analysis"), pictures.alias("picture"))


GAOKAO_SQL = "WITH " + LINE_SQL.replace("regexp_replace(question ||", "regexp_replace('1. ' || question ||") + rf"""
SELECT 'CHIS_' || lpad(CAST(id AS VARCHAR), 6, '0') AS question_id, 'GROUP_{{group}}_' || CAST(year AS VARCHAR) || '_' || lpad(CAST(id AS VARCHAR), 4, '0') AS group_id, {STEM.format(TRIM.format("stem"))} AS question, {LAST.format("B")} AS b, {LAST.format("C")} AS c, q.answer, year,
  CAST(year AS VARCHAR) || '年普通高等学校招生全国统一考试历史真题{{suffix}}' AS paper_title, 'why' AS answer_explanation, {{images}} AS images FROM piece JOIN (SELECT id, answer, CASE id % 2 WHEN 0 THEN 2013 ELSE 2022 END AS year FROM q) q USING (id) WHERE q.answer <> '' AND {TRIM.format("stem")} <> ''
"""
GAOKAO = ("question_id", "group_id", "question", "b", "c", "answer", "year", "paper_title", "answer_explanation", "images")


def _gaokao(out):
    return out.withColumns({"b": F.col("options.B"), "c": F.col("options.C"), "images": F.array_join("image_paths", ",")}).select(*GAOKAO)


@query(GAOKAO_SQL.format(group="GAOKAOBENCH", suffix="", images="''"))
def gaokao_bench_items(spark, d):
    return _gaokao(I.get_adapter("gaokao_bench_adapter")(_gaokao_items(spark, d).drop("picture")))


@query(GAOKAO_SQL.format(group="GAOKAOMM", suffix="（图文版）", images="CASE WHEN id % 3 = 0 THEN 'assets/q.png' ELSE '' END"))
def gaokao_mm_items(spark, d):
    return _gaokao(I.get_adapter("gaokao_mm_adapter")(_gaokao_items(spark, d)))


@query("WITH " + LINE_SQL.replace("regexp_replace(question ||", "regexp_replace('1. ' || question ||") + rf""",
z AS (SELECT id, {STEM.format(TRIM.format("stem"))} AS question, {LAST.format("A")} AS a, {LAST.format("B")} AS b, {LAST.format("C")} AS c, {LAST.format("D")} AS d FROM piece)
SELECT 'CHIS_' || lpad(CAST((77000000 + id) % 1000000 AS VARCHAR), 6, '0') AS question_id, question, a, d, CASE id % 3 WHEN 0 THEN 2019 WHEN 1 THEN 2021 END AS year, CASE id % 3 WHEN 0 THEN '湖南' ELSE '全国' END AS province,
  CASE WHEN id % 2 = 0 THEN 'assets/zujuan_' || CAST(77000000 + id AS VARCHAR) || '_a.png' ELSE '' END AS images FROM z WHERE length(question) > 5 AND a <> '' AND b <> '' AND c <> '' AND d <> ''
""")
def zujuan_items(spark, d):
    i = F.col("id")
    line = F.concat(F.lit("1. "), F.col("question"), F.lit("\nA. "), F.col("A"), F.lit(" B、"), F.col("B"), F.lit("\nC．"), F.col("C"), F.lit("  D. "), F.col("D"))
    title = F.when(i % 3 == 0, "2019年湖南试卷-组卷网x").otherwise("月考卷-组卷网")
    info = F.when(i % 3 == 1, "2021年全国高考真题").otherwise("")
    blocks = flat(spark, d).select(i.alias("idx"), title.alias("title"), line.alias("text"), F.concat(F.lit("q"), (i + 77_000_000).cast("string")).alias("div_id"), info.alias("info"), F.when(i % 2 == 0, F.array(F.lit("https://h/a.png?x"), F.lit("/local.png"))).alias("images"))
    return I.get_adapter("zujuan_adapter")(blocks).select("question_id", "question", F.col("options.A").alias("a"), F.col("options.D").alias("d"), "year", "province", F.array_join("image_paths", ",").alias("images"))


@query(with_q("""
SELECT CASE WHEN id % 8 = 0 THEN '' WHEN id % 8 = 1 THEN 'twice' ELSE CAST(id AS VARCHAR) END AS question_id, CASE id % 8 WHEN 0 THEN 'id' WHEN 1 THEN 'duplicate' WHEN 2 THEN 'stem' WHEN 3 THEN 'options' ELSE 'answer' END AS reason FROM q WHERE id % 8 < 5
"""))
def unusable_items(spark, d):
    i = F.col("id") % 8
    rows = flat(spark, d).select(
        F.when(i == 0, "").when(i == 1, "twice").otherwise(F.col("id").cast("string")).alias("question_id"), F.when(i == 2, "　 ").otherwise("x").alias("question"), F.struct(F.when(i == 3, " ").otherwise("a").alias("A"), *(F.lit("x").alias(x) for x in "BCD")).alias("options"),
        F.when(i == 4, "e").when(i == 5, F.lit(None)).otherwise("A").alias("answer"),
    )
    return E.invalid_items(rows)


@query("SELECT doc_id, doc_id % 6 IN (0, 5) AS images_ok, doc_id % 3 = 0 AS answer_image FROM documents")
def image_checks(spark, d):
    """References that pair up and are well formed, and blobs that are pictures of some size."""
    i = F.col("doc_id") % 6
    good = F.sha2("text", 256)
    paths = F.when(i == 1, F.array(F.lit("images/../a.png"))).when(i == 2, F.array(F.lit("images/a.gif"))).when(i >= 4, F.array().cast("array<string>")).otherwise(F.array(F.lit("images/a-1.jpeg")))
    hashes = F.when(i == 3, F.array(F.lit("xyz"))).when(i >= 4, F.array().cast("array<string>")).otherwise(F.array(good))
    blob = F.concat(F.unhex(F.when(F.col("doc_id") % 3 == 1, "00").otherwise("89504E470D0A1A0A")), F.rpad(F.lit("x"), F.when(F.col("doc_id") % 3 == 2, 100).otherwise(20_000), F.lit("x")).cast("binary"))
    rows = table(spark, f"{d}/documents.parquet").select("doc_id", paths.alias("image_paths"), hashes.alias("image_sha256"), (i == 4).alias("has_image"), blob.alias("blob"))
    return E.image_references(rows).select("doc_id", "images_ok", I.is_answer_image(F.col("blob")).alias("answer_image"))


@query("""
SELECT CAST(page_id % 70 AS VARCHAR) AS pid, min(page_id) AS first_page FROM pages GROUP BY 1
""")
def listed_papers(spark, d):
    html = F.concat("html", F.lit('<a href="/17p'), (F.col("page_id") % 70).cast("string"), F.lit('.html">x</a> <a href="/18p1.html">'))
    return I.paper_links(table(spark, f"{d}/pages.parquet").select(F.col("page_id").alias("page_no"), html.alias("html")))


@query("""
WITH b AS (SELECT page_id, unnest([0, 1, 2]) AS block FROM pages), g AS (SELECT *, block // 2 AS g FROM b)
SELECT page_id, block, 'CHIS_' || lpad(CAST(row_number() OVER (ORDER BY page_id, block) AS VARCHAR), 6, '0') AS question_id, 'GROUP_' || lpad(CAST(dense_rank() OVER (ORDER BY page_id, g) AS VARCHAR), 6, '0') AS group_id,
  CASE block WHEN 0 THEN 'A' ELSE '' END AS answer, CASE block WHEN 0 THEN 'single_source' ELSE 'missing' END AS answer_status, block = 1 AS has_image FROM g
""")
def numbered_blocks(spark, d):
    """Two groups of a page with two blocks and one: ids count over all pages."""
    inside = '<section class="g"><article><p class="q">a</p><b class="k">答案：A</b></article><article><p class="q">b<img src="x.png"></p></article></section><section class="g"><article><p class="q">c</p></article></section>'
    pages = table(spark, f"{d}/pages.parquet").select("page_id", F.concat("html", F.lit(inside)).alias("html"))
    blocks = I.parse_pages(pages, I.Selectors(group="section.g", block="article", question=".q", option="li.option", answer=".k"))
    out = I.page_records(blocks, ["page_id"])
    return out.select("page_id", F.col("block").cast("int").alias("block"), "question_id", "group_id", "answer", "answer_status", "has_image")


@query("WITH " + LOG_SQL + """
SELECT 'u' || CAST(user_id AS VARCHAR) AS url, count(*) FILTER (event_type NOT IN ('purchase', 'signup', 'error')) + CASE WHEN arg_min(event_type, event_id) IN ('purchase', 'signup', 'error') THEN 1 ELSE 0 END AS attempts, arg_max(event_type, event_id) IN ('purchase', 'signup') AS succeeded FROM events WHERE user_id = 4 GROUP BY 1
""")
def state_lookup(spark, d):
    return I.get_state(I.fold_state(crawl_log(spark, d)), "s1", "u4").select("url", "attempts", "succeeded")
