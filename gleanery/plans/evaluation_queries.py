"""Queries over the evaluation view. SQL beside each."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gleanery.operators import evaluation as E
from gleanery.plans.views import RES_SQL, results
from gleanery.sources.files import shared_folder
from gleanery.sources.results import ResultTable

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = "WITH " + RES_SQL + sql
        return fn

    return register


def _rounded(df, *cols, places=6):
    return df.withColumns({c: F.round(c, places) for c in cols})


METRICS = """
, models AS (SELECT DISTINCT model FROM res), modes AS (SELECT unnest(['direct', 'cot']) AS mode),
planned AS (SELECT {by} count(*) AS planned FROM items {group}),
got AS (SELECT model, mode, {by} count(*) AS attempted, count(*) FILTER (status = 'correct') AS correct, count(*) FILTER (status = 'incorrect') AS incorrect, count(*) FILTER (status = 'api_error') AS api_error, count(*) FILTER (status = 'format_error') AS format_error
  FROM res JOIN items USING (question_id) GROUP BY model, mode {group2})
SELECT model, mode, {by} planned, coalesce(attempted, 0) AS attempted, planned - coalesce(attempted, 0) AS pending, coalesce(correct, 0) AS correct, coalesce(incorrect, 0) AS incorrect, coalesce(api_error, 0) AS api_error, coalesce(format_error, 0) AS format_error,
  round(correct / attempted, 6) AS accuracy_over_attempted, round(CASE WHEN correct + incorrect > 0 THEN correct / (correct + incorrect) END, 6) AS accuracy_valid_answers_only,
  round((p + zz / (2 * attempted) - z * sqrt(p * (1 - p) / attempted + zz / (4.0 * attempted * attempted))) / (1 + zz / attempted), 6) AS wilson_low,
  round((p + zz / (2 * attempted) + z * sqrt(p * (1 - p) / attempted + zz / (4.0 * attempted * attempted))) / (1 + zz / attempted), 6) AS wilson_high
FROM (SELECT *, CAST(correct AS DOUBLE) / attempted AS p, 1.959963984540054 AS z, 1.959963984540054 * 1.959963984540054 AS zz FROM (SELECT * FROM models, modes, planned) g LEFT JOIN got USING (model, mode {using}))
"""
COLUMNS = ["planned", "attempted", "pending", "correct", "incorrect", "api_error", "format_error", "accuracy_over_attempted", "accuracy_valid_answers_only", "wilson_low", "wilson_high"]


def _metrics(spark, d, by):
    res, items = results(spark, d)
    out = E.run_metrics(items.select("question_id", *by), res, by).select("model", "mode", *by, *COLUMNS)
    return _rounded(out, *COLUMNS[-4:])


@query(METRICS.format(by="", group="", group2="", using=""))
def status_metrics(spark, d):
    return _metrics(spark, d, [])


@query(METRICS.format(by="ability,", group="GROUP BY ability", group2=", ability", using=", ability"))
def metrics_by_ability(spark, d):
    return _metrics(spark, d, ["ability"])


@query(METRICS.format(by="image,", group="GROUP BY image", group2=", image", using=", image"))
def metrics_by_modality(spark, d):
    return _metrics(spark, d, ["image"])


PAIRS = """
, p AS (SELECT model, question_id, max(status) FILTER (mode = 'direct') AS direct, max(status) FILTER (mode = 'cot') AS cot FROM res GROUP BY 1, 2 HAVING direct IS NOT NULL AND cot IS NOT NULL)
"""


@query(PAIRS + """
SELECT model, count(*) AS paired_valid_answers, count(*) FILTER (direct = 'correct' AND cot = 'correct') AS correct_to_correct, count(*) FILTER (direct = 'correct' AND cot = 'incorrect') AS correct_to_incorrect,
  count(*) FILTER (direct = 'incorrect' AND cot = 'correct') AS incorrect_to_correct, count(*) FILTER (direct = 'incorrect' AND cot = 'incorrect') AS incorrect_to_incorrect,
  round((count(*) FILTER (direct = 'incorrect' AND cot = 'correct') - count(*) FILTER (direct = 'correct' AND cot = 'incorrect')) / count(*), 6) AS paired_cot_minus_direct
FROM p WHERE direct IN ('correct', 'incorrect') AND cot IN ('correct', 'incorrect') GROUP BY model
""")
def paired_transitions(spark, d):
    return _rounded(E.transitions(E.pairs(results(spark, d)[0])), "paired_cot_minus_direct")


STATS = """
, s AS (SELECT model, count(*) AS pairs, count(*) FILTER (cot = 'correct' AND direct <> 'correct') AS improved, count(*) FILTER (direct = 'correct' AND cot <> 'correct') AS degraded,
  count(*) FILTER (direct = 'correct' AND cot = 'correct') AS both_correct, count(*) FILTER (direct <> 'correct' AND cot <> 'correct') AS both_incorrect_or_failed FROM {source} GROUP BY model)
SELECT *, round((improved - degraded) / pairs, 6) AS delta,
  round(CASE WHEN improved + degraded = 0 THEN 1 ELSE least(1, 2 * (SELECT sum(exp(lgamma(improved + degraded + 1) - lgamma(i.range + 1) - lgamma(improved + degraded - i.range + 1) - (improved + degraded) * ln(2))) FROM range(least(improved, degraded) + 1) i)) END, 6) AS mcnemar_exact_p FROM s
"""
COMMON = """
, common AS (SELECT question_id FROM res GROUP BY 1 HAVING count(DISTINCT model || mode) = (SELECT count(DISTINCT model) * 2 FROM res)),
pc AS (SELECT p.* FROM p JOIN common USING (question_id))
"""


@query(PAIRS + STATS.format(source="p"))
def paired_stats(spark, d):
    return _rounded(E.paired_stats(E.pairs(results(spark, d)[0]), ["model"]), "delta", "mcnemar_exact_p")


@query(PAIRS + COMMON + "SELECT question_id FROM common")
def common_ids(spark, d):
    return E.common_questions(results(spark, d)[0])


@query(PAIRS + COMMON + "SELECT question_id FROM common")
def common_ids_by_bitmap(spark, d):
    return E.numbered_in_all(results(spark, d)[0])


@query(PAIRS + COMMON + STATS.format(source="pc"))
def model_comparison(spark, d):
    return _rounded(E.comparison(results(spark, d)[0]), "delta", "mcnemar_exact_p")


@query()
def bootstrap_bounds(spark, d):
    """Resamples drawn from counts are not SQL; a test holds them against the seeded ones."""
    return E.bootstrap_bounds(E.pairs(results(spark, d)[0]), ["model"])


@query("SELECT question_id, mode, max(event_id) AS event_id, arg_max(model, event_id) AS model, arg_max(status, event_id) AS status FROM res GROUP BY question_id, mode")
def results_replaced(spark, d):
    """The results of all models added one after another to a table with one row for each question and mode, two of its parts merged."""
    res = results(spark, d)[0].select("question_id", "mode", "event_id", "model", "status")
    table = ResultTable(spark, f"{shared_folder(spark)}/results-{uuid.uuid4().hex}", ["question_id", "mode"], "event_id", buckets=4)
    for odd in (1, 0, 2):  # later models first
        table.add(res.filter(F.crc32("model") % 3 == odd))
    table.compact(table.manifest()["parts"][:2])
    return table.current()


@query()
def bootstrap_ci(spark, d):
    """The draws of a seeded generator are not SQL; a test holds this against the plain loop."""
    return E.bootstrap_interval(E.pairs(results(spark, d)[0]), ["model"])


@query("""
, models AS (SELECT DISTINCT model FROM res),
p AS (SELECT model, question_id, max(status) FILTER (mode = 'direct') AS ds, max(status) FILTER (mode = 'cot') AS cs FROM res GROUP BY 1, 2)
SELECT model, question_id, coalesce(ds, 'pending') AS direct_status, coalesce(cs, 'pending') AS cot_status, ability FROM (SELECT * FROM models, items) g LEFT JOIN p USING (model, question_id) WHERE coalesce(ds, 'pending') <> 'correct' OR coalesce(cs, 'pending') <> 'correct'
""")
def error_cases(spark, d):
    res, items = results(spark, d)
    return E.error_cases(items.select("question_id", "ability"), res).select("model", "question_id", "direct_status", "cot_status", "ability")


@query("""
SELECT question_id, mode FROM items, (SELECT unnest(['direct', 'cot']) AS mode) m WHERE NOT EXISTS (SELECT 1 FROM res WHERE res.question_id = items.question_id AND res.mode = m.mode AND model = 'M0' AND status <> 'api_error')
""")
def resume_pending(spark, d):
    res, items = results(spark, d)
    planned = items.select("question_id", F.explode(F.array(F.lit("direct"), F.lit("cot"))).alias("mode"))
    return E.pending_work(planned, res.filter("model = 'M0'"), retry=("api_error",))


@query("""
, g AS (SELECT *, sum(CASE WHEN status <> 'api_error' THEN 1 ELSE 0 END) OVER (PARTITION BY model ORDER BY event_id) AS island FROM res)
SELECT model, min(event_id) AS first, max(event_id) AS last, count(*) AS n, count(*) >= 2 AS tripped FROM g WHERE status = 'api_error' GROUP BY model, island
""")
def error_runs(spark, d):
    return E.error_islands(results(spark, d)[0], "event_id", limit=2)


@query("""
SELECT event_id, CASE WHEN r = 0 THEN 'truncated' WHEN r = 1 THEN 'refused' WHEN r IN (2, 5) THEN 'format_error' WHEN r = 3 THEN CASE WHEN mode = 'direct' THEN 'correct' ELSE 'format_error' END ELSE CASE WHEN mode = 'cot' THEN 'incorrect' ELSE 'format_error' END END AS status,
  CASE WHEN r = 3 AND mode = 'direct' THEN 'A' WHEN r = 4 AND mode = 'cot' THEN 'B' END AS prediction FROM (SELECT *, event_id % 6 AS r FROM res)
""")
def score_status(spark, d):
    res = results(spark, d)[0]
    r = F.col("event_id") % 6
    content = F.when(r == 2, "答案 A").when(r == 3, " 答案：Ａ ").when(r == 4, "思考\n\n答案: b").when(r == 5, "答案:A\n答案:B").otherwise("答案:A")
    status, prediction = E.score(F.when(r == 0, "length").otherwise("stop"), F.when(r == 1, "no"), content, F.col("mode"), F.lit("A"), F.lit(True))
    return res.select("event_id", status.alias("status"), prediction.alias("prediction"))


@query("""
SELECT question_id, mode, model, CASE WHEN n > 1 THEN 'duplicate' WHEN question_id % 10 = 0 OR mode = 'none' THEN 'unplanned' WHEN question_id % 7 = 0 THEN 'input' END AS problem FROM (
  SELECT *, count(*) OVER (PARTITION BY model, question_id, mode) AS n FROM (SELECT model, question_id, mode FROM res UNION ALL SELECT model, question_id, mode FROM res WHERE question_id % 50 = 1)) WHERE problem IS NOT NULL
""")
def result_problems(spark, d):
    res, items = results(spark, d)
    rows = res.select("model", "question_id", "mode", F.when(F.col("question_id") % 7 == 0, "other").otherwise(F.col("question_id").cast("string")).alias("sent"))
    rows = rows.unionByName(rows.filter("question_id % 50 = 1"))
    return E.result_problems(rows, items.select("question_id", F.col("question_id").cast("string").alias("text")), items.filter("question_id % 10 <> 0").select("question_id"))
