"""Runs of a model over items: messages, configurations and manifests, call outcomes, whole summaries, provenance of labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.operators import evaluation as E
from gleanery.schema import ABILITIES, MODES

# Fixed values of the call protocol.
RETRYABLE = (408, 429, 500, 502, 503, 504)
STOPS = (400, 401, 402, 403, 404, 422)
LONGEST_WAIT, RETRIES, ERRORS_IN_A_ROW = 60, 2, 5
BARE_IMAGES = ("glm-4.6v-flash", "glm-4.6v")  # models that take images without a media type before them
RESERVED = ("model", "messages", "stream", "n", "tools", "tool_choice", "functions", "function_call", "api_key", "response_format")
LOCAL_HOSTS = ("127.0.0.1", "localhost", "[::1]")
UNLABELLED = "未标注"
REFERENCES = "array<struct<path:string,sha256:string>>"


def messages(prompt: Column, item: Column) -> Column:
    """array<struct(role, text, images)>: the system's prompt and the item as it is put, with references to its images."""
    pictures = lambda x: F.coalesce(x, F.array().cast("array<string>"))
    refs = F.transform(F.arrays_zip(pictures(item["image_paths"]).alias("path"), pictures(item["image_sha256"]).alias("sha256")), lambda x: F.struct(x["path"].alias("path"), x["sha256"].alias("sha256")))
    none = F.array().cast(REFERENCES)
    said = E.user_text(item["shared_material"], item["question"], item["options"])
    return F.array(F.struct(F.lit("system").alias("role"), prompt.alias("text"), none.alias("images")), F.struct(F.lit("user").alias("role"), said.alias("text"), refs.cast(REFERENCES).alias("images")))


def image_url(path: Column, content: Column, model: Column) -> Column:
    """An image as a call carries it: Base64, and before it, but for some models, its media type."""
    kind = F.when(path.endswith(".png"), "image/png").otherwise("image/jpeg")
    coded = F.translate(F.base64(content), "\r\n", "")  # one line, however the session's base64 breaks it
    return F.when(model.isin(*BARE_IMAGES), coded).otherwise(F.concat(F.lit("data:"), kind, F.lit(";base64,"), coded))


def encoded_images(refs: DataFrame, files: DataFrame, model: str) -> DataFrame:
    """refs (question_id, place, path, sha256) with `url`, the content of the file (path, content) of the same fingerprint, and
    `missing` where there is none. Files are joined by path, and read only where they are asked for."""
    named = files.select(F.col("path").alias("_path"), F.sha2("content", 256).alias("_sha"), "content")
    out = refs.join(named, (refs["path"] == named["_path"]) & (refs["sha256"] == named["_sha"]), "left")
    return out.select(*refs.columns, image_url(F.col("path"), F.col("content"), F.lit(model)).alias("url"), F.col("content").isNull().alias("missing"))


def call_outcome(http_status: Column, error: Column, retry_after: Column, attempt: Column, retries: int = RETRIES) -> Column:
    """struct(retryable, again, wait, stop) of an attempt (counted from 0): whether the error is one that passes, whether there is
    another attempt, after how many seconds, and whether the whole run ends."""
    passes = F.coalesce(http_status.isin(*RETRYABLE), F.lit(False)) | F.coalesce(error == "connection_or_timeout", F.lit(False))
    wait = F.coalesce(retry_after, F.pow(F.lit(2), attempt).cast("int"))
    again = passes & (attempt < retries) & (wait <= LONGEST_WAIT)
    failed = F.coalesce(error, F.lit("")) != ""
    stop = F.coalesce(http_status.isin(*STOPS), F.lit(False)) | (failed & (F.coalesce(retry_after, F.lit(0)) > LONGEST_WAIT))
    return F.struct(passes.alias("retryable"), again.alias("again"), F.when(again, wait).alias("wait"), stop.alias("stop"))


def config_problems() -> Column:
    """array<string> of what is wrong with a run's configuration (endpoint, model, api_key_env, parameters as a map of JSON
    values, timeout_seconds, min_interval_seconds, retries); empty if it may run."""
    part = lambda p: F.try_parse_url(F.col("endpoint"), F.lit(p))
    host, scheme = F.coalesce(part("HOST"), F.lit("")), F.coalesce(part("PROTOCOL"), F.lit(""))
    secure = (scheme == "https") | ((scheme == "http") & host.isin(*LOCAL_HOSTS))
    plain = part("USERINFO").isNull() & part("QUERY").isNull() & part("REF").isNull()
    endpoint = (host != "") & secure & plain & F.regexp_replace(F.coalesce(part("PATH"), F.lit("")), "/+$", "").endswith("/chat/completions")
    model = F.coalesce(F.col("model"), F.lit(""))
    given = F.coalesce(F.col("parameters"), F.create_map().cast("map<string,string>"))
    lengths = [F.try_element_at(given, F.lit(k)) for k in ("max_tokens", "max_completion_tokens")]
    whole = [F.coalesce(x.rlike(r"\A[1-9][0-9]{0,17}\z"), F.lit(True)) for x in lengths]
    finite = lambda c, low, ok: F.coalesce(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf")) & (F.col(c) >= low if ok else F.col(c) > low), F.lit(False))
    rules = {
        "endpoint": ~endpoint, "model": ~model.rlike(r"(?U)\S") | model.startswith("REPLACE_"), "api_key_env": ~F.coalesce(F.col("api_key_env"), F.lit("API_KEY")).rlike(r"\A[A-Za-z_][A-Za-z0-9_]*\z"),
        "parameters": F.arrays_overlap(F.map_keys(given), F.array(*map(F.lit, RESERVED))), "max_tokens": ~whole[0] | ~whole[1], "two lengths": lengths[0].isNotNull() & lengths[1].isNotNull(),
        "timing": ~finite("timeout_seconds", 0, False) | ~finite("min_interval_seconds", 0, True) | ~F.coalesce(F.col("retries").between(0, 5), F.lit(False)),
    }
    return F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())), lambda x: x.isNotNull())


MANIFEST = ("dataset_sha256", "question_ids", "modes", "endpoint", "model", "parameters", "prompts")


def manifest_hash() -> Column:
    """Fingerprint of a run's manifest; two runs share an output only if it is the same."""
    return F.sha2(T.json(F.struct(*MANIFEST)), 256)


def manifest_problems(manifests: DataFrame, items: DataFrame, dataset_sha256: str, prompts: dict[str, str]) -> DataFrame:
    """(run, problem) of manifests (run, *MANIFEST) that do not fit the data set, its modes, its prompts (mode -> fingerprint) or
    its items, and of runs of one model.

    Ids are looked up by a join; a manifest's list is exploded and counted before the shuffle.
    """
    ids = manifests.select("run", F.explode("question_ids").alias("question_id")).groupBy("run", "question_id").agg(F.count("*").alias("n"))
    known = ids.join(items.select("question_id", F.lit(True).alias("known")).distinct(), "question_id", "left")
    bad = known.groupBy("run").agg(F.bool_or((F.col("n") > 1) | F.col("known").isNull()).alias("bad"))
    models = manifests.groupBy("model").agg(F.count("*").alias("_runs"))
    m = manifests.join(bad, "run", "left").join(models, "model")
    prompt = F.exists(F.array(*(F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in prompts.items())), lambda p: ~F.coalesce(F.try_element_at(F.col("prompts"), p["k"]) == p["v"], F.lit(False)))
    rules = {
        "dataset": ~F.coalesce(F.col("dataset_sha256") == dataset_sha256, F.lit(False)), "modes": ~F.coalesce(F.col("modes") == F.array(*map(F.lit, MODES)), F.lit(False)),
        "question_ids": F.coalesce("bad", F.lit(True)), "prompts": prompt, "repeated model": F.col("_runs") > 1,
    }
    found = F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())), lambda x: x.isNotNull())
    return m.select("run", F.explode(found).alias("problem"))


GROUPS = ("all", "ability", "modality", "module")


def grouped_items(items: DataFrame) -> DataFrame:
    """(question_id, grouping, value): each item in its groups: all, ability (the reviewed label, else the first one), modality,
    and, if any item has one, knowledge module."""
    label = F.coalesce(F.nullif("primary_ability", F.lit("")), F.col("ai_primary_ability"))
    module = F.nullif(F.coalesce("knowledge_module", F.lit("")), F.lit(""))
    image = F.coalesce(F.size("image_paths"), F.lit(0)) > 0
    pair = lambda k, v: F.struct(F.lit(k).alias("grouping"), v.alias("value"))
    groups = F.array(pair("all", F.lit("")), F.when(label.isin(*ABILITIES), pair("ability", label)), pair("modality", F.when(image, "image").otherwise("text")), pair("module", F.coalesce(module, F.lit(UNLABELLED))))
    rows = items.select("question_id", F.explode(F.filter(groups, lambda g: g.isNotNull())).alias("g")).select("question_id", "g.*")
    any_module = items.agg(F.coalesce(F.bool_or(module.isNotNull()), F.lit(False)).alias("_any"))
    return rows.join(F.broadcast(any_module), (F.col("grouping") != "module") | F.col("_any")).drop("_any")  # one row


def group_summary(items: DataFrame, results: DataFrame) -> DataFrame:
    """Per model, grouping, value and mode: planned, attempted, pending, each status, accuracy, Wilson interval, and the paired
    statistics of the group. Planned items are counted over all items; abilities and modalities appear even without any.

    One shuffle joins results to the items' groups; groups without results come from the grid of planned ones.
    """
    groups = grouped_items(items)
    fixed = [("all", ""), *(("ability", a) for a in ABILITIES), ("modality", "text"), ("modality", "image")]
    grid = items.sparkSession.createDataFrame([(g, v, 0) for g, v in fixed], "grouping string, value string, planned long")
    planned = groups.groupBy("grouping", "value").agg(F.count("*").alias("planned")).unionByName(grid).groupBy("grouping", "value").agg(F.sum("planned").alias("planned"))
    planned = E._with_models(planned, results).withColumn("mode", F.explode(F.array(*map(F.lit, MODES))))
    joined = results.join(groups, "question_id")
    statuses = ("correct", "incorrect", "truncated", "refused", "format_error", "api_error")
    got = joined.groupBy("model", "grouping", "value", "mode").agg(F.count("*").alias("attempted"), *(F.count_if(F.col("status") == s).alias(s) for s in statuses))
    out = planned.join(got, ["model", "grouping", "value", "mode"], "left").fillna(0, ["attempted", *statuses])
    low, high = E.wilson(F.col("correct"), F.col("attempted"))
    out = out.withColumns({"pending": F.col("planned") - F.col("attempted"), "accuracy_over_attempted": F.when(F.col("attempted") > 0, F.col("correct") / F.col("attempted")), "wilson_low": low, "wilson_high": high})
    both = joined.groupBy("model", "grouping", "value", "question_id").pivot("mode", list(MODES)).agg(F.first("status")).filter("direct is not null and cot is not null")
    return out.join(E.paired_stats(both, ["model", "grouping", "value"]), ["model", "grouping", "value"], "left").fillna(0, ["pairs", "improved", "degraded", "both_correct", "both_incorrect_or_failed"])


def run_report(results: DataFrame, planned: int) -> DataFrame:
    """One row per model: responses, whether all planned items are answered in both modes, token sums, the response models and
    how many show reasoning of their own.

    results: model, mode, usage struct(prompt_tokens, completion_tokens, total_tokens), response_model, native_reasoning_present.
    """
    tokens = [F.coalesce(F.sum(f"usage.{t}"), F.lit(0)).alias(t) for t in ("prompt_tokens", "completion_tokens", "total_tokens")]
    full = [F.count_if(F.col("mode") == m) == planned for m in MODES]
    said = F.array_sort(F.collect_set(F.nullif("response_model", F.lit(""))))  # names of models: a few
    return results.groupBy("model").agg(F.count("*").alias("responses"), (full[0] & full[1]).alias("complete"), *tokens, F.array_join(said, ",").alias("response_models"), F.count_if(F.coalesce("native_reasoning_present", F.lit(False))).alias("native_reasoning_responses"))


def label_provenance(items: DataFrame) -> DataFrame:
    """(metric, key, n): how items were labelled, by method and review status with 'unknown' for none, and the count of items
    whose label no human has reviewed. All labels are reviewed if that is 0."""
    by = {"knowledge_module_methods": "knowledge_module_method", "ability_methods": "ability_label_method", "knowledge_module_review_statuses": "knowledge_module_review_status"}
    cell = lambda k, v: F.struct(F.lit(k).alias("metric"), v.alias("key"))
    reviewed = F.coalesce(F.col("label_review_status") == "human_reviewed", F.lit(False))
    cells = F.array(cell("label_status", F.when(reviewed, "human_reviewed").otherwise("pending")), *(cell(k, F.coalesce(c, F.lit("unknown"))) for k, c in by.items()))
    return items.select(F.explode(cells).alias("c")).groupBy("c.metric", "c.key").agg(F.count("*").alias("n"))


def rescored(results: DataFrame, items: DataFrame) -> DataFrame:
    """Results (question_id, mode, model, raw struct(finish_reason, refusal, content) or null) with status and prediction worked
    out anew from the response, against the answer of the item."""
    key = items.select("question_id", F.col("answer").alias("gold"))
    out = results.join(key, "question_id")
    status, prediction = E.score(F.col("raw.finish_reason"), F.col("raw.refusal"), F.col("raw.content"), F.col("mode"), F.col("gold"), F.col("raw").isNotNull())
    return out.select("question_id", "mode", "model", status.alias("status"), prediction.alias("prediction"))
