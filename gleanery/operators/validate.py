"""Validation rules, answer status, image dependency, parse status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.open_records import OPEN, option_keys
from gleanery.schema import ANSWER_STATUSES, LETTERS

# Words of a question that point at an image. So are the codes and messages of the rules below.
IMAGE_CUES = ("如图", "下图", "图中", "地图", "示意图", "表中", "图表")


def _issue(when: Column, code: str, severity: str, message) -> Column:
    message = F.lit(message) if isinstance(message, str) else message
    return F.when(when, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), message.alias("message")))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _blank(c: Column) -> Column:
    return ~c.rlike(r"(?U)\S")


def found_issues(latest_year: int, earliest_year: int = 1900, keys: Column | None = None) -> Column:
    """array<{code, severity, message}> of one record, in the order of the rules. latest_year is a parameter, so that
    a run does not depend on its clock. keys: the sorted keys of the options as they were read, null for options that are no object; without
    them, only a null struct tells of wrong keys."""
    options = [F.coalesce(F.col(f"options.{x}"), F.lit("")) for x in LETTERS]
    empty = F.filter(F.array(*(F.when(_blank(o), F.lit(x)) for x, o in zip(LETTERS, options, strict=True))), lambda x: x.isNotNull())
    filled = F.filter(F.array(*(F.regexp_replace(o, r"(?U)^\s+|\s+\z", "") for o in options)), lambda x: x != "")
    answer, url, year = _text("answer"), _text("source.url"), F.col("source.year")
    chosen = F.coalesce(*(F.when(answer == x, o) for x, o in zip(LETTERS, options, strict=True)))
    searchable = F.concat_ws(" ", _text("shared_material"), _text("question"), *options)
    main = F.coalesce(F.nullif(_text("normalized_question"), F.lit("")), _text("question"))
    fit = F.col("options").isNotNull() if keys is None else F.coalesce(keys == F.array(*map(F.lit, LETTERS)), F.lit(False))
    rules = [
        _issue(_blank(main), "empty_question", "error", "Question text is empty"),
        _issue(~F.col("question").eqNullSafe(F.col("normalized_question")), "question_normalization_mismatch", "error", "question must equal normalized_question"),
        _issue(_blank(_text("group_id")), "missing_group_id", "error", "group_id is empty"),
        _issue(~fit, "invalid_option_keys", "error", "Options must be exactly A, B, C and D"),
        _issue(fit & (F.size(empty) > 0), "empty_options", "error", F.concat(F.lit("Empty options: "), F.array_join(empty, ", "))),
        _issue(fit & (F.size(filled) > F.size(F.array_distinct(filled))), "duplicate_options", "error", "Two or more options have the same text"),
        _issue((answer != "") & ~answer.isin(*LETTERS), "invalid_answer", "error", "Answer must be A, B, C or D"),
        _issue(F.col("options").isNotNull() & (chosen == ""), "missing_answer_option", "error", "Answer points to a missing option"),
        _issue(~url.rlike(r"(?i)^https?://[^/?#]"), "invalid_source_url", "error", "A traceable HTTP(S) source URL is required"),
        _issue(year.isNotNull() & ~year.between(earliest_year, latest_year), "invalid_year", "warning", f"Year must be between {earliest_year} and {latest_year}"),
        _issue(searchable.rlike(r"[\uFFFD\x00-\x08\x0B\x0C\x0E-\x1F]"), "abnormal_unicode", "warning", "Replacement or control characters detected"),
        _issue(F.col("provenance.ocr_confidence") < 0.80, "low_ocr_confidence", "warning", "OCR confidence is below 0.80"),
        _issue(F.coalesce("has_image", F.lit(False)) & (F.coalesce(F.size("image_paths"), F.lit(0)) <= 0), "unprocessed_image", "warning", "Image reference has no saved local asset"),
    ]
    return F.filter(F.array(*rules), lambda x: x.isNotNull())


def _first_of_each(issues: Column) -> Column:
    """Without later issues of a code and message that came before."""
    empty = F.slice(issues, 1, 0)
    add = lambda acc, x: F.when(F.exists(acc, lambda y: (y["code"] == x["code"]) & (y["message"] == x["message"])), acc).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(issues, empty, add)


def answer_status() -> Column:
    answer, evidence = _text("answer"), F.coalesce("answer_evidence", F.array())
    told = F.array_distinct(F.filter(F.transform(evidence, lambda e: F.upper(F.coalesce(e["answer"], F.lit("")))), lambda x: x != ""))
    official = F.exists(evidence, lambda e: F.coalesce(e["official"] & (e["answer"] == answer), F.lit(False)))
    reliable = F.array_distinct(F.transform(F.filter(evidence, lambda e: F.coalesce(e["reliable"] & (e["answer"] == answer), F.lit(False))), lambda e: e["source_id"]))
    before = F.col("quality.answer_status")
    return (
        F.when(answer == "", "missing").when(~answer.isin(*LETTERS), "invalid").when(F.size(told) > 1, "conflict").when(official, "verified")
        .when(F.size(reliable) >= 2, "verified").when(F.size(evidence) > 0, "single_source").when(before.isin(*ANSWER_STATUSES), before).otherwise("unchecked")
    )


def image_dependency() -> Column:
    text = F.concat_ws(" ", _text("shared_material"), _text("question"))
    cue = text.rlike("|".join(IMAGE_CUES))
    return F.when(F.col("quality.image_dependency") == "image_dependent", "image_dependent").when(~F.coalesce("has_image", F.lit(False)), "not_image_dependent").when(cue, "image_dependent").otherwise("needs_review")


def validate_records(records: DataFrame, latest_year: int, earliest_year: int = 1900) -> DataFrame:
    """records with issues (kept ones first, each code and message once), answer status, image dependency, parse status.
    Of open records, the keys of the options are those of the object that was read.

    The one shuffle is by group: min and max of a group's material, both combined before it, tell if they differ.
    """
    group = F.coalesce("group_id", F.lit(""))
    material = F.coalesce("shared_material", F.lit(""))
    mixed = records.select(group.alias("_g"), material.alias("_m")).filter("_g <> ''").groupBy("_g").agg((F.min("_m") != F.max("_m")).alias("_mixed")).filter("_mixed")
    out = records.withColumn("_g", group).join(mixed, "_g", "left")
    clash = _issue(F.coalesce("_mixed", F.lit(False)), "inconsistent_group_material", "error", "Records in the same group have different shared material")
    keys = option_keys(F.col(OPEN)) if OPEN in records.columns else None
    fresh = F.concat(found_issues(latest_year, earliest_year, keys), F.filter(F.array(clash), lambda x: x.isNotNull()))
    kept = F.coalesce(F.col("quality.issues"), F.slice(fresh, 1, 0))
    issues = _first_of_each(F.concat(kept, fresh))
    quality = F.col("quality").withField("issues", issues).withField("answer_status", answer_status()).withField("image_dependency", image_dependency())
    out = out.withColumn("quality", quality).drop("_g", "_mixed")
    severities = F.transform("quality.issues", lambda x: x["severity"])
    status = F.when(F.array_contains(severities, "error"), "failed").when(F.size(severities) > 0, "needs_review").otherwise("valid")
    return out.withColumn("quality", F.col("quality").withField("parse_status", status))


def _report(records: DataFrame, flags: dict[str, Column], histograms: dict[str, Column], *more: Column) -> DataFrame:
    """(metric, key, n) in one pass over records: rows that a flag holds for (0 where there are none), values of histograms, and
    the cells of further arrays of struct(metric, key)."""
    cell = lambda metric, key: F.struct(F.lit(metric).alias("metric"), key.alias("key"))
    held = F.filter(F.array(*(F.when(c, cell(k, F.lit(""))) for k, c in flags.items())), lambda x: x.isNotNull())
    known = lambda c: F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit("unknown"))
    cells = F.concat(held, F.array(*(cell(k, known(c)) for k, c in histograms.items())), *more)
    counts = records.select(F.explode(cells).alias("c")).groupBy("c.metric", "c.key").agg(F.count("*").alias("n"))
    none = records.sparkSession.range(1).select(F.explode(F.array(*(cell(k, F.lit("")) for k in flags))).alias("c")).select("c.metric", "c.key", F.lit(0).cast("long").alias("n"))
    return counts.unionByName(none).groupBy("metric", "key").agg(F.sum("n").alias("n"))


def _codes(metric: str) -> Column:
    cells = F.transform("quality.issues", lambda x: F.struct(F.lit(metric).alias("metric"), x["code"].alias("key")))
    return F.coalesce(cells, F.array().cast("array<struct<metric:string,key:string>>"))


def validation_summary(records: DataFrame) -> DataFrame:
    """(metric, key, n): totals with an empty key, and the histograms by_source, by_year and issue_counts."""
    q = F.col("quality")
    valid = q["parse_status"] == "valid"
    flags = {
        "total": F.lit(True), "structurally_valid": valid,
        "qualified": valid & (q["answer_status"] == "verified") & (q["image_dependency"] != "image_dependent"),
        "missing_answer": q["answer_status"] == "missing", "parse_failed": q["parse_status"] == "failed", "image_dependent": q["image_dependency"] == "image_dependent",
    }
    return _report(records, flags, {"by_source": F.col("source.source_id"), "by_year": F.col("source.year")}, _codes("issue_counts"))


def quality_report(records: DataFrame) -> DataFrame:
    """(metric, key, n) of the final report: five conditions make a record qualified."""
    q = F.col("quality")
    flags = {
        "total": F.lit(True),
        "qualified": (q["parse_status"] == "valid") & (q["answer_status"] == "verified") & (q["review_status"] == "approved") & (q["duplicate_status"] == "unique") & (q["image_dependency"] != "image_dependent"),
        "missing_answer": q["answer_status"] == "missing", "verified_answer": q["answer_status"] == "verified", "parse_failed": q["parse_status"] == "failed",
        "suspected_duplicate": q["duplicate_status"] == "suspected_duplicate", "exact_duplicate": q["duplicate_status"] == "exact_duplicate",
        "image_dependent": q["image_dependency"] == "image_dependent", "needs_human_review": q["review_status"].isin("pending", "needs_revision"),
    }
    by = {"by_source": "source.source_id", "by_year": "source.year", "answer_statuses": "quality.answer_status", "parse_statuses": "quality.parse_status", "review_statuses": "quality.review_status", "duplicate_statuses": "quality.duplicate_status"}
    codes = _codes("rejection_reasons")
    other = F.array(F.struct(F.lit("rejection_reasons").alias("metric"), F.lit("unspecified").alias("key")))
    reasons = F.when(F.col("quality.review_status") == "rejected", F.when(F.coalesce(F.size("quality.issues"), F.lit(0)) > 0, codes).otherwise(other)).otherwise(F.slice(other, 1, 0))
    return _report(records, flags, {k: F.col(c) for k, c in by.items()}, reasons)


def nested_report(spark, report: DataFrame) -> dict:
    """The report as one nested dict: its size is that of the histograms, not of the records."""
    out: dict = {}
    for r in report.orderBy("metric", "key").collect():
        if r["key"] == "" and r["metric"] in {"total", "qualified", "structurally_valid", "missing_answer", "verified_answer", "parse_failed", "suspected_duplicate", "exact_duplicate", "image_dependent", "needs_human_review"}:
            out[r["metric"]] = r["n"]
        else:
            out.setdefault(r["metric"], {})[r["key"]] = r["n"]
    return out

