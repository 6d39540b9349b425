"""Integrity of a published data set: ids, texts, hashes, raw files, assets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.schema import LETTERS


def violations(records: DataFrame, manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(check, item) of what is wrong. manifest: (raw_file, content_hash); files: (path, sha256), relative to the set.

    Records are read three times: for what each tells of itself and of the manifest, for repeated ids, and for the paths it
    names. Paths, manifest and files, a row each, meet in one join.
    """
    qid = F.col("question_id")
    question = F.coalesce(F.nullif("normalized_question", F.lit("")), F.col("question"))
    args = (F.col("shared_material"), question, F.col("options"))
    blank = [~F.coalesce(F.col(f"options.{x}"), F.lit("")).rlike(r"(?U)\S") for x in LETTERS]
    stale = (F.col("provenance.ordered_hash") != T.ordered_hash(*args)) | (F.col("provenance.permutation_hash") != T.permutation_hash(*args))
    named = lambda checks: F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in checks.items())), lambda x: x.isNotNull())

    listed = manifest.groupBy("raw_file").agg(F.max("content_hash").alias("h"), F.count("*").alias("n"))
    own = records.select(qid, F.col("provenance.raw_file").alias("raw_file"), F.col("provenance.content_hash").alias("own"), named({
        "question_differs": ~F.col("question").eqNullSafe(F.col("normalized_question")), "stale_hash": stale,
        "incomplete": ~F.coalesce("answer", F.lit("")).isin(*LETTERS) | blank[0] | blank[1] | blank[2] | blank[3],
    }).alias("c")).join(listed.select("raw_file", "h"), "raw_file", "left")
    checks = F.concat("c", named({"not_in_manifest": F.col("h").isNull(), "manifest_hash": F.col("h") != F.col("own")}))
    out = own.select(F.explode(checks).alias("check"), qid.cast("string").alias("item"))
    twice = records.groupBy("question_id").agg(F.count("*").alias("n")).filter("n > 1")
    out = out.unionByName(twice.select(F.lit("duplicate_id").alias("check"), qid.cast("string").alias("item")))

    raw = F.filter(F.concat(F.array("provenance.raw_file"), F.transform("answer_evidence", lambda e: e["raw_file"])), lambda p: p.isNotNull())
    path = lambda paths, is_raw: F.transform(paths, lambda p: F.struct(p.alias("path"), F.lit(is_raw).alias("raw")))
    evidence = F.filter(F.array_distinct(raw), lambda p: p != "")
    used = records.select(F.explode(F.array_union(path(evidence, True), path(F.coalesce("image_paths", F.array().cast("array<string>")), False))).alias("p"))
    used = used.groupBy("p.path").agg(F.bool_or("p.raw").alias("raw"))
    climbs = F.col("path").rlike(r"(^|/)\.\.(/|$)|^/")
    both = used.join(files.select("path", "sha256"), "path", "full").join(listed.select(F.col("raw_file").alias("path"), "h", "n"), "path", "full")
    checks = named({
        "missing_file": F.col("raw").isNotNull() & (F.col("sha256").isNull() | climbs), "raw_bytes": F.col("sha256") != F.col("h"), "unreferenced": F.col("sha256").isNotNull() & F.col("raw").isNull(),
        "manifest_unused": F.col("h").isNotNull() & ~F.coalesce("raw", F.lit(False)), "duplicate_manifest": F.col("n") > 1,
    })
    return out.unionByName(both.select(F.explode(checks).alias("check"), F.col("path").alias("item")))
