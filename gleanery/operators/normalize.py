"""Normalisation of question records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.schema import LETTERS


def normalize_records(records: DataFrame) -> DataFrame:
    """Clean question, options, material, explanation and answer of records, with a log of what changed and both hashes.

    Raw question and options stay as they were; a missing raw question takes the question's place. Raw options that are
    all empty are not replaced by options, and changes of material and explanation are not logged.
    """
    raw = F.coalesce(F.nullif("raw_question", F.lit("")), F.col("question"), F.lit(""))
    options = F.struct(*(F.coalesce(F.col(f"raw_options.{x}"), F.lit("")).alias(x) for x in LETTERS))
    out = records.withColumns({"raw_question": raw, "_old_answer": F.coalesce("answer", F.lit("")), "raw_options": options})
    clean = T.normal_text(F.col("raw_question"), number=True)
    out = out.withColumns({
        "normalized_question": clean,
        "options": F.struct(*(T.option_text(F.col(f"raw_options.{x}")).alias(x) for x in LETTERS)),
        "shared_material": T.normal_text(F.col("shared_material")),
        "answer_explanation": T.normal_text(F.col("answer_explanation")),
        "answer": T.answer_of(F.col("_old_answer")),
        "group_id": F.when((F.coalesce("group_id", F.lit("")) == "") & (F.coalesce("question_id", F.lit("")) != ""), F.concat(F.lit("GROUP_"), F.element_at(F.split("question_id", "_"), -1))).otherwise(F.col("group_id")),
    })
    out = out.withColumn("question", F.col("normalized_question"))
    fields = [("question", F.col("raw_question"), F.col("question")), *((f"options.{x}", F.col(f"raw_options.{x}"), F.col(f"options.{x}")) for x in LETTERS), ("answer", F.col("_old_answer"), F.col("answer"))]
    hashed = F.col("provenance").withField("normalization_changes", T.changes(*fields))
    return out.withColumn("provenance", hashed).transform(with_hashes).drop("_old_answer")


def with_hashes(records: DataFrame) -> DataFrame:
    question = F.coalesce(F.nullif("normalized_question", F.lit("")), F.col("question"))
    args = (F.col("shared_material"), question, F.col("options"))
    return records.withColumn("provenance", F.col("provenance").withField("ordered_hash", T.ordered_hash(*args)).withField("permutation_hash", T.permutation_hash(*args)))
