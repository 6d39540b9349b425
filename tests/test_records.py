"""Normalising, validating, duplicates, reviews and files on small records."""

import itertools
import json
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.operators import dedup, normalize, review, validate
from gleanery.schema import RECORD
from gleanery.sources import files


def record(**over):
    source = {"source_id": "s", "site_name": "n", "url": "https://x.example/1", "paper_title": "", "year": 2024, "province": "", "exam_type": "", "page_number": None, "retrieved_at": ""}
    base = {
        "schema_version": "0.1.0", "record_version": 1, "question_id": "CHIS_000001", "group_id": "GROUP_000001", "shared_material": "", "raw_question": "1. 题干内容", "normalized_question": "题干内容", "question": "题干内容",
        "raw_options": {"A": "甲", "B": "乙", "C": "丙", "D": "丁"}, "options": {"A": "甲", "B": "乙", "C": "丙", "D": "丁"}, "answer": "A", "answer_explanation": "",
        "answer_evidence": [{"source_id": "s", "answer": "A", "official": True}], "has_image": False, "image_paths": [], "source": source, "source_records": [],
        "quality": {"answer_status": "unchecked", "duplicate_status": "unchecked", "parse_status": "pending", "review_status": "pending", "image_dependency": "unknown", "issues": [], "collector": "", "reviewer": "", "notes": ""},
        "provenance": {"raw_file": "", "content_hash": "", "license_status": "allowed"},
    }
    for k, v in over.items():
        base[k] = {**base[k], **v} if isinstance(v, dict) and isinstance(base.get(k), dict) else v
    return base


@pytest.fixture
def frame(spark, tmp_path):
    def make(*records):
        path = tmp_path / f"r{len(list(tmp_path.iterdir()))}.jsonl"
        path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in records) + "\n\n", encoding="utf-8")
        return files.read_jsonl(spark, str(path), RECORD)

    return make


def test_clean_question_options_and_answer(frame):
    r = record(raw_question="１．​题&nbsp;干", raw_options={"A": "Ａ．甲", "B": "B) 乙"}, answer="ａ")
    x = normalize.normalize_records(frame(r)).first()
    assert (x.question, x.normalized_question, x.options.A, x.options.B, x.answer) == ("题 干", "题 干", "甲", "乙", "A")
    assert x.raw_question == r["raw_question"] and len(x.provenance.ordered_hash) == 64
    assert [c.field for c in x.provenance.normalization_changes] == ["question", "options.A", "options.B", "answer"]


def test_decimal_loses_its_head_like_a_number(spark):
    assert spark.range(1).select(T.normal_text(F.lit("1.5亿人"), number=True)).first()[0] == "5亿人"


def test_hash_ignores_order_only_when_asked(frame):
    a, b = record(), record(options={"A": "乙", "B": "甲"})
    x, y = normalize.with_hashes(frame(a, b)).orderBy("_ord").collect()
    assert x.provenance.ordered_hash != y.provenance.ordered_hash and x.provenance.permutation_hash == y.provenance.permutation_hash
    import hashlib

    data = json.dumps({"options": ["甲", "乙", "丙", "丁"], "question": "题干内容", "shared_material": ""}, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    assert x.provenance.ordered_hash == hashlib.sha256(data.encode()).hexdigest()


@pytest.mark.parametrize(
    ("over", "codes", "status", "parse"),
    [
        ({}, [], "verified", "valid"),
        ({"answer_evidence": [{"source_id": "s", "answer": "A", "official": False}]}, [], "single_source", "valid"),
        ({"answer_evidence": [{"answer": "A"}, {"answer": "B"}]}, [], "conflict", "valid"),
        ({"answer_evidence": [{"source_id": "a", "answer": "A", "reliable": True}, {"source_id": "b", "answer": "A", "reliable": True}]}, [], "verified", "valid"),
        ({"answer": ""}, [], "missing", "valid"),
        ({"answer": "E"}, ["invalid_answer"], "invalid", "failed"),
        ({"normalized_question": "别的"}, ["question_normalization_mismatch"], "verified", "failed"),
        ({"options": {"D": "丙"}}, ["duplicate_options"], "verified", "failed"),
        ({"options": {"A": " "}}, ["empty_options"], "verified", "failed"),
        ({"source": {"year": 1800}}, ["invalid_year"], "verified", "needs_review"),
        ({"source": {"url": "file:x"}}, ["invalid_source_url"], "verified", "failed"),
        ({"provenance": {"ocr_confidence": 0.5}}, ["low_ocr_confidence"], "verified", "needs_review"),
        ({"has_image": True}, ["unprocessed_image"], "verified", "needs_review"),
        ({"question": "坏�字", "normalized_question": "坏�字"}, ["abnormal_unicode"], "verified", "needs_review"),
    ],
)
def test_rules(frame, over, codes, status, parse):
    q = validate.validate_records(frame(record(**over)), 2027).first().quality
    assert ([i.code for i in q.issues], q.answer_status, q.parse_status) == (codes, status, parse)


def test_group_material_flags_every_member_and_issues_stay_once(frame):
    rows = validate.validate_records(frame(record(), record(question_id="CHIS_000002", shared_material="m")), 2027)
    again = validate.validate_records(rows, 2027).collect()
    assert [[i.code for i in r.quality.issues] for r in again] == [["inconsistent_group_material"]] * 2


def test_image_dependency_is_sticky_and_reports_differ(frame):
    rows = validate.validate_records(frame(record(quality={"image_dependency": "image_dependent"}), record(has_image=True, question="如图", normalized_question="如图", image_paths=["a"])), 2027)
    assert [r.quality.image_dependency for r in rows.collect()] == ["image_dependent"] * 2
    one = validate.validate_records(frame(record()), 2027)
    summary = {r.metric: r.n for r in validate.validation_summary(one).collect()}
    report = validate.nested_report(None, validate.quality_report(one))
    assert summary["qualified"] == 1 and report["qualified"] == 0 and report["needs_human_review"] == 1 and report["by_year"] == {"2024": 1}


def test_exact_reordered_and_similar(frame):
    swapped = record(question_id="CHIS_000003", options={"A": "乙", "B": "甲"}, answer="B")
    got = dedup.deduplicate_records(frame(record(), record(question_id="CHIS_000002"), swapped, record(question_id="CHIS_000004", question="题干内容？", normalized_question="题干内容？")), threshold=0.7)
    assert got.exact.count() == 1 and got.reordered.count() == 2
    assert got.exact.first().suggested_keep == "CHIS_000001" and {r.answer_equivalence for r in got.reordered.collect()} == {"equivalent"}
    status = {r.question_id: r.quality.duplicate_status for r in got.records.collect()}
    assert status == {"CHIS_000001": "exact_duplicate", "CHIS_000002": "exact_duplicate", "CHIS_000003": "reordered_duplicate", "CHIS_000004": "suspected_duplicate"}
    assert got.records.count() == 4


def grams(t, n=3):
    t = "".join(t.split())
    return {t} if 0 < len(t) <= n else {t[i : i + n] for i in range(len(t) - n + 1)}


def test_similar_pairs_equal_the_nested_loop(spark):
    import random

    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    texts = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randint(3, 12))]
        for _ in range(rng.randint(1, 3)):
            x = list(base)
            if rng.random() < 0.7:
                x[rng.randrange(len(x))] = rng.choice(words)
            texts.append(" ".join(x))
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    tau = 0.6
    got = {(r.a, r.b) for r in dedup.similar_sets(rows, tau).collect()}
    want = {(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if len(grams(texts[i]) & grams(texts[j])) / len(grams(texts[i]) | grams(texts[j])) >= tau}
    assert got == want
    scored = spark.createDataFrame([("abcd", "abce", 0.5)], "a string, b string, j double").select(dedup.blended_similarity("a", "b", "j")).first()[0]
    assert scored == round((SequenceMatcher(None, "abcd", "abce").ratio() + 0.5) / 2, 6)
    with pytest.raises(ValueError):
        dedup.similar_sets(rows, 0.0)


def test_review_round_trip(spark, frame, tmp_path):
    r = frame(record(question="=1", normalized_question="=1"), record(question_id="CHIS_000002"))
    sheet = review.review_rows(r).withColumn("review_status", F.lit("approved")).withColumn("reviewer", F.lit("x"))
    files.write_csv(sheet, str(tmp_path / "sheet"))
    back = files.read_sheet(spark, str(tmp_path / "sheet"), review.REVIEW_COLUMNS)
    out = {x.question_id: x for x in review.merge_review(r, back).collect()}
    assert all(x.quality.review_status == "approved" and x.record_version == 2 and x.quality.reviewer == "x" for x in out.values())
    changed = r.withColumn("answer", F.lit("B"))
    outcomes = review.merge_outcomes(changed, back)
    assert {x.outcome for x in outcomes.collect()} == {"stale"} and review.merge_summary(outcomes).first().skipped == 2
    assert "stale review snapshot for" in review.merge_errors(outcomes).first().message
    with pytest.raises(files.BadInput):
        files.read_sheet(spark, str(tmp_path / "sheet"), ["nowhere"])


def test_canonical_rows_have_their_columns(frame):
    row = review.canonical_rows(frame(record(question="@x"))).first()
    assert row.__fields__ == review.CANONICAL_COLUMNS and row.question == "'@x" and row.has_image == "False" and row.issues_json == "[]"


def test_malformed_line_is_an_error(spark, tmp_path):
    path = tmp_path / "bad.jsonl"
    path.write_text('{"question_id": "a"}\n[1]\n')
    with pytest.raises(Exception, match="malformed line"):
        files.read_jsonl(spark, str(path), RECORD).collect()


def test_jsonl_round_trip(spark, frame, tmp_path):
    files.write_jsonl(frame(record()).drop("_ord"), str(tmp_path / "out"), single=True)
    assert files.read_jsonl(spark, str(tmp_path / "out"), RECORD).first().question == "题干内容"


def test_answers(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert [one(T.answer_of(F.lit(t))) for t in ("参考答案：ｂ", " Ｃ ", "无", "", None)] == ["B", "C", "", "", ""]
    assert one(T.claimed_answer(T.answer_claims(F.lit("A项正确；故选A项。")))) == "A" and one(T.claimed_answer(T.answer_claims(F.lit("【答案】B。故选D项。")))) == ""
    final = lambda t, m: one(T.final_answer(F.lit(t), F.lit(m)))
    assert final("答案：Ａ", "direct") == "A" and final("x\n答案:b", "cot") == "B"
    assert [final(*a) for a in (("答案:A\n多", "direct"), ("答案:A", "cot"), ("答案:A\n答案:B", "cot"), ("", "direct"), ("答案:A\n\n", "direct"))] == [None, None, None, None, "A"]
