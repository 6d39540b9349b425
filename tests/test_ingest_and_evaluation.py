"""Gates, parsing, crawl state, streams and evaluation statistics."""

import math
import random
import time
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gleanery.operators import evaluation as E
from gleanery.operators import ingest as I
from gleanery.sources import files
from gleanery.streaming import state

PAGE = """<html><body><section class="group"><div class="material">共同 材料</div>
<article class="q"><p class="stem">甲？</p><ul><li class="option" data-option="A">A. 一</li><li class="option">B）二</li><li class="option" data-option="c">三</li><li class="option">D. 四</li></ul><span class="answer">答案：A</span></article>
<article class="q"><p class="stem">乙？<img src="x.png"></p></article></section>
<section class="group"><article class="q"><p class="stem">丙？</article></section></body></html>"""


def test_page_blocks(spark):
    spec = I.Selectors(group="section.group", block="article.q", question=".stem", option="li.option", material=".material", answer=".answer")
    rows = I.parse_pages(spark.createDataFrame([(1, PAGE), (2, "<p>none"), (3, None)], "id int, html string"), spec).orderBy("block").collect()
    assert [(r.group_no, r.raw_question, r.answer, r.shared_material) for r in rows] == [(0, "甲？", "A", "共同 材料"), (0, "乙？", "", "共同 材料"), (1, "丙？", "", "")]
    assert tuple(rows[0].options) == ("一", "二", "三", "四") and rows[1].images == ["x.png"]


def test_options_in_line(spark):
    one = lambda t: spark.range(1).select(I.split_options(F.lit(t))).first()[0]
    assert tuple(one("题干A. 一 B．二\nC、三D. 四")) == ("题干", "一", "二", "三", "四")
    assert one("题干A. 一 B. 二 C. 三") is None and one("") is None


def test_adapters(spark):
    line = '{"question": "12．（4分）题", "options": ["(A)一", "(B)二", "(C)三", "(D)四"], "label": "B", "other": {"source": "2015年江苏卷"}}'
    r = I.get_adapter("agieval_adapter")(spark.createDataFrame([(1, line), (2, '{"question": "x", "options": ["a"], "label": "A"}')], "idx int, json string")).collect()
    assert len(r) == 1 and (r[0].question, r[0].year, r[0].province, tuple(r[0].options), r[0].group_id) == ("题", 2015, "江苏", ("一", "二", "三", "四"), "GROUP_AGIEVAL_2015_0001")
    schema = "idx int, question string, answer array<string>, year string, analysis string, picture array<string>"
    x = I.get_adapter("gaokao_mm_adapter")(spark.createDataFrame([(7, "1. 题A. 一B. 二C. 三D. 四", ["C"], "x", None, ["p/q.png"])], schema)).first()
    assert (x.question_id, x.year, x.image_paths, x.image_dependency) == ("CHIS_000007", 2022, ["assets/q.png"], "image_dependent")
    schema = "idx int, title string, text string, div_id string, info string, images array<string>"
    z = I.get_adapter("zujuan_adapter")(spark.createDataFrame([(1, "湖南试卷-组卷网x", "1. 足够长的题干A. 一B. 二C. 三D. 四", "q12345678", "2021年全国高考真题", ["https://h/a.png?x"])], schema)).first()
    assert (z.question_id, z.year, z.province, z.image_paths) == ("CHIS_345678", 2021, "湖南", ["assets/zujuan_12345678_a.png"])
    with pytest.raises(LookupError):
        I.get_adapter("none")
    with pytest.raises(ValueError):
        I.adapter("agieval_adapter")(lambda df: df)


def test_exam_year_cascade(spark):
    cases = {"某卷2023-2024学年高二下学期期末": 2024, "某卷2023-2024学年高二上学期": 2023, "2027届": 2026, "2019年模拟卷": 2019, "2020/05/06": 2020, "该试题已被下架": None, "": None}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", I.item_year(F.col("t"))["year"].alias("y")).collect()
    assert {r.t: r.y for r in rows} == cases


def test_scope_gate_registry_and_raw_files(spark, tmp_path):
    row = lambda u: spark.range(1).select(I.in_scope(F.lit(u), F.lit("https://a.example"), F.array(F.lit("b.example")))).first()[0]
    assert row("https://x.b.example/1") and row("https://A.example/") and not row("https://evilb.example") and not row("::")
    path = tmp_path / "r.yaml"
    entry = "source_id: s1\n  site_name: n\n  base_url: https://x\n  source_type: html\n  exam_type: e\n  has_answer: true\n  year_range: x\n  estimated_questions: 1\n  login_required: true\n  robots_checked: true\n  terms_checked: true\n  license_status: restricted\n  redistribution_allowed: false\n  collector: c\n  status: draft\n  notes: n\n"
    path.write_text("version: 1\nsources:\n- " + entry)
    sources = files.load_registry(str(path))
    text = I.registry_frame(spark, list(sources.values())).withColumn("authenticated", F.lit(False)).select(I.crawl_refusals()).first()[0]
    assert text == "status is not approved; login is required; use --authenticated with an existing local session; licence is restricted"
    path.write_text("version: 2")
    with pytest.raises(files.BadInput):
        files.load_registry(str(path))
    meta = files.save_raw(str(tmp_path / "raw"), "https://x/a.txt?q", b"hi", "application/pdf")
    assert meta["raw_file"].endswith(".pdf") and files.binary_files(spark, str(tmp_path / "raw")).filter("path like '%.pdf'").first().sha256 == meta["content_hash"]


def test_page_kinds(spark):
    long = "字" * 40
    rows = [("t", long), ("t", long), ("s", " "), ("s", None), ("m", long), ("m", "")]
    got = {r.doc_id: r.kind for r in I.page_kind(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"t": "text", "s": "scan", "m": "mixed"}


def test_state_by_stream_is_the_fold(spark, tmp_path):
    from datetime import datetime

    at = datetime(2024, 1, 1)
    rows = [("s", "u", "attempt", 1, at, None, None), ("s", "u", "failure", 2, at, None, "x" * 3000), ("s", "u", "attempt", 3, at, None, None), ("s", "u", "success", 4, at, "f", None), ("s", "v", "failure", 5, at, None, "e")]
    log = spark.createDataFrame(rows, state.LOG)
    log.repartition(2).write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(state.LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    state.follow(stream, str(tmp_path / "table"), str(tmp_path / "cp")).awaitTermination()
    got = {r.url: (r.status, r.attempts, r.raw_file, r.error_message) for r in state.current(spark, str(tmp_path / "table")).collect()}
    assert got == {"u": ("success", 2, "f", None), "v": ("failed", 1, None, "e")}
    assert got == {r.url: (r.status, r.attempts, r.raw_file, r.error_message) for r in I.fold_state(log).collect()}
    assert state.windowed_outcomes(log).count() == 3
    assert [r.url for r in I.successful_files(I.fold_state(log), "s", 1).collect()] == ["u"]


def test_mcnemar_of_many_changes(spark):
    """Beyond whole numbers the same p, and for hundreds of thousands of changes at once."""
    pairs = [(500, 501), (480, 600), (2000, 2100), (4000, 4000), (1500, 1700), (16, 1000), (15, 1200), (0, 1001)]
    for i, d in pairs:
        n, term, total = i + d, 1, 1
        for k in range(min(i, d)):
            term = term * (n - k) // (k + 1)
            total += term
        want = min(1.0, float(Fraction(2 * total, 2**n)))
        assert math.isclose(E._exact_p(i, d), want, rel_tol=1e-10) and E._exact_p(i, d) == E._exact_p(d, i)
    start = time.monotonic()
    got = spark.createDataFrame([(300_000, 301_000), (400_000, 400_000)], "i long, d long").select(E.mcnemar_p("i", "d").alias("p")).collect()
    assert math.isclose(got[0].p, math.erfc(999 / math.sqrt(2 * 601_000)), rel_tol=1e-4) and got[1].p == 1.0 and time.monotonic() - start < 60


def test_comparison_meets_questions_once(spark):
    """The rows of the pairs on common questions, nulls and other modes among them, from one shuffle by question."""
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None] if i % 7 == 0 else ["a", "b"]), rng.choice([None, *range(40)]), rng.choice(["direct", "cot", "direct", "cot", "other", None]), rng.choice(["correct", "incorrect", "api_error", None])) for i in range(1500)]
    res = spark.createDataFrame(rows, "model string, question_id long, mode string, status string")
    want = E.paired_stats(E.pairs(res).join(E.common_questions(res), "question_id", "left_semi"), ["model"])
    got = E.comparison(res)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 3
    plan = got._jdf.queryExecution().sparkPlan().toString() + got._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and plan.count("SortMergeJoin") == 0


def test_comparison_of_many_questions(spark):
    """200,000 changes on common questions, half each way."""
    both = spark.range(400_000).select(F.lit("M").alias("model"), F.col("id").alias("question_id"), F.explode(F.array(F.lit("direct"), F.lit("cot"))).alias("mode"))
    right = F.col("question_id") % 4 == F.when(F.col("mode") == "direct", 0).otherwise(1)
    row = E.comparison(both.withColumn("status", F.when(right, "correct").otherwise("incorrect"))).first()
    assert (row.pairs, row.improved, row.degraded, row.delta, row.mcnemar_exact_p) == (400_000, 100_000, 100_000, 0.0, 1.0)


def test_mcnemar_bootstrap_and_wilson(spark):
    rng = random.Random(1)
    rows = []
    for m in ("M0", "M1"):
        for q in range(60):
            rows += [(m, q, mode, rng.choice(["correct", "incorrect", "api_error"])) for mode in ("direct", "cot")]
    res = spark.createDataFrame(rows, "model string, question_id int, mode string, status string")
    pairs = E.pairs(res)
    stats = {r.model: r for r in E.paired_stats(pairs, ["model"]).collect()}
    boot = {r.model: r for r in E.bootstrap_interval(pairs, ["model"]).collect()}
    for m in ("M0", "M1"):
        by = {(q, mode): s for mm, q, mode, s in rows if mm == m}
        changes = [int(by[q, "cot"] == "correct") - int(by[q, "direct"] == "correct") for q in range(60)]
        i, d = changes.count(1), changes.count(-1)
        assert (stats[m].improved, stats[m].degraded) == (i, d)
        assert math.isclose(stats[m].mcnemar_exact_p, min(1, 2 * sum(math.comb(i + d, k) for k in range(min(i, d) + 1)) / 2 ** (i + d)))
        g = random.Random(20261113)
        want = sorted(sum(g.choices(changes, k=60)) / 60 for _ in range(2000))
        assert (boot[m].boot_low, boot[m].boot_high) == (want[49], want[1949])
    low, high = spark.range(1).select(*(c.alias(n) for c, n in zip(E.wilson(F.lit(8), F.lit(10)), "lh", strict=True))).first()
    assert math.isclose(low, 0.4901625, abs_tol=1e-6) and math.isclose(high, 0.9433178, abs_tol=1e-6)
    assert spark.range(1).select(E.wilson(F.lit(0), F.lit(0))[0].alias("x")).first().x is None


def test_scores_items_and_labels(spark):
    one = lambda *a: tuple(spark.range(1).select(*(c.alias(str(i)) for i, c in enumerate(E.score(*a)))).first())
    s = F.lit("stop")
    none, yes = F.lit(None).cast("string"), F.lit(True)
    assert one(F.lit("length"), none, F.lit("答案:A"), F.lit("direct"), F.lit("A"), yes) == ("truncated", None)
    assert one(s, F.lit("no"), F.lit("答案:A"), F.lit("direct"), F.lit("A"), yes) == ("refused", None)
    assert one(s, none, F.lit("答案:A"), F.lit("direct"), none, yes) == ("answered", "A")
    assert one(s, none, F.lit("x"), F.lit("direct"), F.lit("A"), yes) == ("format_error", None)
    assert one(none, none, none, F.lit("direct"), F.lit("A"), F.lit(False)) == ("api_error", None)
    text = spark.range(1).select(E.user_text(F.lit("m"), F.lit("q"), F.struct(*(F.lit(x).alias(x) for x in "ABCD")))).first()[0]
    assert text == "材料：\nm\n\n题目：\nq\n\nA. A\nB. B\nC. C\nD. D"
    items = spark.createDataFrame([("a", "q", ("1", "2", "3", "4"), "A"), ("a", "q", ("1", "2", "3", "4"), "A"), ("b", " ", ("1", "2", "3", "4"), "A"), ("c", "q", ("1", "", "3", "4"), "A"), ("d", "q", ("1", "2", "3", "4"), "E"), ("e", "q", ("1", "2", "3", "4"), None)], "question_id string, question string, options struct<A:string,B:string,C:string,D:string>, answer string")
    assert sorted((r.question_id, r.reason) for r in E.invalid_items(items).collect()) == [("a", "duplicate"), ("a", "duplicate"), ("b", "stem"), ("c", "options"), ("d", "answer")]
    good = spark.createDataFrame([("a",), ("b",)], "question_id string")
    assert E.with_labels(good, spark.createDataFrame([("a", "x"), ("b", "y")], "question_id string, knowledge_module string")).count() == 2
    for bad in ([("a", "x")], [("a", "x"), ("b", " ")], [("a", "x"), ("a", "x"), ("b", "y")]):
        with pytest.raises(ValueError):
            E.with_labels(good, spark.createDataFrame(bad, "question_id string, knowledge_module string"))
    images = spark.createDataFrame([(True, ["images/a.png"], ["0" * 64]), (True, None, None), (False, ["../a.png"], ["0" * 64])], "has_image boolean, image_paths array<string>, image_sha256 array<string>")
    assert [r.images_ok for r in E.image_references(images).collect()] == [True, False, False]
