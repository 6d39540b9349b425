"""Whole records from pages: numbers over groups and pages, sources, evidence, images, options of the page itself."""

from pyspark.sql import functions as F

from gleanery.operators import ingest as I
from gleanery.schema import RECORD

PAGE = """<div class=g><p class=m>text</p><div class=q><h2>one</h2><ul><li data-option=A>A. x<li data-option=b>y<li>Ｃ、z<li data-option=D>D：w</ul><b>答案：B</b><i>why</i></div>
<div class=q><h2>two</h2><img src="a.png"><img src=""><img src="b.png"></div></div><div class=g></div><div class=g><div class=q><h2>three</h2></div></div>"""
SPEC = I.Selectors(group="div.g", block="div.q", question="h2", option="li", material=".m", answer="b", explanation="i")


def test_records_of_pages(spark):
    pages = spark.createDataFrame([(2, PAGE, "https://x.example/2", "h2", None), (1, PAGE, "https://x.example/1", "h1", 1999), (3, "<p>none</p>", "u", "h", 1), (4, "<div class=g><div class=q><h2>four</h2></div></div>", "https://x.example/4", "h4", 2001)], "n int, html string, url string, sha string, y int")
    about = I.PageContext(source_id="src", site_name="Site", url=F.col("url"), raw_file=F.concat(F.lit("raw/"), F.col("sha")), content_hash=F.col("sha"), collector="me", year=F.col("y"), license_status="allowed")
    got = I.html_records(pages, SPEC, about, ["n"], question_start=5, group_start=10, now="2024-05-06T07:08:09+00:00").orderBy("question_id").collect()
    assert [c.split()[0] for c in RECORD.split(", ")] == list(got[0].asDict())
    assert [r.question_id for r in got] == [f"CHIS_{i:06d}" for i in range(5, 12)]
    # a group without blocks has its number all the same
    assert [r.group_id for r in got] == [f"GROUP_{i:06d}" for i in (10, 10, 12, 13, 13, 15, 16)]
    first, second = got[0], got[1]
    assert (first.question, first.raw_question, first.shared_material, first.answer, first.answer_explanation) == ("one", "one", "text", "B", "why")
    assert first.options.asDict() == {"A": "x", "B": "y", "C": "z", "D": "w"} == first.raw_options.asDict()
    assert [(e.source_id, e.answer) for e in first.answer_evidence] == [("src", "B")] and first.quality.answer_status == "single_source" and first.quality.parse_status == "parsed"
    assert (second.quality.answer_status, second.has_image, second.image_paths, [tuple(i) for i in second.quality.issues]) == ("missing", True, [], [("unresolved_image_reference", "warning", "a.png; b.png")])
    assert (first.source.url, first.source.year, first.source.retrieved_at, first.provenance.raw_file, first.provenance.license_status, first.quality.collector) == ("https://x.example/1", 1999, "2024-05-06T07:08:09+00:00", "raw/h1", "allowed", "me")
    assert first.source_records == [first.source] and got[3].source.year is None and got[6].source.url == "https://x.example/4"
    assert first.schema_version == "0.1.0" and second.answer_evidence == [] and first.labels.primary_ability == ""


CUT = ["a&amp;&amp", "&amp;lt; &lt;b&gt;", "x &quot;y&quot", "&copy; &amp;copy;", "A&B &a"]


def test_only_named_references_are_resolved(spark):
    """A reference that was cut short, or one that the pages do not escape, is text; by default all of HTML's are resolved."""
    pages = spark.createDataFrame([(i, f"<body><article><h1>{t}</h1></article></body>") for i, t in enumerate(CUT)], "n int, html string")
    spec = I.Selectors(group="body", block="article", question="h1", option="li")
    title = lambda **more: [r.raw_question for r in I.parse_pages(pages, spec, **more).orderBy("n").collect()]
    assert title(references=("lt", "gt", "amp")) == [t.replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&") for t in CUT]
    assert title(references=()) == CUT
    assert title() == ["a&&", "&lt; <b>", 'x "y"', "© &copy;", "A&B &a"]


def test_records_keep_a_reference_cut_short(spark):
    pages = spark.createDataFrame([(1, "<div class=g><div class=q><h2>a &amp;&amp</h2></div></div>")], "n int, html string")
    about = I.PageContext(source_id="s", site_name="s", url="u", raw_file="r", content_hash="h")
    for references, want in ((("lt", "gt", "amp"), "a &&amp"), (None, "a &&")):
        row = I.html_records(pages, SPEC, about, ["n"], now="t", references=references).first()
        assert row.question == row.raw_question == row.normalized_question == want


def test_pages_without_groups_give_no_records(spark):
    pages = spark.createDataFrame([(1, "<p>x</p>"), (2, "")], "n int, html string")
    about = I.PageContext(source_id="s", site_name="", url="u", raw_file="", content_hash="")
    assert I.html_records(pages, SPEC, about, ["n"]).count() == 0
