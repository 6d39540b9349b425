"""Crawl state, gates, raw files, and the parsing of pages and exam sources into records."""

from __future__ import annotations

from dataclasses import dataclass, fields

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleanery.functions import text as T
from gleanery.operators.conform import build_records
from gleanery.operators.scan import prefix_sums
from gleanery.schema import LETTERS, RECORD

# Provinces in the order they are looked for, suffixes that are kept, retryable HTTP codes.
PROVINCES_SHORT = ("北京", "上海", "天津", "重庆", "江苏", "浙江", "山东", "广东", "福建")
PROVINCES = (
    "北京", "上海", "天津", "重庆", "河北", "山西", "辽宁", "吉林", "黑龙江", "江苏", "浙江", "安徽", "福建", "江西", "山东", "河南", "湖北", "湖南", "广东", "海南", "四川", "贵州", "云南", "陕西", "甘肃",
)
SUFFIXES = (".html", ".htm", ".pdf", ".txt", ".json")
RETRY_CRAWL = (408, 425, 429, 500, 502, 503, 504)
# Words that point at pictures, words of a second term, and the patterns of item_year.
PICTURE_CUES = ("图", "表", "漫画", "地图", "下表", "下图", "如图")
LATE_TERMS = ("下学期", "第二学期", "期末", "春季", "3月", "4月", "5月", "6月", "7月")


def in_scope(url: Column, base_url: Column, allowed: Column) -> Column:
    """Whether a URL's host is the base URL's, an allowed domain, or a subdomain of either."""
    host = lambda u: F.lower(F.coalesce(F.try_parse_url(u, F.lit("HOST")), F.lit("")))
    domains = F.concat(F.transform(F.coalesce(allowed, F.array().cast("array<string>")), F.lower), F.array(host(base_url)))
    h = host(url)
    return F.exists(domains, lambda d: (d != "") & ((h == d) | h.endswith(F.concat(F.lit("."), d))))


def crawl_refusals() -> Column:
    """All reasons, '; '-joined, why a registry row may not be crawled; '' if it may. Column `authenticated` counts."""
    reasons = F.array(
        F.when(F.col("status") != "approved", "status is not approved"),
        F.when(F.col("login_required") & ~F.col("authenticated"), "login is required; use --authenticated with an existing local session"),
        F.when(~F.col("robots_checked"), "robots policy has not been checked"),
        F.when(~F.col("terms_checked"), "terms have not been checked"),
        F.when(F.col("license_status") == "restricted", "licence is restricted"),
    )
    return F.array_join(F.filter(reasons, lambda x: x.isNotNull()), "; ")


def raw_suffix(url: Column, content_type: Column) -> Column:
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    found = F.lower(F.regexp_extract(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), r"(\.[A-Za-z0-9]+)$", 1))
    return F.when(kind.contains("pdf"), ".pdf").when(kind.contains("html"), ".html").when(found.isin(*SUFFIXES), found).otherwise(".bin")


def raw_name(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 20)


def crawl_outcome(status: Column) -> Column:
    """What a crawler makes of an HTTP status: success, retry or failed."""
    return F.when(status.between(200, 299), "success").when(status.isin(*RETRY_CRAWL), "retry").otherwise("failed")


def is_answer_image(content: Column) -> Column:
    """A PNG of 10,000 bytes or more."""
    return (F.hex(F.substring(content, 1, 8)) == "89504E470D0A1A0A") & (F.octet_length(content) >= 10_000)


def fold_state(log: DataFrame) -> DataFrame:
    """The state of each (source_id, url) from its log of attempts, successes and failures, in order of `seq`.

    Maxima by seq are combined before the shuffle, so a URL with a long log is no burden. A success or failure without
    an attempt counts as one; a success clears the error, a failure keeps the last file and its fingerprint. The log's columns
    http_status, content_hash and error_type are optional, and null where it has none.
    """
    lacking = {"http_status": "int", "content_hash": "string", "error_type": "string"}
    log = log.withColumns({c: F.lit(None).cast(t) for c, t in lacking.items() if c not in log.columns})
    at = lambda kind, c: F.max_by(c, F.when(F.col("kind") == kind, F.col("seq")))
    seq = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("seq")))
    first = F.min_by("kind", "seq")
    out = log.groupBy("source_id", "url").agg(
        F.max_by("kind", "seq").alias("_last"), (F.count_if(F.col("kind") == "attempt") + F.when(first != "attempt", 1).otherwise(0)).alias("attempts"), F.max_by("updated_at", "seq").alias("updated_at"),
        at("success", F.struct("raw_file", "content_hash", "http_status")).alias("_file"), seq("success").alias("_ok"), seq("failure").alias("_bad"),
        at("failure", F.struct(F.substring("message", 1, 2000).alias("message"), "error_type", "http_status")).alias("_error"),
    )
    failed = F.col("_bad") > F.coalesce("_ok", F.lit(-1))
    status = F.when(F.col("_last") == "attempt", "pending").when(F.col("_last") == "success", "success").otherwise("failed")
    of_error = lambda c: F.when(failed, F.col(f"_error.{c}"))
    return out.select(
        "source_id", "url", status.alias("status"), "attempts", F.when(failed, F.col("_error.http_status")).otherwise(F.col("_file.http_status")).alias("http_status"), F.col("_file.raw_file").alias("raw_file"),
        F.col("_file.content_hash").alias("content_hash"), of_error("error_type").alias("error_type"), of_error("message").alias("error_message"), "updated_at",
    )


def get_state(state: DataFrame, source_id: str, url: str) -> DataFrame:
    """The row of one URL, with `succeeded`: whether its last outcome is a success that left a file."""
    done = (F.col("status") == "success") & (F.coalesce("raw_file", F.lit("")) != "")
    return state.filter((F.col("source_id") == source_id) & (F.col("url") == url)).withColumn("succeeded", done)


def successful_files(state: DataFrame, source_id: str, limit: int | None = None) -> DataFrame:
    """Successful rows of a source by updated_at, the first `limit` of them if asked."""
    out = state.filter((F.col("source_id") == source_id) & (F.col("status") == "success")).orderBy("updated_at", "url")
    return out.limit(limit) if limit is not None else out


def page_kind(pages: DataFrame, minimum: int = 30) -> DataFrame:
    """(doc_id, kind) from pages (doc_id, text): text if all pages have enough characters, scan if none, else mixed."""
    full = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)\s+", "")) >= minimum
    flags = pages.groupBy("doc_id").agg(F.bool_and(full).alias("a"), F.bool_or(full).alias("o"))
    return flags.select("doc_id", F.when(F.col("a"), "text").when(~F.col("o"), "scan").otherwise("mixed").alias("kind"))


def split_options(text: Column) -> Column:
    """struct(question, A..D) of a text with its options in line, or null: at least four option marks, every letter
    there; a later mark of a letter counts."""
    def of_pieces(parts: Column, pieces: Column) -> Column:
        named = F.transform(pieces, lambda p: F.struct(F.substring(p, 1, 1).alias("k"), T.strip(F.regexp_replace(p, r"(?U)\A[A-D][.、．]\s*", "")).alias("v")))
        return T.let(named, lambda n: of_named(parts, n))

    def of_named(parts: Column, named: Column) -> Column:
        last = lambda x: F.try_element_at(F.filter(named, lambda p: p["k"] == x), F.lit(-1))["v"]
        letters = F.array_distinct(F.transform(named, lambda p: p["k"]))
        complete = (F.size(parts) >= 5) & F.forall(letters, lambda k: k.isin(*LETTERS)) & (F.size(letters) == 4)
        return F.when(complete, F.struct(T.strip(parts[0]).alias("question"), *(last(x).alias(x) for x in LETTERS)))

    def of_parts(parts: Column) -> Column:
        rest = F.filter(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), T.strip), lambda p: p != "")
        pieces = F.flatten(F.transform(rest, lambda p: F.transform(F.split(p, r"(?U)\s+(?=[B-D][.、．])"), T.strip)))
        return T.let(pieces, lambda x: of_pieces(parts, x))

    parts = F.split(text, r"(?=[A-D][.、．])")
    # Spark leaves out an empty first part, which stands for an empty question
    return T.let(F.when(text.rlike(r"\A[A-D][.、．]"), F.concat(F.array(F.lit("")), parts)).otherwise(parts), of_parts)


def exam_year(text: Column, title: bool = False) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), r"(19\d\d|20\d\d)", 1), F.lit("")).cast("int")


def province(text: Column, names=PROVINCES) -> Column:
    return F.coalesce(*(F.when(text.contains(p), p) for p in names), F.lit("全国"))


def item_year(info: Column) -> Column:
    """struct(year, reason) of a question's citation line: the exam's year, an academic year, a class year, a year, or the
    date of entry; none after 2026."""
    t = T.strip(F.coalesce(info, F.lit("")))
    number = lambda c: F.nullif(c, F.lit("")).cast("int")
    cap = lambda y: F.when(y.isNotNull(), F.least(y, F.lit(2026)))  # noqa: E731  (least leaves nulls out)
    exam = number(F.regexp_extract(t, r"(20[12]\d)年(?:[0-9一二三四五六七八九十月]+)?(?:[^\s|]+)?高考", 1))
    cited = F.when(t.contains("引用："), F.regexp_extract(t, r"(?s)引用：(.*)\z", 1)).otherwise(t)
    tokens = F.transform(F.split(cited, r"(?<=[卷题练测考])"), T.strip)
    dated = F.filter(tokens, lambda e: e.rlike("202[0-6]|201"))
    target = F.coalesce(F.try_element_at(dated, F.lit(1)), cited)
    cite = F.concat(F.lit("名校考卷引用："), F.substring(target, 1, 45))
    start, end = (number(F.regexp_extract(target, r"(20[12]\d)[-—至]20(\d\d)学年", i)) for i in (1, 2))
    late = target.rlike("|".join(LATE_TERMS))
    academic = F.when(start >= 2026, 2026).when(late, cap(2000 + end)).otherwise(cap(start))
    grade = cap(number(F.regexp_extract(target, r"(20[12]\d)届", 1)))
    plain = cap(number(F.regexp_extract(target, r"(20[12]\d)年", 1)))
    entered = F.regexp_extract(t, r"((20[12]\d)/\d{2}/\d{2})", 1)
    uploaded = cap(number(F.regexp_extract(t, r"(20[12]\d)/\d{2}/\d{2}", 1)))
    pick = lambda y, why: F.struct(y.cast("int").alias("year"), why.alias("reason"))
    none = pick(F.lit(None), F.lit(""))
    return (
        F.when((t == "") | t.contains("该试题已被下架"), none).when(exam.isNotNull(), pick(cap(exam), F.concat(F.lit("历年高考统考真题("), exam.cast("string"), F.lit("年)"))))
        .when(start.isNotNull(), pick(academic, cite)).when(grade.isNotNull(), pick(grade, cite)).when(plain.isNotNull(), pick(plain, cite))
        .when(uploaded.isNotNull(), pick(uploaded, F.concat(F.lit("题库系统录入时间("), entered, F.lit(")")))).otherwise(none)
    )


@dataclass(frozen=True)
class Selectors:
    """What to look for in a page: `tag.class`, `.class` or `tag`."""

    group: str
    block: str
    question: str
    option: str
    material: str = ""
    answer: str = ""
    explanation: str = ""
    image: str = "img"
    label: str = "data-option"


def html_blocks(spec: Selectors, references: tuple[str, ...] | None = None):
    """A pandas function html -> [{group, material, question, options, answer, explanation, images}], tolerant of unclosed tags.

    references: the names of the character references that are resolved, each with its semicolon, where pages escape no others; any
    other ampersand stands for itself. None: all that HTML knows, some of them without a semicolon.
    """
    import re

    bare = None if references is None else re.compile(f"&(?!(?:{'|'.join(map(re.escape, references))});)" if references else "&")

    def parse(html: str):
        from html.parser import HTMLParser

        void = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

        class Tree(HTMLParser):
            def __init__(self):
                super().__init__(convert_charrefs=True)
                self.root = ("", {}, [])
                self.stack = [self.root]

            def handle_starttag(self, tag, attrs):
                closes = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}.get(tag, ())
                if len(self.stack) > 1 and self.stack[-1][0] in closes:
                    self.stack.pop()
                node = (tag, {k: v or "" for k, v in attrs}, [])
                self.stack[-1][2].append(node)
                if tag not in void:
                    self.stack.append(node)

            def handle_startendtag(self, tag, attrs):
                self.stack[-1][2].append((tag, {k: v or "" for k, v in attrs}, []))

            def handle_endtag(self, tag):
                for k in range(len(self.stack) - 1, 0, -1):
                    if self.stack[k][0] == tag:
                        del self.stack[k:]
                        break

            def handle_data(self, data):
                if self.stack[-1][0] not in ("script", "style"):
                    self.stack[-1][2].append(data)

        tree = Tree()
        tree.feed(bare.sub("&amp;", html or "") if bare else html or "")
        tree.close()

        def all_of(node, selector):
            tag, _, cls = selector.partition(".")
            out, stack = [], list(reversed(node[2]))
            while stack:
                x = stack.pop()
                if not isinstance(x, str):
                    if (not tag or x[0] == tag) and (not cls or cls in x[1].get("class", "").split()):
                        out.append(x)
                    stack.extend(reversed(x[2]))
            return out

        def text(node):
            out, stack = [], [node]
            while stack:
                x = stack.pop()
                if isinstance(x, str):
                    if x.strip():
                        out.append(x.strip())
                else:
                    stack.extend(reversed(x[2]))
            return " ".join(out)

        def first(node, selector):
            found = all_of(node, selector) if selector else []
            return text(found[0]) if found else ""

        rows = []
        for g, group in enumerate(all_of(tree.root, spec.group)):
            for block in all_of(group, spec.block):
                options = [{"label": o[1].get(spec.label, ""), "text": text(o)} for o in all_of(block, spec.option)]
                rows.append({
                    "group": g, "material": first(group, spec.material), "question": first(block, spec.question), "options": options, "answer": first(block, spec.answer),
                    "explanation": first(block, spec.explanation), "images": [i[1]["src"] for i in all_of(block, spec.image) if i[1].get("src")],
                })
        return rows

    return parse


BLOCKS = "array<struct<group:int,material:string,question:string,options:array<struct<label:string,text:string>>,answer:string,explanation:string,images:array<string>>>"


def parse_pages(pages: DataFrame, spec: Selectors, html: str = "html", references: tuple[str, ...] | None = None) -> DataFrame:
    """One row per question block of pages: the pages' columns but html, then block (its number in the page), group_no,
    shared_material, raw_question, options A..D, answer, explanation, images. Pages without groups give no rows.

    The tree is built in Python over Arrow batches; options and answers are expressions. references: as of html_blocks.
    """
    parse = html_blocks(spec, references)

    def run(s):
        return s.map(parse)

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    blocks = F.pandas_udf(run, BLOCKS)
    rows = pages.withColumn("_b", blocks(html)).select(*(c for c in pages.columns if c != html), F.posexplode("_b").alias("block", "b"))
    marked = r"(?U)^\s*([A-DＡ-Ｄa-dａ-ｄ])[.．、:：)）\s]+(.+)$"
    label = lambda o: F.upper(F.trim(o["label"]))
    named = F.transform("b.options", lambda o: F.when(
        label(o).isin(*LETTERS), F.struct(label(o).alias("k"), F.regexp_replace(o["text"], r"(?iU)^\s*[A-D][.．、:：)）\s]+", "").alias("v"))
    ).otherwise(F.struct(F.upper(F.translate(F.regexp_extract(o["text"], marked, 1), T.WIDE, T.NARROW)).alias("k"), T.strip(F.regexp_extract(o["text"], marked, 2)).alias("v"))))
    option = lambda x: F.coalesce(F.try_element_at(F.filter(named, lambda o: o["k"] == x), F.lit(-1))["v"], F.lit(""))
    kept = [c for c in pages.columns if c != html]
    return rows.select(
        *kept, "block", F.col("b.group").alias("group_no"), F.col("b.material").alias("shared_material"), F.col("b.question").alias("raw_question"), F.struct(*(option(x).alias(x) for x in LETTERS)).alias("options"),
        T.answer_of(F.col("b.answer")).alias("answer"), F.col("b.explanation").alias("explanation"), F.col("b.images").alias("images"),
    )


ADAPTERS: dict = {}


def adapter(name: str):
    """Registers a function DataFrame -> DataFrame as the adapter of a source; names are unique."""

    def register(fn):
        if name in ADAPTERS:
            raise ValueError(f"adapter {name} is there already")
        ADAPTERS[name] = fn
        return fn

    return register


def get_adapter(name: str):
    if not name or name not in ADAPTERS:
        raise LookupError(f"no adapter {name!r}")
    return ADAPTERS[name]


def _records(rows: DataFrame, group: str, paper: Column) -> DataFrame:
    """Common columns of the exam adapters from (idx, raw, stem, opts, answer, year, province, material, explanation, images)."""
    idx = F.col("idx").cast("string")
    return rows.select(
        F.concat(F.lit("CHIS_"), F.lpad(idx, 6, "0")).alias("question_id"), F.concat(F.lit(f"GROUP_{group}_"), F.col("year").cast("string"), F.lit("_"), F.lpad(idx, 4, "0")).alias("group_id"),
        F.col("material").alias("shared_material"), F.col("raw").alias("raw_question"), F.col("stem").alias("question"), F.col("opts").alias("options"), "answer", F.col("explanation").alias("answer_explanation"),
        "year", "province", paper.alias("paper_title"), F.col("images").alias("image_paths"), F.when(F.size("images") > 0, "image_dependent").otherwise("not_image_dependent").alias("image_dependency"), F.lit("single_source").alias("answer_status"),
    )


@adapter("agieval_adapter")
def agieval(lines: DataFrame) -> DataFrame:
    """lines: (idx, json) of non-blank lines in order; items without four options or a letter are left out."""
    schema = "question string, passage string, options array<string>, label string, answer string, other struct<source:string>"
    x = lines.select("idx", F.from_json("json", schema).alias("x")).select("idx", "x.*")
    source = F.coalesce("other.source", F.lit("高考历史试卷"))
    answer = F.coalesce(F.nullif("label", F.lit("")), F.col("answer"))
    rows = x.filter((F.size("options") == 4) & answer.isin(*LETTERS)).select(
        "idx", T.strip(F.coalesce("question", F.lit(""))).alias("raw"), T.without_score(T.strip(F.coalesce("question", F.lit("")))).alias("stem"),
        F.struct(*(T.strip(F.regexp_replace(F.col("options")[i], r"(?U)^\(?([A-D])\)?[.、．\s]*", "")).alias(k) for i, k in enumerate(LETTERS))).alias("opts"), answer.alias("answer"),
        F.coalesce(exam_year(source), F.lit(2018)).alias("year"), province(source, PROVINCES_SHORT).alias("province"), F.coalesce("passage", F.lit("")).alias("material"), F.lit("").alias("explanation"),
        F.array().cast("array<string>").alias("images"), source.alias("source"),
    )
    return _records(rows, "AGIEVAL", F.col("source"))


def _gaokao(items: DataFrame, group: str, suffix: str) -> DataFrame:
    answer = F.coalesce(F.try_element_at("answer", F.lit(1)), F.lit(""))
    # an exploded array of one: its element is made once, whatever is asked of it later
    whole = F.filter(F.array(split_options(F.col("question"))), lambda p: p.isNotNull() & (p["question"] != ""))
    rows = items.filter(answer.isin(*LETTERS)).withColumn("p", F.explode(whole))
    year = F.when(F.col("year").cast("string").rlike("^[0-9]+$"), F.col("year").cast("int")).otherwise(2022)
    images = F.transform(F.coalesce("picture", F.array().cast("array<string>")), lambda p: F.concat(F.lit("assets/"), F.element_at(F.split(p, "/"), -1)))
    rows = rows.select(
        "idx", F.col("p.question").alias("raw"), T.without_score(F.col("p.question")).alias("stem"), F.struct(*(F.col(f"p.{x}").alias(x) for x in LETTERS)).alias("opts"), answer.alias("answer"), year.alias("year"),
        F.lit("全国").alias("province"), F.lit("").alias("material"), T.strip(F.coalesce("analysis", F.lit(""))).alias("explanation"), images.alias("images"),
    )
    return _records(rows, group, F.concat(F.col("year").cast("string"), F.lit(f"年普通高等学校招生全国统一考试历史真题{suffix}")))


@adapter("gaokao_bench_adapter")
def gaokao_bench(items: DataFrame) -> DataFrame:
    """items: (idx, question, answer array, year, analysis)."""
    return _gaokao(items.withColumn("picture", F.array().cast("array<string>")), "GAOKAOBENCH", "")


@adapter("gaokao_mm_adapter")
def gaokao_mm(items: DataFrame) -> DataFrame:
    """items: (idx, question, answer array, year, analysis, picture array)."""
    return _gaokao(items, "GAOKAOMM", "（图文版）")


@adapter("zujuan_adapter")
def zujuan(blocks: DataFrame) -> DataFrame:
    """blocks: (idx, title, text, div_id, info, images) of a paper's question blocks, idx within the paper.

    Ids come from the number in div_id modulo a million, so papers can share ids; there are no answers.
    """
    title = T.strip(F.regexp_replace("title", "(?s)-组卷网.*$", ""))
    rows = blocks.withColumn("p", split_options(F.col("text"))).withColumn("stem", T.without_score(F.col("p.question"))).filter(F.col("p").isNotNull() & (F.length("stem") > 5))
    rows = rows.filter(" and ".join(f"p.{x} <> ''" for x in LETTERS))
    number = F.coalesce(F.nullif(F.regexp_extract(F.coalesce("div_id", F.lit("")), r"(\d+)", 1), F.lit("")), F.col("idx").cast("string"))
    found = item_year(F.col("info"))
    web = F.filter(F.coalesce("images", F.array().cast("array<string>")), lambda s: s.startswith("http"))
    images = F.transform(web, lambda s: F.concat(F.lit("assets/zujuan_"), number, F.lit("_"), F.element_at(F.split(F.element_at(F.split(s, r"\?"), 1), "/"), -1)))
    cue = F.col("stem").rlike("|".join(PICTURE_CUES))
    return rows.select(
        F.concat(F.lit("CHIS_"), F.lpad((number.cast("decimal(38,0)") % 1_000_000).cast("string"), 6, "0")).alias("question_id"), F.concat(F.lit("GROUP_ZUJUAN_000000_"), F.lpad(F.col("idx").cast("string"), 3, "0")).alias("group_id"),
        F.col("stem").alias("question"), F.struct(*(F.col(f"p.{x}").alias(x) for x in LETTERS)).alias("options"), F.lit("").alias("answer"), F.coalesce(exam_year(title), found["year"]).alias("year"), found["reason"].alias("year_reason"),
        province(title).alias("province"), title.alias("paper_title"), images.alias("image_paths"), F.when(F.size(images) == 0, "not_image_dependent").when(cue, "image_dependent").otherwise("needs_review").alias("image_dependency"), number.alias("source_question_number"),
    )


def paper_links(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """(pid, first_page) of the papers that list pages (page_no, html) link to, in order of first sight."""
    ids = pages.select("page_no", F.posexplode(F.regexp_extract_all("html", F.lit(r"/17p(\d+)\.html"), 1)).alias("i", "pid"))
    first = ids.groupBy("pid").agg(F.min(F.struct("page_no", "i")).alias("f")).orderBy("f")
    out = first.select("pid", F.col("f.page_no").alias("first_page"))
    return out.limit(limit) if limit is not None else out


def ocr_confidence(lines: DataFrame) -> DataFrame:
    """(doc_id, page, text, confidence) from (doc_id, page, line_no, text, confidence); malformed lines (no text) are left out."""
    good = lines.filter("text is not null")
    return good.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n").alias("text"), F.avg("confidence").alias("confidence"))


def page_records(blocks: DataFrame, order: list[str], question_start: int = 1, group_start: int = 1) -> DataFrame:
    """Blocks of parse_pages with question_id, group_id, answer_status, has_image and issues: ids count blocks and groups of all
    pages in the order of the columns `order`, which tell pages apart, then of the page. Groups without blocks count up to a page's last
    one with some.

    A page's blocks are numbered by themselves; its two totals are summed up over the pages before it by ranges of pages.
    """
    totals = blocks.groupBy(*order).agg(F.count("*").alias("_blocks"), (F.max("group_no") + 1).alias("_groups"))
    totals = prefix_sums(totals, order, _blocks="_blocks", _groups="_groups")
    page = Window.partitionBy(*order)
    out = blocks.withColumns({"_q": F.row_number().over(page.orderBy("block")), "_g": F.col("group_no") + 1}).join(totals, order)
    number = lambda c, start, prefix: F.concat(F.lit(prefix), F.lpad((c + (start - 1)).cast("string"), 6, "0"))
    picture = F.size("images") > 0
    issue = F.struct(F.lit("unresolved_image_reference").alias("code"), F.lit("warning").alias("severity"), F.array_join("images", "; ").alias("message"))
    return out.select(
        *blocks.columns, number(F.col("_q") + F.col("_blocks"), question_start, "CHIS_").alias("question_id"), number(F.col("_g") + F.col("_groups"), group_start, "GROUP_").alias("group_id"),
        F.when(F.col("answer") == "", "missing").otherwise("single_source").alias("answer_status"), picture.alias("has_image"), F.when(picture, F.array(issue)).otherwise(F.array()).alias("issues"),
    )


@dataclass(frozen=True)
class PageContext:
    """Where pages come from, for the source, evidence and provenance of their records: columns of the pages, or values for all."""

    source_id: Column | str
    site_name: Column | str
    url: Column | str
    raw_file: Column | str
    content_hash: Column | str
    license_status: Column | str = "unknown"
    collector: Column | str = ""
    paper_title: Column | str = ""
    year: Column | int | None = None
    province: Column | str = ""
    exam_type: Column | str = ""
    retrieved_at: Column | str = ""

    def column(self, now: str) -> Column:
        """All of it as one struct; retrieved_at is `now` where nothing is known."""
        given = {f.name: getattr(self, f.name) for f in fields(self)}
        cols = {k: v if isinstance(v, Column) else F.lit(v) for k, v in given.items()}
        cols |= {k: F.coalesce(c.cast("string"), F.lit("")) for k, c in cols.items() if k != "year"} | {"year": cols["year"].cast("int")}
        cols["retrieved_at"] = F.coalesce(F.nullif(cols["retrieved_at"], F.lit("")), F.lit(now))
        return F.struct(*(c.alias(k) for k, c in cols.items()))


def html_records(pages: DataFrame, spec: Selectors, context: PageContext, order: list[str], question_start: int = 1, group_start: int = 1, html: str = "html", now: str | None = None, references: tuple[str, ...] | None = None) -> DataFrame:
    """Whole records of the question blocks of pages, numbered over all pages in the order of the columns `order`.

    An answer is evidence of the page's source; images are issues until they are saved. now: the time of pages that have none,
    when the plan is made if not given. references: as of html_blocks.
    """
    about = context.column(now or T.utc_now_iso())
    blocks = parse_pages(pages.select(*order, html, about.alias("_about")), spec, html, references)
    rows = page_records(blocks, order, question_start, group_start)
    text = lambda c: F.col(f"_about.{c}").alias(c)
    source = F.struct(*map(text, ("source_id", "site_name", "url", "paper_title", "year", "province", "exam_type", "retrieved_at")))
    kinds = {f.name: f.dataType for f in StructType.fromDDL(RECORD).fields}
    one = kinds["answer_evidence"].elementType
    full = F.struct(*((F.col("_about.source_id") if f.name == "source_id" else F.col("answer") if f.name == "answer" else F.lit(None).cast(f.dataType)).alias(f.name) for f in one.fields))
    evidence = F.when(F.col("answer") != "", F.array(full)).otherwise(F.array().cast(kinds["answer_evidence"]))
    page = F.struct(*((source[f.name] if f.name != "page_number" else F.lit(None).cast("int")).alias(f.name) for f in kinds["source"].fields))
    quality = F.struct("answer_status", F.lit("parsed").alias("parse_status"), text("collector"), "issues")
    parts = rows.select(
        *order, "question_id", "group_id", "shared_material", "raw_question", F.col("raw_question").alias("normalized_question"), F.col("raw_question").alias("question"), F.col("options").alias("raw_options"), "options", "answer",
        F.col("explanation").alias("answer_explanation"), evidence.alias("answer_evidence"), "has_image", page.alias("source"), F.array(page).alias("source_records"), quality.alias("quality"),
        F.struct(*map(text, ("raw_file", "content_hash", "license_status"))).alias("provenance"),
    )
    return build_records(parts)


def registry_frame(spark: SparkSession, sources: list[dict]) -> DataFrame:
    schema = "source_id string, base_url string, status string, login_required boolean, robots_checked boolean, terms_checked boolean, license_status string, allowed_domains array<string>, adapter string"
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(s.get(n) for n in names) for s in sources], schema)
