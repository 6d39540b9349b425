"""Open records, JSON-schema conformance, and sinks that count."""

import json
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from gleanery import cli
from gleanery.operators import json_schema, open_records
from gleanery.operators.validate import validate_records
from gleanery.plans import open_queries
from gleanery.schema import record_document
from gleanery.sources import files
from tests.conftest import normal

DOCUMENT = {
    "type": "object", "required": ["n", "o"], "minProperties": 2, "maxProperties": 7,
    "properties": {
        "n": {"type": "integer", "minimum": 1, "exclusiveMaximum": 4}, "s": {"type": "string", "pattern": "^X[0-9]+$", "minLength": 2, "maxLength": 3}, "e": {"enum": ["", "A", 3, None, True]}, "o": {"$ref": "#/$defs/o"},
        "l": {"type": ["array", "null"], "items": {"$ref": "#/$defs/o"}, "minItems": 1, "maxItems": 2}, "f": {"type": ["number", "null"], "maximum": 1}, "u": {"type": "array", "uniqueItems": True, "prefixItems": [{"type": "string"}], "items": {"type": "integer"}},
        "q": {"anyOf": [{"type": "string"}, {"type": "integer", "minimum": 2}], "not": {"const": "no"}}, "k": {"oneOf": [{"minimum": 1}, {"maximum": 2}], "if": {"type": "number"}, "then": {"minimum": 0}, "else": {"type": "string"}},
    },
    "patternProperties": {"^p_": {"type": "boolean"}}, "additionalProperties": {"type": ["string", "null"]},
    "$defs": {"o": {"type": "object", "required": ["A", "B"], "properties": {"A": {"type": "string"}, "B": {"allOf": [{"type": "string"}, {"minLength": 1}]}}, "additionalProperties": False}},
}


def kind(x):
    if x is None:
        return {"null"}
    if isinstance(x, bool):
        return {"boolean"}
    if isinstance(x, (int, float)):
        return {"number", "integer"} if x == int(x) else {"number"}
    return {{str: "string", list: "array", dict: "object"}[type(x)]}


def walk(s, x, path="$"):
    """The violations of a value, by hand."""
    if "$ref" in s:
        yield from walk(DOCUMENT["$defs"][s["$ref"].rsplit("/", 1)[1]], x, path)
    number = isinstance(x, (int, float)) and not isinstance(x, bool)
    types = [s["type"]] if isinstance(s.get("type"), str) else s.get("type", [])
    same = lambda a, b: kind(a) == kind(b) and a == b
    bad = {
        "type": types and not kind(x) & set(types), "enum": "enum" in s and not any(same(x, e) for e in s["enum"]), "const": "const" in s and not same(x, s["const"]),
        "pattern": "pattern" in s and isinstance(x, str) and not re.search(s["pattern"], x), "minLength": isinstance(x, str) and len(x) < s.get("minLength", 0), "maxLength": isinstance(x, str) and len(x) > s.get("maxLength", 99),
        "minimum": number and x < s.get("minimum", -99), "maximum": number and x > s.get("maximum", 99), "exclusiveMaximum": number and x >= s.get("exclusiveMaximum", 99),
        "minItems": isinstance(x, list) and len(x) < s.get("minItems", 0), "maxItems": isinstance(x, list) and len(x) > s.get("maxItems", 99), "minProperties": isinstance(x, dict) and len(x) < s.get("minProperties", 0),
        "maxProperties": isinstance(x, dict) and len(x) > s.get("maxProperties", 99), "uniqueItems": s.get("uniqueItems") and isinstance(x, list) and any(same(a, b) for i, a in enumerate(x) for b in x[:i]),
        "anyOf": "anyOf" in s and all(list(walk(t, x)) for t in s["anyOf"]), "oneOf": "oneOf" in s and sum(not list(walk(t, x)) for t in s["oneOf"]) != 1, "not": "not" in s and not list(walk(s["not"], x)),
    }
    yield from ((path, word) for word, b in bad.items() if b)
    for t in s.get("allOf", []):
        yield from walk(t, x, path)
    if "if" in s:
        yield from walk(s["else"] if list(walk(s["if"], x)) else s["then"], x, path)
    if isinstance(x, dict):
        yield from ((f"{path}.{k}", "required") for k in s.get("required", []) if k not in x)
        for k, y in x.items():
            subs = [s["properties"][k]] if k in s.get("properties", {}) else []
            subs += [t for p, t in s.get("patternProperties", {}).items() if re.search(p, k)]
            more = s.get("additionalProperties", True)
            if not subs and more is False:
                yield f"{path}.{k}", "additionalProperties"
            for t in subs or ([more] if isinstance(more, dict) else []):
                yield from walk(t, y, f"{path}.{k}")
    if isinstance(x, list):
        first = s.get("prefixItems", [])
        for i, y in enumerate(x):
            t = first[i] if i < len(first) else s.get("items", {})
            yield from walk(t, y, f"{path}[{i}]")


def test_conformance_equals_a_walk(spark):
    rng = random.Random(4)
    scalar = lambda: rng.choice([0, 1, 2, 3, 4, 1.0, 2.5, 0.5, -1, True, False, None, "", "A", "X1", "X12\n", "X123", "y", "no", "é🙂"])

    def value(depth=0):
        roll = rng.random()
        if depth < 3 and roll < 0.25:
            return [value(depth + 1) for _ in range(rng.randint(0, 3))]
        if depth < 3 and roll < 0.45:
            return {k: value(depth + 1) for k in rng.sample(["A", "B", "C", "x y"], rng.randint(0, 3))}
        return scalar()

    docs = []
    for _ in range(400):
        d = {k: value() for k in rng.sample(["n", "s", "e", "o", "l", "f", "u", "q", "k", "p_1", "p_x", "more", "z"], rng.randint(0, 9))}
        for k in ("o", "l"):
            if rng.random() < 0.5:
                o = lambda: {x: rng.choice(["", "v", 1]) for x in rng.sample(["A", "B", "C"], rng.randint(1, 3))}
                d[k] = o() if k == "o" else [o() for _ in range(rng.randint(0, 3))]
        docs.append(d)
    docs += [[1], "x", 5, None]
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(-1, "{bad"), (-2, '{"a": 1, "a": 2}')], "id int, value string").withColumn("v", F.try_parse_json("value"))
    got = sorted((r.id, r.path, r.keyword) for r in json_schema.violations(rows, DOCUMENT, "v", "id").collect())
    want = sorted([(i, p, w) for i, d in enumerate(docs) for p, w in walk(DOCUMENT, d)] + [(-1, "$", "parse"), (-2, "$", "parse")])
    assert got == want and len({w for _, _, w in want}) >= 18


def test_schemas_that_cannot_be_checked_are_errors(spark):
    for wrong in ({"contains": {}}, {"$ref": "#/$defs/none"}, {"$ref": "other.json"}, {"enum": [[1]]}, {"$ref": "#"}, {"properties": {"a'\"b": {}}}):
        with pytest.raises(files.BadInput):
            json_schema.compiled(wrong)(F.col("v"))


def record(**more):
    full = {
        "schema_version": "0.1.0", "record_version": 1, "question_id": "CHIS_000001", "group_id": "GROUP_1", "shared_material": "", "raw_question": "q", "normalized_question": "q", "question": "q", "answer": "A",
        "raw_options": dict(zip("ABCD", "wxyz", strict=True)), "options": dict(zip("ABCD", "wxyz", strict=True)), "answer_explanation": "", "answer_evidence": [{"source_id": "s", "answer": "A", "weird": {"x": 1}}, {"source_id": "t", "answer": "B"}], "has_image": False, "image_paths": [],
        "source": {"source_id": "s", "site_name": "", "url": "https://x.example/1", "paper_title": "", "year": 2020, "province": "", "exam_type": "", "page_number": None, "retrieved_at": "", "extra": [1, {"y": None}]}, "source_records": [],
        "labels": dict.fromkeys(("primary_ability", "history_scope", "historical_period", "knowledge_point", "material_type"), ""),
        "quality": {"answer_status": "unchecked", "duplicate_status": "unchecked", "parse_status": "pending", "review_status": "pending", "image_dependency": "unknown", "issues": [], "collector": "", "reviewer": "", "notes": ""},
        "provenance": {"raw_file": "f", "content_hash": "", "ordered_hash": "", "permutation_hash": "", "crawler_version": "v0.1", "license_status": "unknown", "normalization_changes": [], "merged_occurrences": [{"id": 7}]},
    }
    return full | more


@pytest.fixture
def sheet(tmp_path):
    rows = [record(note={"deep": [1, 2.5, "x"]}), record(question_id="CHIS_000002", options={"A": "w", "B": "x", "C": "y", "D": "z", "E": "v"}), record(question_id="CHIS_3", options=["w"], answer="E", has_image="yes"), record(question_id="CHIS_000004", options={"A": "w", "B": " ", "C": "y", "D": "y"})]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text("\n\n".join(map(json.dumps, rows)) + "\n", encoding="utf-8")
    return tmp_path, rows


def test_unknown_fields_survive(spark, sheet):
    folder, rows = sheet
    records = files.read_open_jsonl(spark, str(folder / "in"))
    assert files.write_open_jsonl(records, str(folder / "same")) == 4
    back = sorted((json.loads(x) for p in (folder / "same").glob("part-*") for x in p.read_text().splitlines()), key=lambda r: r["question_id"])
    assert back == sorted(rows, key=lambda r: r["question_id"])
    changed = records.withColumn("options", F.col("options").withField("A", F.lit("new"))).withColumn("source", F.col("source").withField("year", F.lit(None).cast("int"))).withColumn("answer_evidence", F.reverse("answer_evidence"))
    files.write_open_jsonl(changed, str(folder / "other"))
    back = {r["question_id"]: r for r in (json.loads(x) for p in (folder / "other").glob("part-*") for x in p.read_text().splitlines())}
    r = back["CHIS_000002"]
    assert r["options"] == {"A": "new", "B": "x", "C": "y", "D": "z", "E": "v"} and r["source"]["year"] is None and r["source"]["extra"] == [1, {"y": None}]
    assert r["answer_evidence"] == [{"source_id": "t", "answer": "B"}, {"source_id": "s", "answer": "A", "weird": {"x": 1}}] and r["provenance"]["merged_occurrences"] == [{"id": 7}]
    assert back["CHIS_000001"]["note"] == {"deep": [1, 2.5, "x"]} and back["CHIS_3"]["has_image"] == "yes"
    assert [set(x.k or ()) for x in records.orderBy("question_id").select(F.map_keys(open_records.unknown_fields(F.col("_open"))).alias("k")).collect()] == [{"note"}, set(), set(), set()]


def test_option_keys_are_those_that_were_read(spark, sheet):
    folder, _ = sheet
    found = {r.question_id: {i.code for i in r.quality.issues} for r in validate_records(files.read_open_jsonl(spark, str(folder / "in")), 2026).collect()}
    assert "invalid_option_keys" not in found["CHIS_000001"] and {"empty_options", "duplicate_options"} <= found["CHIS_000004"]
    assert "invalid_option_keys" in found["CHIS_000002"] & found["CHIS_3"] and not found["CHIS_000002"] & {"empty_options", "duplicate_options"}


def test_malformed_lines_are_errors(spark, tmp_path):
    for k, line in enumerate(('{"a": ', "[1]", '{"a": 1, "a": 2}')):
        (tmp_path / f"{k}.jsonl").write_text('{"question_id": "x"}\n' + line + "\n")
        with pytest.raises(Exception, match="malformed line"):
            files.read_open_jsonl(spark, str(tmp_path / f"{k}.jsonl")).collect()


def test_record_document_and_command(spark, sheet, capsys):
    folder, _ = sheet
    found = json_schema.violations(files.read_open_jsonl(spark, str(folder / "in")), record_document(), "_open", "question_id")
    assert sorted(tuple(r) for r in found.collect()) == [("CHIS_000002", "$.options.E", "additionalProperties"), ("CHIS_3", "$.answer", "enum"), ("CHIS_3", "$.has_image", "type"), ("CHIS_3", "$.options", "type"), ("CHIS_3", "$.question_id", "pattern")]
    assert cli.main(["conform", "--input", str(folder / "in"), "--output", str(folder / "out")]) == 0
    said = json.loads(capsys.readouterr().out)
    assert said["rows"] == 5 and said["violations"] == {"additionalProperties": 1, "enum": 1, "type": 2, "pattern": 1}
    assert cli.main(["conform", "--dry-run", "--input", str(folder / "in"), "--output", str(folder / "none")]) == 0 and not (folder / "none").exists()


def test_sinks_count_in_the_job_that_writes(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(1000, numPartitions=3).withColumn("s", F.col("id").cast("string"))
    for k, write in enumerate((files.write_jsonl, files.write_csv)):
        spark.sparkContext.setJobGroup(f"sink-{k}", "")
        assert write(df, str(tmp_path / str(k))) == 1000
        assert len(tracker.getJobIdsForGroup(f"sink-{k}")) == 1
    spark.sparkContext.setJobGroup("none", "")


def test_round_trip_of_letters_that_the_full_mapping_makes_several(spark, tmp_path):
    """First letters like ß, whose capital is one character in SQL, and small letters that do not ask what stands around."""
    texts = ["ßa. ßb", "ß", "ᾳ. ᾀ", "ŉ. ﬁ", "İΣ. ÉΣ", "ΑΣ. aΣ", "x. y", "", None]
    rows = [(i, t, "de", len(t or ""), "s") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = open_queries.open_round_trip(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(open_queries.ROUND_SQL).df()[got.columns]
    assert normal([tuple(r) for r in got.collect()]) == normal(want.itertuples(index=False, name=None))
    assert {r["first"] for r in got.collect()} >= {"ẞ", "ᾼ", "ŉ"}
