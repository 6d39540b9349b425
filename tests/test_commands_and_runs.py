"""Commands, sinks, tables of results, and what the record and run operators say of odd input."""

import json

import pytest
from pyspark.sql import functions as F

from gleanery import cli
from gleanery.operators import conform, dedup, runs
from gleanery.plans.views import flat, records
from gleanery.sources import files
from tests.conftest import SF


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("data") / "records")
    files.write_jsonl(records(spark, SF).filter("length(question) < 700").drop("_ord"), path)
    return path


def run(capsys, *args):
    assert cli.main([str(a) for a in args]) == 0
    return json.loads(capsys.readouterr().out)


def test_commands(spark, stored, tmp_path, capsys):
    n = run(capsys, "normalize", "--input", stored, "--output", tmp_path / "n")["rows"]
    assert n == files.read_jsonl(spark, stored).count()
    said = run(capsys, "validate", "--input", tmp_path / "n", "--output", tmp_path / "v", "--report", tmp_path / "v.json", "--latest-year", 2027)
    assert said["report"]["total"] == n and json.loads((tmp_path / "v.json").read_text())["total"] == n
    said = run(capsys, "deduplicate", "--input", tmp_path / "v", "--output", tmp_path / "d", "--report-dir", tmp_path / "dedup")
    assert said["records"] == n and json.loads((tmp_path / "dedup/summary.json").read_text())["records"] == n
    run(capsys, "export-review", "--input", tmp_path / "d", "--output", tmp_path / "sheet")
    said = run(capsys, "merge-review", "--input", tmp_path / "d", "--review", tmp_path / "sheet", "--output", tmp_path / "m", "--report", tmp_path / "m.json")
    assert (said["input_rows"], said["merged"], said["errors"]) == (n, n, [])
    assert run(capsys, "report", "--input", tmp_path / "m", "--output", tmp_path / "r.json")["total"] == n
    assert run(capsys, "export-csv", "--input", tmp_path / "m", "--output", tmp_path / "csv", "--dry-run")["output"] is None and not (tmp_path / "csv").exists()
    assert cli.main(["normalize", "--input", stored, "--output", stored]) == 2
    with pytest.raises(SystemExit):
        cli.main(["validate", "--input", "x", "--output", "y", "--latest-year", "0"])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x "q"\n2'), ("b", None)], "id string, text string")
    files.write_once(df, str(tmp_path / "c"), "csv")
    part = next((tmp_path / "c").glob("part-*"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbfid,text")
    with pytest.raises(Exception, match="(?i)already exists"):
        files.write_once(df, str(tmp_path / "c"), "csv")
    files.write_once(df, str(tmp_path / "j"), "jsonl")
    assert spark.read.text(str(tmp_path / "j")).count() == 2
    table = str(tmp_path / "t")
    for k, rows in enumerate([[("q1", "direct", "api_error"), ("q2", "cot", "correct")], [("q1", "direct", "correct")]]):
        files.replace_results(spark, spark.createDataFrame([(*r, k) for r in rows], "question_id string, mode string, status string, finished_at int"), table, ["question_id", "mode"])
    now = files.current_results(spark, table, ["question_id", "mode"])
    assert sorted(tuple(r) for r in now.collect()) == [("q1", "direct", "correct", 1), ("q2", "cot", "correct", 0)]


def test_files_are_read_once(spark):
    found = spark.createDataFrame([("/x/a.png", "1"), ("/x/b.png", "2"), ("/x/c.png", "3")], "path string, sha256 string")
    cache = spark.createDataFrame([("a", "1"), ("b", "old")], "stem string, sha256 string")
    assert sorted(r.stem for r in files.unread_files(found, cache).collect()) == ["b", "c"]
    assert files.unread_files(found, cache, force=True).count() == 3


def test_small_tables_are_dealt_out(spark):
    df = files.table(spark, f"{SF}/documents.parquet")
    assert df.rdd.getNumPartitions() == 4 and df.count() == 200
    plan = df.select("doc_id").filter("doc_id > 5")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in plan and "GreaterThan(doc_id,5)" in plan


def test_records_without_hashes_are_no_duplicates(spark):
    r = records(spark, SF).filter("_ord < 3").withColumn("provenance", F.col("provenance").withField("ordered_hash", F.lit("")).withField("permutation_hash", F.lit("")))
    assert {x.s for x in dedup.duplicate_statuses(r).select(F.col("quality.duplicate_status").alias("s")).collect()} == {"unique"}


def test_reordered_pairs_leave_out_ids_of_exact_pairs(spark):
    """Ids that repeat: a pair of ids that is an exact pair elsewhere is no reordered one."""
    r = flat(spark, SF).filter("id = 1").crossJoin(spark.createDataFrame([(1, "x", "h1"), (2, "y", "h1"), (3, "x", "h2"), (4, "z", "h2")], "o int, q string, h string"))
    base = records(spark, SF).filter("_ord = 1").drop("_ord", "question_id")
    rows = base.crossJoin(r.select(F.col("o").alias("_ord"), F.col("q").alias("question_id"), "h"))
    rows = rows.withColumn("provenance", F.col("provenance").withField("ordered_hash", F.col("h")).withField("permutation_hash", F.lit("p")))
    got = {tuple(sorted((x.question_id_1, x.question_id_2))) for x in dedup.reordered_pairs(rows).collect()}
    assert got == {("y", "z")} and {(x.question_id_1, x.question_id_2) for x in dedup.exact_pairs(rows).collect()} == {("x", "y"), ("x", "z")}


def test_built_records_conform_but_for_their_ids(spark):
    out = conform.build_records(spark.createDataFrame([("CHIS_000001", "GROUP_1")], "question_id string, group_id string"))
    assert conform.nonconforming(out).count() == 0
    assert conform.nonconforming(conform.build_records(spark.createDataFrame([("x",)], "question_id string"))).count() == 2


def test_runs_without_results_show_planned_items(spark):
    items = spark.createDataFrame([(1, "FACT", "", [], ""), (2, "TIME", None, ["images/a.png"], "")], "question_id long, ai_primary_ability string, primary_ability string, image_paths array<string>, knowledge_module string")
    res = spark.createDataFrame([("m", 1, "direct", "correct")], "model string, question_id long, mode string, status string")
    got = {(r.grouping, r.value, r.mode): (r.planned, r.attempted, r.pairs) for r in runs.group_summary(items, res).collect()}
    assert got["all", "", "cot"] == (2, 0, 0) and got["ability", "REASON", "direct"] == (0, 0, 0) and got["modality", "text", "direct"] == (1, 1, 0) and not any(g == "module" for g, _, _ in got)
