"""Segmented scans against plain loops, and what is built on them."""

import itertools
import random

from pyspark.sql import functions as F

from gleanery.operators import scan
from gleanery.operators.evaluation import error_islands
from gleanery.sources import files


def test_prefix_sums_and_row_numbers(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b"]), rng.choice([None, 0, 1, 5])) for i in rng.sample(range(10_000), 700)]
    df = spark.createDataFrame(rows, "k long, g string, v int").repartition(7)
    got = {r.k: r for r in scan.prefix_sums(df, ["k"], before="v", n=F.lit(1)).collect()}
    total = 0
    for n, (k, g, v) in enumerate(sorted(rows)):
        assert (got[k].before, got[k].n, got[k].g, got[k].v) == (total, n, g, v)
        total += v or 0
    assert [r.n for r in scan.row_numbers(df, ["g", "k"], "n").orderBy("g", "k").collect()] == list(range(1, 701))
    assert scan.row_numbers(df.filter("k < 0"), ["k"], "n").count() == 0
    same = spark.createDataFrame([(1,)] * 50, "k int")
    assert sorted(r.n for r in scan.row_numbers(same, ["k"], "n").collect()) == list(range(1, 51))


def loops(rows):
    out = []
    for g, of in itertools.groupby(sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])), key=lambda r: r[0]):
        for flag, run in itertools.groupby(of, key=lambda r: bool(r[2])):
            run = list(run)
            if flag:
                out.append((g, run[0][1], run[-1][1], len(run)))
    return sorted(out, key=str)


def test_runs_equal_a_loop(spark):
    """Runs shorter than a range, across two, over many, and of groups that end inside one; ranges are a few rows each."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rng = random.Random(5)
    try:
        for parts, size, shares in (("4", 60, (0.5, 1.0)), ("17", 120, (0.1, 0.7, 0.95))):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            for p in shares:
                rows = [(rng.choice(["hot", "hot", "hot", "x", None]), i, None if rng.random() < 0.02 else rng.random() < p) for i in range(size)]
                df = spark.createDataFrame(rows, "g string, o long, f boolean").repartition(3)
                got = [tuple(r) for r in scan.runs(df, "g", "o", F.col("f")).collect()]
                assert sorted(got, key=str) == loops(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert scan.runs(df.filter("o < 0"), "g", "o", F.col("f")).count() == 0


def test_no_window_over_a_whole_model(spark):
    """The plan that reads rows has windows by range only: the one by model sees what touches the ends of ranges."""
    log = spark.range(5000).select(F.lit("m").alias("model"), F.col("id").alias("event_id"), F.when(F.col("id") % 10 < 6, "api_error").otherwise("correct").alias("status"))
    found = error_islands(log, "event_id", limit=6)
    assert found.count() == 500 and found.filter("tripped").count() == 500 and found.agg(F.sum("n")).first()[0] == 3000
    ranges = scan.in_order(log, ["model", "event_id"]).groupBy("_part").count().collect()
    assert len(ranges) > 1 and max(r["count"] for r in ranges) < 4000


def test_lines_of_several_sheets(spark, tmp_path):
    for name, n in (("a", 5), ("b", 1), ("c", 300)):
        (tmp_path / f"{name}.csv").write_text("﻿id,note\n" + "".join(f'{name}{i},"x\ny"\n' for i in range(n)), encoding="utf-8")
    got = files.read_sheet(spark, str(tmp_path), ["id", "note"]).collect()
    assert len(got) == 306 and all(r.line == int(r.id[1:]) + 2 and r.sheet.endswith(f"/{r.id[0]}.csv") for r in got)
