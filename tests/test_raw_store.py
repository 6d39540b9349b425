"""The folder of raw responses as a data source."""

import os

import pytest

from gleanery.sources import files, raw_store


@pytest.fixture
def store(spark, tmp_path):
    raw_store.register(spark)
    for i in range(40):
        files.save_raw(str(tmp_path), f"https://a.example/{i}.html", b"x" * (100 + i), "text/html", http_status=200 + i)
    return str(tmp_path)


def test_rows_and_bodies(spark, store):
    df = spark.read.format("raw_store").load(store)
    got = {r.url: r for r in df.collect()}
    assert len(got) == 40 and got["https://a.example/7.html"].size == 107 and '"http_status": 207' in got["https://a.example/7.html"].about
    bodies = spark.read.format("raw_store").option("bodies", "true").load(store)
    assert bodies.selectExpr("sha2(body, 256) = content_hash ok").filter("not ok").count() == 0
    assert bodies.filter("size > 130").count() == 9


def test_partitions_by_size_and_names_of_urls(store):
    reader = raw_store.RawReader(store, 1000, False)
    parts = reader.partitions()
    assert len(parts) >= 5 and sorted(n for p in parts for n in p.names) == sorted(raw_store.stem(f"https://a.example/{i}.html") for i in range(40))
    asked = raw_store.RawReader(store, 1000, False)
    left = list(asked.pushFilters([raw_store.EqualTo(("url",), "https://a.example/3.html"), raw_store.EqualTo(("content_type",), "text/html")]))
    assert len(left) == 1 and [p.names for p in asked.partitions()] == [[raw_store.stem("https://a.example/3.html")]]
    again = [list(asked.read(p)) for p in asked.partitions()]
    assert again == [list(asked.read(p)) for p in asked.partitions()] and len(again[0]) == 1


def test_filters_reach_the_source(spark, store):
    df = spark.read.format("raw_store").load(store)
    wanted = df.filter("url in ('https://a.example/3.html', 'https://a.example/5.html', 'https://b.example/') and size > 104")
    assert [r.url for r in wanted.collect()] == ["https://a.example/5.html"] and wanted.rdd.getNumPartitions() == 1
    assert df.filter("url = 'https://b.example/'").count() == 0


def test_unfinished_responses_are_no_rows(spark, store):
    name = raw_store.stem("https://a.example/1.html")
    os.remove(os.path.join(store, name + ".html"))
    open(os.path.join(store, "half.html.tmp"), "wb").close()
    open(os.path.join(store, "lonely.html"), "wb").close()
    assert spark.read.format("raw_store").load(store).count() == 39
    assert spark.read.format("raw_store").load(store).filter("url = 'https://a.example/1.html'").count() == 0
