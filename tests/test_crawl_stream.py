"""Keyed crawl state of a stream against the fold of its whole log."""

import datetime
import random
import time

import pandas as pd
import pytest

from gleanery.operators.ingest import fold_state
from gleanery.streaming import crawl
from tests.conftest import normal

SCHEMA = "source_id string, url string, kind string, seq long, updated_at timestamp, raw_file string, content_hash string, http_status int, message string, error_type string"


def entries(seed, n):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        kind = rng.choice(["attempt", "attempt", "success", "failure"])
        good, bad = kind == "success", kind == "failure"
        rows.append((f"s{rng.randrange(2)}", f"u{rng.randrange(6)}", kind, seq, datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC) + datetime.timedelta(seconds=seq), f"f{seq}" if good else None, f"h{seq}" if good else None, 200 if good else 500 if bad else None, "m" * 3000 if bad else None, "E" if bad else None))
    return rows


def test_the_fold_composes_in_any_order():
    """Folding parts in any order gives one state."""
    rng = random.Random(1)
    names = [c.split()[0] for c in crawl.LOG.split(", ")[2:]]
    for seed in range(30):
        rows = [(k, s, int(t.timestamp()) * 1_000_000, f, h, c, m, e) for _, _, k, s, t, f, h, c, m, e in entries(seed, 25)]
        whole = crawl.folded(crawl.NOTHING, pd.DataFrame(rows, columns=names))
        rng.shuffle(rows)
        state, at = crawl.NOTHING, 0
        while at < len(rows):
            size = rng.randint(1, 9)
            state = crawl.folded(state, pd.DataFrame(rows[at : at + size], columns=names))
            at += size
        assert state == whole


@pytest.mark.parametrize("order", ["in order", "late"])
def test_state_of_any_split_is_the_fold(spark, tmp_path, order):
    """Batches of other sizes, late entries, and a new start from the checkpoint between any two."""
    rows = entries(7, 80)
    parts = list(rows)
    if order == "late":
        random.Random(3).shuffle(parts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for k, (lo, hi) in enumerate(((0, 11), (11, 60), (60, 80))):
            spark.createDataFrame(parts[lo:hi], SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"log/{k}"))
            stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "log/*"))
            crawl.keep_state(stream, str(tmp_path / "out"), str(tmp_path / "cp"), wait=0.0, keep=30).awaitTermination()
            want = fold_state(spark.createDataFrame(parts[:hi], SCHEMA))
            got = crawl.kept_state(spark, str(tmp_path / "out"))
            assert normal([tuple(r) for r in got.collect()]) == normal([tuple(r) for r in want.select(*got.columns).collect()])
            time.sleep(1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert crawl.due_retries(spark, str(tmp_path / "out")).count() > 0
