"""Tables of results through deaths and races; the sequence ratio; bootstrap from counts."""

import itertools
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from gleanery.functions import sequence
from gleanery.functions import text as T
from gleanery.operators import dedup, evaluation, normalize
from gleanery.sources.results import ResultTable

SCHEMA = "question_id string, mode string, status string, finished_at long"


def rows(*those):
    return [(f"q{q}", m, s, t) for q, m, s, t in those]


def held(table):
    return sorted(tuple(r) for r in table.current().collect())


def test_the_last_row_of_a_key_counts(spark, tmp_path):
    make = lambda *r: spark.createDataFrame(rows(*r), SCHEMA).coalesce(1)
    table = ResultTable(spark, str(tmp_path / "t"), ["question_id", "mode"], buckets=3)
    with pytest.raises(ValueError):
        table.current()
    table.add(make((1, "d", "bad", 1), (2, "d", "ok", 1)))
    table.add(make((1, "d", "ok", 3), (3, "c", "ok", 2)))
    table.add(make((1, "d", "late", 2)))
    want = rows((1, "d", "ok", 3), (2, "d", "ok", 1), (3, "c", "ok", 2))
    assert held(table) == want and table.manifest()["generation"] == 3
    first, second, third = table.manifest()["parts"]
    table.compact([second, third])  # the first part is not read: it may even be away
    assert held(table) == want and table.manifest()["parts"][0] == first and len(table.manifest()["parts"]) == 2
    assert table.clean() == sorted([second, third]) and held(table) == want
    again = ResultTable(spark, str(tmp_path / "t"))
    assert again.keys == ["question_id", "mode"] and again.buckets == 3
    assert [tuple(r) for r in again.current(make((3, "c", "", 0), (9, "c", "", 0))).collect()] == rows((3, "c", "ok", 2))
    table.add(make((1, "d", "", 0)).filter("mode = 'none'"))
    assert held(table) == want
    with pytest.raises(ValueError):
        ResultTable(spark, str(tmp_path / "t"), ["mode"])
    with pytest.raises(ValueError):
        ResultTable(spark, str(tmp_path / "none"))


def test_a_job_that_dies_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    """Compaction and addition killed before the manifest; races of two writers and of two compactions."""
    make = lambda *r: spark.createDataFrame(rows(*r), SCHEMA).coalesce(1)
    table = ResultTable(spark, str(tmp_path / "t"), ["question_id", "mode"], buckets=2)
    table.add(make((1, "d", "bad", 1)))
    table.add(make((1, "d", "ok", 2)))
    want, before = held(table), table.manifest()

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(ResultTable, "_commit", dies)
        for step in (table.compact, lambda: table.add(make((5, "d", "ok", 9)))):
            with pytest.raises(KeyboardInterrupt):
                step()
    assert table.manifest() == before and held(table) == want and len(table.clean()) == 2 and held(table) == want
    # another writer commits while a compaction is at work: both stay
    write = ResultTable._write

    def slow(self, df):
        name = write(self, df)
        if len(seen) == 0:
            seen.append(1)
            other.add(make((7, "d", "ok", 1)))
        return name

    other, seen = ResultTable(spark, str(tmp_path / "t")), []
    with monkeypatch.context() as m:
        m.setattr(ResultTable, "_write", slow)
        table.compact()
    assert held(table) == sorted(want + rows((7, "d", "ok", 1)))
    parts = table.manifest()["parts"]
    other.compact(parts)
    with pytest.raises(RuntimeError):
        table.compact(parts)
    assert held(table) == sorted(want + rows((7, "d", "ok", 1)))


def changed(rng, text, times):
    out = list(text)
    for _ in range(times):
        i = rng.randrange(len(out) + 1)
        roll = rng.random()
        if roll < 0.4 and out:
            out.pop(min(i, len(out) - 1))
        elif roll < 0.8:
            out.insert(i, rng.choice("abcxyz "))
        else:
            j = rng.randrange(len(out) + 1)
            out[i:i] = out[j : j + rng.randint(1, 30)]
    return "".join(out)


def test_ratio_is_the_library_s():
    """Random and repetitive texts, short and beyond the length at which frequent characters start no stretch."""
    rng = random.Random(3)
    for _ in range(1500):
        letters, most = "abcdefghijklmnopqrstuvwxyz"[: rng.choice([1, 2, 3, 8, 26])], rng.choice([0, 1, 5, 20, 60, 150, 199, 200, 201, 260, 400])
        a = "".join(rng.choice(letters) for _ in range(rng.randint(0, most)))
        roll = rng.random()
        b = changed(rng, a, rng.randint(0, 20)) if roll < 0.6 else "".join(rng.choice(letters) for _ in range(rng.randint(0, most)))
        if roll > 0.9:
            b = (b[:7] * 60)[: rng.randint(0, 420)]
        want = SequenceMatcher(None, a, b)
        assert sequence.ratio(a, b) == want.ratio() and sequence.at_most(a, b) >= want.ratio() - 1e-12
        assert sequence.longest_stretch(a, 0, len(a), b, 0, len(b), sequence.frequent(b)) == tuple(want.find_longest_match(0, len(a), 0, len(b)))


def test_ratio_of_whole_texts_and_its_bound():
    """Texts whose stretches start at few characters, against the library; below the bound a number under it will do."""
    rng = random.Random(6)
    words = ["".join(rng.choice("eeeeetttaaaoooinshrdlucmfwypvbgkqjxzQZ.,") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([60, 300, 900]))) for _ in range(30)]
    for a in texts:
        for b in (changed(rng, a, rng.choice([1, 5, 40])), rng.choice(texts)):
            want = SequenceMatcher(None, a, b).ratio()
            assert sequence.ratio(a, b) == want
            for least in (0.3, 0.7, 0.95):
                got = sequence.ratio(a, b, sequence.counted(b), least)
                assert got == want if want >= least else got < least


def test_suspected_pairs_of_whole_documents(spark):
    """Long records against the loop over all pairs."""
    rng = random.Random(8)
    words = ["".join(rng.choice("etaoinshrdlucmfwypvbgkqjxz") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    base = [" ".join(rng.choice(words) for _ in range(rng.choice([30, 200]))) for _ in range(6)]
    texts = base + [changed(rng, t, k) for t in base for k in (1, 2, 4, 12)] + [base[0], "", "a b"]
    full = {"shared_material": F.lit(""), "answer": F.lit("A"), "options": F.struct(*(F.lit(x).alias(x) for x in "ABCD")), "source": F.struct(F.lit("s").alias("source_id")), "quality": F.struct(F.lit("verified").alias("answer_status")), "provenance": F.struct(F.lit("allowed").alias("license_status"))}
    df = spark.createDataFrame([(str(i), t, t, i) for i, t in enumerate(texts)], "question_id string, question string, normalized_question string, _ord long").withColumns(full)
    got = {(int(r.question_id_1), int(r.question_id_2)): r.similarity for r in dedup.suspected_pairs(normalize.with_hashes(df)).collect()}

    def grams(t):
        t = "".join(t.split())
        return {t[i : i + 3] for i in range(len(t) - 2)}

    want = {}
    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = (f"|{texts[k]}|A|B|C|D" for k in (i, j))
        if texts[i] != texts[j]:
            x, y = grams(a), grams(b)
            score = round((SequenceMatcher(None, a, b).ratio() + len(x & y) / len(x | y)) / 2, 6)
            if score >= 0.88:
                want[i, j] = score
    assert got == want and len(want) >= 6


def test_similar_sets_by_sketches(spark, monkeypatch):
    """All pairs by size and sketch, in several chunks a band, against the loop; rows that are the same are not asked for."""
    monkeypatch.setattr(dedup, "CHUNK", 16)
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.choice([4, 9, 30, 200, 1200]))) for _ in range(30)]
    texts = base + [changed(rng, t, k) for t in base for k in (0, 1, 3)] + ["", " ", "a", "ab", "ab", "a b c", "abc", "日本🙂日本", "日本🙂日本🙂"]
    same = [i % 7 if i % 2 else None for i in range(len(texts))]
    sets = [set(dedup.gram_set("".join(t.split()), 3).tolist()) for t in texts]
    for tau in (0.3, 0.76, 1.0):
        got = [(r.a, r.b, round(r.jaccard, 9)) for r in dedup.similar_sets(spark.createDataFrame(list(zip(range(len(texts)), texts, same)), "id long, text string, same int"), tau).collect()]
        want = {(i, j, round(len(x & y) / len(x | y), 9)) for (i, x), (j, y) in itertools.combinations(enumerate(sets), 2) if x and y and len(x & y) >= tau * len(x | y) and (same[i] is None or same[i] != same[j])}
        assert sorted(got) == sorted(want) and len(want) > 10


def test_n_grams_are_those_of_the_text(spark):
    texts = ["", " \t", "ab", "abc", "a b　c d", "日本🙂日本🙂日", None, "aaaaaa"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("t", T.ngrams(F.col("t"), 3).alias("g")).collect():
        t = "".join((r.t or "").split())
        assert len(r.g) == len(set(r.g)) and set(r.g) == ({t} if 0 < len(t) <= 3 else {t[i : i + 3] for i in range(len(t) - 2)})


def test_bootstrap_from_counts_is_the_seeded_one(spark):
    """Bounds within four standard errors of a bound's own sampling error; groups of one pair and without changes."""
    rng = random.Random(2)
    data = [(m, i, *rng.choices([("correct", "correct"), ("incorrect", "correct"), ("correct", "incorrect"), ("incorrect", "incorrect")], w)[0]) for m, n, w in (("a", 900, (5, 3, 1, 1)), ("b", 60, (1, 1, 1, 1)), ("c", 1, (1, 0, 0, 0)), ("d", 40, (1, 0, 0, 1))) for i in range(n)]
    df = spark.createDataFrame(data, "model string, question_id long, direct string, cot string")
    got = {r.model: r for r in evaluation.bootstrap_bounds(df, ["model"]).collect()}
    for r in evaluation.bootstrap_interval(df, ["model"]).collect():
        n = got[r.model].n
        spread = max(r.boot_high - r.boot_low, 0) / 3.92
        assert abs(got[r.model].boot_low - r.boot_low) <= 4 * spread * (2.7 / 2000**0.5 * 2) + 1.01 / n * (spread > 0) and abs(got[r.model].boot_high - r.boot_high) <= 4 * spread * (2.7 / 2000**0.5 * 2) + 1.01 / n * (spread > 0)
    assert got["c"].n == 1 and (got["c"].boot_low, got["d"].boot_high) == (0.0, 0.0)


def test_bitmaps_intersect_as_counts_do(spark):
    """Ids over several ranges, their borders, and ids that are not positive."""
    rng = random.Random(6)
    ids = [0, 1, 2, 32_767, 32_768, 32_769, 65_536, 65_537, 10**12, -1, -32_767, -32_768, -40_000, *(rng.randrange(200_000) for _ in range(300))]
    rows = [(m, q, mode, "correct") for q in set(ids) for m in ("a", "b") for mode in ("direct", "cot") if rng.random() < 0.85]
    df = spark.createDataFrame([*rows, ("c", 1, "other", "x")], "model string, question_id long, mode string, status string").filter("model <> 'c'")
    want = sorted(r.question_id for r in evaluation.common_questions(df).collect())
    assert sorted(r.question_id for r in evaluation.numbered_in_all(df).collect()) == want and len(want) > 100
    assert evaluation.numbered_in_all(df.filter("model = 'z'")).count() == 0


def test_tables_of_pairs_are_not_broadcast(spark, monkeypatch):
    """Pairs take next to nothing on disk and much in memory: joins with them do not go by the size of their files."""
    import re

    plans, write = {}, dedup.written

    def noted(df, tag="table"):
        plans[tag] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, tag)

    monkeypatch.setattr(dedup, "written", noted)
    rows = [(str(i), f"which of these events came first in the year {1900 + i % 3}", i) for i in range(12)]
    df = spark.createDataFrame(rows, "question_id string, question string, _ord long").withColumns({"normalized_question": F.col("question"), "shared_material": F.lit(""), "answer": F.lit("A")})
    df = df.withColumns({"options": F.struct(*(F.lit(x).alias(x) for x in "ABCD")), "source": F.struct(F.lit("s").alias("source_id"))})
    df = df.withColumns({"quality": F.struct(F.lit("verified").alias("answer_status")), "provenance": F.struct(F.lit("allowed").alias("license_status"))})
    out = dedup.suspected_pairs(normalize.with_hashes(df), 0.8)
    plans["out"] = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 48
    for tag in ("near", "scored", "out"):
        assert "SortMergeJoin [a#" in plans[tag] and not re.search(r"(BroadcastHash|ShuffledHash)Join \[[ab]#", plans[tag]), tag
