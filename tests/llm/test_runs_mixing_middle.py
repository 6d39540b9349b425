"""Periodic runs, mixing and fill-in-the-middle: brute force, SQL, exact round trips and odd inputs."""

import hashlib
import inspect
import itertools
import math
import random
import re
import zlib
from array import array

import duckdb
import pytest
from pyspark.sql import functions as F

from gleanery.llm import fill_in_middle, mixing, periodic_runs
from tests.conftest import SF, normal

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(fill_in_middle.UNIT)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, runs string, size string, u string, output string, target string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, repeated rows, ties, and columns whose names clash."""
    long = "word again " * 30_000
    rows = [(None, None, None, None), (1, "", "en", "s"), (1, "", "en", "s"), (2, None, "de", None), (3, long, "en", "s"), (4, " \t\n\x0b\x0c\r", None, "s"), (None, "a b　c é🙂", "xx", "S"), (5, "x y z", "en", "t"), (5, "x y z", "en", "t"), (5, "x y z", "en", "t")]
    return spark.createDataFrame([(*r, len(r[1] or ""), "a", "b", "c", "d", "e") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    return c


def all_runs(codes, least):
    """Every maximal stretch of every period, the smallest period of each."""
    out = {}
    for p in range(1, len(codes) // 2 + 1):
        i = 0
        while i + p < len(codes):
            if codes[i] != codes[i + p]:
                i += 1
                continue
            s = i
            while i + p < len(codes) and codes[i] == codes[i + p]:
                i += 1
            if i + p - s >= max(least, 2 * p):
                out.setdefault((s, i + p - s), p)
    return sorted((s, n, p) for (s, n), p in out.items())


def test_runs_equal_brute_force():
    for n in range(1, 11):
        for codes in itertools.product(range(2), repeat=n):
            assert periodic_runs.runs_of(list(codes), 2) == all_runs(codes, 2)
    rng = random.Random(1)
    for _ in range(3000):
        n, k = rng.randint(1, 70), rng.choice([1, 2, 3, 4, 8])
        codes = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            a, p, m = rng.randrange(n), rng.randint(1, 12), rng.randint(1, n)
            for i in range(a + p, min(n, a + m)):
                codes[i] = codes[i - p]
        least = rng.choice([2, 12])
        assert periodic_runs.runs_of(codes, least) == all_runs(codes, least)


def test_matches_take_linear_work():
    """Counted in the code itself: at most 2 n words compared beyond the first for strings full of runs."""
    source = inspect.getsource(periodic_runs.lyndon_edges)
    step = "                        k += 1\n"
    assert source.count(step) == 1
    seen = [0]
    space = {"array": array, "seen": seen}
    exec(source.replace(step, step + "                        seen[0] += 1\n"), space)
    fib = [0], [0, 1]
    while len(fib[1]) < 6000:
        fib = fib[1], fib[1] + fib[0]
    thue = [bin(i).count("1") & 1 for i in range(6000)]
    rng = random.Random(3)
    for codes in (fib[1], thue, [0] * 6000, [0, 1] * 3000, [0] * 3000 + [1] * 3000, [rng.randrange(2) for _ in range(6000)], [rng.randrange(5) for _ in range(100)] * 60, ([0] * 99 + [1]) * 60):
        for w in (codes, [1 + max(codes) - c for c in codes]):
            seen[0] = 0
            space["lyndon_edges"](array("i", [*w, -1]), len(w))
            assert seen[0] <= 2 * len(w)


def test_runs_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = periodic_runs.op11_lyndon_runs(spark, SF).collect()
    assert len(got) == len(texts) and sum(r.n_runs > 0 for r in got) > 10
    for r in got:
        words = WORD.findall(texts[r.doc_id] or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1200:
            continue
        runs = all_runs(words, 12)
        assert r.n_runs == len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()


def test_runs_of_odd_rows(spark, odd, nothing):
    got = sorted(periodic_runs.periodic_runs(odd).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.n_words))
    assert len(got) == 10 and got[0].runs == [] and got[0].collapsed == ""
    assert [(r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got if r.doc_id == 3] == [(60_000, [(0, 60_000, 2)], "word again")]
    assert [r.collapsed for r in got if r.doc_id is None] == ["", "a b　c é🙂"]
    assert periodic_runs.periodic_runs(nothing).count() == 0
    made = odd.select(periodic_runs.with_periods(F.col("text"), F.col("doc_id")).alias("t")).collect()
    assert len(made) == 10 and made[0].t is None


def test_middle_query_is_the_sql(spark, con):
    (name,) = fill_in_middle.QUERIES
    got = fill_in_middle.QUERIES[name](spark, SF)
    want = con.execute(fill_in_middle.ORACLE[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert normal([tuple(r) for r in got.select(*cols).collect()]) == normal(want[cols].itertuples(index=False, name=None))


def test_middle_round_trip(spark, odd, nothing, monkeypatch):
    """Units are those of the regular expression, stretches or not, and every output gives its text back."""
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "bc", "é", "🙂", " ", "  ", "\n", "\t", "　", "<", ">", "P>", "<S", "\x00"]) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(fill_in_middle, "STRETCH", 7)
    ends = fill_in_middle.unit_ends()
    for t in texts:
        assert ends(t).tolist() == [m.end() for m in UNIT.finditer(t)]
    made = fill_in_middle.fill_in_middle(docs, rate=90).withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    for r in made:
        t = texts[r.doc_id]
        assert r.back == t and r.n == len(UNIT.findall(t))
        if r.form != "plain":
            a, b = r.prefix_chars, r.prefix_chars + r.middle_chars
            assert r.output == (f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}" if r.form == "psm" else f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}")
    rows = fill_in_middle.fill_in_middle(odd, rate=100).collect()
    assert len(rows) == 10 and [(r.n, r.form, r.output) for r in rows if r.doc_id == 1] == [(0, "plain", "")] * 2
    assert [r.n for r in rows if r.doc_id == 4] == [1] and [r.n for r in rows if r.doc_id == 3] == [60_001]
    assert len({(r.form, r.output) for r in rows if r.doc_id == 5}) == 1
    assert fill_in_middle.fill_in_middle(nothing).count() == 0


def test_mix_query_is_the_sql(spark, con):
    (name,) = mixing.QUERIES
    got = mixing.QUERIES[name](spark, SF)
    want = con.execute(mixing.ORACLE[name]).df()
    cols = sorted(got.columns)
    rows = got.select(*cols).collect()
    assert cols == sorted(want.columns)
    assert normal([tuple(r) for r in rows]) == normal(want[cols].itertuples(index=False, name=None))
    assert normal([tuple(r) for r in rows]) == normal([tuple(r) for r in mixing.QUERIES[name](spark, SF).select(*cols).collect()])


def by_hand(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets of {source: size}: shares by weight, the excess of full sources shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    full, left = set(), share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        rest = left - sum(most * sizes[s] for s in full)
        t = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        above = {s for s in free if t[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else t[s] for s in order}
        full |= above


@pytest.mark.parametrize("seed", range(2))
def test_mix_meets_its_targets(spark, seed):
    """Sources of all sizes: one document, one giant among small ones, copies of one row, no words."""
    rng = random.Random(seed)
    rows = []
    for s in ["a", "b", "c", "d", "Z", None, "é", "empty", "copies", "one"]:
        for _ in range({"one": 1, "empty": 3, "copies": 0}.get(s, rng.randint(2, 60))):
            n = 0 if s == "empty" else rng.choice([1, 5, 30, 400]) if rng.random() < 0.95 else 9000
            rows.append((len(rows), s, " ".join(["w"] * n)))
    rows += [(9999, "copies", "x y z")] * 57
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    got = mixing.mix(docs, keep=("text",))
    found = got.collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    targets = by_hand(sizes)
    taken = {s: 0 for s in sizes}
    for r in found:
        assert r.size == len(r.text.split()) and 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        taken[r.source] += r.taken
    for s in sizes:
        assert targets[s] - 1 - 57 * (s == "copies") <= taken[s] <= targets[s] + 1e-6
    assert len({r.taken for r in found if r.source == "copies"}) == 1
    copies = mixing.repeated(got)
    assert copies.agg(F.sum("words")).first()[0] == sum(taken.values())
    again = mixing.mix(docs.repartition(2))
    assert normal([tuple(r) for r in again.collect()]) == normal([tuple(r)[:-1] for r in found])


def test_inclusion_follows_size(spark):
    """Over seeds, documents are sampled about in proportion to their words, and large ones are certain."""
    sizes = [10, 20, 40, 80] * 30 + [5000]
    docs = spark.createDataFrame([(i, "s", "w " * n) for i, n in enumerate(sizes)], "doc_id long, source string, text string").coalesce(1).cache()
    hits = [0] * len(sizes)
    for seed in range(8):
        for r in mixing.mix(docs, share=0.85, seed=seed).collect():
            hits[r.doc_id] += r.taken == r.size
    assert hits[-1] == 8
    rest, squares = 0.85 * sum(sizes) - 5000, sum(n * n for n in sizes[:-1])
    for n in (10, 20, 40, 80):
        p = rest / squares * n
        mean = sum(h for h, s in zip(hits, sizes, strict=True) if s == n) / 240
        assert abs(mean - p) < 4 * math.sqrt(p * (1 - p) / 240) + 0.02


def test_mix_of_odd_rows(spark, odd, nothing):
    got = mixing.mix(odd).collect()
    assert len(got) == 10 and all(r.taken <= 2 * r.size for r in got) and sum(r.size for r in got) == 60_000 + 3 + 9
    assert {r.source for r in got} == {"s", "S", "t", None} and all(r.taken == 0 for r in got if r.size == 0)
    assert mixing.mix(nothing).count() == 0
    assert [r.target for r in mixing.mix(odd.filter("doc_id = 1")).collect()] == [0.0, 0.0]


def test_a_run_drops_its_own_tables_only(spark):
    from gleanery.llm.common import drop_tables, own_tables, written

    before = written(spark.range(3).toDF("a"))
    with own_tables():
        first, last = written(spark.range(4).toDF("a")), written(spark.range(5).toDF("a"))
        assert drop_tables(spark, 0) == 2
    assert before.count() == 3 and last.count() == 5
    with pytest.raises(Exception):
        first.count()
