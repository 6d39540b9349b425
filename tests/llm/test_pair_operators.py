"""Embedding near-duplicates, suffix arrays, the Jaccard join, components and the pipeline against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleanery.llm import embedding_dedup, jaccard_join, quality, secrets, suffix_dedup
from gleanery.llm.graph import components
from tests.conftest import SF


def union_find(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    want = union_find({x for e in edges for x in e}, edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {k: v for k, v in want.items() if k in got} == got
    assert all(want[n] == n and list(want.values()).count(n) == 1 for n in set(want) - set(got))
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def jaccard_brute(rows, n, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    part = union_find(range(len(rows)), edges)
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[part[i]].append(d)
    return sorted(((d, len(sets[i]), min(low[part[i]]) if low[part[i]] and (sets[i] or d is None) and sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def families(seed, n, sizes):
    """Texts in families of near copies."""
    rng = random.Random(seed)
    rows, at = [], 0
    for size in sizes:
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randint(3, 90))]
        for _ in range(size):
            x = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                x[rng.randrange(len(x))] = f"v{rng.randrange(1000)}"
            rows.append((at, " ".join(x)))
            at += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (1, 60)])
def test_jaccard_join(spark, monkeypatch, n, percent):
    monkeypatch.setattr(jaccard_join, "CROWD", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "RESIDENTS", 300)
    rows = families(n, n, [1] * 30 + [2, 3, 5, 8, 30, 60])
    rows += [(None, None), (900, ""), (901, " \n"), (902, "one"), (903, "ONE"), (None, rows[0][1]), (904, "only two"), (rows[3][0], rows[3][1]), (905, "é É"), (906, "é é"), (907, "big " * 5000), (908, "big " * 5001)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cid", F.lit("clash")).repartition(3)
    got = sorted((tuple(r) for r in jaccard_join.similar_documents(df, n, percent).collect()), key=str)
    assert got == jaccard_brute(rows, n, percent)


def test_classes_of_different_texts_keep_their_links(spark):
    rng, rows = random.Random(11), []
    for k in range(24):
        w = [f"w{rng.randrange(500)}" for _ in range(60)]
        near = [*w[:30], f"v{k}", *w[31:]]
        texts = [" ".join(w), " ".join(w).upper(), "  ".join(w), "\n".join(w), " ".join(near), " ".join(near).upper()]
        rng.shuffle(texts)
        rows += [(None if k % 6 == 5 and i % 2 else 10 * k + i, t) for i, t in enumerate(texts)]
    got = sorted((tuple(r) for r in jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()), key=str)
    assert len({c for _, _, c in got}) == 24
    assert got == jaccard_brute(rows, 4, 85)


def test_jaccard_edge_tables(spark):
    schema = "doc_id long, text string"
    assert jaccard_join.similar_documents(spark.createDataFrame([], schema), 4, 85).count() == 0
    rows = jaccard_join.similar_documents(spark.createDataFrame([(None, "a b c d e f")] * 2, schema), 4, 85).collect()
    assert [tuple(r) for r in rows] == [(None, 3, None)] * 2
    kept = jaccard_join.near_duplicates_dropped(spark.createDataFrame([(2, "a b c d e f"), (1, "a b c d e f"), (3, None), (None, "a b c d e f")], schema))
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["1", "3"]


def test_one_row_of_each_group_stays(spark):
    """Ids that repeat with other texts lose no text, repeated rows go to one, clashing columns stay."""
    a, b = "a b c d e f g", "x y z w v u t"
    rows = [(5, a), (5, a), (1, b), (5, b), (9, "nine other words stand in this one here"), (None, a), (None, "no id but its own text here"), (None, "no id but its own text here"), (4, ""), (4, "")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, _key long").repartition(3)
    got = jaccard_join.near_duplicates_dropped(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(5, a), (1, b), rows[4], (None, rows[6][1]), (4, ""), (4, "")], key=str)
    ids = sorted((tuple(r) for r in jaccard_join.similar_documents(df, 5, 80).collect()), key=str)
    assert ids == jaccard_brute(rows, 5, 80)


def test_a_crowd_of_near_copies_is_one_component(spark, monkeypatch):
    """A large group of near copies, many of them too far from one another to link."""
    monkeypatch.setattr(jaccard_join, "CROWD", 8)
    monkeypatch.setattr(jaccard_join, "BLOCK", 32)
    rng, rows = random.Random(8), []
    base = [f"w{i}" for i in range(150)]
    for i in range(300):
        x = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            x[rng.randrange(len(x))] = f"v{rng.randrange(10000)}"
        rows.append((i, " ".join(x)))
    got = sorted((tuple(r) for r in jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 4, 85).collect()), key=str)
    assert got == jaccard_brute(rows, 4, 85)


def test_a_common_passage_makes_no_family(spark, monkeypatch):
    """Sets that a common passage brings into the same crowds are not all one family, whatever their sizes."""
    monkeypatch.setattr(jaccard_join, "CROWD", 8)
    rng, rows = random.Random(5), []
    passage = [f"p{i}" for i in range(100)]
    for i in range(300):
        rows.append((i, " ".join([*passage, *(f"w{rng.randrange(100_000)}" for _ in range(rng.randint(10, 120)))])))
    for i in range(300, 340):
        rows.append((i, rows[i % 10][1] + f" v{i}"))
    sizes, write = {}, jaccard_join.written

    def noted(df, tag="table"):
        out = write(df, tag)
        if tag == "families":
            sizes.update((r.component, r.n) for r in out.groupBy("component").agg(F.count("*").alias("n")).collect())
        return out

    monkeypatch.setattr(jaccard_join, "written", noted)
    got = sorted((tuple(r) for r in jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 4, 85).collect()), key=str)
    assert got == jaccard_brute(rows, 4, 85)
    assert 0 < max(sizes.values()) < 200, sizes


def test_similar_sets_share_enough_signatures():
    rng = np.random.default_rng(0)
    for percent in (80, 85, 90):
        bands = jaccard_join.Bands(percent)
        for _ in range(60):
            size = int(rng.integers(1, 400))
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            b = a.copy()
            for _ in range(int(rng.integers(0, max(1, size * (100 - percent) // 100)) + 1)):
                b = np.delete(b, rng.integers(len(b))) if rng.random() < 0.5 and len(b) > 1 else np.append(b, rng.integers(0, 2**63).astype(np.uint64))
            b = np.unique(b)
            both = len(np.intersect1d(a, b))
            if 100 * both < percent * (len(a) + len(b) - both) or both == len(a) == len(b):
                continue
            sig, src = jaccard_join.signatures([a, b], bands)
            shared = np.intersect1d(sig[src == 0], sig[src == 1])
            assert sum(1 / jaccard_join.NEEDS[int(s) & 7] for s in shared) >= jaccard_join.ONE


def test_crowds_flow_across_batches():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(1, 200))
        sig, key = np.sort(rng.integers(0, 12, n) * 8), rng.integers(0, 40, n)
        order = np.lexsort((key, sig))
        sig, key, step = sig[order], key[order], int(rng.integers(1, 30))
        known = np.zeros(n, dtype=bool)
        batches = [pa.RecordBatch.from_arrays([pa.array(x[i : i + step]) for x in (sig, key, known)], ["sig", "k1", "known"]) for i in range(0, n, step)]
        pairs, crowd = Counter(), defaultdict(list)
        for b in jaccard_join.meet(5)(iter(batches)):
            for a, c, s in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if c is None:
                    crowd[s].append(a)
                else:
                    pairs[a, c] += 1
        want, groups = Counter(), defaultdict(set)
        for s, k in zip(sig.tolist(), key.tolist(), strict=True):
            groups[s].add(k)
        for s, ks in groups.items():
            if len(ks) > 5:
                assert sorted(crowd[s]) == sorted(ks)
            else:
                want.update((a, b) for a in ks for b in ks if a < b)
        assert pairs == want


def test_linear_grouping_sorts_suffixes():
    rng = random.Random(1)
    for _ in range(1500):
        t = [rng.randint(0, rng.randint(1, 4)) for _ in range(rng.randint(0, 40))]
        array = suffix_dedup.linear_grouping(t) if t else []
        assert array == sorted(range(len(t)), key=lambda i: t[i:])
        if t:
            lcp = suffix_dedup.common_prefixes(t, array)
            for r in range(1, len(t)):
                a, b = t[array[r - 1] :], t[array[r] :]
                assert lcp[r] == next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))


def repeats_brute(rows, length):
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        cover = np.zeros(len(b) + 1, dtype=int)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                cover[i] += 1
                cover[i + length] -= 1
        gone = np.cumsum(cover)[: len(b)] > 0
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("crowd", [512, 3])
def test_repeats(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    rng = random.Random(crowd)
    base = "".join(rng.choice("ab") for _ in range(300))
    rows = []
    for i in range(50):
        a = rng.randint(0, 250)
        rows.append((i, "".join(rng.choice("abé") for _ in range(rng.randint(0, 20))) + base[a : a + rng.randint(5, 50)] * rng.randint(1, 3) + "a" * rng.randint(0, 14) + "".join(rng.choice("ab") for _ in range(rng.randint(0, 20)))))
    rows += [(None, None), (None, ""), (5, rows[5][1]), (None, rows[7][1]), (60, "a" * 19), (61, "xy" * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("th", F.lit("clash")).repartition(3)
    got = sorted((tuple(r) for r in suffix_dedup.repeats_digest(df, 20, 10).collect()), key=str)
    assert got == repeats_brute(rows, 20)
    assert suffix_dedup.repeats_digest(df.limit(0), 20, 10).count() == 0


def test_repeats_removed_keeps_rows_and_columns(spark):
    passage = "".join(random.Random(2).choice("abcdefgh é") for _ in range(260))
    rows = [(1, "one " + passage + " end", 9), (2, passage, 9), (3, "clean", 5), (4, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    clash = suffix_dedup.repeats_removed(df.withColumns({c: F.lit("clash") for c in ("_th", "_t", "_id", "_spans", "_slot", "_word", "th")}))
    assert clash.filter("_th = 'clash' and _spans = 'clash' and _slot = 'clash'").count() == 4
    got = {r.doc_id: (r.text, r.n_chars) for r in suffix_dedup.repeats_removed(df).collect()}
    assert got[2] == ("", 0) and got[3] == ("clean", 5) and got[4] == (None, None) and got[1][0].startswith("one") and len(got[1][0]) < 20


def planted(seed, n, dim, low, high, copies=True):
    """n random vectors, and one near each at a cosine between low and high."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    near = x / np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.standard_normal(near.shape)
    noise -= (noise * near).sum(1, keepdims=True) * near
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    c = rng.uniform(low, high, n)[:, None]
    return np.concatenate([x, c * near + np.sqrt(1 - c * c) * noise])


def linked_brute(rows, cosine=0.9):
    """(vec_id, n_links, component_id) of each row."""
    good = [i for i, (_, v) in enumerate(rows) if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    edges = []
    for dim in {len(rows[i][1]) for i in good}:
        at = [i for i in good if len(rows[i][1]) == dim]
        u = np.array([rows[i][1] for i in at])
        u /= np.abs(u).max(1, keepdims=True)
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        edges += [(at[a], at[b]) for a, b in zip(*np.nonzero(np.triu(u @ u.T >= cosine, 1)), strict=True)]
    part, n, low = union_find(range(len(rows)), edges), Counter(x for e in edges for x in e), defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[part[i]].append(d)
    return sorted(((d, n[i], min(low[part[i]], default=None)) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [8192, 16])
def test_embeddings(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    v = planted(0, 300, 16, 0.93, 0.97)
    v = np.concatenate([v, v[:5], np.repeat(v[:1], 40, 0)])
    rows = [(i, [float(a) for a in r]) for i, r in enumerate(v)]
    rows += [(9000, None), (9001, [0.0] * 16), (9002, [float("inf")] + [0.0] * 15), (9003, []), (9004, [None] + [1.0] * 15), (9005, [1e300] * 16), (9006, [1.0] * 16), (9007, [1.0] * 3), (9008, [float("nan")] * 16), (9009, [-2.0]), (9010, [-3.0]), (None, rows[3][1])]
    # ids with several vectors: each row is a vector of its own
    rows += [(5, rows[200][1]), (5, [float(a) for a in np.random.default_rng(9).standard_normal(16)]), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1))
    found = embedding_dedup.near_vectors(df).collect()
    got, want = sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str), linked_brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found) and len(got) == len(want)
    assert sum(g == w for g, w in zip(got, want, strict=True)) >= 0.97 * len(want) and sum(n for _, n, _ in got) <= sum(n for _, n, _ in want)
    odd = {x for x in got if x[0] is not None and x[0] >= 9000}
    assert odd == {x for x in want if x[0] is not None and x[0] >= 9000}
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize(("most", "dim"), [(64, 64), (1024, 32), (4096, 64)])
def test_embeddings_recall_with_any_number_of_directions(spark, most, dim):
    v = planted(most, 1500, dim, 0.9, 0.92)
    rows = [(i, [float(a) for a in r]) for i, r in enumerate(v)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), most=most)
    want = sum(n for _, n, _ in linked_brute([(i, list(np.float32(r).astype(float))) for i, r in rows]))
    assert 0.95 * want <= got.agg(F.sum("n_links")).first()[0] <= want


def test_embeddings_of_a_crowd(spark):
    """A crowd of near vectors on the same lines: all links are counted."""
    rng = np.random.default_rng(4)
    v = rng.standard_normal(64) * 3 + 0.4 * rng.standard_normal((700, 64))
    rows = [(i, [float(a) for a in r]) for i, r in enumerate(v)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    want = linked_brute(rows)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got.collect()), key=str) == want and want[0][1] == 699


def test_rejected_rows_leave_other_texts_of_their_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    twice = docs.filter("doc_id < 20").withColumn("text", F.lit("this text is much too short"))
    kept = {r.doc_id for r in quality.quality(docs.unionByName(twice)).filter("kept").collect()}
    got = corpus_pipeline.quality_rules(spark, docs.unionByName(twice), "").collect()
    assert any(d < 20 for d in kept) and {r.doc_id for r in got} == kept and all(r.text != "this text is much too short" for r in got)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "word " * 3 + "many other words that stand here for a text of ten", "en", "s", 1), (10**9, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(odd)
    figures = {r.doc_id: r.kept for r in quality.quality(docs).collect() if r.doc_id is not None}
    a = corpus_pipeline.written(corpus_pipeline.quality_rules(spark, docs, ""))
    assert a.columns == columns and {r.doc_id for r in a.collect() if r.doc_id is not None} == {d for d, k in figures.items() if k}
    b = corpus_pipeline.written(corpus_pipeline.near_duplicates(spark, a, ""))
    rows = [(r.doc_id, r.text) for r in a.collect()]
    want = {d for d, _, c in jaccard_brute(rows, 5, 80) if d == c or d is None}
    assert b.columns == columns and {r.doc_id for r in b.collect()} == want
    c = corpus_pipeline.written(corpus_pipeline.repeated_passages(spark, b, ""))
    kept = {r[0]: r for r in repeats_brute([(r.doc_id, r.text) for r in b.collect()], 200)}
    for r in c.collect():
        if r.doc_id is not None and kept[r.doc_id][2] == 0:
            assert hashlib.sha256(r.text.encode()).hexdigest() == kept[r.doc_id][4]
    assert c.columns == columns and c.count() == b.count()
    d = corpus_pipeline.written(corpus_pipeline.secret_scan(spark, c, ""))
    assert d.columns == columns and d.count() == c.count() and secrets.scan_secrets(d).agg(F.sum("n_access")).first()[0] in (0, None)
    e = corpus_pipeline.packing(spark, d, "")
    assert e.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t")).filter("doc_id is not null and n <> t").count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "suffix-array dedup", "secret scans", "packing"]
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_signatures_in_passes_are_all_of_them_and_shuffles_go(spark, tmp_path):
    """The parts of the signatures are disjoint, together the whole, and about equal; a written table leaves no shuffle files."""
    import pathlib

    import numpy as np
    import pyarrow as pa

    from gleanery.llm import common, jaccard_join

    rng = np.random.default_rng(2)
    texts = pa.RecordBatch.from_arrays([pa.array([" ".join(f"w{k}" for k in rng.integers(0, 5000, n)) for n in rng.integers(1, 300, 60)])], ["text"])
    rows = lambda *part: sorted((s, k) for b in jaccard_join.sign(5, 80, 48, *part)([texts]) for s, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
    whole, parts = rows(), [rows(p, 3) for p in range(3)]
    assert sorted(sum(parts, [])) == whole and min(map(len, parts)) > len(whole) / 4
    before = spark.conf.get(common.CLEANUP)
    files = lambda: {p for d in spark._jvm.org.apache.spark.util.Utils.getConfiguredLocalDirs(spark._jsc.sc().getConf()) for p in pathlib.Path(d).rglob("shuffle_*.data")}
    held = files()
    table = common.written(spark.range(1000).repartition("id"))
    assert files() <= held and spark.conf.get(common.CLEANUP) == before and table.count() == 1000
