"""Exact n-gram Jaccard join by universe partition and the pigeonhole principle.

Documents become sets of word n-grams (64-bit hashes); equal sets are one class. Sizes fall into bands, and for each
band the universe of n-grams is hashed into segments. Similar sets differ in at most H n-grams, so of more than H
segments one agrees, or, where a segment's one-deletion neighbourhood is indexed too, differs in at most one. Each
set leaves out its `skips` costliest segments (empty ones, then those with fewest n-grams, which most others share);
the band has twice as many segments more, so that two sets' different choices still leave enough in common. Small
bands get few segments, all with neighbourhoods.

Pairs that share a signature are held against a 512-bit sketch, whose differing bits bound the sets' difference from
below, and those left are verified on the sets themselves. Signatures of more than `CROWD` sets are crowds: similar sets
that meet in no others share as many of one band's crowds as the band needs, so one of the rarest of each set's is common
to both, and only sets that these connect are compared by sketch, in blocks of at most 2 * BLOCK sets each. So no
task holds a whole crowd and no pair is dropped. Only components are wanted, so links inside a component already
found need no verification.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm.common import fold, perhaps, ranges, released, slices, unused, written
from gleanery.llm.graph import components
from gleanery.sources.files import table

WORDS = 8  # 64-bit words of a sketch
CROWD = 48
BLOCK = 2048
ONE = 1 - 1e-9
RESIDENTS = 4_000_000  # n-grams of a chunk's sets, 32 MB
PASSES = 3  # over the signatures, so that a third of them at a time is on disks
NEEDS = [1, 3, 6, 12, 24, 48, 96, 192]
KIND = 1023  # lowest bits of a signature: three for the place in NEEDS, seven for the band

BASE = 0x9E3779B97F4A7C15
_MULT = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3]


class WordHash:
    """64-bit hashes of the words of texts, A-Z lower-cased: polynomials over their bytes, mixed with their length."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)
        self.blank = np.zeros(256, dtype=bool)
        self.blank[[9, 10, 11, 12, 13, 32]] = True

    def of(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words, number of words of each text)."""
        parts = [t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts]
        data = np.frombuffer(b" ".join([b"", *parts, b""]), dtype=np.uint8)  # a blank before each text and at the end
        if len(self.up) <= len(data):
            n = 2 * len(data) + 1
            self.up, self.down = np.full(n, BASE, dtype=np.uint64), np.full(n, pow(BASE, -1, 1 << 64), dtype=np.uint64)
            self.up[0] = self.down[0] = 1
            self.up, self.down = np.multiply.accumulate(self.up), np.multiply.accumulate(self.down)
        edge = np.diff(self.blank[data].view(np.int8))
        start, end = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        h = fold((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))
        ends = np.cumsum([len(p) + 1 for p in parts])
        return h, np.diff(np.concatenate([[0], np.searchsorted(start, ends)]))


def shingle_sets(texts, n: int, hashes: WordHash) -> list[np.ndarray]:
    """Sorted different n-gram hashes of each text; the whole sequence counts as one where there are fewer words."""
    flat, size = hashes.of(texts)
    h = np.zeros(max(0, len(flat) - n + 1), dtype=np.uint64)
    for k in range(n):
        h += flat[k : k + len(h)] * np.uint64(_MULT[k])
    h = fold(h)
    first = np.cumsum(size) - size
    out = []
    for s, c in zip(first.tolist(), size.tolist(), strict=True):
        if c >= n:
            own = np.sort(h[s : s + c - n + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif c:
            short = np.zeros(1, dtype=np.uint64)
            for k in range(c):
                short += flat[s + k : s + k + 1] * np.uint64(_MULT[k])
            out.append(fold(short + np.uint64(c)))
        else:
            out.append(flat[:0])
    return out


class Bands:
    """Size bands and their segments for Jaccard similarity percent / 100."""

    def __init__(self, percent: int):
        self.percent, self.low, self.high = percent, [1], []

    def reach(self, size: int) -> None:
        while self.low[-1] <= size:
            self.high.append(max(self.low[-1], self.low[-1] * 100 // self.percent))
            self.low.append(self.high[-1] + 1)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        self.reach(int(sizes.max(initial=1)) + 1)
        return np.searchsorted(np.array(self.high), sizes)

    def plan(self, band: int) -> tuple[int, int, int, int]:
        """(segments, how many of the first have one-deletion neighbourhoods, skips, place in NEEDS) of a band; no segments
        where only equal sets are similar. H differences spoil at most H segments; with NEEDS more, besides both sets'
        skips, similar sets agree in that many. In small bands, where all have neighbourhoods that take two
        differences each to spoil, they agree in one."""
        self.reach(self.low[0] if not self.high else self.high[-1])
        while len(self.high) <= band:
            self.reach(self.low[-1])
        h = 2 * self.high[band] * (100 - self.percent) // (100 + self.percent)
        if h == 0:
            return 0, 0, 0, 0
        if h <= 3:
            return (h + 2) // 2, (h + 2) // 2, 0, 0
        skips = h // 20 + 1
        need = max(k for k in range(1, len(NEEDS)) if k == 1 or NEEDS[k] <= h // 16)
        return h + NEEDS[need] + 2 * skips, 1, skips, need


def signatures(sets: list[np.ndarray], bands: Bands):
    """(signature, index of its set) of all sets."""
    size = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    at = np.flatnonzero(size)
    if not len(at):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    band = bands.of(size[at])
    bands.reach(int(size.max() * 100 // bands.percent) + 2)
    low = np.array(bands.low)
    both = size[at] * 100 >= bands.percent * low[band + 1]
    of = np.concatenate([at, at[both]])
    band = np.concatenate([band, band[both] + 1])
    plans = np.array([bands.plan(b) for b in range(int(band.max()) + 1)], dtype=np.int64)
    segments, near, skips, need = plans[band].T
    use = segments > 0
    of, band, segments, near, skips, need = of[use], band[use], segments[use], near[use], skips[use], need[use]
    if not len(of):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    n = size[of]
    row = np.repeat(np.arange(len(of)), n)
    first = np.cumsum(size) - size
    token = np.concatenate(sets)[ranges(first[of], n)]
    which = fold(token ^ np.uint64(0x5851F42D4C957F2D))
    seg = ((which >> np.uint64(32)) * segments[row].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    value = fold(token + np.uint64(0x14057B7EF767814F))
    base = np.cumsum(segments) - segments
    cell = base[row] + seg
    total = np.zeros(int(segments.sum()), dtype=np.uint64)
    np.add.at(total, cell, value)
    count = np.bincount(cell, minlength=len(total))
    owner = np.repeat(np.arange(len(of)), segments)
    index = np.arange(len(total)) - base[owner]
    salt = fold((band[owner].astype(np.uint64) << np.uint64(32)) + index.astype(np.uint64) + np.uint64(1))
    # cost of a segment: the fewer n-grams, the more sets share it; those with neighbourhoods are never left out
    cost = np.where(index < near[owner], 1 << 20, np.minimum(count, (1 << 20) - 1))
    order = np.argsort(owner * (1 << 21) + cost, kind="stable")
    rank = np.empty(len(total), dtype=np.int64)
    rank[order] = np.arange(len(total)) - base[owner[order]]
    kept = np.flatnonzero(rank >= skips[owner])
    low, kind = np.uint64(KIND), (need + (band % 128 << 3))[owner].astype(np.uint64)
    sig = [fold(total[kept] + salt[kept]) & ~low | kind[kept]]
    src = [of[owner[kept]]]
    near_token = np.flatnonzero(seg < near[row])
    c = cell[near_token]
    sig.append(fold(total[c] - value[near_token] + salt[c]) & ~low | kind[c])
    src.append(of[row[near_token]])
    return np.concatenate(sig), np.concatenate(src)


def sketch(s: np.ndarray) -> np.ndarray:
    bits = np.zeros(64 * WORDS, dtype=np.uint8)
    bits[(s >> np.uint64(7)).astype(np.int64) & (64 * WORDS - 1)] = 1
    return np.packbits(bits, bitorder="little").view("<i8")


def _key(s: np.ndarray) -> int:
    """64-bit hash of a set, by which equal sets are one class."""
    import xxhash

    return xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63


def describe(n: int):
    """(doc_id, dh, text) to (doc_id, dh, n_shingles, k1, sketch words)."""

    def run(batches):
        hashes = WordHash()
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in slices(texts, 500_000):
                sets = shingle_sets(texts[lo:hi], n, hashes)
                words = np.stack([sketch(s) for s in sets])
                cols = [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()), pa.array([_key(s) for s in sets], pa.int64())]
                cols += [pa.array(words[:, j]) for j in range(WORDS)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "dh", "n_shingles", "k1", *(f"w{j}" for j in range(WORDS))])

    return run


class Crowds:
    """Tells which of a task's signatures need not be dealt out: of those that over `crowd` of its sets share, the first
    crowd + 1 rows, which tell that it is a crowd, are."""

    def __init__(self, crowd: int):
        self.crowd = crowd
        self.sent: dict[int, int] = {}

    def known(self, sig: np.ndarray) -> np.ndarray:
        """Which of these (signature, set) rows are crowds' and can go their way at once."""
        out = np.zeros(len(sig), dtype=bool)
        order = np.argsort(sig, kind="stable")
        line = sig[order]
        start = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else order
        size = np.diff(np.append(start, len(line)))
        often = size > max(1, self.crowd // 8)
        if self.sent:
            often |= np.isin(line[start], np.fromiter(self.sent, dtype=sig.dtype, count=len(self.sent)))
        for s, n in zip(start[often].tolist(), size[often].tolist(), strict=True):
            before = self.sent.get(int(line[s]), 0)
            self.sent[int(line[s])] = before + n
            out[order[s + max(0, min(n, self.crowd + 1 - before)) : s + n]] = True
        return out


def sign(n: int, percent: int, crowd: int, part: int = 0, parts: int = 1):
    """(text) to (sig, k1, known) of this part's signatures; each set once in a partition."""

    def run(batches):
        hashes, bands, seen, crowds_ = WordHash(), Bands(percent), set(), Crowds(crowd)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in slices(texts, 500_000):
                fresh, keys = [], []
                for s in shingle_sets(texts[lo:hi], n, hashes):
                    k = _key(s)
                    if len(s) and k not in seen:
                        seen.add(k)
                        fresh.append(s)
                        keys.append(k)
                sig, src = signatures(fresh, bands)
                mine = np.flatnonzero((sig >> np.uint64(32)) % np.uint64(parts) == np.uint64(part))
                sig, src = sig[mine], src[mine]
                known = crowds_.known(sig)
                yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(np.array(keys, dtype=np.int64)[src]), pa.array(known)], ["sig", "k1", "known"])

    return run


def meet(crowd: int):
    """Rows (sig, k1, known) sorted by (sig, k1) to pairs (a, b, place in NEEDS) of small groups, and (k1, null, sig) of crowds."""

    def rows(a, b, sig):
        if b is None:
            cols = [pa.array(a), pa.nulls(len(a), pa.int64()), pa.array(sig)]
        else:
            cols = [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(sig & 7)]
        return pa.RecordBatch.from_arrays(cols, ["a", "b", "sig"])

    def groups(sig, key):
        start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        return start, np.diff(np.append(start, len(sig)))

    def whole(sig, key):
        if not len(sig):
            return
        start, size = groups(sig, key)
        group = np.repeat(np.arange(len(start)), size)
        out = np.flatnonzero(size[group] > crowd)
        if len(out):
            yield rows(key[out], None, sig[out])
        for g in np.unique(size[(size > 1) & (size <= crowd)]).tolist():
            s = start[size == g]
            i, j = np.triu_indices(g, 1)
            yield rows(key[(s[:, None] + i).ravel()], key[(s[:, None] + j).ravel()], np.repeat(sig[s], len(i)))

    def run(batches):
        held_sig = held_key = np.zeros(0, dtype=np.int64)  # of the last group, as long as it is no crowd
        flow = None  # (signature, last key) of a crowd that goes on
        for batch in batches:
            sig, key, known = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            if known.any():
                yield rows(key[known], None, sig[known])
                sig, key = sig[~known], key[~known]
            sig, key = np.concatenate([held_sig, sig]), np.concatenate([held_key, key])
            held_sig = held_key = sig[:0]
            if not len(sig):
                continue
            fresh = np.concatenate([[flow is None or (sig[0], key[0]) != flow], (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])])
            sig, key = sig[fresh], key[fresh]
            if flow is not None and len(sig):
                n = int(np.searchsorted(sig, flow[0], "right"))
                if n:
                    yield rows(key[:n], None, sig[:n])
                    flow = (flow[0], key[n - 1])
                    sig, key = sig[n:], key[n:]
                if len(sig):
                    flow = None
            if not len(sig):
                continue
            start, size = groups(sig, key)
            last = start[-1]
            yield from whole(sig[:last], key[:last])
            sig, key = sig[last:], key[last:]
            if len(sig) > crowd:
                yield rows(key, None, sig)
                flow = (sig[0], key[-1])
            else:
                held_sig, held_key = sig, key
        yield from whole(held_sig, held_key)

    return run


def crowds(percent: int):
    """Rows (family, lo, hi, chunk, cid, n, words, two words of cells) sorted by (family, lo, hi) to (family, u, partners): the
    sets v > u with a cell in common that size and sketch allow, and a row without partners for each set that is only a partner."""

    def block(fam, k, n, w, c, same):
        left, right = (np.arange(len(k)),) * 2 if same else (np.flatnonzero(c == c.min()), np.flatnonzero(c == c.max()))
        u, v = [], []
        for i in range(0, len(left), 256):
            x = left[i : i + 256]
            met = (w[x, WORDS][:, None] & w[right, WORDS][None, :]) | (w[x, WORDS + 1][:, None] & w[right, WORDS + 1][None, :])
            a, b = n[x][:, None], n[right][None, :]
            ok = (met != 0) & (np.minimum(a, b) * 100 >= percent * np.maximum(a, b)) & (k[x][:, None] < k[right][None, :] if same else True)
            p, q = np.nonzero(ok)
            p, q = x[p], right[q]
            diff = np.zeros(len(p), dtype=np.int64)
            for j in range(WORDS):
                diff += np.bitwise_count(w[p, j] ^ w[q, j])
            near = diff * (100 + percent) <= (n[p] + n[q]) * (100 - percent)
            p, q = k[p[near]], k[q[near]]
            u.append(np.minimum(p, q))
            v.append(np.maximum(p, q))
        u, v = np.concatenate(u), np.concatenate(v)
        if len(u):
            order = np.lexsort((v, u))
            u, v = u[order], v[order]
            start = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
            lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(v)).astype(np.int32)), pa.array(v))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(start), fam)), pa.array(u[start]), lists], ["family", "u", "partners"])
            alone = np.setdiff1d(v, u)
            none = pa.ListArray.from_arrays(pa.array(np.zeros(len(alone) + 1, dtype=np.int32)), pa.array(v[:0]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(alone), fam)), pa.array(alone), none], ["family", "u", "partners"])

    def run(batches):
        held = None
        stream = iter(batches)
        done = False
        while not done:
            batch = next(stream, None)
            done = batch is None
            if not done:
                cols = [c.to_numpy() for c in batch.columns]
                held = cols if held is None else [np.concatenate([x, y]) for x, y in zip(held, cols, strict=True)]
            if held is None or not len(held[0]):
                continue
            new = np.concatenate([[True], (held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1]) | (held[2][1:] != held[2][:-1])])
            start = np.flatnonzero(new).tolist() + [len(new)]
            for s, e in zip(start[: None if done else -2], start[1 : None if done else -1], strict=False):
                if e > s + 1:
                    yield from block(held[0][s], held[4][s:e], held[5][s:e], np.stack([x[s:e] for x in held[6:]], 1).view(np.uint64), held[3][s:e], held[1][s] == held[2][s])
            held = [x[start[-2] if not done else start[-1] :] for x in held]

    return run


def _wanted_sets(n: int):
    """(dh, text) to (dh, k1, set), each document's once in a partition."""

    def run(batches):
        hashes, seen = WordHash(), set()
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(texts, 500_000):
                fresh = [i for i in range(lo, hi) if not (names[i] in seen or seen.add(names[i]))]
                sets = shingle_sets([texts[i] for i in fresh], n, hashes)
                cols = [pa.array([names[i] for i in fresh], pa.int64()), pa.array([_key(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["dh", "k1", "set"])

    return run


def verify(percent: int):
    """Rows (label, chunk, lives, cid, set, partners, chunks) sorted by (label, chunk), residents first, to (u, v, linked):
    links that span the components of all links here, and, not linked, pairs whose partner lives under another label.

    Residents of a chunk are held, and ask when all are; sets of other chunks stream by. A set's partner of this chunk is
    known by its hash.
    """

    def run(batches):
        now, held, asking, root = None, {}, [], {}

        def find(x):
            while root.get(x, x) != x:
                root[x] = x = root.get(root[x], root[x])
            return x

        def ask(cid, own, partners, chunks):
            for v in partners:
                if v % chunks != now[1]:
                    continue
                if v not in held:
                    out.append((cid, v, False))
                    continue
                a, b = find(cid), find(v)
                if a != b and similar(own, held[v], percent):
                    root[a] = b
                    out.append((cid, v, True))

        def settle():
            for cid, partners, chunks in asking:
                ask(cid, held[cid], partners, chunks)
            asking.clear()

        out: list[tuple] = []
        for batch in _ended(batches):
            for label, chunk, lives, cid, data, partners, chunks in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True) if batch is not None else ():
                if (label, chunk) != now:
                    settle()
                    now, held, root = (label, chunk), {}, {}
                own = np.frombuffer(data, dtype=np.uint64)
                if lives:
                    held[cid] = own
                    if partners:
                        asking.append((cid, partners, chunks))
                else:
                    settle()
                    ask(cid, own, partners or (), chunks)
            if batch is None:
                settle()
            u, v, linked = zip(*out, strict=True) if out else ((), (), ())
            out.clear()
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(linked, pa.bool_())], ["u", "v", "linked"])

    return run


def _ended(batches):
    """The batches, then None."""
    yield from batches
    yield None


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def verify_pairs(percent: int):
    """Rows (u, v, x, y) with both sets to (u, v, linked)."""

    def run(batches):
        for batch in batches:
            ok = [similar(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), percent) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(ok, pa.bool_())], ["u", "v", "linked"]).filter(pa.array(ok, pa.bool_()))

    return run


def classified(docs: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, dh, n_shingles, k1) of each row, dh being a hash of id and text, and (k1, component, component_id) of each
    class of equal sets that are not empty."""
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("dh"), text.alias("text"))
    words = [f"w{j}" for j in range(WORDS)]
    schema = "doc_id long, dh long, n_shingles long, k1 long, " + ", ".join(f"{w} long" for w in words)
    described = written(docs.mapInArrow(released(describe(shingle)), schema), "described")
    # a class is read from the row that names it, or, where all ids are null, from any
    classes = described.filter("n_shingles > 0").groupBy("k1").agg(F.min("doc_id").alias("lead"), F.coalesce(F.min_by("dh", "doc_id"), F.min("dh")).alias("dh"), *(F.min(c).alias(c) for c in ("n_shingles", *words)))
    classes = written(classes.withColumnRenamed("n_shingles", "n"), "classes")

    # what the signatures take on disks is most of what the join needs: they are made again for each part of them
    met = None
    for part in range(PASSES):
        signed = docs.select("text").mapInArrow(released(sign(shingle, percent, CROWD, part, PASSES)), "sig long, k1 long, known boolean")
        dealt = signed.repartition(F.when(F.col("known"), F.xxhash64("sig", "k1")).otherwise(F.col("sig"))).sortWithinPartitions("sig", "k1")
        found = written(dealt.mapInArrow(meet(CROWD), "a long, b long, sig long"), "met")
        met = found if met is None else met.unionByName(found)
    share = F.element_at(F.array(*(F.lit(1 / n) for n in NEEDS)), F.col("sig").bitwiseAND(F.lit(7).cast("long")).cast("int") + 1)
    packed = written(met.filter("b is null").select("sig", F.col("a").alias("k1")).distinct(), "crowds")
    crowded = written(packed.groupBy("k1").agg(F.sum(share).alias("c")), "crowded")
    # shares of similar sets' common signatures add up to one; those in crowds are at most either set's in crowds
    pairs = met.filter("b is not null").groupBy("a", "b").agg(F.sum(share).alias("w"))
    sure, rest = pairs.filter(F.col("w") >= ONE), pairs.filter(F.col("w") < ONE)
    ids = crowded.select(F.col("k1").alias("k"))
    pairs = sure.unionByName(perhaps(perhaps(rest, "a", ids), "b", ids))
    rated = classes.join(crowded, "k1", "left").withColumn("c", F.coalesce("c", F.lit(0.0)))
    x, y = (rated.select(F.col("k1").alias(s), F.col("n").alias(f"n{s}"), F.col("c").alias(f"s{s}"), *(F.col(w).alias(f"{w}{s}") for w in words)) for s in "ab")
    bits = sum((F.bit_count(F.col(f"{w}a").bitwiseXOR(F.col(f"{w}b"))) for w in words), F.lit(0))
    able = (bits * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)) & (F.least("na", "nb") * 100 >= percent * F.greatest("na", "nb"))
    able &= F.col("w") + F.least("sa", "sb") >= ONE
    left = pairs.join(x, "a").join(y, "b").filter(able).select(F.col("a").alias("u"), F.col("b").alias("v"))
    left = written(left.distinct(), "candidates")
    # two sets that may have all their common signatures in crowds are compared there
    deep = written(_rarest(packed), "deep")
    lists = None if deep.isEmpty() else written(_crowded(deep, classes, words, percent), "lists")
    named = classes.select("k1", "lead")
    if left.isEmpty() and (lists is None or lists.isEmpty()):
        named = named.withColumn("component", F.col("k1"))
    else:
        joined = components(_linked(docs, classes, left, lists, shingle, percent)).withColumnRenamed("node", "k1")
        named = named.join(joined, "k1", "left").withColumn("component", F.coalesce("component", "k1"))
    named = written(named, "named")
    return described.select("doc_id", "dh", "n_shingles", "k1"), named.join(named.groupBy("component").agg(F.min("lead").alias("component_id")), "component").select("k1", "component", "component_id")


def row_hash():
    """Hash of a row's id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")))


def similar_documents(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, the smallest doc_id that links reach.

    Words are runs of what is not ASCII white space, A-Z lower-cased. Null texts and texts without words have an empty
    set, link with nothing and are their own component. Repeated rows and equal texts are one class, and each row of an id
    that has several texts is a document of its own; null ids take part, but never name a component unless all of it is null.
    Very long texts are taken whole, one at a time. Other columns are left out; no rows give none. The result is exact at
    every size, up to equal 64-bit hashes of different sets.
    """
    rows, named = classified(docs, shingle, percent)
    out = rows.join(named.select("k1", "component_id", F.lit(True).alias("found")), "k1", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _rarest(packed):
    """(sig, k1, node) of the crowds in which similar sets surely meet that share only crowds: of a set's m crowds in a band that needs
    k, all but the k - 1 most frequent. Sets share k of a band at least, and the rarest one of these is among both sets'. A
    node is a set in a band."""
    kind = F.col("sig").bitwiseAND(F.lit(KIND).cast("long"))
    need = F.element_at(F.array(*map(F.lit, NEEDS)), kind.bitwiseAND(F.lit(7).cast("long")).cast("int") + 1)
    ranked = packed.join(packed.groupBy("sig").agg(F.count("*").alias("f")), "sig").withColumn("node", F.xxhash64("k1", kind))
    own = Window.partitionBy("k1", "node")
    ranked = ranked.withColumns({"m": F.count("*").over(own), "at": F.row_number().over(own.orderBy("f", "sig"))})
    return ranked.filter(F.col("at") <= F.col("m") - need + 1).select("sig", "k1", "node")


def _crowded(deep, classes, words, percent):
    """(family, u, partners) of the sets in crowds. A family is all sets of a band that its rarest crowds connect; each two sets of it
    are compared once, by what crowds they are in and by sketch, in blocks of two chunks of about BLOCK."""
    led = deep.join(deep.groupBy("sig").agg(F.min("node").alias("v")), "sig").select(F.col("node").alias("u"), "v").distinct()
    family = written(components(led), "families")
    sizes = family.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("chunks"))
    # a set's crowds as cells of 128: sets without one in common are in no crowd together
    cell = F.shiftright("sig", 10).bitwiseAND(F.lit(127).cast("long")).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(F.lit(63)))
    cells = [F.bit_or(F.when(side, bit).otherwise(F.lit(0).cast("long"))).alias(f"c{j}") for j, side in enumerate((cell < 64, cell >= 64))]
    nodes = deep.groupBy("node", "k1").agg(*cells)
    members = family.join(sizes, "component").join(nodes, "node").join(classes.select("k1", F.col("k1").alias("cid"), "n", *words), "k1")
    spread = members.withColumn("chunk", F.pmod(F.xxhash64("cid"), "chunks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = spread.select("component", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", "cid", "n", *words, "c0", "c1")
    return dealt.repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi").mapInArrow(released(crowds(percent)), "family long, u long, partners array<long>")


def _linked(docs, classes, left, lists, shingle, percent):
    """Verified links (u, v) of classes that span the same components as all links.

    left: candidate pairs; lists: (family, u, partners) of crowds, or None. Sets meet under labels, the components of each
    set's edge to its smallest partner or to its family's smallest set, in chunks of about RESIDENTS n-grams: a set travels to
    its own chunk, and with the list of its partners to theirs. Pairs that labels part meet in the next round, and
    what two rounds leave, pair by pair.
    """
    none = F.array().cast("array<long>")
    nodes = left.select("u").unionByName(left.select(F.col("v").alias("u")))
    nodes = (nodes if lists is None else nodes.unionByName(lists.select("u"))).distinct()
    nodes = written(nodes.join(classes.select(F.col("k1").alias("u"), "dh", "n"), "u"), "nodes")
    # a class's set comes from the row that names it
    wanted = perhaps(docs, "dh", nodes.select(F.col("dh").alias("k"))).select("dh", "text").mapInArrow(released(_wanted_sets(shingle)), "dh long, k1 long, set binary").withColumnRenamed("k1", "u")
    links = []
    for last in (False, True):
        edges = left.groupBy("v").agg(F.min("u").alias("u")).select("u", "v").unionByName(left.groupBy("u").agg(F.min("v").alias("v")).select("u", "v"))
        asks = left.groupBy("u").agg(F.collect_list("v").alias("partners")).unionByName(left.select(F.col("v").alias("u"), none.alias("partners")).distinct())
        if lists is not None:
            edges = edges.unionByName(lists.join(lists.groupBy("family").agg(F.min("u").alias("v")), "family").select("u", "v"))
            asks = asks.unionByName(lists.select("u", "partners"))
            lists = None
        labels = written(components(edges), "labels")
        sizes = labels.join(nodes.select(F.col("u").alias("node"), "n"), "node").groupBy("component").agg(F.ceil(F.sum("n") / RESIDENTS).alias("chunks"))
        asks = asks.groupBy(F.col("u").alias("node")).agg(F.array_distinct(F.flatten(F.collect_list("partners"))).alias("partners"))
        labels = labels.join(sizes, "component").join(asks, "node", "left").select(F.col("node").alias("u"), F.col("component").alias("label"), "chunks", "partners")
        labels = written(labels.join(nodes.drop("n"), "u"), "labels")
        sets = labels.join(wanted, ["u", "dh"]).select("label", F.col("u").alias("cid"), "set", "partners", "chunks")
        chunks = F.array_union(F.array(F.pmod("cid", "chunks")), F.transform(F.coalesce("partners", none), lambda v: F.pmod(v, F.col("chunks"))))
        both = sets.withColumn("chunk", F.explode(chunks)).withColumn("lives", F.col("chunk") == F.pmod("cid", "chunks"))
        both = both.withColumn("partners", F.filter("partners", lambda v: F.pmod(v, F.col("chunks")) == F.col("chunk")))
        both = both.repartition("label", "chunk").sortWithinPartitions("label", "chunk", F.desc("lives"), "cid").select("label", "chunk", "lives", "cid", "set", "partners", "chunks")
        found = written(both.mapInArrow(released(verify(percent)), "u long, v long, linked boolean"), "links")
        links.append(found.filter("linked").select("u", "v"))
        left = found.filter("not linked").select("u", "v")
        if left.isEmpty():
            break
        if last:
            sets = nodes.join(wanted, ["u", "dh"])
            x, y = (sets.select(F.col("u").alias(c), F.col("set").alias(n)) for c, n in (("u", "x"), ("v", "y")))
            found = left.join(x, "u").join(y, "v").select("u", "v", "x", "y").mapInArrow(verify_pairs(percent), "u long, v long, linked boolean")
            links.append(written(found, "links").select("u", "v"))
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates_dropped(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each group of similar ones, that with the smallest doc_id, and of those the smallest hash of id and
    text; columns stay. Of rows with the same id and text any one stays.

    Rows with a null id come last in their group. Rows without words are in no group and stay.
    """
    rows, named = classified(docs, shingle, percent)
    rows = rows.join(named.select("k1", "component"), "k1")  # not those without words
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "dh")
    first = written(rows.groupBy("component").agg(F.min(place)["dh"].alias("first")), "first")
    twice = written(rows.groupBy("component", "dh").agg(F.count("*").alias("n")).join(first, "component"), "rows")
    key = unused(docs, "_key")
    keyed = docs.withColumn(key, row_hash())
    gone = twice.filter("dh <> first").select(F.col("dh").alias(key)).distinct()
    keyed = keyed.join(gone, key, "left_anti")
    several = twice.filter("dh = first and n > 1").select(F.col("dh").alias(key))
    if not several.isEmpty():
        keyed = keyed.join(several, key, "left_anti").unionByName(keyed.join(several, key, "left_semi").dropDuplicates([key]))
    return keyed.select(*(F.col(f"`{c}`") for c in docs.columns))


def op9_partition_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, f"{sf_dir}/documents.parquet"), shingle=4, percent=85)


QUERIES = {"op9_partition_jaccard": op9_partition_jaccard}
ORACLE: dict[str, str] = {}
