"""Exact removal of long repeated byte strings by suffix arrays built in linear grouping.

A byte goes if a string of `LENGTH` bytes over it also starts anywhere else in the corpus. Suffix arrays of a whole
corpus do not fit anywhere, so equal strings are first brought together: of the `ANCHOR`-byte grams in each window
of LENGTH bytes the one with the least hash is its anchor, and equal windows have equal anchors at equal places.
So each start of a window belongs to one anchor, and only windows of the same anchor can be equal.

1. Anchors are counted (pre-aggregated in each batch); a bounded bit table of repeated ones prunes the second scan.
2. The stretch around an anchor that its windows cover is its context. Contexts found twice repeat as a whole.
3. Of anchors with several contexts the distinct ones are cut from the texts and sorted by suffix array: within a
   task, what all contexts of an anchor share becomes one symbol, what no two share is left out, and a suffix whose
   common prefix with a neighbour reaches LENGTH bytes starts a repeated string. The array is built by linear
   grouping: groups of suffixes with equal Lyndon prefix are processed in descending order, each moving the previous
   smaller suffixes of its members to longer prefixes, and then each suffix, in ascending order, emits those whose
   Lyndon prefix ends before it to the front of their groups. No symbols are renamed recursively.
4. Anchors with more than `CROWD` contexts (a passage in very many documents) are split into parts of ever fewer
   starts, keyed by all that a part's windows share, so that no task gathers a crowd.
5. Repeated starts go back to all documents with that context.

Hashes of 64 bits stand for equal strings in steps 1, 2 and 4.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import bit_filter, fold, perhaps, released, unused, written
from gleanery.sources.files import table

LENGTH, ANCHOR = 200, 100
CROWD = 512
BITS = 24
PLACE_BITS = 24
BASE = 0x9E3779B97F4A7C15
SYMBOLS = 150_000  # of the suffix arrays built at once; a larger group is one array of its own


def linear_grouping(t: list[int]) -> list[int]:
    """Suffix array of t, the end of t being smaller than any symbol."""
    n = len(t)
    where: dict[int, list[int]] = {}
    for i, c in enumerate(t):
        where.setdefault(c, []).append(i)
    members = [where[c] for c in sorted(where)]
    below = list(range(-1, len(members) - 1))  # the next smaller group of each, and the next larger
    above = [*range(1, len(members)), -1]
    group = [0] * n
    for g, m in enumerate(members):
        for i in m:
            group[i] = g
    prev = [-1] * n  # previous smaller suffix
    done = bytearray(n)
    order = []
    g = len(members) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        count: dict[int, int] = {}
        for i in own:  # ascending, so that members to the left are done
            p = i - 1
            while p >= 0 and done[p]:
                p = prev[p]
            prev[i] = p
            done[i] = 1
            if p >= 0:
                count[p] = count.get(p, 0) + 1
        members[g] = own
        order.append(g)
        moved: dict[int, dict[int, list[int]]] = {}
        for p, c in count.items():
            moved.setdefault(group[p], {}).setdefault(c, []).append(p)
        for h, by in moved.items():
            under = h
            for c in sorted(by):  # the more copies of this group's prefix follow, the larger
                new = len(members)
                found = sorted(by[c])
                members.append(found)
                for p in found:
                    group[p] = new
                over = above[under]
                below.append(under)
                above.append(over)
                above[under] = new
                if over >= 0:
                    below[over] = new
                under = new
        g = below[g]
    # each suffix, in ascending order, emits to their groups the suffixes whose Lyndon prefix ends before it
    front, at = [0] * len(members), 0
    for g in reversed(order):
        front[g] = at
        at += len(members[g])
    array = [0] * n
    placed = bytearray(n)
    s = n - 1
    r = 0
    while True:
        while s >= 0 and not placed[s]:
            placed[s] = 1
            g = group[s]
            array[front[g]] = s
            front[g] += 1
            s = prev[s]
        if r == n:
            return array
        s = array[r] - 1
        r += 1


def common_prefixes(t: list[int], array: list[int]) -> list[int]:
    """Length of the common prefix of each suffix in the array with the one before it."""
    n = len(t)
    rank = [0] * n
    for r, i in enumerate(array):
        rank[i] = r
    out, h = [0] * n, 0
    for i in range(n):
        r = rank[i]
        if r:
            j = array[r - 1]
            while i + h < n and j + h < n and t[i + h] == t[j + h]:
                h += 1
            out[r] = h
            if h:
                h -= 1
        else:
            h = 0
    return out


def _agree(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while hi - lo > 1:  # a[:lo] agree, a[:hi] do not
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def _trim(sides: list[bytes]) -> tuple[int, list[int]]:
    """(what all share, the most that each shares with any other) of prefixes."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    least, most = min(map(len, sides)), [0] * len(sides)
    for a, b in zip(order, order[1:], strict=False):
        k = _agree(sides[a], sides[b])
        least = min(least, k)
        most[a], most[b] = max(most[a], k), max(most[b], k)
    return least, most


class Contexts:
    """Distinct contexts of several anchors, and the window starts in them that repeat."""

    def __init__(self, length: int):
        self.length = length
        self.symbols: list[int] = []
        self.widths: list[int] = []
        self.rows: list[tuple] = []  # (row key, owned starts, place of the anchor, first place in symbols, shared, kept)
        self.groups = 0

    def add(self, rows: list[tuple], anchor: int) -> None:
        """rows: (key, owned starts, place of the anchor, bytes) of one anchor of that many bytes."""
        lefts, rights = [r[3][: r[2]][::-1] for r in rows], [r[3][r[2] + anchor :] for r in rows]
        left, lmost = _trim(lefts)
        right, rmost = _trim(rights)
        for (key, own, at, _), x, y, a, b in zip(rows, lefts, rights, lmost, rmost, strict=True):
            self.rows.append((key, own, at, len(self.symbols), left, a))
            self.symbols += x[left:a][::-1]
            self.symbols.append(256 + self.groups)
            self.symbols += y[right:b]
            self.symbols.append(-len(self.rows))  # ends a context: unlike any other
            self.widths += [1] * (a - left) + [left + anchor + right] + [1] * (b - right + 1)
        self.groups += 1

    def repeated(self):
        """(key, from, to) of the repeated starts of each context."""
        t, n = self.symbols, len(self.symbols)
        array = linear_grouping(t)
        common = common_prefixes(t, array)
        best = [0] * (n + 1)
        for r, i in enumerate(array):
            best[i] = max(common[r], common[r + 1] if r + 1 < n else 0)
        reach = np.concatenate([[0], np.cumsum(self.widths)]).tolist()
        for key, own, at, first, left, kept in self.rows:
            hit = []
            for k in range(kept - left + 1):
                i = at - kept + k  # the start that this symbol stands for, the anchor's symbol for several
                spare = reach[first + k + best[first + k]] - reach[first + k] - self.length
                if spare >= 0:
                    hit.append((i, min(i + spare, at) + 1 if k == kept - left else i + 1))
            lo = hi = -1
            for a, b in hit:
                a, b = max(a, 0), min(b, own)
                if a < b:
                    if a > hi:
                        if hi > lo:
                            yield key, lo, hi
                        lo = a
                    hi = max(hi, b)
            if hi > lo:
                yield key, lo, hi


class Anchors:
    """Anchors of a text: place of each, its first start and number of starts, hash of anchor and context."""

    def __init__(self, length: int, anchor: int):
        self.length, self.anchor = length, anchor
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def powers(self, n: int) -> None:
        if len(self.up) <= n:
            n = max(n + 1, 2 * len(self.up))
            self.up = np.full(n, BASE, dtype=np.uint64)
            self.down = np.full(n, pow(BASE, -1, 1 << 64), dtype=np.uint64)
            self.up[0] = self.down[0] = 1
            self.up, self.down = np.multiply.accumulate(self.up), np.multiply.accumulate(self.down)

    def sums(self, data: bytes) -> np.ndarray:
        self.powers(len(data))
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, start, end) -> np.ndarray:
        """Hashes of the strings from start to end."""
        return fold((sums[end] - sums[start]) * self.down[start] + (np.asarray(end) - np.asarray(start)).astype(np.uint64))

    def of(self, data: bytes):
        """(prefix sums, hash of each anchor, first start, number of starts, place of the anchor after the first)."""
        n, w, k = len(data), self.length - self.anchor + 1, self.anchor
        if n < self.length:
            return None
        sums = self.sums(data)
        gram = fold((sums[k:] - sums[:-k]) * self.down[: n - k + 1] + np.uint64(k))
        low = np.uint64((1 << PLACE_BITS) - 1)
        firsts, owns, places = [], [], []
        for b in range(0, n - self.length + 1, 1 << (PLACE_BITS - 1)):
            e = min(n - self.length + 1, b + (1 << (PLACE_BITS - 1)))
            g = gram[b : e - 1 + w]
            # the least upper bits of the hash, the rightmost of equals: what decides is in the window alone
            least, span = (g & ~low) | (low - np.arange(len(g), dtype=np.uint64)), 1
            while span * 2 <= w:
                least = np.minimum(least[:-span], least[span:])
                span *= 2
            if w > span:
                least = np.minimum(least[: len(least) - (w - span)], least[w - span :])
            first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            owns.append(np.diff(np.concatenate([first, [len(least)]])))
            places.append((low - (least[first] & low)).astype(np.int64) - first)
            firsts.append(first + b)
        first, own, place = (np.concatenate(x) for x in (firsts, owns, places))
        return sums, gram[first + place], first, own, place


def _bytes(text) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def count_anchors(length: int, anchor: int):
    """(text) to (fp, n), summed within batches."""

    def run(batches):
        book = Anchors(length, anchor)
        for batch in batches:
            found = [x[1] for x in map(book.of, map(_bytes, batch.column(0).to_pylist())) if x]
            if found:
                fp, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(n)], ["fp", "n"])

    return run


def list_anchors(length: int, anchor: int, wanted):
    """(doc_id, th, text) to (fp, ctx, doc_id, th, s, own, at) of the anchors that the bit table lets pass."""

    def run(batches):
        book, table = Anchors(length, anchor), np.unpackbits(wanted.value, bitorder="little").view(bool)
        mask = np.uint64(len(table) - 1)
        for batch in batches:
            rows, which = [], []
            for i, t in enumerate(batch.column(2).to_pylist()):
                x = book.of(_bytes(t))
                if x:
                    sums, fp, first, own, place = x
                    hit = np.flatnonzero(table[(fp & mask).astype(np.int64)])
                    if len(hit):
                        fp, first, own, place = fp[hit], first[hit], own[hit], place[hit]
                        ctx = book.spans(sums, first, first + own - 1 + length)
                        rows.append((fp.view(np.int64), fold(ctx + (own * 65536 + place).astype(np.uint64)).view(np.int64), first, own, place))
                        which.append(np.full(len(hit), i))
            if rows:
                fp, ctx, first, own, place = (np.concatenate(x) for x in zip(*rows, strict=True))
                which = pa.array(np.concatenate(which))
                yield pa.RecordBatch.from_arrays([pa.array(fp), pa.array(ctx), batch.column(0).take(which), batch.column(1).take(which), pa.array(first), pa.array(own), pa.array(place)], ["fp", "ctx", "doc_id", "th", "s", "own", "at"])

    return run


def cut_contexts(length: int, anchor: int):
    """(text, asked) to (fp, ctx, n, own, at, anchor, data)."""

    def run(batches):
        for batch in batches:
            out = []
            for text, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = _bytes(text)
                for a in asked:
                    out.append((a["fp"], a["ctx"], a["n"], a["own"], a["at"], anchor, data[a["s"] : a["s"] + a["own"] - 1 + length]))
            cols = list(zip(*out, strict=True)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], pa.binary())], ["fp", "ctx", "n", "own", "at", "anchor", "data"])

    return run


def sort_contexts(length: int):
    """Rows (fp, ctx, own, at, anchor, data) sorted by (fp, ctx) to (fp, ctx, lo, hi), by suffix arrays of whole anchors."""

    def run(batches):
        def close(book):
            rows = [(*key, lo, hi) for key, lo, hi in book.repeated()] if book.rows else []
            cols = list(zip(*rows, strict=True)) if rows else [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["fp", "ctx", "lo", "hi"])

        book, group, now, size = Contexts(length), {}, None, 0
        for batch in batches:
            for fp, ctx, own, at, anchor, data in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if fp != now:
                    if len(group) > 1:
                        book.add(list(group.values()), size)
                    group, now, size = {}, fp, anchor
                    if len(book.symbols) > SYMBOLS:
                        yield close(book)
                        book = Contexts(length)
                group[ctx] = ((fp, ctx), own, at, data)
        if len(group) > 1:
            book.add(list(group.values()), size)
        yield close(book)

    return run


def split_contexts(length: int, block: int):
    """Contexts to parts of at most `block` starts: what all windows of a part share is its anchor, so parts meet only
    where that is equal. (fp, ctx, n, own, at, anchor, data) to (ofp, octx, off, fp, ctx, n, own, at, anchor, data)."""

    def run(batches):
        import xxhash

        signed = lambda h: h - 2**63
        for batch in batches:
            out = []
            for fp, ctx, n, own, at, _, data in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                # a part's distance from the anchor is fixed, and so is what the windows of a whole part share
                for b in range(max(0, at - own + 1) // block, at // block + 1):
                    first = at - (b + 1) * block + 1
                    off, end = max(0, first), min(own, first + block)
                    part = data[off : end - 1 + length]
                    core = data[first + block - 1 : first + length]
                    key = signed(xxhash.xxh3_64_intdigest(core + f"{fp},{b}".encode()))
                    whole = signed(xxhash.xxh3_64_intdigest(part + f"{end - off},{first - off}".encode()))
                    out.append((fp, ctx, off, key, whole, n, end - off, first + block - 1 - off, len(core), part))
            cols = list(zip(*out, strict=True)) if out else [()] * 10
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:9]), pa.array(cols[9], pa.binary())], ["ofp", "octx", "off", *CONTEXT])

    return run


CONTEXT = ["fp", "ctx", "n", "own", "at", "anchor", "data"]
CONTEXT_TYPES = "fp long, ctx long, n long, own long, at long, anchor long, data binary"


def repeated_starts(contexts: DataFrame, length: int, blocks: tuple[int, ...]) -> DataFrame:
    """(fp, ctx, lo, hi): the starts in each context that repeat in another one of its anchor, or in its own copies.

    contexts: one row for each (fp, ctx). Anchors of more than CROWD contexts are split into parts, in turn smaller.
    """
    out = contexts.filter("n > 1").select("fp", "ctx", F.lit(0).cast("long").alias("lo"), F.col("own").alias("hi"))
    several = contexts.groupBy("fp").agg(F.count("*").alias("m"), F.count_if(F.col("n") == 1).alias("single")).filter("m > 1 and single > 0")
    several = written(several, "anchors")
    some = contexts.join(several, "fp")
    few = some.filter(F.col("m") <= CROWD) if blocks else some
    few = few.select("fp", "ctx", "own", "at", "anchor", "data").repartition("fp").sortWithinPartitions("fp", "ctx")
    out = out.unionByName(few.mapInArrow(released(sort_contexts(length)), "fp long, ctx long, lo long, hi long"))
    if blocks and not several.filter(F.col("m") > CROWD).isEmpty():
        crowd = some.filter(F.col("m") > CROWD).select(*CONTEXT)
        parts = written(crowd.mapInArrow(split_contexts(length, blocks[0]), f"ofp long, octx long, off long, {CONTEXT_TYPES}"), "parts")
        distinct = parts.groupBy("fp", "ctx").agg(F.sum("n").alias("n"), *(F.first(c).alias(c) for c in CONTEXT[3:]))
        again = repeated_starts(written(distinct, "parts"), length, blocks[1:])
        back = parts.select("ofp", "octx", "off", "fp", "ctx").join(again, ["fp", "ctx"])
        out = out.unionByName(back.select(F.col("ofp").alias("fp"), F.col("octx").alias("ctx"), (F.col("off") + F.col("lo")).alias("lo"), (F.col("off") + F.col("hi")).alias("hi")))
    return out


def marked(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[DataFrame, DataFrame]:
    """(docs without any repeated byte, the others with one more column: array of (a, b), the repeated byte ranges of `text`).

    The ranges are sorted and disjoint. Together the two hold all rows and columns of docs.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("th"), F.col("text").cast("string").alias("text"))
    counted = keyed.select("text").mapInArrow(released(count_anchors(length, anchor)), "fp long, n long")
    again = written(counted.groupBy("fp").agg(F.sum("n").alias("n")).filter("n > 1").select(F.col("fp").alias("k")), "anchors")
    wanted = spark.sparkContext.broadcast(np.packbits(bit_filter(again, BITS), bitorder="little"))
    listed = keyed.mapInArrow(released(list_anchors(length, anchor, wanted)), "fp long, ctx long, doc_id long, th long, s long, own long, at long")
    listed = written(listed, "anchors")

    contexts = listed.groupBy("fp", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "s", "own", "at")).alias("r"))
    contexts = written(contexts.select("fp", "ctx", "n", "r.*"), "contexts")
    groups = contexts.groupBy("fp").agg(F.count("*").alias("m"), F.count_if(F.col("n") == 1).alias("single")).filter("m > 1 and single > 0").select("fp")
    groups = written(groups, "anchors")
    asked = written(contexts.join(groups, "fp"), "contexts")
    by_doc = asked.groupBy("doc_id", "th").agg(F.collect_list(F.struct("fp", "ctx", "n", "own", "at", "s")).alias("asked"))
    held = perhaps(keyed, "th", asked.select(F.col("th").alias("k")))
    same = held["doc_id"].eqNullSafe(by_doc["doc_id"]) & (held["th"] == by_doc["th"])
    cut = held.join(by_doc, same).select("text", "asked").mapInArrow(released(cut_contexts(length, anchor)), CONTEXT_TYPES)
    cut = written(cut.dropDuplicates(["fp", "ctx"]), "cut")
    repeats = contexts.join(groups, "fp", "left_anti").filter("n > 1").select("fp", "ctx", F.lit(0).cast("long").alias("lo"), F.col("own").alias("hi"))
    repeats = repeats.unionByName(repeated_starts(cut, length, (max(1, length // 8), max(1, length // 40), 1)))
    spans = listed.join(repeats, ["fp", "ctx"]).select("doc_id", "th", (F.col("s") + F.col("lo")).alias("a"), (F.col("s") + F.col("hi") - 1 + length).alias("b"))
    spans = written(spans.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("_spans")), "spans")

    th, of, hashed_as = unused(docs, "_th"), unused(docs, "_id"), unused(docs, "_t")
    hashed, found = docs.withColumn(th, F.xxhash64(F.col("text").cast("string"))), spans.select(F.col("th").alias("k"))
    clean, some = perhaps(hashed, th, found, inside=False).drop(th), perhaps(hashed, th, found)
    spans = spans.select(F.col("doc_id").alias(of), F.col("th").alias(hashed_as), F.col("_spans").alias(unused(docs, "_spans")))
    some = some.join(spans, some["doc_id"].cast("long").eqNullSafe(spans[of]) & (some[th] == spans[hashed_as]), "left")
    return clean, some.select(*(F.col(f"`{c}`") for c in docs.columns), unused(docs, "_spans"))


def _merged(spans):
    lo = hi = None
    for x in spans or ():
        if hi is None or x["a"] > hi:
            if hi is not None:
                yield lo, hi
            lo, hi = x["a"], x["b"]
        else:
            hi = max(hi, x["b"])
    if hi is not None:
        yield lo, hi


def _rest(data: bytes, runs) -> bytes:
    parts, at = [], 0
    for a, b in runs:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


def digest(batches):
    """(doc_id, text, _spans) to the figures of the removal."""
    for batch in batches:
        out = []
        for doc, text, spans in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            data, runs = _bytes(text), list(_merged(spans))
            out.append((doc, len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(_rest(data, runs)).hexdigest()))
        cols = list(zip(*out, strict=True)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeats_digest(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null texts count as empty; texts under `length` bytes cannot repeat. Repeated rows repeat one another, so texts
    of `length` bytes or more of theirs go entirely. Null ids are ids like any other. No rows give none.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    clean, some = marked(docs, length, anchor)
    zero = F.lit(0).cast("long")
    text = F.coalesce("text", F.lit(""))
    out = clean.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(text, 256).alias("kept_sha256"))
    return out.unionByName(some.select("doc_id", "text", "_spans").mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def repeats_removed(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """docs with the repeated bytes cut out of `text`; characters cut in part go whole, n_chars follows. Rows stay."""

    def run(batches):
        for batch in batches:
            texts, spans = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            out = [None if t is None else _rest(_bytes(t), list(_merged(x))).decode("utf-8", "ignore") if x else t for t, x in zip(texts, spans, strict=True)]
            cols = batch.columns[:-1]
            cols[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names)

    names, at = docs.columns, docs.columns.index("text")
    clean, some = marked(docs, length, anchor)
    some = some.mapInArrow(run, docs.schema)
    if "n_chars" in names:
        some = some.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.unionByName(some.select(*names))


def op8_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_digest(table(spark, f"{sf_dir}/documents.parquet"))


QUERIES = {"op8_linear_grouping": op8_linear_grouping}
ORACLE: dict[str, str] = {}
