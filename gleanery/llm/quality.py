"""Quality rules and n-gram perplexity.

The language model is a modified Kneser-Ney model of order 5 over characters, across words: a document is one run
of words with one symbol for the blanks between two, one model for each language. Spark counts the n-grams of all documents that
the base rules let pass: each run of characters is pre-aggregated to its different n-grams, then groupBy sums them.
Continuation counts, discounts and interpolation are DataFrame operations on the n-gram tables, so no language is ever
gathered in one task.

The model is kept as sorted arrays of the n-grams' 64-bit hashes and log probabilities, 12 bytes an entry, none left out but
those found once in different texts, which would let the text that holds them, or its copies, vouch for itself; what they weigh
goes to the back-off weights, so probabilities still add up to 1. They are gathered and broadcast in shards of at most about
`SHARD` entries, and mapped from the broadcasts' files, so what a process must hold does not grow with the corpus.

Perplexity bands are per language: a document's log perplexity must lie within `LOW` robust standard deviations below its
language's median, and `HIGH` above it, where texts with a passage in another language have a long tail. Deviations are times sqrt(characters), and their spread is that of
documents of the language with a like length (powers of two), since what is left of sampling error after that differs with
length; where these are fewer than `LEAST`, it is the median distance from the middle, which takes half of them to be moved where
quartiles take a quarter, and at least the language's. A language with fewer documents has at
least `FEW` of such deviations. Copies of a text count as one in medians and deviations. Beyond the upper perplexity band a text is gibberish or markup, beyond the lower one it is
a stock phrase repeated.
"""

from __future__ import annotations

import itertools
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import fold, perhaps, ranges, released, slices, written
from gleanery.sources.files import table

ORDER = 5
BEGIN, END = "\x02", "\x03"
LOW, HIGH = 4.0, 6.0
LEAST, FEW = 100, 1.0
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
FEW_BANDS = 100_000
SLICE_CHARS = 1_000_000
COUNT_CHARS = 2_500_000
PIECE = 500_000  # n-grams of a long text that are counted or scored at a time
SHARD = 1 << 21  # entries of the model that are gathered and broadcast at a time
MARK = b"kneser-ney arrays"

_MULT = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


def _points(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def _gram_hash(points: np.ndarray, at: np.ndarray, n: int, salt: int) -> np.ndarray:
    """Hash of the n code points from each position; the salt tells languages and kinds apart."""
    salt = np.uint64((salt + n * 0x2545F4914F6CDD1D) & (2**64 - 1))
    if 2 * len(at) > len(points):  # most positions: all of them, without look-ups
        size = len(points) - n + 1
        h = points[:size] * np.uint64(_MULT[0])
        for k in range(1, n):
            h += points[k : k + size] * np.uint64(_MULT[k])
        h = h[at]
    else:
        h = points[at] * np.uint64(_MULT[0])
        for k in range(1, n):
            h += points[at + k] * np.uint64(_MULT[k])
    return fold(h + salt)


def _salt(lang: str, kind: str) -> int:
    import zlib

    data = f"{kind}:{lang}".encode()
    return zlib.crc32(data) << 32 | zlib.crc32(data[::-1])


def _runs(words, across: bool) -> list[str]:
    """A text's words (bytes), or, across blanks, the text as one run with END for each run of blanks."""
    if across:
        words = [END.encode().join(words)] if words else []
    return [w.decode("utf-8", "surrogatepass") for w in words]


def _pieces(run: str):
    """The padded run in pieces of at most PIECE n-grams, each with the context of its first."""
    padded = BEGIN * (ORDER - 1) + run + END
    for s in range(0, len(run) + 1, PIECE):
        yield padded[s : s + PIECE + ORDER - 1]


def _slots(pieces: list[str]):
    """(text of all pieces, its code points, start of each n-gram, index of its piece)."""
    text = "".join(pieces)
    size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    first, count = np.cumsum(size) - size, size - (ORDER - 1)
    return text, _points(text), ranges(first, count), np.repeat(np.arange(len(pieces)), count)


def _different(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a place of each different hash in order, first rank of each, ranks' places)."""
    order = np.argsort(h)
    line = h[order]
    start = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else order
    return order[start], start, order


def _failed(sizes: np.ndarray, repeat: np.ndarray) -> np.ndarray:
    """Which documents the base rules reject."""
    return (sizes < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * sizes)


def count_grams(across: bool, passing: bool):
    """(lang, text) to (lang, gram, n) of each run of about COUNT_CHARS characters; with passing, of the texts only that the
    base rules let pass."""

    def grams_of(lang, pieces):
        text, points, at, _ = _slots(pieces)
        place, start, order = _different(_gram_hash(points, at, ORDER, 0))
        n = np.diff(np.append(start, len(order)))
        grams = [text[i : i + ORDER] for i in at[place].tolist()]
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(n)], ["lang", "gram", "n"])

    def run(batches):
        held: dict[str, list[str]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(texts, SLICE_CHARS):
                words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts[lo:hi]]
                if passing:
                    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
                    codes = _codes(list(itertools.chain.from_iterable(words)))
                    words = [() if f else w for w, f in zip(words, _failed(sizes, _repeated(codes, sizes)).tolist(), strict=True)]
                for lang, found in zip(langs[lo:hi], words, strict=True):
                    lang = lang or ""
                    for piece in itertools.chain.from_iterable(map(_pieces, _runs(found, across))):
                        held.setdefault(lang, []).append(piece)
                        size[lang] = size.get(lang, 0) + len(piece)
                        if sum(size.values()) > COUNT_CHARS:
                            most = max(size, key=size.get)
                            yield grams_of(most, held.pop(most))
                            del size[most]
        for lang, pieces in held.items():
            yield grams_of(lang, pieces)

    return run


def kneser_ney(counts: DataFrame, again: bool = False) -> list[tuple[DataFrame, DataFrame]]:
    """Tables of the orders 1..ORDER: (lang, gram, lp) and the back-off weights (lang, ctx, lb).

    counts: (lang, gram, c) of the highest order. N-grams from the beginning of a word keep their own counts in
    lower orders, all others count their different left neighbours.

    With again, n-grams of orders 2 and up that were found once only are left out; f is how often one was found, whatever its
    order. Their whole counts go to the back-off weight of their context, so the probabilities behind any context still add up to 1.
    """
    tables = {ORDER: written(counts.withColumn("f", F.col("c")), "kn-counts")}
    for k in range(ORDER - 1, 0, -1):
        up = tables[k + 1].withColumn("gram", F.expr(f"right(gram, {k})"))
        c = F.when(F.first(F.col("gram").startswith(BEGIN)), F.sum("c")).otherwise(F.count("*"))
        tables[k] = written(up.groupBy("lang", "gram").agg(c.alias("c"), F.sum("f").alias("f")), "kn-counts")
    out = []
    lower = None
    for k in range(1, ORDER + 1):
        t = tables[k].withColumn("ctx", F.expr(f"left(gram, {k - 1})"))
        n1, n2, n3, n4 = (F.count_if(F.col("c") == i) for i in (1, 2, 3, 4))
        y = n1 / F.greatest(n1 + 2 * n2, F.lit(1))
        kept = lambda d, i: F.least(F.greatest(d, F.lit(0.1)), F.lit(i - 0.05))
        discounts = t.groupBy("lang").agg(
            kept(1 - 2 * y * n2 / F.greatest(n1, F.lit(1)), 1).alias("d1"),
            kept(2 - 3 * y * n3 / F.greatest(n2, F.lit(1)), 2).alias("d2"),
            kept(3 - 4 * y * n4 / F.greatest(n3, F.lit(1)), 3).alias("d3"),
            F.count("*").alias("types"),
        )
        stays = (F.col("f") > 1) if again and k > 1 else F.lit(True)
        of = [F.count_if(stays & (F.col("c") == i if i < 3 else F.col("c") >= 3)).alias(f"n{i}") for i in (1, 2, 3)]
        context = t.groupBy("lang", "ctx").agg(F.sum("c").alias("total"), *of, F.sum(F.when(stays, 0).otherwise(F.col("c"))).alias("out"))
        context = context.filter(F.col("n1") + F.col("n2") + F.col("n3") > 0).join(discounts, "lang")
        context = context.withColumn("weight", (F.col("d1") * F.col("n1") + F.col("d2") * F.col("n2") + F.col("d3") * F.col("n3") + F.col("out")) / F.col("total"))
        j = t.filter(stays).join(context, ["lang", "ctx"])
        d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        own = F.greatest(F.col("c") - d, F.lit(0.0)) / F.col("total")
        if lower is None:
            j = j.withColumn("lp", F.log(own + F.col("weight") / (F.col("types") + 1)))
        else:
            below = lower.select("lang", F.col("gram").alias("suffix"), F.exp("lp").alias("p_low"))
            j = j.withColumn("suffix", F.expr(f"right(gram, {k - 1})")).join(below, ["lang", "suffix"]).withColumn("lp", F.log(own + F.col("weight") * F.col("p_low")))
        lower = written(j.select("lang", "gram", "lp"), "kn-model")
        out.append((lower, context.select("lang", "ctx", F.log("weight").alias("lb"))))
    return out


def _keyed(order: int, kind: str):
    def run(batches):
        for batch in batches:
            langs, grams = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            key = np.zeros(len(grams), dtype=np.uint64)
            by: dict[str, list[int]] = {}
            for i, lang in enumerate(langs):
                by.setdefault(lang, []).append(i)
            for lang, rows in by.items():
                points = _points("".join(grams[i] for i in rows))
                key[rows] = _gram_hash(points, np.arange(len(rows), dtype=np.int64) * order, order, _salt(lang, kind))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(2).cast(pa.float32())], ["key", "value"])

    return run


def texts_once(docs: DataFrame) -> DataFrame:
    """(lang, text) with each text of a language once. Only texts whose hash is found again, and a few by chance, are shuffled."""
    rows = docs.select("lang", "text", F.xxhash64("lang", "text").alias("h"))
    again = written(rows.groupBy("h").count().filter("count > 1").select(F.col("h").alias("k")), "kn-copies")
    once = perhaps(rows, "h", again, inside=False)
    return once.unionByName(perhaps(rows, "h", again).dropDuplicates(["h"])).select("lang", "text")


def model_table(docs: DataFrame, text: str = "text", lang: str = "lang", across: bool = False, passing: bool = False, others: bool = False) -> DataFrame:
    """(key, value) of all n-grams and back-off weights of all orders, of all texts or of those that pass the base rules, in
    files by the first bits of the key.

    With others, equal texts count as one and n-grams found once are left out: a text of the corpus that holds such an n-gram
    holds the one that was counted, or is a copy of that text, so neither can vouch for itself.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    rows = texts_once(rows) if others else rows
    counts = rows.mapInArrow(released(count_grams(across, passing)), "lang string, gram string, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("c"))
    keyed = None
    for k, (grams, contexts) in enumerate(kneser_ney(counts, others), 1):
        parts = [grams.select("lang", "gram", "lp").mapInArrow(_keyed(k, "p"), "key long, value float")]
        if k > 1:
            parts.append(contexts.select("lang", "ctx", "lb").mapInArrow(_keyed(k - 1, "b"), "key long, value float"))
        for x in parts:
            keyed = x if keyed is None else keyed.unionByName(x)
    bits = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1, 31).bit_length()
    return written(keyed.repartitionById(1 << bits, F.shiftrightunsigned("key", 64 - bits).cast("int")).sortWithinPartitions("key"), "kn-arrays")


def shards(table: DataFrame):
    """Sorted (keys, values) of at most about SHARD entries, by the first bits of the keys, one after another. A shard is a range of
    keys, so of a table in files by key each is read from its own files alone."""
    n, bits = table.count(), 0
    while n >> bits > SHARD:
        bits += 1
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for i in range(1 << bits):
        mine = F.col("key").between(signed(i << 64 - bits), signed((i + 1 << 64 - bits) - 1)) if bits else F.lit(True)
        part = table.filter(mine).toArrow()
        keys, values = part.column("key").to_numpy().view(np.uint64), part.column("value").to_numpy()
        order = np.argsort(keys)
        yield keys[order], values[order]


def packed(keys: np.ndarray, values: np.ndarray) -> bytes:
    """Both arrays behind MARK, padded so that the keys are aligned in the file of a broadcast."""
    head = MARK + len(keys).to_bytes(8, "little")
    at = pickle.dumps(head + bytes(1 << 17), pickle.HIGHEST_PROTOCOL).index(MARK) + len(head) + 1
    pad = -at % 8
    return b"".join([head, bytes([pad]), bytes(pad), keys.tobytes(), values.tobytes(), bytes(1 << 17)])


def unpacked(broadcast) -> tuple[np.ndarray, np.ndarray]:
    """The arrays of a broadcast of packed(), mapped from its file where the executor has one: workers share its pages."""
    path = getattr(broadcast, "_path", None)
    data = np.memmap(path, np.uint8, "r") if path else np.frombuffer(broadcast.value, np.uint8)
    at = data[:64].tobytes().find(MARK)
    if at < 0:
        data = np.frombuffer(broadcast.value, np.uint8)
        at = 0
    at += len(MARK)
    n = int.from_bytes(data[at : at + 8].tobytes(), "little")
    at += 9 + int(data[at + 8])
    keys, values = data[at : at + 8 * n], data[at + 8 * n : at + 12 * n]
    return np.require(keys.view(np.uint64), requirements="A"), np.require(values.view(np.float32), requirements="A")


class Model:
    """Sorted hash arrays of a Kneser-Ney model in shards by the first bits of the hash, and their look-ups."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]):
        self.parts, self.bits = parts, len(parts).bit_length() - 1

    @classmethod
    def trained(cls, docs: DataFrame, text: str = "text", lang: str = "lang", across: bool = False) -> Model:
        return cls(list(shards(model_table(docs, text, lang, across))))

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hit, value = np.zeros(len(h), dtype=bool), np.zeros(len(h))
        which = h >> np.uint64(64 - self.bits) if self.bits else np.zeros(len(h), dtype=np.uint64)
        for i, (keys, values) in enumerate(self.parts):
            mine = np.flatnonzero(which == i)
            if len(mine) and len(keys):
                at = np.minimum(np.searchsorted(keys, h[mine]), len(keys) - 1)
                hit[mine], value[mine] = keys[at] == h[mine], values[at]
        return hit, value

    def _grams(self, lang: str, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log probability of the last symbol of each n-gram."""
        place, start, order = _different(_gram_hash(points, at, ORDER, _salt(lang, "p")))
        first = at[place]
        lp = np.zeros(len(first))
        open_ = np.arange(len(first))
        for k in range(ORDER, 0, -1):
            begin = first[open_] + (ORDER - k)
            hit, value = self._find(_gram_hash(points, begin, k, _salt(lang, "p")))
            lp[open_[hit]] += value[hit]
            open_, begin = open_[~hit], begin[~hit]
            if not len(open_):
                break
            if k > 1:
                hit, value = self._find(_gram_hash(points, begin, k - 1, _salt(lang, "b")))
                lp[open_[hit]] += value[hit]
            else:
                lp[open_] -= 16.0
        out = np.empty(len(at))
        out[order] = np.repeat(lp, np.diff(np.append(start, len(order))))
        return out

    def score(self, lang: str, runs: list[str]) -> np.ndarray:
        """Log probability of each run, its end included."""
        out = np.zeros(len(runs))
        held, of, size = [], [], 0
        for i, run in enumerate(runs):
            for piece in _pieces(run):
                held.append(piece)
                of.append(i)
                size += len(piece)
                if size > SLICE_CHARS:
                    out += self._sums(lang, held, of, len(runs))
                    held, of, size = [], [], 0
        return out + self._sums(lang, held, of, len(runs)) if held else out

    def _sums(self, lang, pieces, of, n):
        _, points, at, which = _slots(pieces)
        return np.bincount(np.array(of)[which], weights=self._grams(lang, points, at), minlength=n)


def _codes(words) -> np.ndarray:
    """A 64-bit number for each word (bytes), the same for equal ones in a process."""
    return np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)


def _repeated(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each document, its words in 5-word windows that are found twice or more in it."""
    n = len(codes)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    cover = np.zeros(n + 1, dtype=np.int64)
    if n >= 5:
        h = (doc[: n - 4].astype(np.uint64) + np.uint64(1)) * np.uint64(_MULT[0] ^ _MULT[1])
        for k in range(5):
            h += codes[k : n - 4 + k] * np.uint64(_MULT[k])
        h = fold(h)
        at = np.flatnonzero(doc[: n - 4] == doc[4:])
        order = np.argsort(h[at], kind="stable")
        at, h = at[order], h[at][order]
        same = h[1:] == h[:-1]
        twice = at[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        np.add.at(cover, twice, 1)
        np.subtract.at(cover, twice + 5, 1)
    return np.bincount(doc, weights=np.cumsum(cover[:n]) > 0, minlength=len(sizes)).astype(np.int64)


def judge(model):
    """Batches of (doc_id, lang, text) to the figures of each document; model: the broadcast shards of a Model."""

    def run(batches):
        m = Model([unpacked(b) for b in model])
        blank = " \t\n\x0b\x0c\r"

        def figures(ids, langs, texts):
            sizes, chars, symbols, dup, codes, at = [], [], [], [], [], {}
            for i, (lang, text) in enumerate(zip(langs, texts, strict=True)):
                text, lang = text or "", lang or ""
                words = text.encode("utf-8", "surrogatepass").split()
                codes.append(_codes(words))
                if words:
                    at.setdefault(lang, []).append((i, END.encode().join(words).decode("utf-8", "surrogatepass")))
                sizes.append(len(words))
                chars.append(len(text) - sum(map(text.count, blank)))
                symbols.append(sum(map(text.count, "#*$%&|<>")))
                seen, again = set(), 0
                for line in text.split("\n"):
                    if line in seen:
                        again += 1
                    elif line.strip(blank):
                        seen.add(line)
                dup.append(again)
            lp = np.zeros(len(texts))
            for lang, rows in at.items():
                lp[[i for i, _ in rows]] = m.score(lang, [run for _, run in rows])
            sizes = np.array(sizes, dtype=np.int64)
            repeat = _repeated(np.concatenate(codes) if codes else np.zeros(0, dtype=np.uint64), sizes)
            chars = np.array(chars, dtype=np.int64)
            steps = chars + sizes
            cols = [pa.array(ids, pa.int64()), pa.array([x or "" for x in langs], pa.string())]
            cols += [pa.array(np.asarray(x, dtype=np.int64)) for x in (sizes, chars, symbols, dup, repeat, steps)]
            return pa.RecordBatch.from_arrays([*cols, pa.array(lp / np.maximum(steps, 1))], FIGURES)

        for batch in batches:
            ids, langs, texts = (batch.column(k).to_pylist() for k in range(3))
            for lo, hi in slices(texts, SLICE_CHARS):
                yield figures(ids[lo:hi], langs[lo:hi], texts[lo:hi])

    return run


FIGURES = ["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_steps", "mean_lp"]


def quality(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """One row per document: doc_id, lang, the base figures, base_failed, kept, perplexity and its band.

    Null and empty texts have no words, fail the base rules and are not kept. A null language is one of its own.
    Null ids and repeated rows are judged like any other row; a table without rows gives none. Model and bands are taken
    from the documents that pass the base rules; where a language has none, nothing of it is kept anyway. Very long texts are
    counted and scored whole, in pieces. Other columns are left out.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    model = [spark.sparkContext.broadcast(packed(*part)) for part in shards(model_table(docs, across=True, passing=True, others=True))]
    schema = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_steps long, mean_lp double"
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    figures = written(docs.mapInArrow(released(judge(model)), schema), "quality").withColumn("base_failed", failed)
    steps = F.greatest("n_steps", F.lit(1))
    figures = figures.withColumn("length", F.floor(F.log2(steps)).cast("int"))
    quarters = lambda c: F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(10_000))
    wide = lambda q: (F.col(q)[2] - F.col(q)[0]) / 1.349
    # copies of a text, which have the same figures, are one in the bands
    good = figures.filter("not base_failed").dropDuplicates(["lang", "n_words", "n_steps", "n_repeat_words", "mean_lp"])
    middles = written(good.groupBy("lang").agg(F.percentile_approx("mean_lp", F.lit(0.5), F.lit(10_000)).alias("middle")), "bands")
    middles = F.broadcast(middles) if middles.count() <= FEW_BANDS else middles
    good = good.join(middles, "lang").withColumn("z", (F.col("mean_lp") - F.col("middle")) * F.sqrt(steps))
    langs = good.groupBy("lang").agg(F.first("middle").alias("middle"), quarters("z").alias("ql"), F.count("*").alias("nl"))
    far = F.percentile_approx(F.abs("z"), F.lit(0.5), F.lit(10_000)) * 1.4826
    lengths = good.groupBy("lang", "length").agg(quarters("z").alias("qb"), far.alias("far"), F.count("*").alias("nb"))
    # spread times sqrt(characters)
    scaled = F.when(F.col("nb") >= LEAST, wide("qb")).otherwise(F.greatest("far", wide("ql")))
    scaled = F.when(F.col("nl") >= LEAST, scaled).otherwise(F.greatest(scaled, F.lit(FEW)))
    bands = written(lengths.join(langs, "lang").select("lang", "length", "middle", scaled.alias("scaled")), "bands")
    # rows by language and length; where they are few, as languages are, the join need not deal out documents by them
    out = figures.join(F.broadcast(bands) if bands.count() <= FEW_BANDS else bands, ["lang", "length"], "left")
    reach = F.col("scaled") / F.sqrt(steps)
    within = (F.col("mean_lp") - F.col("middle")).between(-high * reach, low * reach)
    return out.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(within, F.lit(False))).alias("kept"),
        F.exp(-F.col("mean_lp")).alias("perplexity"),
        F.exp(-(F.col("middle") + low * reach)).alias("band_low"),
        F.exp(-(F.col("middle") - high * reach)).alias("band_high"),
    )


def op1_kneser_ney_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, f"{sf_dir}/documents.parquet"))


QUERIES = {"op1_kneser_ney_perplexity": op1_kneser_ney_perplexity}
ORACLE: dict[str, str] = {}
