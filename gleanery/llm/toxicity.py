"""Toxicity: noisy-channel deobfuscation, then a linear score of the restored text.

Suspicious tokens (letters mixed with digits or signs, drawn-out letters) and runs of spaced single letters open a
lattice of what each character may stand for; Viterbi picks the reading that a character trigram model and the
channel's costs favour most. The trigram model is counted over all documents. The words of the text as written
and as restored are the features of an L1-regularised logistic regression.

The classifier is fitted on at most `SAMPLE` labelled documents, those with the smallest hash of their id, one text each: the
documented bound of what the driver holds (the different words of so many texts) and, with it, of the weights that are
broadcast, one for each word of at least `MIN_DOCS` of them. The 64**3 trigram table is counted over all documents.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.sources.files import table

SAMPLE = 12_000
MIN_DOCS = 4
L1 = 4e-3
MISS = 4.0  # how much a toxic document weighs in the fit, against a clean one
MEMO = 300_000

CLASSES = 64
LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßéèêàâçñíóáúœîïûôùëìò"

#: What a character may stand for besides itself.
STANDS_FOR = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
SUBSTITUTE, SHRINK, DROP = -1.0, -1.0, -8.0
FILLERS = "-_.*~'"
EDGE = "".join(c for c in "!\"#%&'()*+,-./:;<=>?[\\]^_`{|}~")

SPACED = re.compile(r"(?<![^\s.,;:!?\"'(])[^\W_](?:[ .\-_*]{1,2}[^\W_]){3,}(?![^\s.,;:!?\"')])")
SUSPECT = re.compile(r"[^\W\d_][0-9@$!|+€_.*~'-]+[^\W\d_]|[0-9@$!|+€][^\W\d_]|([^\W\d_])\1\1")


def classes() -> np.ndarray:
    """Class of each code point below 0x10000: 0 for white space and all that is no letter, 1.. for letters."""
    table = np.zeros(0x10000, dtype=np.int64)
    for i, c in enumerate(LETTERS, 1):
        table[ord(c)] = i
    return table


def count_trigrams(batches):
    """(cell, n) of each partition: character trigrams of lower-cased texts, words set off by blanks."""
    table, total = classes(), np.zeros(CLASSES**3, dtype=np.int64)
    for batch in batches:
        for t in batch.column(0).to_pylist():
            if t:
                points = np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
                c = table[np.minimum(points, 0xFFFF)]
                if len(c) > 2:
                    cell = (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:]
                    if len(cell) > 20_000:
                        total += np.bincount(cell, minlength=CLASSES**3)
                    else:
                        np.add.at(total, cell, 1)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["cell", "n"])


def trigram_model(docs: DataFrame) -> np.ndarray:
    """log p(c | a, b) as an array of 64**3: the sums that come back to the driver are as many at most."""
    counts = docs.select(F.col("text").cast("string")).mapInArrow(count_trigrams, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = counts.toArrow()
    c = np.zeros(CLASSES**3)
    c[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    c3 = c.reshape(CLASSES, CLASSES, CLASSES)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    p1 = (c1 + 1) / (c1.sum() + CLASSES)
    p2 = (c2 + 5 * p1[None, :]) / (c2.sum(1, keepdims=True) + 5)
    p3 = (c3 + 2 * p2[None, :, :]) / (c3.sum(2, keepdims=True) + 2)
    return np.log(p3).astype(np.float32)


class Channel:
    """Restores what an obfuscated token stands for."""

    def __init__(self, lp: np.ndarray):
        self.lp, self.table = lp, classes()

    def _runs(self, token: str):
        out: list[list] = []
        for c in token:
            if out and out[-1][0] == c:
                out[-1][1] += 1
            else:
                out.append([c, 1])
        return out

    def _options(self, c: str, n: int) -> list[tuple[str, float]]:
        """What a run of n characters c may yield, and at what cost."""
        if c in FILLERS:
            return [("", 0.0)]
        if c in STANDS_FOR or c.isdigit():
            return [("", DROP)] + [(s * k, SUBSTITUTE) for s in STANDS_FOR.get(c, "") for k in ((1, 2) if n > 1 else (1,))]
        return [(c, 0.0 if n == 1 else SHRINK)] + ([(c * 2, 0.0 if n == 2 else SHRINK)] if n > 1 else [])

    def decode(self, token: str) -> str:
        """The best reading of a lower-case token: each run of a character yields it once or, where it is written twice
        or more, twice, what it may stand for, or, for fillers, nothing. Linear in the token's length."""
        code = lambda c: int(self.table[min(ord(c), 0xFFFF)])
        states = {(0, 0): (0.0, None)}
        for c, n in self._runs(token):
            options = self._options(c, n)
            new: dict = {}
            for (a, b), (score, back) in states.items():
                for emit, cost in options:
                    x, y, s = a, b, score + cost
                    for e in emit:
                        z = code(e)
                        s += float(self.lp[x, y, z])
                        x, y = y, z
                    if (x, y) not in new or s > new[x, y][0]:
                        new[x, y] = (s, (back, emit))
            states = new
        best = max(((s + float(self.lp[x, y, 0]), back) for (x, y), (s, back) in states.items()), key=lambda v: v[0], default=(0.0, None))[1]
        parts = []
        while best:
            best, emit = best
            parts.append(emit)
        return "".join(reversed(parts))

    def readings(self, token: str) -> tuple[str, ...]:
        """Words that a white-space token of lower-case text counts as: without its punctuation, and restored."""
        bare = token.strip(EDGE + "@$")
        words = [bare] if bare else []
        if SUSPECT.search(token):
            for x in {token.strip("\"#%&'()*,-./:;<=>?[\\]^_`{}~").rstrip("!+|"), bare}:
                if x and not x.isdigit():
                    words.append(self.decode(x))
        return tuple(dict.fromkeys(w for w in words if w))

    def spaced(self, text: str) -> list[str]:
        """Words written letter by letter."""
        return [self.decode("".join(c for c in m[0] if c not in " .-_*")) for m in SPACED.finditer(text)]


def _hash(word: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) - 2**63


class _Readings(dict):
    """Values of white-space tokens, each found once; emptied between texts when it holds too many."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, token):
        value = self[token] = self.make(token)
        return value


def featurize(lp):
    """(key, y, text) to (key, y, hashes of the text's different words)."""

    def run(batches):
        channel = Channel(lp.value)
        memo = _Readings(lambda t: tuple(map(_hash, channel.readings(t))))
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                t = (t or "").lower()
                found = {h for token in set(t.split()) for h in memo[token]}
                found.update(map(_hash, channel.spaced(t)))
                out.append(sorted(found))
                if len(memo) > MEMO:
                    memo.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], ["y", "words"])

    return run


def fit(y: np.ndarray, words: list[np.ndarray], l1: float = L1, steps: int = 150) -> tuple[np.ndarray, np.ndarray, float]:
    """L1 logistic regression over present words by FISTA: (hashes, weights, bias). Words in under MIN_DOCS documents
    are left out."""
    n = len(y)
    if n == 0 or y.min() == y.max():
        p = min(max(float(y.mean()) if n else 0.5, 1e-3), 1 - 1e-3) if n else 0.5
        return np.zeros(0, dtype=np.int64), np.zeros(0), float(np.log(p / (1 - p)))
    size = np.fromiter(map(len, words), dtype=np.int64, count=n)
    flat = np.concatenate(words) if size.sum() else np.zeros(0, dtype=np.int64)
    names, col, df = np.unique(flat, return_inverse=True, return_counts=True)
    keep = df >= MIN_DOCS
    row = np.repeat(np.arange(n), size)[keep[col]]
    col = (np.cumsum(keep) - 1)[col[keep[col]]]
    names = names[keep]
    # columns are scaled by their spread, so that the penalty treats rare words as it treats frequent ones
    scale = 1 / np.sqrt(np.maximum(df[keep] / n * (1 - df[keep] / n), 1e-4))
    mean = df[keep] / n * scale
    w, b = np.zeros(len(names)), float(np.log(y.mean() / (1 - y.mean())))
    v, vb, t, rate = w.copy(), b, 1.0, None
    x = lambda u: np.bincount(row, weights=(u * scale)[col], minlength=n) - mean @ u
    xt = lambda r: np.bincount(col, weights=r[row], minlength=len(names)) * scale - mean * r.sum()
    u = np.random.default_rng(0).standard_normal(len(names))
    for _ in range(12):  # largest eigenvalue by power iteration
        u = xt(x(u)) / n
        norm = np.linalg.norm(u) or 1.0
        u /= norm
    rate = 1 / (0.25 * max(norm, 1.0) * 1.1)
    weight = np.where(y == 1, MISS, 1.0)
    rate /= MISS
    for _ in range(steps):
        r = 1 / (1 + np.exp(-np.clip(x(v) + vb, -30, 30))) - y
        r *= weight
        new = v - rate * xt(r) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
        nb = vb - rate * r.mean()
        t, told = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, vb = new + (told - 1) / t * (new - w), nb + (told - 1) / t * (nb - b)
        w, b = new, nb
    used = w != 0
    return names[used], (w * scale)[used], b - float(mean @ w)


def scorer(lp, weights):
    def run(batches):
        channel = Channel(lp.value)
        names, values, bias = weights.value
        book = dict(zip(names.tolist(), values.tolist(), strict=True))
        hit = lambda words: tuple(h for h in map(_hash, words) if h in book)
        memo = _Readings(lambda t: hit(channel.readings(t)))
        for batch in batches:
            scores = []
            for t in batch.column(1).to_pylist():
                t = (t or "").lower()
                found = {h for hs in map(memo.__getitem__, set(t.split())) if hs for h in hs}
                found.update(hit(channel.spaced(t)))
                z = bias + sum(book[h] for h in sorted(found))
                scores.append(float(1 / (1 + np.exp(-max(-30.0, min(30.0, z))))))
                if len(memo) > MEMO:
                    memo.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the text enters a score. Null and empty texts get the score of a text without words. Labels of held-out
    ids, null labels and null ids are never learned from; without labels of both kinds every score is their rate
    (a half where there are none). Repeated rows are scored alike. An id with several labels counts as toxic if one says so;
    one with several texts is learned from that with the smallest hash. Very long texts are scored whole.
    """
    sc = docs.sparkSession.sparkContext
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    lp = sc.broadcast(trigram_model(docs))
    marked = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("y")).filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # the sample's bound
    texts = docs.join(F.broadcast(marked), "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))
    learned = texts.orderBy("doc_id").select(F.col("y").cast("long").alias("y"), "text")
    got = learned.mapInArrow(featurize(lp), "y long, words array<long>").toArrow()
    y = got.column("y").to_numpy().astype(np.float64) if got.num_rows else np.zeros(0)
    weights = sc.broadcast(fit(y, [x.values.to_numpy() for x in got.column("words")]))
    scored = docs.mapInArrow(scorer(lp, weights), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, f"{sf_dir}/documents.parquet"), table(spark, f"{sf_dir}/labels.parquet"))


QUERIES = {"op10_noisy_channel_toxicity": op10_noisy_channel_toxicity}
ORACLE: dict[str, str] = {}
