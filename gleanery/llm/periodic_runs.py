"""Periodic runs of words by Lyndon arrays, in the way of Ellert and Fischer.

A run of period p holds, in one of the two orders of its alphabet, a longest Lyndon word of length p: a position l and its
next smaller suffix r = l + p. For each order the words are read once from left to right with a stack of suffixes that no later
one has undercut yet. A new suffix is compared with the top until one is smaller, which gives both the Lyndon array and how far
l and r match. Three things make these matches linear, with symbol comparisons alone, without suffix arrays or trees
and without fingerprints:

* suffixes that lie between two others in order match each of them at least as far as these match each other, so along the
  stack a match goes on where the last one ended, or follows from it without a look;
* of all matches so far one reaches furthest to the right, and what lies inside it is a copy: comparisons there have been made
  before, one period earlier;
* a comparison that leaves the copy begins at its end, and moves it.

Right matches and Lyndon arrays thus take at most 2 n comparisons an order (tests count them). How far l and r match to the left
is then asked only where r's first word is l's and the run may be long enough. Such a match ends after p words, before the
previous smaller suffix of l; its cost is within the smaller of two neighbouring subtrees of the Lyndon array, n log n over
all at worst. Nothing is shuffled: a document is one string.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import released
from gleanery.sources.files import table

LEAST = 12
WORD = r"[^\x20\x09-\x0D]+"


def lyndon_edges(w, n: int):
    """(at, next, match) for each position whose next smaller suffix begins with the same word; match: words they share.

    w holds n numbers and then one below all of them. Suffixes compare as w does, the end being smallest.
    """
    above, match_above = array("i", [-1]) * n, array("i", [0]) * n  # previous smaller suffix, and how far it matches
    below, match_below = array("i", [0]) * n, array("i", [0]) * n  # next smaller suffix, likewise
    edges = []
    i = j = end = 0  # suffixes i and j match up to `end`, the furthest of all matches so far
    for r in range(n):
        at, popped, match = r - 1, -1, -1  # suffix r matches the one popped last by `match` words
        while at >= 0:
            k, known = 0, False
            if popped >= 0:
                k = match_above[popped]  # suffixes `at` and r are both smaller than the popped one
                if k > match:
                    k, known, smaller = match, True, True
                elif k < match:
                    known, smaller = True, False
            if not known and r < end:  # the same words are at i, where they have been compared
                s, t = at - j + i if at >= j else at, r - j + i
                x = match_below[s] if below[s] == t else match_above[t] if above[t] == s else -1
                if 0 <= x < end - r:
                    k, known, smaller = x, True, w[r + x] < w[at + x]
                elif x >= 0 and k < end - r:
                    k = end - r
            if not known:
                if k or w[at] == w[r]:
                    while r + k < n and w[at + k] == w[r + k]:
                        k += 1
                    if r + k >= end:
                        i, j, end = at, r, r + k
                smaller = w[r + k] < w[at + k]
            if not smaller:
                above[r], match_above[r] = at, k
                break
            below[at], match_below[at] = r, k
            if k:
                edges.append((at, r, k))
            popped, match, at = at, k, above[at]
    return edges


def runs_of(codes: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """Sorted (start, length, period) of the runs of length >= max(least, 2 * period) that no neighbour extends.

    codes: numbers from 0 on, equal for equal words; any order of them will do.
    """
    n = len(codes)
    if n < max(least, 2):
        return []
    found, high = {}, max(codes)
    for w in (array("i", [*codes, -1]), array("i", [*(high - c for c in codes), -1])):
        for at, r, match in lyndon_edges(w, n):
            p = r - at
            need = max(least, 2 * p) - p - match  # words before `at` that make a run of it
            if need > min(p - 1, at):
                continue
            k, stop = 0, min(p, at)
            while k < stop and w[at - 1 - k] == w[r - 1 - k]:
                k += 1
            if need <= k < p:  # with p words the Lyndon word before this one reports the run
                found[at - k, p + match + k] = p
    return sorted((start, length, p) for (start, length), p in found.items())


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words but those that lie in a run behind its first period."""
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, p in runs:
        edge[start + p] += 1
        edge[start + length] -= 1
    return [w for w, covered in zip(words, np.cumsum(edge[:-1]).tolist(), strict=True) if not covered]


def finder(least: int):
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            sizes, found, collapsed, total = [0], [], [], []
            for text in batch.column(1).to_pylist():
                words = (text or "").encode().split()
                code: dict[bytes, int] = {}
                runs = runs_of([code.setdefault(w, len(code)) for w in words], least)
                found += runs
                sizes.append(len(found))
                total.append(len(words))
                collapsed.append(b" ".join(kept_words(words, runs) if runs else words))
            cols = np.array(found, dtype=np.int64).reshape(-1, 3).T
            runs = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays([pa.array(c) for c in cols], fields=list(run_type)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), runs, pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period, sorted), collapsed.

    Runs are stretches of at least max(least, 2 * period) words, maximal for their smallest period. collapsed holds the words,
    joined by one space, without those that lie in a run behind its first period. Null and empty texts have no words and
    no runs and collapse to an empty text. Rows are judged one by one, so null ids and repeated rows do not matter, and an empty
    table gives no rows; other columns are left out whatever their names. A very long text is one string, about
    150 bytes a word while it is at work.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(released(finder(least)), "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def with_periods(text: Column, doc_id: Column) -> Column:
    """The text, or, for documents whose id's CRC-32 is divisible by 10, its words with a stretch at the end made periodic."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def made(words):
        n = F.size(words)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(words, lambda _, i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    # as an element of an array the words are taken once, not for each of them
    words = F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    return F.when((h % 10 == 0) & text.rlike(WORD), F.get(F.transform(words, made), F.lit(0))).otherwise(text)


def op11_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, f"{sf_dir}/documents.parquet")
    found = periodic_runs(docs.select("doc_id", with_periods(F.col("text"), F.col("doc_id")).alias("text")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("b", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("b.s").alias("start"), (-F.col("b.l")).alias("length"), F.col("b.p").alias("period"),
        F.expr("-1000 * b.l div b.p").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op11_lyndon_runs": op11_lyndon_runs}
ORACLE: dict[str, str] = {}
