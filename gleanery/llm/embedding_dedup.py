"""Embedding near-duplicates by counting collisions of one-dimensional projections.

Unit vectors are projected on many random directions. Each direction and sign is a line; a vector is filed on the `top`
lines on which it reaches furthest, where few others are. A line is sorted by its projection, and a query's window on it, as wide as near pairs spread, holds the vectors
that collide with it there. For each pair so touched, once, on the first line that both are filed on, the
collisions of both vectors' windows on `PROJECTIONS` more projections are counted; pairs whose count reaches a threshold are
verified in double precision. No other pair is looked at.

How many lines a vector is filed on and the threshold are calibrated for the wanted recall on random pairs of the wanted
cosine, for each length of vectors and number of directions. Larger tables take more directions, so that lines stay
short; recall is the same. Past the most directions, lines grow with the table.

Equal vectors are one class. A line of more than `BLOCK` classes is dealt into chunks, and each two chunks meet in one
block, so no task holds a crowded line; a block gives link counts and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import ranges, released, written
from gleanery.llm.graph import components
from gleanery.sources.files import table

COSINE = 0.9
RECALL = 0.97
PROJECTIONS = 24
LINES = (65536, 16384, 4096, 1024, 256, 64, 16, 4, 1)
TOP = 16
SHARE = 64  # vectors for each direction, up to the most directions
CELLS = 4_000_000  # projections held at a time
BLOCK = 8192
PAIRS = 100_000  # looked at together
USUAL = 16
TRIALS = 1500
SEED = 20


def touching(la, ra, lb, rb, window: float) -> np.ndarray:
    """For each pair of rows, the lines of the first by the lines of the second: true where they are one line, on which each
    is within the other's window."""
    return (la[:, :, None] == lb[:, None, :]) & (np.abs(ra[:, :, None] - rb[:, None, :]) <= np.float32(window))


def directions(dim: int, count: int, seed: int) -> np.ndarray:
    """count rows of length sqrt(dim), orthogonal within each run of dim."""
    rng, out = np.random.default_rng([seed, dim]), []
    while dim * len(out) < count:
        q, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
        out.append(q.T * math.sqrt(dim))
    return np.concatenate(out)[:count]


class Plan:
    """What vectors of a length are filed and counted by: at most `most` directions, fewer where TOP lines would not do."""

    def __init__(self, most: int, cosine: float, recall: float, projections: int):
        self.most, self.cosine, self.recall, self.projections = most, cosine, recall, projections
        self.plans: dict[int, tuple[int, int, float, int]] = {}
        self.made: dict = {}

    def __getstate__(self):
        return self.__dict__ | {"made": {}}

    def __call__(self, dim: int) -> tuple[int, int, float, int]:
        """(directions, top, window, least count)."""
        if dim not in self.plans:
            self.plans[dim] = self.calibrated(dim)
        return self.plans[dim]

    def lines(self, dim: int, count: int) -> np.ndarray:
        if (dim, count) not in self.made:
            self.made[dim, count] = directions(dim, count, SEED)
        return self.made[dim, count]

    def counted(self, x: np.ndarray) -> np.ndarray:
        """The projections whose collisions are counted."""
        return x @ directions(x.shape[1], self.projections, SEED + 1).T

    def furthest(self, x: np.ndarray, count: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """(lines, reach on them) of each vector's furthest projections, furthest first; line 2j is direction j, 2j + 1 its
        opposite."""
        lines, reaches, step = [], [], max(1, CELLS // count)
        for s in range(0, len(x), step):
            p = x[s : s + step] @ self.lines(x.shape[1], count).T
            reach = np.abs(p)
            at = np.argpartition(-reach, top - 1, axis=1)[:, :top] if top < count else np.tile(np.arange(count), (len(p), 1))
            at = np.take_along_axis(at, np.argsort(-np.take_along_axis(reach, at, 1), axis=1, kind="stable"), 1)
            lines.append((2 * at + (np.take_along_axis(p, at, 1) < 0)).astype(np.int32))
            reaches.append(np.take_along_axis(reach, at, 1).astype(np.float32))
        return np.concatenate(lines), np.concatenate(reaches)

    def calibrated(self, dim: int) -> tuple[int, int, float, int]:
        """The plan with which random pairs of the wanted cosine are found with the wanted recall, half of the loss left to
        either step."""
        rng = np.random.default_rng([SEED, dim, 1])
        keep, window = math.sqrt(self.recall), 1.35 * math.sqrt(2 * (1 - self.cosine))
        x, y = (rng.standard_normal((TRIALS, dim)) for _ in range(2))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y -= (x * y).sum(1, keepdims=True) * x
        norm = np.linalg.norm(y, axis=1, keepdims=True)
        y = self.cosine * x + math.sqrt(max(0.0, 1 - self.cosine**2)) * y / np.where(norm > 1e-9, norm, 1) if dim > 1 else x
        for count in (c for c in LINES if c <= self.most):
            most = min(TOP, count)
            met = touching(*self.furthest(x, count, most), *self.furthest(y, count, most), window)
            top = next((t for t in range(1, most + 1) if met[:, :t, :t].any((1, 2)).mean() >= keep), 0)
            if top:
                break
        else:
            top = most
        met = met[:, :top, :top].any((1, 2))
        collisions = (np.abs(self.counted(x) - self.counted(y)) <= window).sum(1)[met]
        return count, top, window, int(np.quantile(collisions, 1 - keep, method="lower")) if len(collisions) else 0


def units(column) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """{dim: (rows, unit vectors)} of an Arrow column of lists, all valid; in double precision."""
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    size = np.diff(ends)
    out = {}
    for dim in np.unique(size).tolist():
        at = np.flatnonzero(size == dim)
        x = flat[ends[at][:, None] + np.arange(dim)].astype(np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        out[dim] = (at, x / np.linalg.norm(x, axis=1, keepdims=True))
    return out


def file_vectors(plan):
    """(key, weight, vector) to (dim, line, key, weight, lines, reach, vector), a row for each line that a vector is filed on."""

    def run(batches):
        for batch in batches:
            for dim, (at, x) in units(batch.column(2)).items():
                lines, top, _, _ = plan(dim)
                for s in range(0, len(at), 2000):
                    line, reach = plan.furthest(x[s : s + 2000], lines, top)
                    take = pa.array(np.repeat(at[s : s + 2000], top))
                    rows = pa.array(np.repeat(np.arange(len(line)), top))
                    both = [pa.array([r.tobytes() for r in m], pa.binary()).take(rows) for m in (line, reach)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(line.size, dim)), pa.array(line.ravel().astype(np.int64)), batch.column(0).take(take), batch.column(1).take(take), *both, batch.column(2).take(take)], ["dim", "line", "k1", "weight", "lines", "reach", "vector"])

    return run


def compare(plan, cosine: float):
    """Rows (dim, line, lo, hi, chunk, key, weight, lines, reach, vector) sorted by block to (u, v, n): link weights have v
    null, edges n null."""

    def block(dim, line, same, chunk, key, weight, filed, reach, x):
        _, _, window, least = plan(dim)
        q = plan.counted(x).T.copy()
        here = reach[filed == line]
        order = np.argsort(here, kind="stable")
        # each vector's window, from its own place up: a pair is met by the one that comes first
        spread = np.searchsorted(here[order], here[order] + np.float32(window * 1.0001), "right") - np.arange(len(order)) - 1
        ends, s, found = np.cumsum(spread), 0, [np.zeros((2, 0), dtype=np.int64)]
        while s < len(order):
            e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + PAIRS, "right")))
            a = order[np.repeat(np.arange(s, e), spread[s:e])]
            b = order[ranges(np.arange(s, e) + 1, spread[s:e])]
            s = e
            part = np.abs(here[a] - here[b]) <= np.float32(window)
            if not same:
                part &= chunk[a] != chunk[b]
            a, b = a[part], b[part]
            count = np.zeros(len(a), dtype=np.uint8)
            for line_q in q:
                count += np.abs(line_q[a] - line_q[b]) <= window
            a, b = a[count >= least], b[count >= least]
            if len(a):
                # the first line on which both are touched counts the pair
                met = touching(filed[a], reach[a], filed[b], reach[b], window) & (filed[a] < line)[:, :, None]
                a, b = a[~met.any((1, 2))], b[~met.any((1, 2))]
                ok = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
                found.append(np.stack([a[ok], b[ok]]))
        a, b = np.concatenate(found, axis=1)
        if not len(a):
            return
        n = np.zeros(len(key), dtype=np.int64)
        np.add.at(n, a, weight[b])
        np.add.at(n, b, weight[a])
        hit = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(key[hit]), pa.nulls(len(hit), pa.int64()), pa.array(n[hit])], ["u", "v", "n"])
        label = np.arange(len(key))
        while True:
            old = label.copy()
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            if (label == old).all():
                break
        moved = np.flatnonzero(label != np.arange(len(key)))
        yield pa.RecordBatch.from_arrays([pa.array(key[moved]), pa.array(key[label[moved]]), pa.nulls(len(moved), pa.int64())], ["u", "v", "n"])

    def run(batches):
        now, held = None, []

        def close():
            table = pa.Table.from_batches(held).combine_chunks()
            if len(table) > 1:
                ((_, x),) = units(table.column(9).chunk(0)).values()
                chunk, key, weight = (table.column(k).to_numpy() for k in (4, 5, 6))
                filed, reach = (np.frombuffer(b"".join(table.column(k).to_pylist()), t).reshape(len(key), -1) for k, t in ((7, np.int32), (8, np.float32)))
                yield from block(now[0], now[1], now[2] == now[3], chunk, key, weight, filed, reach, x)

        for batch in batches:
            ids = np.stack([batch.column(k).to_numpy() for k in range(4)], 1)
            start = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]).any(1)])).tolist() if len(ids) else []
            for s, e in zip(start, [*start[1:], len(ids)], strict=True):
                if tuple(ids[s].tolist()) != now:
                    if held:
                        yield from close()
                    now, held = tuple(ids[s].tolist()), []
                held.append(batch.slice(s, e - s))
        if held:
            yield from close()

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, projections: int = PROJECTIONS, most: int = 0) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Null, empty and zero vectors and those with null or non-finite components have no links and are kept; vectors of
    different lengths never link. Each repeated row is a vector of its own, and so is each row of an id that has several
    vectors. A null id links like any other, but never names a component unless all ids in it are null. A table
    without rows gives none. Other columns are left out. Cosines are those of the components as doubles.
    """
    kind = vectors.schema["embedding"].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind if kind == "array<float>" else "array<double>").alias("embedding"))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    valid = F.coalesce(F.forall("embedding", number) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("valid", valid).withColumn("k1", F.when(F.col("valid"), F.xxhash64("embedding")))
    classes = rows.filter("valid").groupBy("k1").agg(F.count("*").alias("weight"), F.min("vec_id").alias("lead"), F.first("embedding").alias("embedding"))
    classes = written(classes, "vectors")
    # the driver calibrates for the usual lengths, tasks for any others that they meet
    usual = classes.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(USUAL).collect()
    wanted = classes.count() // SHARE
    plan = Plan(most or next((c for c in reversed(LINES[:-4]) if c >= wanted), LINES[0]), cosine, recall, projections)
    for r in usual:
        plan(r.dim)
    filed = classes.select("k1", "weight", "embedding").mapInArrow(released(file_vectors(plan)), f"dim long, line long, k1 long, weight long, lines binary, reach binary, vector {rows.schema['embedding'].dataType.simpleString()}")
    filed = written(filed, "filed")
    chunks = filed.groupBy("dim", "line").agg(F.ceil(F.count("*") / BLOCK).alias("chunks"), F.count("*").alias("m")).filter("m > 1")
    dealt = filed.join(chunks, ["dim", "line"]).withColumn("chunk", F.pmod(F.xxhash64("k1"), "chunks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = dealt.select("dim", "line", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", "k1", "weight", "lines", "reach", "vector")
    found = dealt.repartition("dim", "line", "lo", "hi").sortWithinPartitions("dim", "line", "lo", "hi").mapInArrow(released(compare(plan, cosine)), "u long, v long, n long")
    found = written(found, "linked")
    counts = found.filter("v is null").groupBy(F.col("u").alias("k1")).agg(F.sum("n").alias("n"))
    parts = components(found.filter("v is not null").select("u", "v")).withColumnRenamed("node", "k1")
    named = classes.select("k1", "weight", "lead").join(parts, "k1", "left").join(counts, "k1", "left")
    own = F.coalesce("component", "k1")
    names = written(named.withColumn("component", own), "named")
    names = names.join(names.groupBy("component").agg(F.min("lead").alias("component_id")), "component")
    links = F.coalesce("n", F.lit(0)) + F.col("weight") - 1
    names = names.select("k1", links.alias("n_links"), "component_id")
    out = rows.select("vec_id", "k1", "valid").join(names, "k1", "left")
    part = F.when(F.col("valid"), F.col("component_id")).otherwise(F.col("vec_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), part.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op5_collision_counting": op5_collision_counting}
ORACLE: dict[str, str] = {}
