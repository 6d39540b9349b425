"""Shared pieces of the training-data operators: words, written tables, memoised tokenisers."""

from __future__ import annotations

import contextlib
import itertools
import sys
import tempfile
import threading
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import gleanery

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

# Functions travel by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(gleanery)
for _name in ("gleanery.llm", __name__):
    if _name in sys.modules:
        cloudpickle.register_pickle_by_value(sys.modules[_name])


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or, in one process, a temporary one."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="gleanery-"))
        found = sc.getCheckpointDir()
    return found


#: By thread, paths of the tables that its run has written, empty where they were dropped. Functions travel with it by value.
_tables: dict[int, list[str]] = {}


def _mine() -> list[str]:
    return _tables.setdefault(threading.get_ident(), [])


@contextlib.contextmanager
def own_tables():
    """A run: tables written in it are noted by themselves, so dropping them leaves those of other queries of this process alone,
    of other threads as well as of results that are still to be read."""
    before = _mine()
    _tables[threading.get_ident()] = []
    try:
        yield
    finally:
        _tables[threading.get_ident()] = before


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class _Cleaning:
    """What the setting was, once for each write that is going on. Functions travel with it by value and a lock cannot, so a copy begins anew."""

    def __init__(self):
        self.before, self.lock = [], threading.Lock()

    def __reduce__(self):
        return type(self), ()


_cleaning = _Cleaning()


@contextlib.contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Shuffle files of what is run here go when it ends. Otherwise they stay until the driver happens to collect garbage, which it does
    the less often for a GB the larger the tables are."""
    with _cleaning.lock:
        _cleaning.before.append(_cleaning.before[0] if _cleaning.before else spark.conf.get(CLEANUP, "false"))
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _cleaning.lock:
            before = _cleaning.before.pop()
            if not _cleaning.before:
                spark.conf.set(CLEANUP, before)


def written(df: DataFrame, tag: str = "table") -> DataFrame:
    """df written as Parquet in the shared folder and read again: cuts lineage and survives lost executors. Its shuffles' files are
    deleted when it is written.

    Whole texts travel in Arrow batches, so the session's batches are lowered to 2000 rows for good: a change that
    every thread makes alike.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    if int(spark.conf.get(BATCH_ROWS)) > 2000:
        spark.conf.set(BATCH_ROWS, "2000")
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    _mine().append(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, i: int) -> None:
    mine = _mine()
    if mine[i]:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(mine[i])
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        mine[i] = ""


def dropped(table: DataFrame) -> None:
    """Delete a table of written() that nothing reads again: what came of it has been written in turn."""
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        mine = _mine()
        for i in range(len(mine) - 1, -1, -1):
            if mine[i] and path.endswith(mine[i].rsplit("/", 1)[1]):
                _delete(table.sparkSession, i)
                break


def drop_tables(spark: SparkSession, since: int) -> int:
    """Delete all but the last of the tables that written() has made in this run after its first `since`; how many it has made. For
    callers that have written a result and read none of the tables behind it again."""
    for i in range(since, len(_mine()) - 1):
        _delete(spark, i)
    return len(_mine())


def released(run):
    """The function over batches, giving freed memory back at its end: workers live on for other stages."""

    def out(batches):
        import ctypes

        yield from run(batches)
        pa.default_memory_pool().release_unused()
        libc = ctypes.CDLL(None)
        if hasattr(libc, "malloc_trim"):
            libc.malloc_trim(0)

    return out


def bit_filter(keys: DataFrame, bits: int = 23) -> np.ndarray:
    """Boolean table of 2**bits cells, set for the keys (column k) low bits: a bounded pre-filter without misses."""
    bit = F.col("k").bitwiseAND((1 << bits) - 1)
    got = keys.select(F.shiftright(bit, 15).alias("bucket"), bit.bitwiseAND(0x7FFF).alias("at")).groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("map")).toArrow()
    out = np.zeros(1 << bits, dtype=bool)
    for b, m in zip(got.column("bucket").to_pylist(), got.column("map").to_pylist(), strict=True):
        out[b << 15 : (b + 1) << 15] = np.unpackbits(np.frombuffer(m, dtype=np.uint8), bitorder="little")
    return out


def unused(df: DataFrame, name: str) -> str:
    """The name, or one like it, that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def perhaps(df: DataFrame, key: str, keys: DataFrame, inside: bool = True, bits: int = 23) -> DataFrame:
    """The rows of df whose long column `key` is among the keys (column k), and a few others by chance; or, with
    inside=False, exactly the rest.

    Keys' low bits set bits of at most 2**(bits - 6) words, the bound of what is broadcast. Filtering with it before a
    join saves shuffling what cannot match; where keys fill the table, it only stops saving.
    """
    mask, one = (1 << bits) - 1, F.lit(1).cast("long")
    low = lambda c: c.bitwiseAND(F.lit(mask).cast("long"))
    bit = lambda c: c.bitwiseAND(F.lit(63).cast("long")).cast("int")
    k = F.col("k")
    slot, word = unused(df, "_slot"), unused(df, "_word")
    words = keys.select(F.shiftright(low(k), 6).alias(slot), F.call_function("shiftleft", one, bit(k)).alias("one"))
    words = words.groupBy(slot).agg(F.bit_or("one").alias(word))
    hit = F.coalesce(F.call_function("shiftrightunsigned", F.col(word), bit(F.col(key))).bitwiseAND(one), F.lit(0)) == 1
    out = df.withColumn(slot, F.shiftright(low(F.col(key)), 6)).join(F.broadcast(words), slot, "left")
    return out.filter(hit if inside else ~hit).select(*df.columns)


def fold(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (unsigned, wraps around)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of arange(s, s + n) for each s, n."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts.astype(np.int64) - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


class Memo(dict):
    """Token ids of chunks that never influence one another, each encoded once by the tokenizer.

    encode(list of chunks) -> list of id lists. Code 0 stands for `tail`, which ends a text. The memo is
    emptied between batches once it holds `bound` chunks or `room` characters, so its memory is bounded.
    """

    def __init__(self, encode, tail, bound: int = 600_000, room: int = 16_000_000):
        super().__init__()
        import gc

        gc.set_threshold(1_000_000, 50, 100)  # millions of small lists live here, none in cycles
        self.encode, self.tail, self.bound, self.room = encode, list(tail), bound, room
        self.reset()

    def full(self) -> bool:
        return len(self) > self.bound or self.chars > self.room

    def reset(self):
        self.clear()
        self.chars = 0
        self.todo: list[str] = []
        self.ids = np.array(self.tail, dtype=np.uint32)
        self.first = np.zeros(1, dtype=np.int64)
        self.count = np.array([len(self.tail)], dtype=np.int64)

    def __missing__(self, chunk):
        self.todo.append(chunk)
        code = self[chunk] = len(self) + 1
        return code

    def settle(self):
        if self.todo:
            self.chars += sum(map(len, self.todo))
            got = self.encode(self.todo)
            count = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
            flat = np.fromiter(itertools.chain.from_iterable(got), dtype=np.uint32, count=int(count.sum()))
            self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(count) - count])
            self.ids = np.concatenate([self.ids, flat])
            self.count = np.concatenate([self.count, count])
            self.todo = []

    def batch(self, texts, chunks):
        """(ids of all texts one after another, number of ids of each text); each text ends with the tail."""
        if self.full():
            self.reset()
        get = self.__getitem__
        codes, sizes = [], np.empty(len(texts), dtype=np.int64)
        for k, t in enumerate(texts):
            part = chunks(t) if t else []
            codes.extend(map(get, part))
            codes.append(0)
            sizes[k] = len(part) + 1
        self.settle()
        self.codes, self.sizes = codes, sizes  # of the last batch
        codes = np.array(codes, dtype=np.int64)
        count = self.count[codes]
        ids = self.ids[ranges(self.first[codes], count)]
        ends = np.concatenate([[0], np.cumsum(count)])[np.cumsum(sizes)]
        return ids, np.diff(np.concatenate([[0], ends]))


def slices(texts, most: int = 4_000_000):
    """(from, to) of runs of texts with about `most` characters; a longer text is a run of its own."""
    first = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held > most:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def byte_letters() -> dict[int, str]:
    """Byte-level BPE's public letter for each byte: printable Latin-1 as it is, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def word_encoder(tok, bound: int = 300_000):
    """Encoder of white-space-free chunks for the lower-casing word BPE.

    Chunks of printable ASCII (no apostrophe) and Latin letters need no normaliser but lower case, and their
    pre-tokens are runs of letters, single digits and runs of signs: these go to the tokenizer's model directly.
    All others go through the whole tokenizer, in batches.
    """
    import re

    plain = re.compile("[!-&(-~À-ÖØ-öø-ſ]+").fullmatch
    pieces = re.compile("[A-Za-zÀ-ÖØ-öø-ſ]+|[0-9]|[^A-Za-z0-9À-ÖØ-öø-ſ]+").findall
    model, letters = tok.model, byte_letters()

    class Pieces(dict):
        def __missing__(self, piece):
            low = piece if piece.isascii() else piece.encode().decode("latin-1").translate(letters)
            ids = self[piece] = [t.id for t in model.tokenize(low)]
            return ids

    book = Pieces()

    def encode(todo):
        out, odd = [None] * len(todo), []
        if len(book) > bound:
            book.clear()
        for k, chunk in enumerate(todo):
            if chunk.isascii() and chunk.isalpha():
                out[k] = book[chunk.lower()]
                continue
            if not plain(chunk) or "İ" in chunk or "<|" in chunk:
                odd.append(k)
                continue
            low = chunk.lower()
            if low.isalpha():
                out[k] = book[low]
            elif low[:-1].isalpha():
                out[k] = book[low[:-1]] + book[low[-1]]
            else:
                out[k] = [i for p in pieces(low) for i in book[p]]
        for k in range(0, len(odd), 1000):
            part = odd[k : k + 1000]
            for j, e in zip(part, tok.encode_batch_fast([todo[i] for i in part], add_special_tokens=False), strict=True):
                out[j] = e.ids
        return out

    return encode


def load_tokenizer(path: str, name: str):
    """A tokenizers.Tokenizer of this executor's copy of the file; `path` may be on the driver only."""
    from tokenizers import Tokenizer

    import public_tokenizers

    return Tokenizer.from_file(path or public_tokenizers.path(name))
