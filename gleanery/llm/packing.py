"""Bounded-space online packing of tokenised documents into fixed windows.

Each partition streams its documents once and keeps a fixed number of windows open. A piece goes to the window it
fits best; when it fits none, the fullest window is emitted and a new one opened. Documents longer than a window
are cut into whole windows and a rest. Windows still open at the end of a partition are leftovers: their pieces
are merged best-fit in groups of partitions, so no task ever gets more than `fan_in` partitions' open windows.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import Memo, load_tokenizer, released, slices, word_encoder, written
from gleanery.sources.files import table

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
SEQ_LEN = 4096
OPEN_WINDOWS = 64
FAN_IN = 32

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"


def white_chunks(text: str) -> list[str]:
    """Chunks between blanks and newlines. This tokenizer drops white space and never joins across it."""
    return [c for c in text.replace("\n", " ").split(" ") if c]


class Windows:
    """At most `most` open windows of `size`; emit(pieces) gets each window that is closed."""

    def __init__(self, size: int, most: int, emit):
        self.size, self.most, self.emit = size, most, emit
        self.free: list[tuple[int, int]] = []  # (free room, window), ascending
        self.held: dict[int, list] = {}
        self.next = 0

    def place(self, piece, n: int) -> None:
        k = bisect.bisect_left(self.free, (n, -1))
        if k < len(self.free):
            room, w = self.free.pop(k)
        else:
            if len(self.free) >= self.most:
                self.emit(self.held.pop(self.free.pop(0)[1]))
            room, w = self.size, self.next
            self.next += 1
            self.held[w] = []
        self.held[w].append(piece)
        if room == n:
            self.emit(self.held.pop(w))
        else:
            bisect.insort(self.free, (room - n, w))


def packer(tokenizer_path: str | None, tokenizer_name: str, end_id: int, seq_len: int, open_windows: int, with_ids: bool, memo_words: int):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        tok = load_tokenizer(tokenizer_path, tokenizer_name)
        memo = Memo(word_encoder(tok, memo_words // 2), [end_id], memo_words)
        rows: list[tuple] = []
        made = 0

        def emit(pieces, done=True):
            nonlocal made
            at = 0
            for p in pieces:
                rows.append((*p, (part << 32) + made, at, done, part))
                at += p[2]
            made += 1

        windows = Windows(seq_len, open_windows, emit)

        def flush():
            cols = list(zip(*rows, strict=True)) if rows else [()] * 10
            rows.clear()
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset", "done", "part"]
            types = [pa.int64()] * 5 + [pa.binary()] + [pa.int64()] * 2 + [pa.bool_(), pa.int64()]
            arrays = {n: pa.array(c, t) for n, c, t in zip(names, cols, types, strict=True)}
            if not with_ids:
                arrays.pop("ids")
            return pa.RecordBatch.from_pydict(arrays)

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(texts, 2_000_000):
                ids, counts = memo.batch(texts[lo:hi], white_chunks)
                ends = np.cumsum(counts)
                raw = memoryview(ids.astype("<u4").tobytes())
                for doc, n, end in zip(doc_ids[lo:hi], counts.tolist(), ends.tolist(), strict=True):
                    first = end - n
                    for s in range(0, n, seq_len):
                        size = min(seq_len, n - s)
                        data = raw[4 * (first + s) : 4 * (first + s + size)]
                        windows.place((doc, s, size, zlib.crc32(data), n, bytes(data) if with_ids else None), size)
                yield flush()
        for w in sorted(windows.held):
            emit(windows.held[w], done=False)
        yield flush()

    return run


def merger(seq_len: int, fan_in: int):
    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["length", "sequence_id", "offset"], ascending=[False, True, True], kind="stable")
        out, seq = [], []
        base = (1 << 62) + (int(pdf["part"].iloc[0]) // fan_in << 32)

        def emit(pieces):
            at = 0
            for k, n in pieces:
                out.append(k)
                seq.append((base + len(seq_ids), at))
                at += n
            seq_ids.append(1)

        seq_ids: list[int] = []
        windows = Windows(seq_len, len(pdf) + 1, emit)
        for k, n in enumerate(pdf["length"].tolist()):
            windows.place((k, n), n)
        for w in sorted(windows.held):
            emit(windows.held[w])
        pdf = pdf.iloc[out].drop(columns=["done", "part"])
        pdf["sequence_id"], pdf["offset"] = (pd.Series(c, index=pdf.index, dtype="int64") for c in zip(*seq, strict=True))
        return pdf

    return run


def pack_documents(
    docs: DataFrame, tokenizer_path: str | None = None, tokenizer_name: str = TOKENIZER, end_id: int = END_ID, seq_len: int = SEQ_LEN,
    open_windows: int = OPEN_WINDOWS, fan_in: int = FAN_IN, with_ids: bool = False, memo_words: int = 600_000,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, little-endian
    unsigned 32-bit, if with_ids).

    A null or empty text is its end id alone. Null ids and repeated rows are packed like any other row, each row on
    its own. Other columns are left out. An empty table gives no rows. Nothing is cut but what exceeds a window. Up to memo_words
    different words are remembered by a task, about 250 bytes each; how many changes only the time.
    """
    schema = PIECE + (", ids binary" if with_ids else "") + ", done boolean, part long"
    schema = ", ".join(sorted(schema.split(", "), key=lambda c: ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "`offset`", "done", "part"].index(c.split()[0])))
    raw = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(released(packer(tokenizer_path, tokenizer_name, end_id, seq_len, open_windows, with_ids, memo_words)), schema)
    pieces = written(raw, "packing")  # read twice below
    plain = [c for c in pieces.columns if c not in ("done", "part")]
    full = pieces.filter("done").select(*plain)
    left = pieces.filter("not done").withColumn("_group", F.floor(F.col("part") / fan_in))
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name in plain)
    return full.unionByName(left.groupBy("_group").applyInPandas(lambda pdf: merger(seq_len, fan_in)(pdf.drop(columns="_group")), out_schema))


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences of pieces with ids: sequence_id, n_tokens, ids (binary), doc_ids, offsets."""
    held = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids", "length")))
    out = pieces.groupBy("sequence_id").agg(held.alias("p"))
    return out.select(
        "sequence_id",
        F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("n_tokens"),
        F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"),
        F.transform("p", lambda x: x["offset"]).alias("offsets"),
    )


def op2_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_online_packing": op2_online_packing}
ORACLE: dict[str, str] = {}
