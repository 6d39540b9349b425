"""Token ids packed best-fit-decreasing into fixed rows, as binary matrices.

Each partition is tokenised in stretches of about `STRETCH` ids, the bound of what a task holds. Documents longer than
a row are split into whole rows and a rest, losing nothing; the pieces of a stretch are placed by falling
length, each into the row with the least room that fits, found in a segment tree over capacities. A stretch gives
matrices of up to `ROWS` rows: ids with padding, cumulative segment lengths of each row, and positions that start
again at each piece.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import byte_letters, load_tokenizer, ranges, released, slices
from gleanery.sources.files import table

TOKENIZER = "byte_bpe_50k.json"
END_ID = PAD_ID = 50256
WIDTH = 2048
ROWS = 64
STRETCH = 3_000_000


class Capacities:
    """Segment tree over capacities 0..size: which of them some open row has left."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += n
            i >>= 1

    def least(self, need: int) -> int:
        """The least capacity in the tree that is need or more, or -1."""
        i = need + self.leaves
        if self.count[i]:
            return need
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return -1


def best_fit_decreasing(lengths: np.ndarray, width: int) -> list[list[int]]:
    """Rows of piece numbers; ties go by piece number."""
    tree, open_, rows = Capacities(width), {}, []
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        room = tree.least(n)
        if room < 0:
            row, room = len(rows), width
            rows.append([])
        else:
            row = open_[room].pop()
            tree.add(room, -1)
        rows[row].append(k)
        if room > n:
            open_.setdefault(room - n, []).append(row)
            tree.add(room - n, 1)
    return rows


LONG = 100  # bytes of a chunk that goes to the tokenizer by itself
#: White space in Arrow's regular expressions, of Python's \s: what the tokenizer takes for it, and four control characters.
SPACE = r"[\s\pZ\x0b\x1c-\x1f\x{85}]"


def blank_chunks(texts: pa.Array, strings: list) -> pa.Array:
    """A list of chunks for each text: pre-tokens never cross a blank before a character that is no white space. These
    blanks are left out; what comes before the first of them is the first chunk."""
    import re

    odd = np.array([k for k, t in enumerate(strings) if t and re.search(r" \s| \Z", t)], dtype=np.int64)
    if not len(odd):
        return pc.split_pattern(texts, " ")
    plain = np.ones(len(strings), dtype=bool)
    plain[odd] = False
    at = np.empty(len(strings), dtype=np.int64)
    at[plain], at[odd] = np.arange(plain.sum()), plain.sum() + np.arange(len(odd))
    split = pa.array([re.split(r" (?=\S)", strings[k]) for k in odd], pa.list_(pa.string()))
    return pa.concat_arrays([pc.split_pattern(texts.filter(pa.array(plain)), " "), split]).take(pa.array(at))


class Chunks:
    """Ids of such chunks for byte-level BPE, each different one encoded once until there are `bound` or they take `room` bytes.

    Short chunks without blanks, and without white space at their ends, go to the tokenizer some hundreds in a text, with their blanks:
    each begins where a token begins with a blank. Others go by themselves. Code 0 stands for `tail`, which ends a text.
    """

    def __init__(self, tok, tail, bound: int = 600_000, together: int = 500, room: int = 20_000_000):
        self.tok, self.tail, self.bound, self.together, self.room = tok, np.array(tail, dtype=np.uint32), bound, together, room
        vocab, blank = tok.get_vocab(), byte_letters()[32]
        self.blank = np.zeros(1 + max(vocab.values()), dtype=bool)
        self.blank[[i for t, i in vocab.items() if t[:1] == blank]] = True
        self.reset()

    def reset(self):
        self.known = pa.array([], pa.string())
        self.ids, self.count = self.tail, np.array([len(self.tail)], dtype=np.int64)

    def alone(self, texts: list[str], at_once: int = 1000) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts one after another, number of ids of each)."""
        ids = [np.zeros(0, dtype=np.uint32)]
        for k in range(0, len(texts), at_once):
            ids += [np.array(e.ids, dtype=np.uint32) for e in self.tok.encode_batch_fast(texts[k : k + at_once], add_special_tokens=False)]
        return np.concatenate(ids), np.fromiter(map(len, ids[1:]), dtype=np.int64, count=len(texts))

    def joined(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for plain chunks, each after its blank."""
        cuts = pa.array([*range(0, len(chunks), self.together), len(chunks)], pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(cuts, chunks), " ").to_pylist()
        ids, _ = self.alone([" " + t for t in texts], 20)  # the tokenizer takes about 1 KB for a chunk while it encodes
        first = np.flatnonzero(self.blank[ids])
        if len(first) != len(chunks):
            return self.alone([" " + c for c in chunks.to_pylist()])
        return ids, np.diff(np.append(first, len(ids)))

    def codes(self, chunks: pa.Array) -> np.ndarray:
        """A code for each of these different chunks."""
        at = pc.fill_null(pc.index_in(chunks, self.known), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        part = chunks.take(pa.array(new))
        odd = pc.or_(pc.match_substring_regex(part, rf"^$|^{SPACE}|{SPACE}$| |<\|"), pc.greater(pc.binary_length(part), LONG)).to_numpy(zero_copy_only=False)
        for where, encode in ((new[~odd], self.joined), (new[odd], lambda c: self.alone([" " + x for x in c.to_pylist()]))):
            if len(where):
                part = chunks.take(pa.array(where))
                ids, count = encode(part)
                at[where] = len(self.known) + np.arange(len(part))
                self.known = pa.concat_arrays([self.known, part])
                self.ids, self.count = np.concatenate([self.ids, ids]), np.concatenate([self.count, count])
        return 1 + at

    def batch(self, texts: pa.Array, strings: list) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text); each text ends with the tail. `strings` has the texts as str."""
        if len(self.known) > self.bound or self.known.nbytes > self.room:
            self.reset()
        lists = blank_chunks(texts.cast(pa.string()), strings)
        n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
        flat, ends = lists.flatten(), np.cumsum(n + 1)
        first = (np.cumsum(n) - n)[n > 0]
        later = np.ones(len(flat), dtype=bool)
        later[first] = False
        different = flat.filter(pa.array(later)).dictionary_encode()
        known = self.codes(different.dictionary)
        # first chunks have no blank, and are encoded for this batch alone
        head_ids, head_count = self.alone(flat.take(pa.array(first)).to_pylist())
        inside = np.ones(int(ends[-1]), dtype=bool)
        inside[ends - 1] = False
        code = np.zeros(len(inside), dtype=np.int64)
        of_flat = np.empty(len(flat), dtype=np.int64)
        of_flat[later] = known[different.indices.to_numpy()]
        of_flat[first] = len(self.count) + np.arange(len(first))
        code[inside] = of_flat
        ids, counts = np.concatenate([self.ids, head_ids]), np.concatenate([self.count, head_count])
        count = counts[code]
        return ids[ranges((np.cumsum(counts) - counts)[code], count)], np.add.reduceat(count, ends - n - 1)


def packer(tokenizer_path, tokenizer_name, end_id, pad_id, width, n_rows, stretch):
    def run(batches):
        import os

        from pyspark import TaskContext

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; threads of its own take more time and memory
        part = TaskContext.get().partitionId()
        chunks = Chunks(load_tokenizer(tokenizer_path, tokenizer_name), [end_id])
        made = 0

        def pack(held):
            nonlocal made
            docs = [d for ids, _ in held for d in ids[0]]
            counts = np.concatenate([ids[1] for ids, _ in held])
            flat = np.concatenate([x for _, x in held])
            ends = np.cumsum(counts)
            per = -(-counts // width)
            doc = np.repeat(np.arange(len(counts)), per)
            nth = np.arange(len(doc)) - (np.cumsum(per) - per)[doc]
            start = nth * width
            length = np.minimum(width, counts[doc] - start)
            source = (ends - counts)[doc] + start
            rows = best_fit_decreasing(length, width)
            out = {c: [] for c in MATRIX}
            for first in range(0, len(rows), n_rows):
                block = rows[first : first + n_rows]
                ids = np.full((len(block), width), pad_id, dtype="<u4")
                position = np.zeros((len(block), width), dtype="<u4")
                cu, cu_sizes, pieces = [], [], []
                for r, row in enumerate(block):
                    at = 0
                    cu.append(0)
                    for k in row:
                        n = int(length[k])
                        ids[r, at : at + n] = flat[source[k] : source[k] + n]
                        position[r, at : at + n] = np.arange(n)
                        at += n
                        cu.append(at)
                        pieces.append({"doc_id": docs[doc[k]], "start": int(start[k]), "length": n, "row": r})
                    position[r, at:] = np.arange(width - at)
                    cu_sizes.append(len(row) + 1)
                cu = np.array(cu, dtype="<u4")
                for c, v in zip(MATRIX, ((part << 32) + made, len(block), width, ids.tobytes(), cu.tobytes(), cu_sizes, position.tobytes(), pieces), strict=True):
                    out[c].append(v)
                made += 1
            return pa.RecordBatch.from_pydict({c: pa.array(v, t) for (c, v), t in zip(out.items(), TYPES, strict=True)})

        held, n = [], 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                flat, counts = chunks.batch(batch.column(1).slice(lo, hi - lo), texts[lo:hi])
                held.append(((ids[lo:hi], counts), flat))
                n += len(flat)
                if n >= stretch:
                    yield pack(held)
                    held, n = [], 0
        if held:
            yield pack(held)

    return run


MATRIX = ["matrix_id", "n_rows", "width", "ids", "cu_seqlens", "cu_sizes", "position_ids", "pieces"]
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("row", pa.int64())]))]
DIGEST = "matrix_id long, n_rows long, ids_crc32 long, cu_seqlens_crc32 long, position_ids_crc32 long, doc_ids array<long>, starts array<long>, lengths array<long>, rows array<long>"
SCHEMA = "matrix_id long, n_rows long, width long, ids binary, cu_seqlens binary, cu_sizes array<long>, position_ids binary, pieces array<struct<doc_id:long,start:long,length:long,row:long>>"


def packed_matrices(
    docs: DataFrame, tokenizer_path: str | None = None, tokenizer_name: str = TOKENIZER, end_id: int = END_ID, pad_id: int = PAD_ID,
    width: int = WIDTH, n_rows: int = ROWS, stretch: int = STRETCH, checksums: bool = False,
) -> DataFrame:
    """One row per matrix: matrix_id, n_rows, width, ids and position_ids (n_rows x width, row-major, little-endian
    unsigned 32-bit), cu_seqlens (each row's from 0, one after another; cu_sizes says how many) and the pieces
    (doc_id, start, length, row) in their order in the matrix.

    Every document's ids end with end_id; a null or empty text is that alone. Each row of docs is packed on its own,
    whatever its id; other columns are left out. No rows give no matrices. Padding positions count from 0.
    With checksums=True the same work gives the CRC-32 of each binary in its place, and the pieces as lists.
    """
    run = released(packer(tokenizer_path, tokenizer_name, end_id, pad_id, width, n_rows, stretch))
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(lambda batches: _digest(run(batches)), DIGEST) if checksums else docs.mapInArrow(run, SCHEMA)


def write_matrices(docs: DataFrame, path: str, **options) -> None:
    """The matrices of docs as Parquet files, through Spark's committer."""
    packed_matrices(docs, **options).write.parquet(path)


def unpacked(matrices: DataFrame) -> DataFrame:
    """(doc_id, start, length, ids) of each piece, from matrices."""

    def run(batches):
        for batch in batches:
            out = []
            for n, width, ids, cu, sizes, pieces in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4, 5, 7)), strict=True):
                m, c = np.frombuffer(ids, dtype="<u4").reshape(n, width), np.frombuffer(cu, dtype="<u4")
                first = np.concatenate([[0], np.cumsum(sizes)])
                seen = [0] * n
                for p in pieces:
                    r = p["row"]
                    a, b = c[first[r] + seen[r]], c[first[r] + seen[r] + 1]
                    seen[r] += 1
                    out.append((p["doc_id"], p["start"], p["length"], m[r, a:b].tobytes()))
            cols = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary())], ["doc_id", "start", "length", "ids"])

    return matrices.mapInArrow(run, "doc_id long, start long, length long, ids binary")


def _digest(batches):
    for batch in batches:
        cols = [batch.column(k).to_pylist() for k in range(8)]
        crc = [[zlib.crc32(x) for x in cols[k]] for k in (3, 4, 6)]
        fields = [pa.array([[p[f] for p in m] for m in cols[7]], pa.list_(pa.int64())) for f in ("doc_id", "start", "length", "row")]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in crc), *fields], ["matrix_id", "n_rows", "ids_crc32", "cu_seqlens_crc32", "position_ids_crc32", "doc_ids", "starts", "lengths", "rows"])


def op7_best_fit_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrices with their binaries as checksums."""
    return packed_matrices(table(spark, f"{sf_dir}/documents.parquet"), checksums=True)


QUERIES = {"op7_best_fit_matrices": op7_best_fit_matrices}
ORACLE: dict[str, str] = {}
