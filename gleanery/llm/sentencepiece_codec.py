"""SentencePiece encoding and decoding on the tokenizers library.

The model protobuf is parsed here (wire format of three small messages), and its parts rebuilt: the normaliser with
its compiled character map, white-space rules and metaspace marker; unigram scores, or BPE merges in the order of
their pieces' scores; byte fallback; and the decoder. Text falls into chunks at the markers, which no piece crosses,
so a chunk is encoded and decoded once and remembered; new chunks of a batch are encoded multithreaded. Each new chunk is also
encoded by the sentencepiece library: where the two differ, the document is not at parity. The ids are the rebuilt tokenizer's.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import Memo, slices
from gleanery.sources.files import table

MODEL = "piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def wire(data: bytes):
    """(field, value) of a protobuf message: ints for varints, bytes for the rest."""

    def varint(i):
        value = shift = 0
        while True:
            b = data[i]
            value |= (b & 127) << shift
            i, shift = i + 1, shift + 7
            if b < 128:
                return value, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            n, i = varint(i)
            value, i = data[i : i + n], i + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, i = data[i : i + n], i + n
        else:
            raise ValueError(f"wire type {kind}")
        yield key >> 3, value


class Spec:
    """What a SentencePiece model file says: pieces (text, score, type), model type, normaliser."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.model_type, self.charsmap = UNIGRAM, b""
        self.dummy_prefix = self.remove_extra = self.escape = True
        for field, value in wire(data):
            if field == 1:
                x = dict(wire(value))
                self.pieces.append((x.get(1, b"").decode(), struct.unpack("<f", x.get(2, b"\0\0\0\0"))[0], x.get(3, NORMAL)))
            elif field == 2:
                self.model_type = dict(wire(value)).get(3, UNIGRAM)
            elif field == 3:
                x = dict(wire(value))
                self.charsmap = x.get(2, b"")
                self.dummy_prefix, self.remove_extra, self.escape = (bool(x.get(k, 1)) for k in (3, 4, 5))
        self.byte_fallback = any(kind == BYTE for *_, kind in self.pieces)
        self.unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        self.splits = not any(MARK in p[0].lstrip(MARK) for p in self.pieces if p[2] in (NORMAL, USER))

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that make a piece, by falling score of what they make."""
        usable = {p: (-score, i) for i, (p, score, kind) in enumerate(self.pieces) if kind in (NORMAL, USER, UNUSED)}
        found = []
        for p, rank in usable.items():
            found += [(rank, i, p[:i], p[i:]) for i in range(1, len(p)) if p[:i] in usable and p[i:] in usable]
        return [(a, b) for *_, a, b in sorted(found)]

    def tokenizer(self):
        """A tokenizers.Tokenizer with the model, normaliser, pre-tokenizer and decoder of the file."""
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        unk = self.pieces[self.unknown][0]
        if self.model_type == UNIGRAM:
            model = models.Unigram([(p, s) for p, s, _ in self.pieces], unk_id=self.unknown, byte_fallback=self.byte_fallback)
        elif self.model_type == BPE:
            model = models.BPE({p: i for i, (p, *_) in enumerate(self.pieces)}, self.merges(), unk_token=unk, fuse_unk=True, byte_fallback=self.byte_fallback)
        else:
            raise ValueError(f"model type {self.model_type}")
        tok = Tokenizer(model)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.remove_extra:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if self.escape else " "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        if steps:
            tok.normalizer = normalizers.Sequence(steps)
        if self.splits:
            tok.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
        undo = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        if self.dummy_prefix:
            undo.append(decoders.Strip(" ", 1, 0))
        tok.decoder = decoders.Sequence(undo)
        return tok


def codec(data: bytes, threads: int, keep_ids: bool):
    def run(batches):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece

        spec = Spec(data)
        tok, own = spec.tokenizer(), sentencepiece.SentencePieceProcessor(model_proto=data)
        odd: set[str] = set()  # chunks that the two libraries encode differently
        said = [""]  # what each chunk's ids decode to

        # chunks come without the dummy prefix, which both libraries put before a text; other chunks begin with a blank
        def encode(todo):
            out = []
            for k in range(0, len(todo), 20_000):
                part = todo[k : k + 20_000]
                texts = [t[1:] for t in part] if plain else part
                got, theirs = [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)], own.encode(texts, num_threads=1)
                if plain and " " in part:  # a marker alone; neither library marks an empty text
                    at = part.index(" ")
                    got[at], theirs[at] = [tok.token_to_id(MARK)], [own.piece_to_id(MARK)]
                if got != theirs:
                    odd.update(t for t, a, b in zip(part, got, theirs, strict=True) if a != b)
                said.extend(tok.decode_batch(got, skip_special_tokens=False))
                out += got
            return out

        plain = spec.splits and spec.dummy_prefix and spec.escape and not spec.remove_extra and not spec.charsmap
        runs = re.compile(r" +[^ ]*")

        def chunks(text):
            if not plain:
                return [text]
            text = " " + text.replace(MARK, " ")  # the marker in a text is a blank to the model
            return runs.findall(text) if "  " in text else [" " + w for w in text[1:].split(" ")] if len(text) > 1 else []

        memo = Memo(encode, [])
        byte_ids = np.zeros(len(spec.pieces) + 1, dtype=bool)
        for i, (*_, kind) in enumerate(spec.pieces):
            byte_ids[i] = kind == BYTE
        for batch in batches:
            docs, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                if memo.full():
                    odd.clear()
                    said[1:] = []
                ids, counts = memo.batch(texts[lo:hi], chunks)
                parts = np.split(ids, np.cumsum(counts)[:-1])
                if plain:  # bytes and blanks of a chunk never join another's, and the decoder takes off a chunk's first blank
                    ends = np.cumsum(memo.sizes).tolist()
                    decoded = [" ".join([said[c] for c in memo.codes[a : b - 1]]) for a, b in zip([0, *ends], ends, strict=False)]
                else:
                    decoded = tok.decode_batch([p.tolist() for p in parts], skip_special_tokens=False)
                crc = [zlib.crc32(p.astype("<u4").tobytes()) for p in parts]
                back = [d == (t or "") for d, t in zip(decoded, texts[lo:hi], strict=True)]
                sha = [hashlib.sha256(d.encode("utf-8", "surrogatepass")).hexdigest() for d in decoded]
                same = [not odd or odd.isdisjoint(chunks(t or "")) for t in texts[lo:hi]]
                cols = [docs.slice(lo, hi - lo), pa.array(counts.astype(np.int64)), pa.array(crc, pa.int64()), pa.array([int(byte_ids[p].sum()) for p in parts], pa.int64())]
                cols += [pa.array(sha), pa.array(back), pa.array(same)]
                if keep_ids:
                    cols.append(pa.array([p.tolist() for p in parts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, COLUMNS[: len(cols)])

    return run


COLUMNS = ["doc_id", "n_ids", "ids_crc32", "n_byte_ids", "decoded_sha256", "round_trip", "parity", "ids"]


def encode_documents(docs: DataFrame, model_path: str | None = None, model_name: str = MODEL, threads: int = 2, ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_ids, ids_crc32 (little-endian unsigned 32-bit ids), n_byte_ids (byte fallback),
    decoded_sha256, round_trip (decoding gave the text back), parity (no chunk differed from the sentencepiece
    library), and ids if asked for.

    Null and empty texts have no ids and decode to the empty text. Each row is encoded on its own; other columns are
    left out, repeated rows and null ids do not matter, no rows give none. A very long text is encoded whole, chunk by chunk
    where the model allows it. The model file is read by the driver, and its bytes travel with the plan.
    """
    import public_tokenizers

    with open(model_path or public_tokenizers.path(model_name), "rb") as f:
        data = f.read()
    schema = "doc_id long, n_ids long, ids_crc32 long, n_byte_ids long, decoded_sha256 string, round_trip boolean, parity boolean" + (", ids array<int>" if ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(codec(data, threads, ids), schema)


def decode_documents(encoded: DataFrame, model_path: str | None = None, model_name: str = MODEL) -> DataFrame:
    """(doc_id, ids) to (doc_id, text); null ids give a null text, ids outside the model are an error."""
    import public_tokenizers

    with open(model_path or public_tokenizers.path(model_name), "rb") as f:
        data = f.read()

    def run(batches):
        tok = Spec(data).tokenizer()
        for batch in batches:
            ids = batch.column(1).to_pylist()
            texts = tok.decode_batch([x or [] for x in ids], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if x is None else t for x, t in zip(ids, texts, strict=True)], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op4_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, f"{sf_dir}/documents.parquet"))


QUERIES = {"op4_sentencepiece_codec": op4_sentencepiece_codec}
ORACLE: dict[str, str] = {}
