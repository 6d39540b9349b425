"""Secret scan with multipart credential linking.

Base patterns are reported wherever they match. Weak candidates (short or unlabelled identifiers, bare secrets,
endpoints) mean little alone; within a document they are interval-joined by a sorted sweep, and one is reported
only when its complementary parts lie within `scope` code points: an identifier needs a secret, a secret needs an
identifier, an endpoint needs both. A candidate asks the sorted spans of the other kind for the furthest end among those that
begin within its scope, so a document with many candidates costs a sort, never all pairs. Nothing is shuffled.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.sources.files import table

SCOPE = 300
KINDS = ["assign", "access", "hex", "id", "secret", "endpoint"]

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
WEAK_ID = r"""(?:client|user|account|access|tenant)[_-]?(?:id|name|key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]{4,})|\bA[KS]IA[A-Z0-9]{8,15}\b"""
WEAK_SECRET = r"""(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])[A-Za-z0-9+/]{30,}={0,2}(?![A-Za-z0-9+/=_-])|\b(?:pass|pwd)["']?\x20*[:=]\x20*["']?[^\s"',;]{4,}"""
ENDPOINT = r"""\b(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]{4,}|\b(?:host|endpoint|server|region)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}"""


class Spans:
    """Spans (start, kind, end), which may overlap, sorted for interval look-ups: starts, and the furthest end up to each."""

    def __init__(self, spans):
        spans = sorted(spans)
        self.starts = [s for s, _, _ in spans]
        self.ends = list(itertools.accumulate((e for _, _, e in spans), max))

    def reach(self, start: int, end: int) -> bool:
        """True if a span begins at `end` or before and ends at `start` or after."""
        k = bisect.bisect_right(self.starts, end)
        return k > 0 and self.ends[k - 1] >= start


def finder(scope: int):
    """text -> ({base kind: count}, base spans, all spans); a span is (start, kind's rank, end)."""
    assign = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
    access, hexa = re.compile(ACCESS), re.compile(HEX)
    weak_id, weak_secret = re.compile(WEAK_ID, re.ASCII | re.IGNORECASE), re.compile(WEAK_SECRET, re.ASCII)
    endpoint = re.compile(ENDPOINT, re.ASCII | re.IGNORECASE)
    bare = re.compile("sia|kia", re.ASCII | re.IGNORECASE).search

    def find(text: str):
        base = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6] if ":" in text or "=" in text else []
        if "AKIA" in text:
            base += [(m.start(), 1, m.end()) for m in access.finditer(text)]
        base += [(m.start(), 2, m.end()) for m in hexa.finditer(text)]
        base.sort()
        counts = [0, 0, 0]
        for _, k, _ in base:
            counts[k] += 1
        spans = list(base)
        labelled = "=" in text or ":" in text
        # no identifier without a label's sign or, in either case, the letters of a prefix
        ids = [(m.start(), 3, m.end()) for m in weak_id.finditer(text)] if labelled or bare(text) else []
        if ids or base:
            taken = Spans(base)
            free = lambda found: [x for x in found if not taken.reach(x[0] + 1, x[2] - 1)]
            secrets = free([(m.start(), 4, m.end()) for m in weak_secret.finditer(text)])
            ids = free(ids)
            all_ids = Spans(ids + [x for x in base if x[1] == 1])
            all_secrets = Spans(secrets + [x for x in base if x[1] != 1])
            if all_ids.starts and all_secrets.starts:
                near = lambda spans, x: spans.reach(x[0] - scope, x[2] + scope)
                spans += [x for x in ids if near(all_secrets, x)]
                spans += [x for x in secrets if near(all_ids, x)]
                if labelled:
                    ends = free([(m.start(), 5, m.end()) for m in endpoint.finditer(text)])
                    spans += [x for x in ends if near(all_ids, x) and near(all_secrets, x)]
                spans.sort()
        return counts, base, spans

    return find


def scanner(scope: int):
    def joined(spans):
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)

    def run(batches):
        find = finder(scope)
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            n = [[], [], []]
            sha, spans = [], []
            for t in batch.column(1).to_pylist():
                counts, base, every = find(t) if t else ((0, 0, 0), (), ())
                for col, c in zip(n, counts, strict=True):
                    col.append(c)
                sha.append(hashlib.sha256(joined(base).encode()).hexdigest() if base else nothing)
                spans.append(joined(every))
            cols = [batch.column(0), *(pa.array(c, pa.int64()) for c in n), pa.array(sha, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, comma-joined).

    Null and empty texts have no spans. Each row is judged on its own, so null ids, repeated rows and other columns
    do not matter; a very long text is scanned whole, in the memory of its own spans. Offsets are code points, ends exclusive.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(scanner(scope), schema)


def redact_secrets(docs: DataFrame, mask: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """docs with every span of the scan in `text` replaced by the mask (overlapping spans by one) and n_chars, if
    there is such a column, set to the new length. Null texts stay null; all rows and columns are kept."""

    def run(batches):
        find = finder(scope)
        for batch in batches:
            out = []
            for t in batch.column(at).to_pylist():
                spans = find(t)[2] if t else ()
                if spans:
                    parts, end = [], -1
                    for s, _, e in spans:
                        if s > end:
                            parts += [t[max(end, 0) : s], mask]
                        end = max(end, e)
                    t = "".join([*parts, t[end:]])
                out.append(t)
            yield batch.set_column(at, "text", pa.array(out, pa.string()))

    at = docs.columns.index("text")
    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op3_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, f"{sf_dir}/documents.parquet"))


QUERIES = {"op3_credential_linking": op3_credential_linking}
ORACLE: dict[str, str] = {}
