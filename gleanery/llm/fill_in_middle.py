"""Fill-in-the-middle transformation over units that a Split pre-tokenizer finds.

A unit is a word with the white space before it, or white space at the end. `pre_tokenizers.Split` of the tokenizers
library isolates the matches of one regular expression and gives their code-point offsets; nothing is trained. The length
of the offset array is n, and two of its entries, ranked, are where prefix and middle end. Numbers that decide about a
document come from SHA-256 of the seed and its id, so every run and every partition decides alike. Nothing is shuffled.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import released
from gleanery.sources.files import table

UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM = 42, 50, 80
STRETCH = 50_000  # characters that are split at a time


def unit_ends():
    """text -> code-point offsets of the ends of its units.

    A long text is split in stretches that end where a unit ends, after a word and before white space, so the units are
    those of the whole text and what the library holds at a time is bounded, one unit of any length aside.
    """
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    split = Split(Regex(UNIT), "isolated").pre_tokenize_str
    edge = re.compile(r"(?<=[^\x20\x09-\x0D])[\x20\x09-\x0D]").search

    def ends(text: str) -> np.ndarray:
        parts, first = [], 0
        while first < len(text):
            m = edge(text, first + STRETCH) if len(text) - first > STRETCH else None
            last = m.start() if m else len(text)
            parts.append(first + np.array([e for _, (_, e) in split(text[first:last])], dtype=np.int64))
            first = last
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)

    return ends


def transformer(rate: int, spm: int):
    """(doc_id, text, h1, h2, h3, h4) to the rows of fill_in_middle."""

    def run(batches):
        ends = unit_ends()
        for batch in batches:
            ids, texts, *h = (c.to_pylist() for c in batch.columns)
            n, form, lengths, out = [], [], ([], []), []
            for text, h1, h2, h3, h4 in zip(texts, *h, strict=True):
                text = text or ""
                at = np.concatenate([[0], ends(text)])
                n.append(len(at) - 1)
                if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= rate:
                    form.append("plain")
                    lengths[0].append(None)
                    lengths[1].append(None)
                    out.append(text)
                    continue
                a, b = sorted((int(at[h1 % len(at)]), int(at[h2 % len(at)])))
                lengths[0].append(a)
                lengths[1].append(b - a)
                if h4 % 100 < spm:
                    form.append("spm")
                    out.append(f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}")
                else:
                    form.append("psm")
                    out.append(f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}")
            cols = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(form, pa.string()), *(pa.array(x, pa.int64()) for x in lengths), pa.array(out, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm: int = SPM, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars, output.

    rate is the percentage of documents that are transformed, spm that of these whose suffix comes first. A null or empty text
    and one that holds a marker stay plain, with their lengths null. A null id counts as an empty string behind the seed. Rows
    are judged one by one, so repeated rows give repeated rows and an empty table gives none; other columns, whatever their
    names, are left out. A very long text is split whole, in stretches.
    """
    doc = F.col("doc_id").cast("long")
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc.cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(hexed, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    rows = docs.select(doc.alias("doc_id"), F.col("text").cast("string").alias("text"), *h)
    return rows.mapInArrow(released(transformer(rate, spm)), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of: no transformed text holds a marker, so the first of each kind is the one put in."""
    cut = lambda first, last: F.substring(output, first, last - first)
    p, s, m = (F.instr(output, x) for x in (PREFIX, SUFFIX, MIDDLE))
    end = F.length(output) + 1
    psm = F.concat(cut(p + 3, s), cut(m + 3, end), cut(s + 3, m))
    spm = F.concat(cut(p + 3, m), cut(m + 3, end), cut(s + 3, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op13_split_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, f"{sf_dir}/documents.parquet"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    )


SQL = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), numbers AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS UBIGINT) AS h1, CAST('0x' || h[9:16] AS UBIGINT) AS h2, CAST('0x' || h[17:24] AS UBIGINT) AS h3, CAST('0x' || h[25:32] AS UBIGINT) AS h4
  FROM hashed
), cuts AS (
  SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
    CAST(length(coalesce(array_to_string(u[1:CAST(least(h1 % (n + 1), h2 % (n + 1)) AS BIGINT)], ''), '')) AS BIGINT) AS a,
    CAST(length(coalesce(array_to_string(u[1:CAST(greatest(h1 % (n + 1), h2 % (n + 1)) AS BIGINT)], ''), '')) AS BIGINT) AS b
  FROM numbers
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'spm' THEN '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a)
    WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a) ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cuts
"""

QUERIES = {"op13_split_fill_in_middle": op13_split_fill_in_middle}
ORACLE = {"op13_split_fill_in_middle": SQL}
