"""Text expressions: cleaning, hashing, n-grams, answers. All are Columns; one Arrow UDF does what Spark lacks."""

from __future__ import annotations

import datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gleanery.schema import LETTERS

# Characters and patterns that decide what is cleaned.
INVISIBLE = r"[\u200B-\u200F\u202A-\u202E\u2060\uFEFF]"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
QUESTION_NUMBER = r"(?U)^\s*(?:第\s*)?\d+\s*(?:题|[.．、)）])\s*"
OPTION_PREFIX = r"(?U)^\s*[A-DＡ-Ｄa-dａ-ｄ]\s*[.．、:：)）]\s*"
SCORE_PREFIX = r"(?U)^\d+[.、．\s]*(（[^）]+）|\([^)]+\))?\s*"
WIDE, NARROW = "ＡＢＣＤａｂｃｄ", "ABCDabcd"


@F.pandas_udf(StringType())
def compatibility_form(s: pd.Series) -> pd.Series:
    """HTML entities resolved, then Unicode NFKC."""
    import html
    import unicodedata

    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", html.unescape(x)))


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def let(value: Column, body) -> Column:
    """body(value) with the value worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def normal_text(c: Column, number: bool = False) -> Column:
    """Null as '', entities, NFKC, no invisible or control characters, single blanks; without a question number."""
    t = compatibility_form(F.coalesce(c, F.lit("")))
    t = F.regexp_replace(F.regexp_replace(t, INVISIBLE, ""), CONTROL, "")
    t = F.trim(F.regexp_replace(t, r"(?U)\s+", " "))
    return strip(F.regexp_replace(t, QUESTION_NUMBER, "")) if number else t


def option_text(c: Column) -> Column:
    return strip(F.regexp_replace(normal_text(c), OPTION_PREFIX, ""))


def without_score(c: Column) -> Column:
    """A stem without its number and the score in brackets after it."""
    return strip(F.regexp_replace(c, SCORE_PREFIX, ""))


def changes(*fields: tuple[str, Column, Column]) -> Column:
    """[{field, before, after}] of the fields that differ, in order."""
    rows = F.array(*(F.struct(F.lit(n).alias("field"), F.coalesce(b, F.lit("")).alias("before"), F.coalesce(a, F.lit("")).alias("after")) for n, b, a in fields))
    return F.filter(rows, lambda x: x["before"] != x["after"])


def json(c: Column) -> Column:
    """Compact JSON that keeps nulls."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def ordered_hash(material: Column, question: Column, options: Column) -> Column:
    row = F.struct(F.array(*(F.coalesce(options[x], F.lit("")) for x in LETTERS)).alias("options"), F.coalesce(question, F.lit("")).alias("question"), F.coalesce(material, F.lit("")).alias("shared_material"))
    return F.sha2(json(row), 256)


def permutation_hash(material: Column, question: Column, options: Column) -> Column:
    row = F.struct(F.array_sort(F.array(*(F.coalesce(options[x], F.lit("")) for x in LETTERS))).alias("options"), F.coalesce(question, F.lit("")).alias("question"), F.coalesce(material, F.lit("")).alias("shared_material"))
    return F.sha2(json(row), 256)


def csv_safe(c: Column) -> Column:
    """Text that a spreadsheet would take for a formula gets an apostrophe."""
    t = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(t.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), t)).otherwise(t)


def csv_restore(c: Column) -> Column:
    return F.regexp_replace(c, r"^'(?=[=+\-@])", "")


def ngrams(c: Column, n: int) -> Column:
    """Different character n-grams without white space; a shorter text is one, an empty one none."""

    def of(letters: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(letters) - (n - 1), F.lit(1)))
        return F.when(F.size(letters) > 0, F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(letters, i, n), ""))))

    # as an element of an array the letters are taken once, not for each n-gram
    letters = F.array(F.regexp_extract_all(c, F.lit(r"(?U)\S"), F.lit(0)))
    return F.coalesce(F.get(F.transform(letters, of), F.lit(0)), F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


# Small letters whose capital is one character, though the full mapping writes them as several.
SMALL = "ß" + "".join(map(chr, [*range(0x1F80, 0x1F88), *range(0x1F90, 0x1F98), *range(0x1FA0, 0x1FA8), 0x1FB3, 0x1FC3, 0x1FF3]))
LARGE = "ẞ" + "".join(map(chr, [*range(0x1F88, 0x1F90), *range(0x1F98, 0x1FA0), *range(0x1FA8, 0x1FB0), 0x1FBC, 0x1FCC, 0x1FFC]))


def capital(c: Column) -> Column:
    """The capital of one character, one character in turn: ẞ of ß, and itself where only several would do."""
    upper = F.upper(c)
    return F.when(F.char_length(upper) > F.char_length(c), F.translate(c, SMALL, LARGE)).otherwise(upper)


def small_letters(c: Column) -> Column:
    """In small letters, character by character: what stands around one is not asked."""
    return F.lower(F.translate(c, "İΣ", "iσ"))


def _letter(c: Column) -> Column:
    return F.upper(F.translate(c, WIDE, NARROW))


def answer_of(c: Column) -> Column:
    """The letter after an answer label anywhere, or of a text that is one letter; else ''."""
    t = F.coalesce(c, F.lit(""))
    labelled = F.regexp_extract(t, r"(?U)(?:参考)?答案\s*[:：]?\s*([A-DＡ-Ｄa-dａ-ｄ])", 1)
    alone = F.regexp_extract(t, r"(?U)^\s*([A-DＡ-Ｄa-dａ-ｄ])\s*\z", 1)
    return F.coalesce(*(F.when(x != "", _letter(x)) for x in (labelled, alone)), F.lit(""))


def final_answer(c: Column, mode: Column) -> Column:
    """The letter of a last line `答案: X`, if the mode's number of lines is right and no earlier line is one."""
    t = compatibility_form(F.coalesce(c, F.lit("")))
    lines = F.filter(F.transform(F.split(t, r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"), strip), lambda x: x != "")
    pattern = r"(?iU)\A答案\s*:\s*([ABCD])\z"
    n = F.size(lines)
    fits = F.when(mode == "direct", n == 1).when(mode == "cot", n >= 2).otherwise(n >= 1)
    early = F.exists(F.slice(lines, 1, F.greatest(n - 1, F.lit(0))), lambda x: x.rlike(pattern))
    letter = F.upper(F.regexp_extract(F.try_element_at(lines, F.lit(-1)), pattern, 1))
    return F.when(fits & ~early & (letter != ""), letter)


# Phrases by which an explanation claims an answer.
CLAIMS = (r"故选[：:\s]*([A-D])", r"【答案】\s*([A-D])", r"(?:正确答案|故答案为|本题选|所以选)[：:\s]*([A-D])", r"答案[：:\s]+([A-D])", r"([A-D])\s*项正确")


def answer_claims(c: Column) -> Column:
    """All letters that a recognised explanation claims, sorted."""
    found = F.flatten(F.array(*(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("(?U)" + p), 1) for p in CLAIMS)))
    return F.array_sort(F.array_distinct(found))


def claimed_answer(claims: Column) -> Column:
    return F.when(F.size(claims) == 1, claims[0]).otherwise("")


def light_clean(c: Column) -> Column:
    """Lines with single blanks, without empty ones."""
    lines = F.transform(F.split(F.regexp_replace(c, "\r\n", "\n"), "\n"), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def utc_now_iso() -> str:
    """The time, to the second, in UTC."""
    return datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds")
