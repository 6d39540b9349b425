"""URL filter: pattern rules indexed by their rarest literal token, DataFrame functions only.

Rules are host rules and wildcard patterns. Each is compiled to a regular expression over ``host + path`` and the literal
tokens (runs of ``[a-z0-9]``) that any match must hold as whole tokens, and filed under that one of its tokens which the
fewest URLs hold. The tokens of a URL fetch its candidate rules, and only those run their regular expression.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import unused

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path prefix, verdict) of the list that every URL is held against; the longest that fits wins.
HOST_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

#: Words that mark a site or a section, by what they tell. Each is filed under every one of TEMPLATES.
BLOCKED_WORDS = {
    "gambling": ["casino", "casinos", "poker", "roulette", "jackpot", "slots", "sportsbook", "free-bets", "free-spins"],
    "pharma": ["pills", "viagra", "cialis", "tramadol", "steroids", "cheap-meds", "no-prescription"],
    "adult": ["adult", "xxx", "porn", "nudes", "escorts", "camgirls", "hookups"],
    "spam": ["spam", "link-farm", "clickbait", "payday-loans", "get-rich", "essay-writers", "replica-watches"],
    "ads": ["ads", "adserver", "popunder", "banner-exchange", "tracking-pixel"],
}

#: Patterns over the lower-cased host + path: || is the beginning of a host's label, * any run of characters, ^ a character
#: other than a-z 0-9 _ . % - or the end, | the end, and all else stands for itself.
TEMPLATES = ["||{}.", "||{}-", "-{}.", "-{}-*/", "-{}^", "/{}/", "/{}.", "/{}|", "/{}-*.html|"]

#: Rules up to this number travel inside the plan (under 1 MB); more are joined by token.
INLINE_RULES = 2_000

RULE = "struct<size:int,rule:string,verdict:string,pattern:string>"


def patterns() -> list[str]:
    return [t.format(w) for words in BLOCKED_WORDS.values() for w in words for t in TEMPLATES]


def compiled(pattern: str) -> tuple[str, list[str]]:
    """(regular expression, whole tokens of any match) of a wildcard pattern."""
    parts = re.findall(r"\|\||[*^]|\|$|[a-z0-9]+|.", pattern)
    out, tokens = [], []
    for k, part in enumerate(parts):
        if part == "||" and k == 0:
            out.append(r"^([^/]*\.)?")
        elif part == "*":
            out.append(".*")
        elif part == "^":
            out.append(r"([^a-z0-9_.%-]|\z)")
        elif part == "|" and k == len(parts) - 1:
            out.append(r"\z")
        else:
            out.append(re.escape(part))
            # a token is whole if what stands on either side cannot be a letter or digit
            if re.fullmatch("[a-z0-9]+", part) and 0 < k < len(parts) - 1 and "*" not in (parts[k - 1], parts[k + 1]):
                tokens.append(part)
    return "(?s)" + "".join(out), tokens


def compile_rules(host_rules=HOST_RULES, blocked: list[str] | None = None) -> list[dict]:
    """Host rules become anchored expressions over host + path; size orders fitting rules, patterns come last."""
    out = []
    for host, path, verdict in host_rules:
        pattern = rf"^([^/]*\.)?{re.escape(host)}{re.escape(path)}"
        # only the tokens closed on both sides by the literal itself are whole tokens of any match
        whole = re.findall(r"(?<![a-z0-9])[a-z0-9]+(?=[^a-z0-9])", (host + path).lower())
        out.append({"size": len(host + path), "rule": host + path, "verdict": verdict, "pattern": pattern, "tokens": whole})
    for text in patterns() if blocked is None else blocked:
        pattern, tokens = compiled(text)
        out.append({"size": 0, "rule": text, "verdict": "block", "pattern": pattern, "tokens": tokens})
    if any(not r["tokens"] for r in out):
        raise ValueError("a rule needs a literal token")
    return out


def host_of(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, "://") + F.lit(3))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.translate(host, UPPER, LOWER)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, "://") + F.lit(3))
    after = F.substr(rest, F.length(F.regexp_extract(rest, r"^([^/?#]*)", 1)) + F.lit(1))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(after, r"^([^?#]*)", 1)).otherwise(F.lit(""))


def _tokens(s: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(s, UPPER, LOWER), F.lit("([a-z0-9]+)")))


def rarest(parsed: DataFrame, rules: list[dict]) -> list[dict]:
    """Each rule with the token that the fewest rows hold (parsed: the rows' tokens). What comes back has a row for each rule
    token at most."""
    wanted = sorted({t for r in rules for t in r["tokens"]})
    seen = parsed.select(F.explode(parsed.columns[0]).alias("t"))
    if len(wanted) <= INLINE_RULES:
        seen = seen.filter(F.col("t").isin(wanted))
    else:
        seen = seen.join(parsed.sparkSession.createDataFrame([(t,) for t in wanted], "t string"), "t", "left_semi")
    n = {r["t"]: r["n"] for r in seen.groupBy("t").agg(F.count("*").alias("n")).collect()}
    return [r | {"token": min(r["tokens"], key=lambda t: (n.get(t, 0), t))} for r in rules]


def filter_urls(pages: DataFrame, rules: list[dict] | None = None, url: str = "url", inline: int = INLINE_RULES) -> DataFrame:
    """pages with host, path, rule, verdict (and the pattern that blocked) for each row.

    Null URLs and URLs without ``://`` get empty host and path, no rule, and the verdict allow. Repeated rows are
    judged alike, very long URLs whole. Columns of these names are replaced, all others stay; an empty table gives no rows. Up
    to `inline` rules the work is one projection without any shuffle besides the bounded token counts; more rules are
    joined by token with each different URL. Both give the same rows.
    """
    rules = compile_rules() if rules is None else rules
    pages = pages.drop("host", "path", "rule", "verdict", "pattern_rule")
    s, tokens, hits = (unused(pages, c) for c in ("_s", "_tokens", "_hits"))
    parsed = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    parsed = parsed.withColumn(s, F.concat("host", "path")).withColumn(tokens, _tokens(F.col(s)))
    filed = rarest(parsed.select(tokens), rules) if rules else []
    if len(filed) <= inline:
        index: dict[str, list] = {}
        for r in filed:
            index.setdefault(r["token"], []).append({k: r[k] for k in ("size", "rule", "verdict", "pattern")})
        held = F.from_json(F.lit(json.dumps(index)), f"map<string,array<{RULE}>>")
        fetched = F.flatten(F.filter(F.transform(tokens, lambda t: F.try_element_at(held, t)), lambda c: c.isNotNull()))
        out = parsed.withColumn(hits, _fitting(fetched, F.col(s)))
    else:
        spark: SparkSession = pages.sparkSession
        table = spark.createDataFrame([(r["token"], r["size"], r["rule"], r["verdict"], r["pattern"]) for r in filed], "t string, size int, rule string, verdict string, pattern string")
        asked = parsed.select(s, tokens).distinct().select(s, F.explode(tokens).alias("t"))
        found = asked.join(table, "t").filter(_fits(F.col(s), F.col("pattern"), F.col("size")))
        found = found.groupBy(s).agg(F.collect_set(F.struct("size", "rule", "verdict", "pattern")).alias(hits))
        out = parsed.join(found, s, "left").withColumn(hits, F.coalesce(hits, F.array().cast(f"array<{RULE}>")))
    listed = F.array_max(F.filter(hits, lambda h: h["size"] > 0))
    matched = F.array_min(F.filter(hits, lambda h: h["size"] == 0))
    return (
        out.withColumn("rule", listed["rule"])
        .withColumn("pattern_rule", matched["rule"])
        .withColumn("verdict", F.coalesce(listed["verdict"], matched["verdict"], F.lit("allow")))
        .drop(s, tokens, hits)
    )


def _fits(s: Column, pattern: Column, size: Column) -> Column:
    """Host rules are held against the path as it is, patterns against lower case."""
    return F.regexp_like(F.when(size > 0, s).otherwise(F.translate(s, UPPER, LOWER)), pattern)


def _fitting(fetched: Column, s: Column) -> Column:
    return F.filter(fetched, lambda r: _fits(s, r["pattern"], r["size"]))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    """SQL of its own: host rules by host and path, words by what may stand around them."""
    words = "|".join(w for ws in BLOCKED_WORDS.values() for w in ws)
    return f"""
WITH a AS (SELECT page_id, url, instr(url, '://') AS p FROM pages),
b AS (SELECT page_id, CASE WHEN p > 0 THEN substr(url, CAST(p + 3 AS BIGINT)) END AS rest FROM a),
c AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM b),
d AS (SELECT page_id, coalesce(translate(raw, '{UPPER}', '{LOWER}'), '') AS host,
  coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path FROM c),
listed(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (SELECT host, path, max(struct_pack(n := length(h || p), r := h || p, v := v)) AS best
  FROM (SELECT DISTINCT host, path FROM d) JOIN listed ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path),
e AS (SELECT page_id, host, path, best, host || translate(path, '{UPPER}', '{LOWER}') AS s FROM d LEFT JOIN best USING (host, path))
SELECT page_id, host, path, best.r AS rule, CASE WHEN best IS NOT NULL THEN best.v
  WHEN regexp_matches(s, '^(?:[^/]*[.])?(?:{words})[.-]') OR regexp_matches(s, '(?s)-(?:{words})(?:[.]|[^a-z0-9_.%-]|\\z|-.*/)')
    OR regexp_matches(s, '(?s)/(?:{words})(?:/|[.]|\\z|-.*[.]html\\z)') THEN 'block' ELSE 'allow' END AS verdict
FROM e
"""


QUERIES = {"op6_url_filter": op6_url_filter}
ORACLE = {"op6_url_filter": _sql()}
