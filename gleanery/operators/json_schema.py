"""Conformance to a JSON-schema document (draft 2020-12), compiled to one expression over VARIANT.

Every violation is reported with its path and keyword. The document is read when the plan is made: references are resolved,
and each subschema becomes conditions on the value at its path, so a check is one pass without a shuffle and without Python.
A keyword that is not known here is an error and never passed over; those that assert nothing are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.sources.files import BadInput

# Keywords that assert nothing, and those that the compiler knows.
SILENT = {"$schema", "$id", "$anchor", "$defs", "definitions", "$comment", "title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "format", "contentEncoding", "contentMediaType"}
KNOWN = {
    "$ref", "type", "enum", "const", "pattern", "minLength", "maxLength", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "required", "properties", "patternProperties",
    "additionalProperties", "minProperties", "maxProperties", "items", "prefixItems", "minItems", "maxItems", "uniqueItems", "allOf", "anyOf", "oneOf", "not", "if", "then", "else",
}
FOUND = "array<struct<path:string,keyword:string>>"


def _key(path: str, name: str) -> str:
    quote = '"' if "'" in name else "'"
    if quote in name or "\\" in name:
        raise BadInput(f"a property's name cannot be put in a path: {name!r}")
    return f"{path}[{quote}{name}{quote}]"


def _kind(v: Column, path: str) -> Column:
    """The JSON type of the value at a path; null where there is none. Numbers without a fraction are integers."""
    at = F.try_variant_get(v, path, "variant")
    name = F.schema_of_variant(at)
    number = F.try_variant_get(v, path, "double")
    whole = F.when(number == F.floor(number), "integer").otherwise("number")
    return (
        F.when(at.isNull(), F.lit(None).cast("string")).when(F.is_variant_null(at), "null").when(F.try_variant_get(v, path, "map<string,variant>").isNotNull(), "object")
        .when(F.try_variant_get(v, path, "array<variant>").isNotNull(), "array").when(name == "STRING", "string").when(name == "BOOLEAN", "boolean").when(name == "BIGINT", "integer").otherwise(whole)
    )


def _equal(v: Column, path: str, kind: Column, values: list) -> Column:
    """Whether the value is one of these. true is not 1, and 1 is 1.0."""
    out = F.lit(False)
    texts = [x for x in values if isinstance(x, str)]
    numbers = [float(x) for x in values if isinstance(x, (int, float)) and not isinstance(x, bool)]
    if any(isinstance(x, (dict, list)) for x in values):
        raise BadInput("enum and const of objects or arrays are not supported")
    if texts:
        out = out | ((kind == "string") & F.try_variant_get(v, path, "string").isin(texts))
    if numbers:
        out = out | (kind.isin("integer", "number") & F.try_variant_get(v, path, "double").isin(numbers))
    for flag in (x for x in values if isinstance(x, bool)):
        out = out | ((kind == "boolean") & (F.try_variant_get(v, path, "boolean") == flag))
    return out | (kind == "null") if None in values else out


def compiled(document: dict | bool, most: int = 20) -> Callable[[Column], Column]:
    """VARIANT -> array<struct<path, keyword>> of its violations; most: how deep references may nest, which a schema that holds
    itself exceeds."""

    def resolve(ref: str):
        if not ref.startswith("#"):
            raise BadInput(f"only references inside the document are supported: {ref}")
        at = document
        for part in filter(None, ref[1:].split("/")):
            part = part.replace("~1", "/").replace("~0", "~")
            try:
                at = at[int(part)] if isinstance(at, list) else at[part]
            except (KeyError, IndexError, ValueError) as e:
                raise BadInput(f"no such reference: {ref}") from e
        return at

    def one(when: Column, shown: Column, keyword: str) -> Column:
        return F.when(when, F.array(F.struct(shown.alias("path"), F.lit(keyword).alias("keyword")))).otherwise(F.array().cast(FOUND))

    def keys(found: Column, shown: Column, keyword: str) -> Column:
        return F.coalesce(F.transform(found, lambda k: F.struct(F.concat(shown, F.lit("."), k).alias("path"), F.lit(keyword).alias("keyword"))), F.array().cast(FOUND))

    def fails(s, v: Column, path: str, shown: Column, depth: int) -> Column:
        return F.size(joined(check(s, v, path, shown, depth))) > 0

    def joined(parts: list[Column]) -> Column:
        return F.concat(*parts) if parts else F.array().cast(FOUND)

    def check(s, v: Column, path: str, shown: Column, depth: int) -> list[Column]:
        """Arrays of violations of the value at `path` of v, which reports show as `shown`."""
        if s is True or s == {}:
            return []
        if s is False:
            return [one(F.try_variant_get(v, path, "variant").isNotNull(), shown, "false")]
        if depth > most:
            raise BadInput("references nest too deep")
        unknown = sorted(set(s) - KNOWN - SILENT)
        if unknown:
            raise BadInput("keywords that are not supported: " + ", ".join(unknown))
        out = check(resolve(s["$ref"]), v, path, shown, depth + 1) if "$ref" in s else []
        kind, found = _kind(v, path), F.try_variant_get(v, path, "map<string,variant>")
        items = F.try_variant_get(v, path, "array<variant>")
        scalars: dict[str, Column] = {}
        if "type" in s:
            types = [s["type"]] if isinstance(s["type"], str) else list(s["type"])
            scalars["type"] = ~kind.isin(*types, *(["integer"] if "number" in types else []))
        if "enum" in s:
            scalars["enum"] = ~_equal(v, path, kind, s["enum"])
        if "const" in s:
            scalars["const"] = ~_equal(v, path, kind, [s["const"]])
        text, number = F.try_variant_get(v, path, "string"), F.try_variant_get(v, path, "double")
        if "pattern" in s:
            scalars["pattern"] = (kind == "string") & ~text.rlike("(?d)" + s["pattern"])
        for word, wrong in (("minLength", lambda n: F.length(text) < n), ("maxLength", lambda n: F.length(text) > n)):
            if word in s:
                scalars[word] = (kind == "string") & wrong(s[word])
        for word, wrong in (("minimum", lambda n: number < n), ("maximum", lambda n: number > n), ("exclusiveMinimum", lambda n: number <= n), ("exclusiveMaximum", lambda n: number >= n)):
            if word in s:
                scalars[word] = kind.isin("integer", "number") & wrong(float(s[word]))
        for word, wrong in (("minItems", lambda n: F.size(items) < n), ("maxItems", lambda n: F.size(items) > n)):
            if word in s:
                scalars[word] = items.isNotNull() & wrong(s[word])
        if s.get("uniqueItems"):
            said = F.transform(items, lambda x: F.to_json(x))
            scalars["uniqueItems"] = items.isNotNull() & (F.size(F.array_distinct(said)) < F.size(said))
        for word, wrong in (("minProperties", lambda n: F.size(found) < n), ("maxProperties", lambda n: F.size(found) > n)):
            if word in s:
                scalars[word] = found.isNotNull() & wrong(s[word])
        present = F.try_variant_get(v, path, "variant").isNotNull()
        for part in s.get("allOf", []):
            out += check(part, v, path, shown, depth + 1)
        if "anyOf" in s:
            scalars["anyOf"] = F.array_min(F.array(*(fails(x, v, path, shown, depth + 1).cast("int") for x in s["anyOf"]))) == 1
        if "oneOf" in s:
            right = [F.when(fails(x, v, path, shown, depth + 1), 0).otherwise(1) for x in s["oneOf"]]
            scalars["oneOf"] = F.aggregate(F.array(*right), F.lit(0), lambda a, x: a + x) != 1
        if "not" in s:
            scalars["not"] = ~fails(s["not"], v, path, shown, depth + 1)
        if "if" in s:
            wrong = fails(s["if"], v, path, shown, depth + 1)
            empty = F.array().cast(FOUND)
            out += [F.when(wrong, joined(check(s.get("else", True), v, path, shown, depth + 1))).otherwise(empty), F.when(~wrong, joined(check(s.get("then", True), v, path, shown, depth + 1))).otherwise(empty)]
        out += [one(present & wrong, shown, word) for word, wrong in scalars.items()]
        if "required" in s:
            lacking = F.array_except(F.array(*(F.lit(n) for n in s["required"])), F.map_keys(found)) if s["required"] else F.array().cast("array<string>")
            out.append(keys(lacking, shown, "required"))
        properties, patterns = s.get("properties", {}), s.get("patternProperties", {})
        for name, sub in properties.items():
            out += check(sub, v, _key(path, name), F.concat(shown, F.lit("." + name)), depth + 1)

        def entries(mine: Callable[[Column], Column], sub) -> Column:
            """Violations of the values whose keys are meant."""
            rest = F.filter(F.map_entries(found), lambda e: mine(e["key"]))
            of = F.transform(rest, lambda e: joined(check(sub, e["value"], "$", F.concat(shown, F.lit("."), e["key"]), depth + 1)))
            return F.coalesce(F.flatten(of), F.array().cast(FOUND))

        def matching(pattern: str) -> Callable[[Column], Column]:
            return lambda k: k.rlike("(?d)" + pattern)

        out += [entries(matching(p), sub) for p, sub in patterns.items()]
        more = s.get("additionalProperties", True)
        if more is not True and more != {}:

            def other(k: Column) -> Column:
                known = F.array_contains(F.array(*(F.lit(n) for n in properties)).cast("array<string>"), k)
                for p in patterns:
                    known = known | matching(p)(k)
                return ~known

            if more is False:
                out.append(keys(F.filter(F.map_keys(found), other), shown, "additionalProperties"))
            else:
                out.append(entries(other, more))
        first = s.get("prefixItems", [])
        for i, sub in enumerate(first):
            out += check(sub, v, f"{path}[{i}]", F.concat(shown, F.lit(f"[{i}]")), depth + 1)
        if s.get("items", True) not in (True, {}):
            named = lambda i: F.concat(shown, F.lit("["), (i + len(first)).cast("string"), F.lit("]"))
            rest = F.slice(items, len(first) + 1, F.size(items)) if first else items
            of = F.transform(rest, lambda x, i: joined(check(s["items"], x, "$", named(i), depth + 1)))
            out.append(F.coalesce(F.flatten(of), F.array().cast(FOUND)))
        return out

    return lambda v: F.when(v.isNull(), F.array(F.struct(F.lit("$").alias("path"), F.lit("parse").alias("keyword")))).otherwise(joined(check(document, v, "$", F.lit("$"), 0)))


def violations(rows: DataFrame, document: dict | bool, value: str, *keys: str) -> DataFrame:
    """(keys, path, keyword) of every violation of the documents in a VARIANT column; one that could not be parsed, and so is null,
    has keyword parse. An array's or object's place is shown as $.name[3].name."""
    return rows.select(*keys, F.explode(compiled(document)(F.col(value))).alias("_v")).select(*keys, "_v.path", "_v.keyword")
