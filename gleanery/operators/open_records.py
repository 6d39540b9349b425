"""Open records: typed columns beside the whole object they were read from, so that no field is lost.

`_open` holds the object of a line as VARIANT. Typed columns are what it says in the record's fields; whatever else it holds, at
any depth, stays in `_open` and is written again. A field keeps its original form until its typed value changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from gleanery.schema import RECORD

OPEN = "_open"


def _entries(v: Column) -> Column:
    """The fields of an object as map<string, variant>; null for anything else."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def _record_type(schema: str | S.StructType) -> S.StructType:
    return S.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def typed(v: Column, schema: str | S.StructType = RECORD) -> Column:
    """The record that an object says, as a struct: what it lacks, or has in another type, is null."""
    return F.from_json(F.to_json(v), _record_type(schema))


def open_records(lines: DataFrame, value: str = "value", schema: str | S.StructType = RECORD) -> DataFrame:
    """Rows with a JSON object in a column as records with `_open`; other columns are kept, but those that a field is named like.

    A line that is no object, or has a key twice, gives null fields and a null `_open`.
    """
    full = _record_type(schema)
    rest = [c for c in lines.columns if c not in full.fieldNames() and c != value]
    parsed = lines.withColumn(OPEN, F.try_parse_json(value))
    parsed = parsed.withColumn(OPEN, F.when(_entries(F.col(OPEN)).isNotNull(), F.col(OPEN)))
    return parsed.withColumn("_typed", typed(F.col(OPEN), full)).select("_typed.*", OPEN, *(F.col(f"`{c}`") for c in rest))


def _variant(kind: S.DataType, value: Column) -> Column:
    """The value as VARIANT, null as a null of JSON."""
    made = F.to_variant_object(value) if isinstance(kind, (S.StructType, S.ArrayType, S.MapType)) else value.cast("variant")
    return F.when(value.isNull(), F.parse_json(F.lit("null"))).otherwise(made)


def _kept(kind: S.DataType, value: Column, was: Column, whole: Column) -> Column:
    """The original where the value is what it was; otherwise the value, with the fields of the original that it cannot hold."""
    if isinstance(kind, S.StructType):
        theirs = F.coalesce(_entries(whole), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>")))
        names = F.array(*(F.lit(f.name) for f in kind.fields))
        own = F.array(*(F.struct(F.lit(f.name).alias("key"), _kept(f.dataType, value[f.name], was[f.name], F.try_element_at(theirs, F.lit(f.name))).alias("value")) for f in kind.fields))
        merged = F.map_concat(F.map_filter(theirs, lambda k, _: ~F.array_contains(names, k)), F.map_from_entries(F.filter(own, lambda e: e["value"].isNotNull())))
        new = F.when(value.isNull(), F.parse_json(F.lit("null"))).otherwise(F.to_variant_object(merged))
    elif isinstance(kind, S.ArrayType) and isinstance(kind.elementType, S.StructType):
        items = F.try_variant_get(whole, "$", "array<variant>")
        same = lambda x: F.coalesce(F.get(items, F.array_position(was, x).cast("int") - 1), _variant(kind.elementType, x))
        new = F.when(value.isNull(), F.parse_json(F.lit("null"))).otherwise(F.to_variant_object(F.transform(value, same)))
    else:
        new = _variant(kind, value)
    return F.when(value.eqNullSafe(was), whole).otherwise(new)


def open_lines(records: DataFrame, schema: str | S.StructType = RECORD) -> DataFrame:
    """(value): each record as one JSON object. Of records with `_open`, unknown fields and the form of unchanged ones are
    those of the original; array elements keep theirs where they equal one of the original's. Keys are in order of their names."""
    full = _record_type(schema)
    fields = [f for f in full.fields if f.name in records.columns]
    value = F.struct(*(F.col(f"`{f.name}`") for f in fields))
    plain = F.to_json(value, {"ignoreNullFields": "false"})
    if OPEN not in records.columns:
        return records.select(plain.alias("value"))
    kind = S.StructType(fields)
    bound = records.select(value.alias("v"), typed(F.col(OPEN), kind).alias("was"), F.col(OPEN).alias("whole"))
    merged = F.to_json(_kept(kind, F.col("v"), F.col("was"), F.col("whole")))
    return bound.select(F.when(F.col("whole").isNull(), F.to_json("v", {"ignoreNullFields": "false"})).otherwise(merged).alias("value"))


def option_keys(v: Column, field: str = "options") -> Column:
    """Sorted keys of a record's options; null where they are no object."""
    return F.array_sort(F.map_keys(F.try_variant_get(v, f"$.{field}", "map<string,variant>")))


def unknown_fields(v: Column, schema: str | S.StructType = RECORD) -> Column:
    """The fields of the object itself that the record does not have, as map<string, variant>."""
    names = F.array(*(F.lit(n) for n in _record_type(schema).fieldNames()))
    return F.map_filter(_entries(v), lambda k, _: ~F.array_contains(names, k))
