"""Typed flattening (F1-F8, F14, F15): one walk over the schema names every document field.

The same walk serves values (one `select` of native expressions), the field catalog and the list of
fields to clear, so the three can never disagree about a name.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docfold.functions.arrays import group_entries, non_empty, present
from docfold.functions.encode import encode, encode_text, encoded_type

MAP_KEY, MAP_VALUE = "key", "value"


@dataclass(frozen=True)
class Leaf:
    """One field of the flat document.

    `name` is dotted; an open (compact) map is one dynamic leaf called `<map>.*` whose value is
    map<full field name, array<value>>. `source_type` is the type before encoding.
    `carried` tells whether a partial update says anything about the field: a carried NULL clears it.
    """

    name: str
    value: Column
    source_type: T.DataType
    multi: bool
    dynamic: bool
    carried: Column

    @property
    def type(self) -> T.DataType:
        return encoded_type(self.source_type)


def map_value_type(value_type: T.DataType) -> T.DataType:
    """Value type of an open map's fields: structs, maps and nested arrays mix types, so text takes them all."""
    inner = value_type.elementType if isinstance(value_type, T.ArrayType) else value_type
    if isinstance(inner, (T.StructType, T.MapType, T.ArrayType)):
        return T.StringType()
    return inner


def _live(entries: Column) -> Column:
    return F.map_filter(entries, lambda k, v: v.isNotNull())


def _map_entries(dtype, expr, name: Column, out: T.DataType, mixed: bool, clearing: bool) -> Column:
    """Everything under one value as array<struct<name, value>>; `clearing` keeps nulls that are carried."""
    shape = f"array<struct<name:string,value:{out.simpleString()}>>"
    empty = F.array().cast(shape)
    null_entry = F.array(F.struct(name.alias("name"), F.lit(None).cast(out).alias("value"))).cast(shape)
    missing = null_entry if clearing else empty
    if isinstance(dtype, T.MapType):
        found = F.flatten(F.transform(F.map_entries(expr), lambda e: _map_entries(
            dtype.valueType, e["value"], F.concat(name, F.lit("."), e["key"].cast("string")), out, mixed, clearing)))
    elif isinstance(dtype, T.StructType):
        found = F.concat(*[
            _map_entries(f.dataType, expr.getField(f.name), F.concat(name, F.lit("." + f.name)), out, mixed, clearing)
            for f in dtype.fields])
    elif isinstance(dtype, T.ArrayType):
        found = F.flatten(F.transform(present(expr), lambda x: _map_entries(
            dtype.elementType, x, name, out, mixed, clearing)))
    else:
        value = encode_text(expr, dtype) if mixed else encode(expr, dtype)
        found = F.array(F.struct(name.alias("name"), value.alias("value"))).cast(shape)
    return F.when(expr.isNull(), missing).otherwise(found)


def _open_map(dtype: T.MapType, expr: Column, name: str, multi: bool, clearing: bool) -> Column:
    source = map_value_type(dtype.valueType)
    out = encoded_type(source)
    mixed = isinstance(dtype.valueType, (T.StructType, T.MapType)) or (
        isinstance(dtype.valueType, T.ArrayType)
        and isinstance(dtype.valueType.elementType, (T.StructType, T.MapType, T.ArrayType)))
    flat = not isinstance(dtype.valueType, (T.StructType, T.MapType, T.ArrayType))
    if flat and not multi and not clearing:
        # Keys of one map are unique, so there is nothing to group.
        return F.map_from_entries(F.transform(F.map_entries(_live(expr)), lambda e: F.struct(
            F.concat(F.lit(name + "."), e["key"].cast("string")).alias("key"),
            F.array(encode(e["value"], dtype.valueType)).alias("value"))))

    def one(m):
        return _map_entries(dtype, m, F.lit(name), out, mixed, clearing)

    entries = F.flatten(F.transform(present(expr), one)) if multi else F.when(expr.isNotNull(), one(expr))
    grouped = group_entries(entries)
    return grouped if clearing else _live(grouped)


def _carried(expr: Column, steps: tuple) -> Column:
    """Whether a record says something about the leaf reached by `steps`: a null on the way clears it,
    an empty list says nothing, and a list speaks when one of its elements does."""
    for i, step in enumerate(steps):
        rest = steps[i + 1:]
        if step == "each":
            return expr.isNull() | F.exists(expr, lambda e: e.isNotNull() & _carried(e, rest))
        if step == "keys":
            return expr.isNull() | (F.size(_live(expr)) > 0)
        if step == "values":
            return expr.isNull() | F.exists(F.map_values(_live(expr)), lambda e: _carried(e, rest))
        expr = expr.getField(step[1])
    return F.lit(True)


def _walk(dtype, expr, name, multi, compact, clearing, root, steps) -> list[Leaf]:
    if isinstance(dtype, T.StructType):
        out = []
        for f in dtype.fields:
            out += _walk(f.dataType, expr.getField(f.name), f"{name}.{f.name}", multi, compact, clearing, root,
                         steps + (("field", f.name),))
        return out
    if isinstance(dtype, T.ArrayType):
        inner = F.flatten(present(expr)) if multi else expr
        return _walk(dtype.elementType, inner, name, True, compact, clearing, root, steps + ("each",))
    if isinstance(dtype, T.MapType):
        if compact:
            value = _open_map(dtype, expr, name, multi, clearing)
            return [Leaf(f"{name}.*", value, map_value_type(dtype.valueType), True, True, value.isNotNull())]
        if multi:
            maps = F.transform(present(expr), _live)
            keys, values = F.flatten(F.transform(maps, F.map_keys)), F.flatten(F.transform(maps, F.map_values))
        else:
            keys, values = F.map_keys(_live(expr)), F.map_values(_live(expr))
        return (_walk(dtype.keyType, keys, f"{name}.{MAP_KEY}", True, compact, clearing, root, steps + ("keys",))
                + _walk(dtype.valueType, values, f"{name}.{MAP_VALUE}", True, compact, clearing, root,
                        steps + ("values",)))
    value = non_empty(F.transform(present(expr), lambda x: encode(x, dtype))) if multi else encode(expr, dtype)
    return [Leaf(name, value, dtype, multi, False, _carried(root, steps))]


def leaves(schema: T.StructType, parent: Column | None = None, compact: bool = True,
           reserved: Iterable[str] = ("id",), clearing: bool = False) -> list[Leaf]:
    """Leaves of `schema`, read from the struct column `parent` or, without one, from the frame's own columns.

    `reserved` top-level names are set by the engine and never re-emitted from the value (P10).
    """
    skip = set(reserved)
    out: list[Leaf] = []
    for f in schema.fields:
        if f.name in skip:
            continue
        expr = F.col(f"`{f.name}`") if parent is None else parent.getField(f.name)
        out += _walk(f.dataType, expr, f.name, False, compact, clearing, expr, ())
    return out


def flatten(df: DataFrame, value: str | None = None, keep: Iterable[str] = (), compact: bool = True,
            reserved: Iterable[str] = ("id",)) -> DataFrame:
    """One `select`: the `keep` columns, then one column per leaf under its dotted name.

    Absent values are NULL (scalars and lists); an empty list is absent.
    """
    schema = df.schema if value is None else df.schema[value].dataType
    kept = list(keep)
    parent = None if value is None else F.col(value)
    reserved = set(reserved) | (set(kept) if value is None else set())
    found = leaves(schema, parent, compact, reserved)
    return df.select(*[F.col(f"`{c}`") for c in kept], *[leaf.value.alias(leaf.name) for leaf in found])


def _text_list(leaf: Leaf) -> Column:
    if leaf.multi:
        return leaf.value.cast("array<string>")
    return F.when(leaf.value.isNotNull(), F.array(leaf.value.cast("string")))


def fields_map(found: list[Leaf], partial: bool = False) -> Column:
    """Leaves -> map<field name, array<string>>, the long form of a document.

    Full records hold only fields that have a value. Partial records also hold the fields they clear,
    with a NULL value; a field they say nothing about has no key.
    """
    fixed = [x for x in found if not x.dynamic]
    parts = []
    if fixed:
        rows = F.array(*[
            F.struct(F.lit(x.name).alias("key"), _text_list(x).alias("value"), x.carried.alias("carried"))
            for x in fixed])
        if partial:
            rows = F.filter(rows, lambda r: r["value"].isNotNull() | r["carried"])
        else:
            rows = F.filter(rows, lambda r: r["value"].isNotNull())
        parts.append(F.map_from_entries(F.transform(rows, lambda r: F.struct(r["key"], r["value"]))))
    for x in found:
        if x.dynamic:
            parts.append(F.coalesce(x.value.cast("map<string,array<string>>"),
                                    F.create_map().cast("map<string,array<string>>")))
    if not parts:
        return F.create_map().cast("map<string,array<string>>")
    return F.map_concat(*parts) if len(parts) > 1 else parts[0]


def effective(fields: Column, partial: bool, stamped: bool = False) -> Column:
    """a partial record that sets nothing but its id writes nothing; a mapping-version stamp counts."""
    if not partial or stamped:
        return F.lit(True)
    return F.size(fields) > 0


def written_names(dtype: T.DataType, name: str, compact: bool = True) -> list[str]:
    """document fields a value of `dtype` writes under `name`, i.e. what a NULL there clears.

    The keys of a compact map are data, so it names none.
    """
    found = _walk(dtype, F.lit(None), name, False, compact, False, F.lit(None), ())
    return [x.name for x in found if not x.dynamic]
