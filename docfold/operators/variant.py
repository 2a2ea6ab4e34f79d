"""Schemaless flattening (F9) of JSON held as VARIANT: any nesting, no shuffle, no Python per row.

Levels are expanded by a fold inside the row that stops as soon as only scalars are left, so the
depth is not limited by the plan. The JSON parser itself refuses more than 1000 levels.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from docfold.functions.arrays import group_entries, let
from docfold.operators.flatten import MAP_KEY, MAP_VALUE

# Nesting the JSON parser accepts.
MAX_JSON_DEPTH = 1000

# Levels written out in the plan; records nested deeper go on in a loop inside the row.
WRITTEN_OUT = 3


def _as_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def is_object(v: Column) -> Column:
    """Whether a record's value is a document at all; needs no flattening."""
    return F.coalesce(_as_object(v).isNotNull(), F.lit(False))


def _as_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _item(name: Column, v: Column) -> Column:
    return F.struct(name.alias("name"), v.alias("v"), (_as_object(v).isNull() & _as_list(v).isNull()).alias("leaf"))


def _expand(item: Column, compact: bool) -> Column:
    name, v = item["name"], item["v"]
    if compact:
        members = F.transform(F.map_entries(_as_object(v)),
                              lambda e: _item(F.concat(name, F.lit("."), e["key"]), e["value"]))
    else:
        live = F.map_filter(_as_object(v), lambda k, x: ~F.is_variant_null(x))
        members = F.flatten(F.transform(F.map_entries(live), lambda e: F.array(
            _item(F.concat(name, F.lit("." + MAP_KEY)), e["key"].cast("variant")),
            _item(F.concat(name, F.lit("." + MAP_VALUE)), e["value"]))))
    elements = F.transform(F.filter(_as_list(v), lambda x: ~F.is_variant_null(x)), lambda x: _item(name, x))
    return F.when(item["leaf"], F.array(item)).otherwise(F.coalesce(members, elements))


def _is_open(items: Column) -> Column:
    return F.exists(items, lambda i: ~i["leaf"])


def _grow(items: Column, compact: bool) -> Column:
    return F.flatten(F.transform(items, lambda i: _expand(i, compact)))


def _grow_to_leaves(items: Column, value: Column, compact: bool) -> Column:
    """Expand until nothing is open: at most one round per opening bracket of the record."""
    text = F.to_json(value)
    brackets = F.length(text) - F.length(F.translate(text, "{[", ""))
    rounds = F.sequence(F.lit(0), F.least(brackets, F.lit(MAX_JSON_DEPTH)))
    return F.aggregate(rounds, items, lambda acc, _: F.when(_is_open(acc), _grow(acc, compact)).otherwise(acc))


def _expand_all(items: Column, value: Column, compact: bool, levels: int) -> Column:
    """Nested conditionals: a record is looked at once per level it really has."""
    if levels == 0:
        deeper = _grow_to_leaves(items, value, compact)
    else:
        deeper = let(_grow(items, compact), lambda x: _expand_all(x, value, compact, levels - 1))
    return F.when(_is_open(items), deeper).otherwise(items)


def _leaf_text(v: Column) -> Column:
    """Scalar -> text. A number written with a fraction or an exponent is a double."""
    decimal = F.schema_of_variant(v).startswith("DECIMAL")
    return F.when(decimal, F.try_variant_get(v, "$", "double").cast("string")).otherwise(F.try_variant_get(v, "$", "string"))


def _text_or_null(v: Column) -> Column:
    return F.when(~F.is_variant_null(v), _leaf_text(v))


def _without(members: Column, reserved: Iterable[str]) -> Column:
    skip = list(reserved)
    return F.map_filter(members, lambda k, _: ~k.isin(skip)) if skip else members


def _entries(members: Column, value: Column, compact: bool) -> Column:
    items = F.transform(F.map_entries(members), lambda e: _item(e["key"], e["value"]))
    items = let(items, lambda x: _expand_all(x, value, compact, WRITTEN_OUT))
    return F.transform(items, lambda i: F.struct(i["name"].alias("name"), _text_or_null(i["v"]).alias("value")))


def variant_entries(value: Column, compact: bool = True, reserved: Iterable[str] = ("id",)) -> Column:
    """Leaves of a JSON object as array<struct<name, value string>>; a JSON null keeps its name with NULL.

    Anything but an object gives NULL: the record is malformed.
    """
    return _entries(_without(_as_object(value), reserved), value, compact)


def variant_fields(value: Column, compact: bool = True, reserved: Iterable[str] = ("id",),
                   partial: bool = False) -> Column:
    """JSON object -> map<field name, array<string>>. Partial: a name that holds only nulls is carried as NULL."""
    def to_fields(members: Column) -> Column:
        # A record without nesting has every name once, and nothing to expand or group.
        nested = F.exists(F.map_values(members), lambda v: _as_object(v).isNotNull() | _as_list(v).isNotNull())
        flat = F.transform_values(members, lambda k, v: F.when(~F.is_variant_null(v), F.array(_leaf_text(v))))
        return F.when(nested, group_entries(_entries(members, value, compact))).otherwise(flat)

    fields = let(_without(_as_object(value), reserved), to_fields)
    return fields if partial else F.map_filter(fields, lambda k, v: v.isNotNull())
