"""Routing, identity and stamps (P1-P16): projections over change records, no shuffle anywhere."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docfold.functions.encode import base64_text, encode, is_temporal, utf16_bytes, value_bytes
from docfold.functions.headers import header_version
from docfold.operators.flatten import Leaf
from docfold.options import FoldOptions

MAPPING_VERSION = "_mapping_version"
VERSION = "_version_"
DELETED = "_deleted"


# --- routing -----------------------------------------------------------------------------------

def route(topic: Column, options: FoldOptions) -> Column:
    """Target collection of a record (P1-P3). A regex replaces inside topics it matches as a whole."""
    if options.collection_naming_strategy == "TOPIC_REGEX":
        pattern, replacement = (part.strip() for part in options.collection.split("=>", 1))
        return F.when(topic.rlike(rf"\A(?:{pattern})\z"), F.regexp_replace(topic, pattern, replacement)).otherwise(topic)
    return F.lit(options.collection) if options.collection else topic


# --- identity ----------------------------------------------------------------------------------

def _scalar_id(col: Column, dtype: T.DataType, as_text: bool) -> Column:
    """Binary, struct and list ids are rejected: they have no readable text form."""
    if isinstance(dtype, T.VariantType):
        composite = F.try_variant_get(col, "$", "map<string,variant>").isNotNull() | \
            F.try_variant_get(col, "$", "array<variant>").isNotNull()
        return F.when(~composite, F.try_variant_get(col, "$", "string"))
    if isinstance(dtype, (T.BinaryType, T.StructType, T.ArrayType, T.MapType)):
        return F.lit(None).cast("string")
    return col.cast("string") if as_text else col


def field_at(value: Column, dtype: T.DataType, path: list[str]) -> tuple[Column, T.DataType]:
    """Walk a dotted path through structs, maps and JSON objects; a scalar on the way gives NULL."""
    for i, part in enumerate(path):
        if isinstance(dtype, T.VariantType):
            rest = "".join(f"['{p}']" for p in path[i:])
            return F.try_variant_get(value, "$" + rest, "variant"), dtype
        if isinstance(dtype, T.StructType) and part in dtype.names:
            value, dtype = value.getField(part), dtype[part].dataType
        elif isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
            value, dtype = F.try_element_at(value, F.lit(part)), dtype.valueType
        else:
            return F.lit(None).cast("string"), T.StringType()
    return value, dtype


def topic_partition_offset() -> Column:
    return F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))


def document_id(schema: T.StructType, options: FoldOptions, value: str = "value", key: str = "key") -> Column:
    """Document id (P4-P9); NULL marks a record that has none.

    KAFKA_KEY turns into topic-partition-offset where the key is ignored (globally or for the topic). Ids
    keep a numeric type only when coercion is off and no record needs a text id. UUID ids differ on
    redelivery; topic-partition-offset is the replay-safe choice.
    """
    strategy = options.id_strategy
    if strategy == "UUID":
        return F.expr("uuid()")
    if strategy == "TOPIC_PARTITION_OFFSET" or (strategy == "KAFKA_KEY" and options.key_ignore):
        return topic_partition_offset()
    if strategy == "RECORD_FIELD":
        found, dtype = field_at(F.col(value), schema[value].dataType, options.id_field.split("."))
        return _scalar_id(found, dtype, options.id_coerce_to_string)
    as_text = options.id_coerce_to_string or bool(options.topic_key_ignore)
    by_key = _scalar_id(F.col(key), schema[key].dataType, as_text)
    if options.topic_key_ignore:
        ignored = F.col("topic").isin(list(options.topic_key_ignore))
        return F.when(ignored, topic_partition_offset()).otherwise(by_key)
    return by_key


def delete_id(schema: T.StructType, key: str = "key") -> Column:
    """A delete always names its document by the record key, as text."""
    return _scalar_id(F.col(key), schema[key].dataType, True)


# --- stamps ------------------------------------------------------------------------------------

def reserved_names(options: FoldOptions) -> tuple[str, ...]:
    """Top-level names the engine sets itself (P10)."""
    own = (options.mapping_version and MAPPING_VERSION, options.offset_version_field, options.offset_version_field and DELETED,
           options.source_field)
    return ("id", *dict.fromkeys(n for n in own if n and n != "id"))


def stamps(schema: T.StructType, options: FoldOptions) -> dict[str, Column]:
    """Mapping-version, offset-version and external-version columns (P11-P13), by field name."""
    out: dict[str, Column] = {}
    if options.mapping_version:
        out[MAPPING_VERSION] = F.lit(options.mapping_version)
    if options.external_version_header and "headers" in schema.names:
        out[VERSION] = header_version(F.col("headers"), options.external_version_header, schema["headers"].dataType)
    if options.offset_version_field:
        out[options.offset_version_field] = F.col("offset")
    return out


def _json_ready(col: Column, dtype: T.DataType, iso: bool) -> Column:
    """A value whose JSON form is the documented one: binary as base64, dates as ISO text or epoch millis."""
    if isinstance(dtype, T.StructType):
        fields = [_json_ready(col.getField(f.name), f.dataType, iso).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _json_ready(x, dtype.elementType, iso))
    if isinstance(dtype, T.MapType):
        return F.map_from_entries(F.transform(F.map_entries(col), lambda e: F.struct(
            e["key"].cast("string").alias("key"), _json_ready(e["value"], dtype.valueType, iso).alias("value"))))
    if isinstance(dtype, T.BinaryType):
        return base64_text(col)
    if is_temporal(dtype):
        if iso:
            return encode(col, dtype)
        if isinstance(dtype, T.TimestampType):
            return F.unix_millis(col)
        return F.unix_millis(F.to_timestamp(encode(col, dtype)))
    return col


def source_json(value: Column, dtype: T.DataType, exclude_prefixes: Iterable[str] = (), iso_dates: bool = True) -> Column:
    """The whole value as JSON, nested shape and nulls kept, minus TOP-LEVEL names with a listed prefix."""
    prefixes = tuple(exclude_prefixes)
    options = {"ignoreNullFields": "false"}
    if isinstance(dtype, T.VariantType):
        if not prefixes:
            return F.to_json(value)
        kept = F.map_filter(F.try_variant_get(value, "$", "map<string,variant>"),
                            lambda k, v: ~_starts_with_any(k, prefixes))
        return F.to_json(kept)
    if isinstance(dtype, T.MapType):
        kept = F.map_filter(value, lambda k, v: ~_starts_with_any(k.cast("string"), prefixes)) if prefixes else value
        return F.to_json(_json_ready(kept, dtype, iso_dates), options)
    fields = [
        _json_ready(value.getField(f.name), f.dataType, iso_dates).alias(f.name)
        for f in dtype.fields if not f.name.startswith(prefixes or ("\0",))
    ]
    if not fields:
        return F.when(value.isNotNull(), F.lit("{}"))
    return F.when(value.isNotNull(), F.to_json(F.struct(*fields), options))


def _starts_with_any(name: Column, prefixes: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | name.startswith(p)
    return hit


# --- size --------------------------------------------------------------------------------------

def document_bytes(found: list[Leaf], doc_id: Column, id_type: T.DataType, options: FoldOptions = FoldOptions()) -> Column:
    """Byte estimate of a converted document (P16): 16, plus for every value twice its name's length and its size.

    The name counts once per list element. Absent fields add nothing.
    """
    total = F.lit(16 + 2 * len("id")).cast("long") + value_bytes(doc_id, id_type)
    if options.mapping_version:
        total = total + F.lit(2 * len(MAPPING_VERSION) + 2 * len(options.mapping_version))
    for x in found:
        if x.dynamic:
            per_field = F.transform(F.map_entries(x.value), lambda e: F.aggregate(
                e["value"], F.lit(0).cast("long"),
                lambda acc, v: acc + utf16_bytes(e["key"]) + value_bytes(v, x.type)))
            cost = F.aggregate(per_field, F.lit(0).cast("long"), lambda acc, n: acc + n)
        elif x.multi:
            name = len(x.name.encode("utf-16-be"))
            cost = F.aggregate(x.value, F.lit(0).cast("long"), lambda acc, v: acc + F.lit(name) + value_bytes(v, x.type))
        else:
            name = len(x.name.encode("utf-16-be"))
            cost = F.when(x.value.isNotNull(), F.lit(name) + value_bytes(x.value, x.type))
        total = total + F.coalesce(cost, F.lit(0).cast("long"))
    return total


def stored_document_bytes(df: DataFrame) -> Column:
    """Whole-document variant of the estimate: a list field counts its name once."""
    total = F.lit(16).cast("long")
    for f in df.schema.fields:
        col, name = F.col(f"`{f.name}`"), len(f.name.encode("utf-16-be"))
        if isinstance(f.dataType, T.ArrayType):
            element = f.dataType.elementType
            each = (lambda acc, v: acc + utf16_bytes(v)) if isinstance(element, T.StringType) \
                else (lambda acc, v: acc + F.lit(16))
            cost = F.lit(name) + F.aggregate(col, F.lit(0).cast("long"), each)
        else:
            cost = F.when(col.isNotNull(), F.lit(name) + value_bytes(col, f.dataType))
        total = total + F.coalesce(cost, F.lit(0).cast("long"))
    return total
