"""Change log -> ops -> documents: the operators put together under one set of options."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docfold.operators import triage
from docfold.operators.flatten import effective, fields_map, leaves
from docfold.operators.identity import (
    DELETED, delete_id, document_id, reserved_names, route, source_json, stamps)
from docfold.operators.variant import is_object, variant_fields
from docfold.options import FoldOptions
from docfold.sources.changes import decode_json


@dataclass(frozen=True)
class Converted:
    """`ops`: collection, id, op, topic, partition, offset, timestamp, version, fields. `dead`: the original record and `reason`."""

    ops: DataFrame
    dead: DataFrame


def convert(changes: DataFrame, options: FoldOptions = FoldOptions(), catalog: dict[str, dict[str, str]] | None = None) -> Converted:
    """Route, identify, flatten and stamp every record; no shuffle.

    `catalog` (collection -> field -> type) holds declared fields: a record with a value that cannot be read as its
    field's type is malformed, its neighbours are not, and whole numbers are written in one spelling.

    The value may be JSON text, VARIANT, or a struct (a declared schema: every field is then carried).
    Under `offset_version_field` a delete is a tombstone document, otherwise it is a delete op.

    Reading both `ops` and `dead` converts the records twice; `classify` is for that.
    """
    rows, record_columns, fields = _identified(changes, options)
    good, dead = triage.split_malformed(rows, options.behavior_on_malformed_documents)
    good = _flattened(good, fields, options)
    if catalog:
        marked = good.withColumn("reason", triage.misfit_in(F.col("collection"), F.col("fields"), catalog))
        good, misfits = triage.split_malformed(marked, options.behavior_on_malformed_documents)
        dead = dead.select(*record_columns, "reason").unionByName(misfits.select(*record_columns, "reason"))
        good = good.withColumn("fields", triage.canonical(F.col("fields"), F.col("collection"), catalog))
    op, version, body = _written(changes.schema, options)
    ops = good.select(
        "collection", "id", op.alias("op"), "topic", "partition", "offset", _timestamp(changes.columns).alias("timestamp"),
        version.alias("version"), body.alias("fields"))
    return Converted(ops, dead.select(*record_columns, "reason"))


def classify(changes: DataFrame, options: FoldOptions = FoldOptions(), catalog: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """`convert` as one frame, to be persisted where ops and dead letters are both read: every record with its columns,
    `collection`, `id`, `reason` (NULL: it is an op), and what it writes as `_op`, `_version`, `_fields`."""
    strict = options.behavior_on_malformed_documents == "fail"
    rows, record_columns, fields = _identified(changes, options)
    if strict:
        rows = triage.split_malformed(rows, "fail")[0].withColumn("reason", F.lit(None).cast("string"))
    rows = _flattened(rows, fields, options, F.col("reason").isNotNull())
    if catalog:
        rows = rows.withColumn("reason", F.coalesce("reason", triage.misfit_in(F.col("collection"), F.col("fields"), catalog)))
        if strict:
            rows = triage.split_malformed(rows, "fail")[0].withColumn("reason", F.lit(None).cast("string"))
        rows = rows.withColumn("fields", triage.canonical(F.col("fields"), F.col("collection"), catalog))
    op, version, body = _written(changes.schema, options)
    return rows.select(*record_columns, "collection", "id", "reason", op.alias("_op"), version.alias("_version"), body.alias("_fields"))


def split(classified: DataFrame, record_columns: Sequence[str]) -> Converted:
    """What `convert` gives, from the records of `classify`."""
    ops = classified.where(F.col("reason").isNull()).select(
        "collection", "id", F.col("_op").alias("op"), "topic", "partition", "offset", _timestamp(record_columns).alias("timestamp"),
        F.col("_version").alias("version"), F.col("_fields").alias("fields"))
    return Converted(ops, classified.where(F.col("reason").isNotNull()).select(*record_columns, "reason"))


def writes_whole(options: FoldOptions) -> bool:
    """Whether every op under these options is a replace or a delete."""
    return bool(options.offset_version_field) or not options.partial


def _identified(changes: DataFrame, options: FoldOptions) -> tuple[DataFrame, list[str], Column]:
    """The records that are not skipped with `collection`, `id` and `reason`, their own columns, and what flattens them."""
    rows = triage.tombstones(changes, options.behavior_on_null_values)
    record_columns = rows.columns
    dtype = rows.schema["value"].dataType
    reserved = reserved_names(options)
    if isinstance(dtype, T.StringType):
        rows = rows.withColumn("_value", decode_json(F.col("value")))
        dtype = T.VariantType()
    else:
        rows = rows.withColumn("_value", F.col("value"))
    if isinstance(dtype, T.VariantType):
        fields = variant_fields(F.col("_value"), options.compact_map_entries, reserved, options.partial)
        is_document = is_object(F.col("_value"))
    elif isinstance(dtype, T.StructType):
        found = leaves(dtype, F.col("_value"), options.compact_map_entries, reserved, options.partial)
        fields = F.when(F.col("_value").isNotNull(), fields_map(found, options.partial))
        is_document = F.col("_value").isNotNull()
    else:
        fields = F.lit(None).cast("map<string,array<string>>")
        is_document = F.lit(False)

    schema = rows.schema
    gone = F.col("value").isNull()
    rows = rows.select(
        "*", route(F.col("topic"), options).alias("collection"),
        F.when(gone, delete_id(schema)).otherwise(document_id(schema, options, "_value")).alias("id"))
    # A delete without a key cannot name its document; it is skipped, not malformed.
    rows = rows.where(~(gone & F.col("id").isNull()))
    source_ok = None
    if options.source_field:
        rows = rows.withColumn("_source", source_json(F.col("_value"), dtype, options.source_exclude_fields))
        source_ok = F.col("_source").isNotNull()
    reason = triage.malformed_reason(F.col("id"), is_document, source_ok)
    rows = rows.withColumn("reason", F.when(~gone, reason))
    return rows, record_columns, fields


def _flattened(rows: DataFrame, fields: Column, options: FoldOptions, kept: Column | None = None) -> DataFrame:
    """`rows` with `fields`, without those that write nothing unless they are `kept`."""
    # Flatten once: a filter on the result would be pushed down and flatten again, a generator is not.
    stamped_only = bool(options.mapping_version)
    kept = F.lit(False) if kept is None else kept
    wanted = F.filter(F.array(fields), lambda f: f.isNull() | kept | effective(f, options.partial, stamped_only))
    return rows.withColumn("fields", F.explode(wanted))


def _written(schema: T.StructType, options: FoldOptions) -> tuple[Column, Column, Column]:
    """Op, version and stamped fields of a flattened record."""
    gone = F.col("value").isNull()
    extra = [(name, col) for name, col in stamps(schema, options).items() if name != "_version_"]
    if options.source_field:
        extra.append((options.source_field, F.col("_source")))
    stamped = F.col("fields")
    if extra:
        stamped = F.map_concat(stamped, F.map_filter(
            F.create_map(*[x for n, c in extra for x in (F.lit(n), F.array(c.cast("string")))]),
            lambda k, v: F.get(v, 0).isNotNull()))
    version = stamps(schema, options).get("_version_", F.lit(None).cast("bigint"))
    if options.offset_version_field:
        marker = F.create_map(F.lit(options.offset_version_field), F.array(F.col("offset").cast("string")),
                              F.lit(DELETED), F.array(F.lit("true")))
        return F.lit("replace"), version, F.when(gone, marker).otherwise(stamped)
    write = "replace" if not options.partial else "update"
    return F.when(gone, F.lit("delete")).otherwise(F.lit(write)), version, F.when(~gone, stamped)


def _timestamp(columns: Sequence[str]) -> Column:
    return F.col("timestamp") if "timestamp" in columns else F.lit(None).cast("timestamp")


def dry_run_report(ops: DataFrame) -> DataFrame:
    """What a write would do, per collection, without doing it."""
    size = F.sum("bytes") if "bytes" in ops.columns else F.lit(None).cast("bigint")
    return ops.groupBy("collection").agg(
        F.count_if(F.col("op") != "delete").alias("would_write"), F.count_if(F.col("op") == "delete").alias("would_delete"),
        size.alias("bytes"))
