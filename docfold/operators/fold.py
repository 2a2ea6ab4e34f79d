"""Applying changes (A1-A13): a fold of the change log per (collection, id).

An op frame has `collection`, `id`, `op`, an order column and the document. `op` is

* ``replace`` - the record becomes the whole document (INDEX);
* ``update``  - the record sets the fields it carries, a carried NULL clears (UPSERT, ATOMIC_UPDATE);
* ``delete``  - the document goes away.

The order column (`offset` by default) orders the ops of ONE id. A log offset does so inside one topic
partition; a collection fed by several needs a struct such as (timestamp, topic, partition, offset).

Every fold is an aggregation with map-side combine (`max_by`, `max`), so however many ops one id has,
at most one row per id, or per id and field, leaves each map task. Replaying records changes nothing,
because the same record wins again: redelivery (A12) needs no de-duplication.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docfold.operators.identity import DELETED
from docfold.operators.skew import skew_join

KEYS = ("collection", "id")


def _keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [k for k in keys if k in df.columns]


# --- whole documents ---------------------------------------------------------------------------

def latest(ops: DataFrame, keys: Sequence[str] = KEYS, order: str | Column = "offset") -> DataFrame:
    """The last op of every id, whole; one shuffle."""
    keys = list(keys)
    rest = [F.col(f"`{c}`") for c in ops.columns if c not in keys]
    order = F.col(order) if isinstance(order, str) else order
    winner = ops.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_w"))
    return winner.select(*keys, "_w.*")


def apply_index(ops: DataFrame, keys: Sequence[str] = KEYS, order: str | Column = "offset") -> DataFrame:
    """A1, A2, A4: the last record per id wins whole, an id whose last op is a delete is gone."""
    return latest(ops, keys, order).where(F.col("op") != "delete").drop("op")


def by_version(ops: DataFrame, version: str, arrival: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """State under the version guard. A write whose version is not above the stored one is ignored, so the
    highest version stays, and of equal versions the first to arrive. Deletes are ops like others here."""
    rank = F.struct(F.col(version), (-F.col(arrival)).alias("_early"))
    return latest(ops, keys, rank)


def soft_deletes(ops: DataFrame, version: str, arrival: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """As `by_version`, a delete being a `{id, version, _deleted: true}` document, so that an older write
    arriving after it cannot bring the document back."""
    state = by_version(ops, version, arrival, keys)
    gone = F.col("op") == "delete"
    kept = {*keys, version}
    return state.select(*[
        F.col(f"`{c}`") if c in kept else F.when(~gone, F.col(f"`{c}`")).alias(c)
        for c in state.columns if c not in ("op", arrival)
    ], F.when(gone, F.lit(True)).alias(DELETED))


def live(docs: DataFrame) -> DataFrame:
    """A10: what readers see; documents without the marker are live. The marker is a column or an entry of `fields`."""
    return docs.where(~_marked(docs))


def _marked(docs: DataFrame) -> Column:
    if DELETED in docs.columns:
        return F.coalesce(F.col(DELETED), F.lit(False))
    return F.coalesce(F.get(F.col("fields")[DELETED], F.lit(0)) == "true", F.lit(False))


def typed(docs: DataFrame, types: dict[str, str]) -> DataFrame:
    """Keys and one column per field of `types` (name -> Spark type) from a `fields` map. An array type keeps all values,
    another the first one; a value that does not fit the type is NULL."""
    def column(name: str, kind: str) -> Column:
        values = F.col("fields")[name]
        if kind.startswith("array<"):
            return F.transform(values, lambda v: v.try_cast(kind[6:-1])).alias(name)
        return F.get(values, F.lit(0)).try_cast(kind).alias(name)

    return docs.select(*_keys(docs, KEYS), *[column(n, t) for n, t in types.items()])


def purge_deleted(docs: DataFrame, version: str, below: int) -> DataFrame:
    """A10: drop tombstone documents whose version is under `below` (no older write can still arrive)."""
    stored = F.col(version) if version in docs.columns else F.get(F.col("fields")[version], F.lit(0)).try_cast("bigint")
    return docs.where(~(_marked(docs) & F.coalesce(stored < below, F.lit(False))))


def delete_all(docs: DataFrame, collection: str | None = None) -> DataFrame:
    """The same table without documents, or without those of one collection."""
    return docs.limit(0) if collection is None else docs.where(F.col("collection") != collection)


# --- field by field ----------------------------------------------------------------------------
#
# A delta says what a set of ops does to an id: `base` is the last op that dropped everything before it
# (delete or replace), `written` the last op that left a document, `fields` the last value of every
# field with the order value that set it. A field counts if it was set at or after `base`; the document
# exists if it was written at or after `base`. Deltas merge by taking maxima, so they can be built per
# micro-batch and combined in any grouping.

def _fold_entries(entries: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, name, at, value, base, written) rows -> one delta per id. NULL names carry base and written."""
    per_field = entries.groupBy(*keys, "name").agg(
        F.max_by("value", "at").alias("value"), F.max("at").alias("at"),
        F.max("base").alias("base"), F.max("written").alias("written"))
    item = F.struct(F.col("name").alias("key"), F.struct("at", "value").alias("value"))
    return per_field.groupBy(*keys).agg(
        F.max("base").alias("base"), F.max("written").alias("written"),
        F.map_from_entries(F.collect_list(F.when(F.col("name").isNotNull(), item))).alias("fields"))


def _explode(df: DataFrame, keys: list[str], fields: Column, value_type: T.DataType, base: Column, written: Column) -> DataFrame:
    """`fields`: array<struct<name, at, value>>, NULL for none. One row per field and one for the id itself."""
    at_type = df.select(base.alias("b")).schema["b"].dataType
    none = F.lit(None)
    own = F.struct(none.cast("string").alias("name"), none.cast(at_type).alias("at"), none.cast(value_type).alias("value"),
                   base.alias("base"), written.alias("written"))
    named = F.transform(fields, lambda f: F.struct(
        f["name"].alias("name"), f["at"].alias("at"), f["value"].alias("value"),
        none.cast(at_type).alias("base"), none.cast(at_type).alias("written")))
    rows = F.when(fields.isNull(), F.array(own)).otherwise(F.concat(F.array(own), named))
    return df.select(*keys, F.explode(rows).alias("_f")).select(*keys, "_f.*")


def delta(ops: DataFrame, keys: Sequence[str] = KEYS, order: str = "offset", fields: str = "fields", whole: bool = False) -> DataFrame:
    """Ops with a `fields` map (name -> value, a NULL value clears) -> one delta per id.

    An update that carries no field writes nothing (F14). `whole`: there are no updates, so the last replace of an id has
    all of its fields, which one row per op and one shuffle find.
    """
    keys = _keys(ops, keys)
    at, op = F.col(order), F.col("op")
    if whole:
        wrote = F.when(op == "replace", at)
        last = ops.groupBy(*keys).agg(F.max(at).alias("base"), F.max(wrote).alias("written"), F.max_by(fields, wrote).alias("_last"))
        stands = F.map_filter("_last", lambda k, v: F.col("written") >= F.col("base"))
        marked = F.transform_values(stands, lambda k, v: F.struct(F.col("written").alias("at"), v.alias("value")))
        none = F.map_from_arrays(F.array(), F.array()).cast(last.select(marked.alias("m")).schema["m"].dataType)
        return last.select(*keys, "base", "written", F.coalesce(marked, none).alias("fields"))
    carried = F.transform(F.map_entries(F.when(op != "delete", F.col(fields))), lambda e: F.struct(
        e["key"].alias("name"), at.alias("at"), e["value"].alias("value")))
    value_type = ops.schema[fields].dataType.valueType
    # No filter on `fields`: it would be pushed below, and the record would be flattened once more for it.
    writes = (op == "replace") | ((op == "update") & (F.size(fields) > 0))
    return _fold_entries(_explode(
        ops, keys, carried, value_type, F.when(op != "update", at), F.when(writes, at)), keys)


def merge_deltas(deltas: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Several deltas per id -> one; fields a later delete or replace made void are dropped on the way."""
    keys = _keys(deltas, keys)
    kept = F.filter(F.map_entries("fields"), lambda e: F.col("base").isNull() | (e["value"]["at"] >= F.col("base")))
    named = F.transform(kept, lambda e: F.struct(
        e["key"].alias("name"), e["value"]["at"].alias("at"), e["value"]["value"].alias("value")))
    value_type = deltas.schema["fields"].dataType.valueType["value"].dataType
    return _fold_entries(_explode(deltas, keys, named, value_type, F.col("base"), F.col("written")), keys)


def documents(deltas: DataFrame, keys: Sequence[str] = KEYS, keep: Sequence[str] = ()) -> DataFrame:
    """Deltas (one per id) -> existing documents: keys, `fields` map without cleared fields, and the columns to `keep`.

    An id whose last field was cleared stays as a document with no field.
    """
    # An id that only had no-op updates has neither mark.
    exists = F.col("written").isNotNull() & (F.col("base").isNull() | (F.col("written") >= F.col("base")))
    alive = F.map_filter("fields", lambda k, v: v["value"].isNotNull() & (
        F.col("base").isNull() | (v["at"] >= F.col("base"))))
    return deltas.where(exists).select(*_keys(deltas, keys), F.transform_values(alive, lambda k, v: v["value"]).alias("fields"), *keep)


def apply_fields(ops: DataFrame, keys: Sequence[str] = KEYS, order: str = "offset") -> DataFrame:
    """A5, A6 (and A1, A2 when mixed): documents after the ops, as keys and a `fields` map."""
    return documents(delta(ops, keys, order), keys)


def apply_columns(ops: DataFrame, fields: Sequence[str], keys: Sequence[str] = KEYS, order: str = "offset",
                  carried: dict[str, Column] | None = None) -> DataFrame:
    """`apply_fields` for a known, not too wide field list: typed columns, ONE shuffle.

    `carried[f]` tells whether an op says something about field `f` (default: always, as a declared
    schema does; a carried NULL clears). Replace ops carry every field.
    """
    keys = _keys(ops, keys)
    at, op = F.col(order), F.col("op")
    carried = carried or {}
    aggs = []
    for i, f in enumerate(fields):
        says = (op != "delete") & ((op == "replace") | carried.get(f, F.lit(True)))
        when = F.when(says, at)
        # A NULL order value never wins, so ops that do not carry the field are passed over.
        aggs += [F.max_by(F.struct(F.col(f"`{f}`").alias("v"), at.alias("at")), when).alias(f"_f{i}")]
    out = ops.groupBy(*keys).agg(
        F.max(F.when(op != "update", at)).alias("_base"), F.max(F.when(op != "delete", at)).alias("_written"), *aggs)
    base = F.col("_base")
    return out.where(F.col("_written").isNotNull() & (base.isNull() | (F.col("_written") >= base))).select(
        *keys, *[F.when(base.isNull() | (F.col(f"_f{i}.at") >= base), F.col(f"_f{i}.v")).alias(f)
                 for i, f in enumerate(fields)])


# --- existing documents only -------------------------------------------------------------------

def apply_atomic(target: DataFrame, ops: DataFrame, keys: Sequence[str] = KEYS, order: str = "offset") -> DataFrame:
    """Updates of documents that exist in `target` (keys and a `fields` map); nothing is ever created.

    A deleted document cannot come back inside the batch, so it is gone whatever follows the delete.
    Both join sides have one row per id.
    """
    keys = _keys(ops, keys)
    change = delta(ops, keys, order).select(
        *keys, F.col("base").alias("_gone"), F.col("fields").alias("_set"))
    joined = target.join(change, keys, "left").where(F.col("_gone").isNull())
    sets = F.coalesce(F.transform_values("_set", lambda k, v: v["value"]),
                      F.map_filter("fields", lambda k, v: F.lit(False)))
    kept = F.map_filter("fields", lambda k, v: ~F.map_contains_key(sets, k))
    merged = F.map_concat(kept, F.map_filter(sets, lambda k, v: v.isNotNull()))
    return joined.select(*keys, merged.alias("fields"))


def atomic_split(target: DataFrame, ops: DataFrame, keys: Sequence[str] = KEYS, order: str = "offset") -> DataFrame:
    """Every delete and every update that sets something, with `refused` true for an update whose document
    is missing or was deleted earlier in the batch. One id may have any number of ops, hence the salted join."""
    keys = _keys(ops, keys)
    ends = ops.where(F.col("op") == "delete").groupBy(*keys).agg(F.min(order).alias("_end"))
    known = target.select(*keys).join(ends, keys, "left").withColumn("_known", F.lit(True))
    effective = ops.where((F.col("op") == "delete") | (F.size("fields") > 0))
    joined = skew_join(effective, known, keys, "left", spread=[*keys, order])
    refused = (F.col("op") == "update") & (F.col("_known").isNull() | F.coalesce(F.col(order) > F.col("_end"), F.lit(False)))
    return joined.withColumn("refused", refused).drop("_known", "_end")


def atomic_rejects(target: DataFrame, ops: DataFrame, keys: Sequence[str] = KEYS, order: str = "offset") -> DataFrame:
    """The refused updates, with the response code of a version conflict."""
    return atomic_split(target, ops, keys, order).where("refused").drop("refused").withColumn("code", F.lit(409))


def optimistic_batch(target: DataFrame, ops: DataFrame, keys: Sequence[str] = KEYS, version: str = "version") -> DataFrame:
    """A11 for a batch with one write per id: every op with `outcome` applied or conflict.

    The op's `version` is what the writer believes is stored: above 1 it must equal `target.version`, 1 means
    the document must exist, a negative number that it must not, 0 or NULL checks nothing.
    """
    keys = _keys(ops, keys)
    stored = target.select(*keys, F.col(version).alias("_stored"), F.lit(True).alias("_exists"))
    joined = ops.join(stored, keys, "left")
    asked, exists = F.col(version), F.coalesce(F.col("_exists"), F.lit(False))
    ok = (F.when(asked.isNull() | (asked == 0), F.lit(True))
          .when(asked < 0, ~exists).when(asked == 1, exists)
          .otherwise(exists & F.coalesce(asked == F.col("_stored"), F.lit(False))))
    return joined.withColumn("outcome", F.when(ok, F.lit("applied")).otherwise(F.lit("conflict"))).drop("_stored", "_exists")


def version_guard_trace(ops: DataFrame, version: str, arrival: str, keys: Sequence[str] = KEYS, **blocks) -> DataFrame:
    """A8, write by write in arrival order: `applied` is false where the guard ignored the write."""
    from docfold.operators.blocks import running_max

    seen = running_max(ops, _keys(ops, keys), arrival, version, "_seen", **blocks)
    return seen.withColumn("applied", F.col("_seen").isNull() | (F.col(version) > F.col("_seen"))).drop("_seen")
