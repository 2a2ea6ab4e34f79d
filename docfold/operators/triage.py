"""Malformed data and failure triage (E1-E4, T6) and tombstone policy (A3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Responses about the documents themselves (bad value, version conflict, too large).
DOCUMENT_REJECTIONS = (400, 409, 413)
BUSY = 429
SERVER_ERROR = 500

MISSING_ID = "missing id"
UNSUPPORTED_VALUE = "unsupported value type"
UNSERIALISABLE_SOURCE = "unserialisable source"


def fail_where(df: DataFrame, condition: Column, message: Column) -> DataFrame:
    """The same rows; evaluating one that meets `condition` fails the job with `message`."""
    return df.where(F.when(condition, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def tombstones(changes: DataFrame, behavior: str) -> DataFrame:
    """A3: drop (`ignore`), keep (`delete`) or refuse (`fail`) records without a value."""
    if behavior == "ignore":
        return changes.where(F.col("value").isNotNull())
    if behavior == "delete":
        return changes
    where = F.concat(F.lit("tombstone record: "), F.concat_ws("-", "topic", F.col("partition").cast("string")),
                     F.lit("@"), F.col("offset").cast("string"))
    return fail_where(changes, F.col("value").isNull(), where)


def malformed_reason(doc_id: Column, is_document: Column, source_ok: Column | None = None) -> Column:
    """Why a value record cannot become a document; NULL when it can."""
    reason = F.when(doc_id.isNull(), F.lit(MISSING_ID)).when(~F.coalesce(is_document, F.lit(False)), F.lit(UNSUPPORTED_VALUE))
    if source_ok is not None:
        reason = reason.when(~F.coalesce(source_ok, F.lit(False)), F.lit(UNSERIALISABLE_SOURCE))
    return reason


def split_malformed(df: DataFrame, behavior: str) -> tuple[DataFrame, DataFrame]:
    """(good, dead) by the `reason` column. `fail` makes the job fail on the first malformed row.

    `ignore` and `warn` both keep going; the dead rows say what was dropped and why.
    """
    bad = F.col("reason").isNotNull()
    if behavior == "fail":
        checked = fail_where(df, bad, F.concat(F.lit("malformed record: "), F.col("reason")))
        return checked.drop("reason"), df.limit(0)
    return df.where(~bad).drop("reason"), df.where(bad)


def conformance_reason(df: DataFrame, declared: dict[str, T.DataType | str]) -> Column:
    """Name of the first field whose value does not fit its declared type; NULL when all fit."""
    checks = []
    for name, dtype in declared.items():
        col = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, T.ArrayType):
            bad = F.exists(col, lambda x: x.isNotNull() & x.try_cast(dtype).isNull())
        else:
            bad = col.isNotNull() & col.try_cast(dtype).isNull()
        checks.append(F.when(bad, F.lit(name)))
    return F.coalesce(*checks, F.lit(None).cast("string"))


# Types of target fields that text may fail to be read as, and Spark's types for them.
READ_AS = {"pint": "int", "plong": "bigint", "pfloat": "float", "pdouble": "double", "boolean": "boolean", "pdate": "timestamp"}


def misfit(fields: Column, declared: dict[str, str]) -> Column:
    """What is wrong with a `fields` map (name -> list of text) under declared field types (name -> type of `READ_AS`,
    others take any text): `field <name> is no <type>` for the first field with a value that cannot be read so, NULL when
    all can. Fields that are not declared take any text, absent and null values fit."""
    checked = {n: t for n, t in declared.items() if t in READ_AS}
    if not checked:
        return F.lit(None).cast("string")
    types = F.create_map(*[F.lit(x) for pair in sorted(checked.items()) for x in pair])

    def unread(kind: Column, v: Column) -> Column:
        fails = F.lit(False)
        for name in sorted(set(checked.values())):
            fails = fails | ((kind == name) & v.try_cast(READ_AS[name]).isNull())
        return v.isNotNull() & fails

    def wrong(e: Column) -> Column:
        return F.exists(e["value"], lambda v: unread(F.try_element_at(types, e["key"]), v))

    bad = F.filter(F.map_entries(fields), lambda e: F.map_contains_key(types, e["key"]) & F.coalesce(wrong(e), F.lit(False)))
    return F.get(F.transform(bad, lambda e: F.concat(F.lit("field "), e["key"], F.lit(" is no "), F.try_element_at(types, e["key"]))), F.lit(0))


def misfit_in(collection: Column, fields: Column, catalog: dict[str, dict[str, str]]) -> Column:
    """`misfit` under the declared types of each collection; one that is not in the catalog takes anything."""
    reason = None
    for name, declared in sorted(catalog.items()):
        step = misfit(fields, declared)
        reason = F.when(collection == name, step) if reason is None else reason.when(collection == name, step)
    return F.lit(None).cast("string") if reason is None else reason


def canonical(fields: Column, collection: Column, catalog: dict[str, dict[str, str]]) -> Column:
    """`fields` that fit, whole numbers among them in one spelling (` 07` is `7`), so that equal numbers are equal text."""
    out = fields
    for name, declared in sorted(catalog.items()):
        whole = sorted(n for n, t in declared.items() if t in ("pint", "plong"))
        if whole:
            plain = F.transform_values(fields, lambda k, v: F.when(k.isin(whole), F.transform(
                v, lambda x: x.try_cast("bigint").cast("string"))).otherwise(v))
            out = F.when(collection == name, plain).otherwise(out)
    return out


def conform(df: DataFrame, declared: dict[str, T.DataType | str]) -> tuple[DataFrame, DataFrame]:
    """Documents that fit, cast to the declared types, and the rejected ones with `field`.

    One bad document never takes its neighbours with it, and no batch is sent again to find it.
    """
    marked = df.withColumn("field", conformance_reason(df, declared))

    def cast(name: str) -> Column:
        if name not in declared:
            return F.col(f"`{name}`")
        dtype = declared[name]
        if isinstance(df.schema[name].dataType, T.ArrayType):
            return F.transform(F.col(f"`{name}`"), lambda x: x.try_cast(dtype)).alias(name)
        return F.col(f"`{name}`").try_cast(dtype).alias(name)

    good = marked.where(F.col("field").isNull()).select(*[cast(c) for c in df.columns])
    return good, marked.where(F.col("field").isNotNull())


def response_class(code: Column, remote: Column, missing_collection: Column, transport: Column) -> Column:
    """What a logged response means: `rejected` (about the document), `retriable` or `fatal`.

    `remote`: the server answered; otherwise the client raised it, and a client error for a missing collection
    is not about a document. A transport failure is retriable whatever code it came with, unless the server
    answered with a final one.
    """
    not_about_documents = ~remote & (missing_collection | transport)
    rejected = code.isin(list(DOCUMENT_REJECTIONS)) & ~not_about_documents
    retriable = (code == BUSY) | (code >= SERVER_ERROR) | (~remote & transport)
    return F.when(F.coalesce(rejected, F.lit(False)), F.lit("rejected")) \
        .when(F.coalesce(retriable, F.lit(False)) | (code.isNull() & transport), F.lit("retriable")) \
        .otherwise(F.lit("fatal"))
