"""Target schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docfold.functions.encode import is_temporal
from docfold.operators.flatten import leaves
from docfold.options import FoldOptions

CATALOG = "name string, type string, multi_valued boolean, dynamic boolean"

# The longest indexed string, in characters, and the fields that are never cut.
MAX_STRING = 8000
UNCAPPED = ("id", "_src")


def field_type(dtype: T.DataType | None) -> str:
    """Target field type; unknown or null types are strings. The names are fixed values."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return "pint"
    if isinstance(dtype, T.LongType):
        return "plong"
    if isinstance(dtype, T.FloatType):
        return "pfloat"
    if isinstance(dtype, T.DoubleType):
        return "pdouble"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if dtype is not None and is_temporal(dtype):
        return "pdate"
    if isinstance(dtype, T.ArrayType):
        return field_type(dtype.elementType)
    return "string"


@dataclass(frozen=True)
class FieldSpec:
    name: str
    type: str
    multi_valued: bool
    dynamic: bool


def field_specs(schema: T.StructType, compact: bool = True, reserved: Iterable[str] = ()) -> list[FieldSpec]:
    """Every field documents of this schema write, first occurrence of a name wins."""
    out: dict[str, FieldSpec] = {}
    for x in leaves(schema, None, compact, reserved):
        out.setdefault(x.name, FieldSpec(x.name, field_type(x.source_type), x.multi, x.dynamic))
    return list(out.values())


def field_catalog(spark: SparkSession, schema: T.StructType, compact: bool = True) -> DataFrame:
    """The catalog as a table: its size is the number of schema leaves, never the number of documents."""
    rows = [(s.name, s.type, s.multi_valued, s.dynamic) for s in field_specs(schema, compact)]
    return spark.createDataFrame(rows, CATALOG)


def missing_fields(known: DataFrame, needed: DataFrame) -> DataFrame:
    """T4: needed fields the target does not have yet, by name. A known field is never retyped."""
    return needed.join(known.select("name"), "name", "left_anti")


def evolves(options: FoldOptions, topic: str | None = None) -> bool:
    """Whether the schema of a topic's records may add fields."""
    return options.schema_auto_evolve and not options.schema_ignore and topic not in options.topic_schema_ignore


def evolve(known: DataFrame, needed: DataFrame, options: FoldOptions, topic: str | None = None) -> DataFrame:
    """T4: the catalog after growth; unchanged unless evolution is on and the schema is not ignored."""
    return known.unionByName(missing_fields(known, needed)) if evolves(options, topic) else known


def declared_types(catalog: dict[str, dict[str, list]]) -> dict[str, dict[str, str]]:
    """collection -> field -> type of a catalog of [type, multi valued, dynamic] entries."""
    return {c: {n: f[0] for n, f in fields.items()} for c, fields in catalog.items()}


def widen(documents: DataFrame, incoming: DataFrame) -> DataFrame:
    """T4 on data: both sets of rows, columns of either, absent ones NULL. A column both have keeps the
    stored type: incoming values that do not fit it are the conformance check's business."""
    stored = dict(documents.dtypes)
    cast = [F.col(f"`{c}`").try_cast(stored[c]).alias(c) if c in stored and stored[c] != t else F.col(f"`{c}`")
            for c, t in incoming.dtypes]
    return documents.unionByName(incoming.select(*cast), allowMissingColumns=True)


class MissingCollection(Exception):
    pass


class Collections:
    """T5: may a collection be written to? Remembers its answer per collection.

    `place` is a folder with one directory per collection, or a table that knows its collections (`collections()`) and
    makes one (`declare(name)`).
    """

    def __init__(self, spark: SparkSession, place, options: FoldOptions):
        self._spark, self._options = spark, options
        self._table, self._root = (None, place.rstrip("/")) if isinstance(place, str) else (place, None)
        self._known: set[str] = set()

    def _folder(self, collection: str):
        path = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._root}/collection={collection}")
        return path.getFileSystem(self._spark._jsc.hadoopConfiguration()), path

    def exists(self, collection: str) -> bool:
        if self._table is not None:
            return collection in self._table.collections()
        fs, path = self._folder(collection)
        return fs.exists(path)

    def create(self, collection: str) -> None:
        if self._table is not None:
            self._table.declare(collection)
            return
        fs, path = self._folder(collection)
        fs.mkdirs(path)

    def ensure(self, collection: str) -> None:
        if not collection or collection in self._known:
            return
        usage = self._options.external_resource_usage
        if usage != "UNUSED" and not self.exists(collection):
            if usage == "REQUIRED":
                raise MissingCollection(f"no collection {collection!r} here, and external_resource_usage=REQUIRED makes none")
            if not self._options.schema_auto_create:
                raise MissingCollection(f"no collection {collection!r} here; with schema_auto_create one would be made")
            self.create(collection)
        self._known.add(collection)


def cap_strings(df: DataFrame, exclude: Sequence[str] = UNCAPPED, limit: int = MAX_STRING) -> DataFrame:
    """String fields cut to `limit` characters, list elements too; the id and the stored source stay whole."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if f.name not in exclude and isinstance(f.dataType, T.StringType):
            col = F.left(col, F.lit(limit)).alias(f.name)
        elif f.name not in exclude and isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            col = F.transform(col, lambda x: F.left(x, F.lit(limit))).alias(f.name)
        out.append(col)
    return df.select(*out)


def indexed_term(text: Column, limit: int = MAX_STRING) -> Column:
    """The lower-cased whole-value term of a text field; over `limit` characters there is none."""
    return F.when(F.length(text) <= limit, F.lower(text))


def copy_fields(df: DataFrame, sources: Sequence[str], target: str) -> DataFrame:
    """Several fields feed one list; a source may be a pattern (`*_value_1`). Absent values add nothing,
    and a document with none of the sources lacks the target."""
    parts = []
    for source in sources:
        for f in df.schema.fields:
            if f.name == target or not fnmatchcase(f.name, source.replace("[", "[[]")):
                continue
            col = F.col(f"`{f.name}`")
            if isinstance(f.dataType, T.ArrayType):
                parts.append(F.coalesce(col.cast("array<string>"), F.array().cast("array<string>")))
            else:
                parts.append(F.array(col.cast("string")))
    if not parts:
        return df.withColumn(target, F.lit(None).cast("array<string>"))
    joined = F.array_compact(F.concat(*parts))
    return df.withColumn(target, F.get(F.filter(F.array(joined), lambda a: F.size(a) > 0), F.lit(0)))


def copy_field(df: DataFrame, source: str, target: str, dtype: str = "string", max_chars: int | None = None) -> DataFrame:
    """One single-valued copy under another type (`id` -> numeric `id_sort`); text that does not fit is absent."""
    col = F.col(f"`{source}`")
    if max_chars is not None:
        col = F.left(col.cast("string"), F.lit(max_chars))
    return df.withColumn(target, col.try_cast(dtype))
