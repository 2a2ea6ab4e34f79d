"""A typed, clustered copy of one collection, which searches read instead of folding the table.

    <root>/search/<name>/<k>.json                 copy k: its folder, the base and the batches it was made of
    <root>/search/<name>/data/<folder>/           documents with a column per declared field, in range order of one of them
    <root>/search/<name>/ranges/<folder>/         smallest and largest value of that field in every file

Files are cut by (field, id), so a value that very many documents share spreads over several files. A range search takes
the files whose range it meets, and inside them Parquet skips by its own statistics and by a Bloom filter of the ids.

A search is never behind the table: documents that batches after the copy touched are folded from the table, by their ids,
and replace those of the copy. A copy of an older base is left unread; `start` makes a new one with every base. Copies are
committed as bases are: an entry is created once, a writer that comes second starts again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F, types as T

from docfold.operators import fold, search
from docfold.streaming import commits
from docfold.streaming.table import DocumentTable

# The Spark type of each declared field type.
SPARK_TYPES = {"pint": "int", "plong": "bigint", "pfloat": "float", "pdouble": "double", "boolean": "boolean", "pdate": "timestamp", "string": "string"}


def column_types(declared: dict[str, list]) -> dict[str, str]:
    """Field -> Spark type of a collection's catalog entry; fields declared by pattern have no column."""
    out = {}
    for name, (kind, multi, dynamic) in declared.items():
        if not dynamic:
            out[name] = f"array<{SPARK_TYPES[kind]}>" if multi else SPARK_TYPES[kind]
    return out


class SearchLayout:
    """`by`: the field in whose order the documents lie. `types`: field -> Spark type (default: the declared fields)."""

    def __init__(self, table: DocumentTable, collection: str, by: str, types: dict[str, str] | None = None, file_bytes: int = 128 << 20):
        self._table, self.collection, self.by, self._file_bytes = table, collection, by, file_bytes
        self.types = dict(types) if types is not None else column_types(table.catalog().get(collection, {}))
        if by not in self.types or self.types[by].startswith("array<"):
            raise ValueError(f"{by!r} is no single-valued field of collection {collection!r}")
        self._spark = table.spark
        self._files = commits.Files(self._spark)
        self._root = f"{table.root}/search/{collection}.{by}"
        self._log = commits.CommitLog(self._files, self._root)

    def _schema(self) -> T.StructType:
        return T.StructType([T.StructField("id", T.StringType())] + [
            T.StructField(n, T.DataType.fromDDL(t)) for n, t in self.types.items()])

    def _typed(self, docs: DataFrame) -> DataFrame:
        return fold.typed(docs, self.types).drop("collection")

    def refresh(self) -> int:
        """Write the collection as it is now as the next copy, and return its number. The fold runs twice, first for a sample
        of the order. The copy before stays for searches that run; older ones go."""
        while True:
            number, before = self._log.newest()
            base, holds, docs, size = self._table.snapshot(self.collection)
            folder = uuid.uuid4().hex
            files = max(1, -(-size // self._file_bytes))
            (self._typed(docs).repartitionByRange(files, self.by, "id").sortWithinPartitions(self.by, "id")
             .write.option("parquet.bloom.filter.enabled#id", "true").parquet(f"{self._root}/data/{folder}"))
            key = F.col(f"`{self.by}`")
            (self._spark.read.schema(self._schema()).parquet(f"{self._root}/data/{folder}").groupBy(F.col("_metadata.file_name").alias("file"))
             .agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("documents"))
             .coalesce(1).write.parquet(f"{self._root}/ranges/{folder}"))      # one row per file
            entry = {"folder": folder, "base": base, "holds": holds, "types": self.types}
            if self._log.create(number + 1, entry):
                break
            self._drop(folder)      # another copy came first; make the next one
        kept = {folder, before.get("folder")}
        for n in self._log.numbers():
            if n < number and (old := self._log.read(n)["folder"]) not in kept:
                self._drop(old)
                self._log.remove(n)
        return number + 1

    def _drop(self, folder: str) -> None:
        for kind in ("data", "ranges"):
            self._files.delete(f"{self._root}/{kind}/{folder}")

    def files(self, low=None, high=None) -> list[str]:
        """Files of the newest copy that may hold a document whose field is in the range (all without one)."""
        return self._files_of(self._log.newest()[1], low, high)

    def _files_of(self, entry: dict, low, high) -> list[str]:
        if not entry:
            return []
        rows = self._spark.read.schema(f"file string, low {self.types[self.by]}, high {self.types[self.by]}, documents bigint").parquet(
            f"{self._root}/ranges/{entry['folder']}")
        if low is not None:
            rows = rows.where(F.col("high") >= F.lit(low))
        if high is not None:
            rows = rows.where(F.col("low") <= F.lit(high))
        return sorted(f"{self._root}/data/{entry['folder']}/{r.file}" for r in rows.select("file").collect())

    def read(self, low=None, high=None) -> DataFrame:
        """id and the typed fields of the current documents; with a bound, of those whose `by` is in [low, high]."""
        ranged = low is not None or high is not None
        entry = self._log.newest()[1]
        if entry and entry["base"] == self._table.base and entry["types"] == self.types:
            paths = self._files_of(entry, low, high)
            stored = self._spark.read.schema(self._schema()).parquet(*paths) if paths else self._spark.createDataFrame([], self._schema())
            touched = self._table.touched(self.collection, entry["holds"])
            if touched is not None:
                fresh = self._typed(self._table.read_among(touched))
                stored = stored.join(touched.select("id"), "id", "left_anti").unionByName(fresh)
        else:
            stored = self._typed(self._table.read(self.collection))
        return stored.where(search.in_range(F.col(f"`{self.by}`"), low, high)) if ranged else stored
