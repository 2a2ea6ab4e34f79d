"""A document table fed by micro-batches: appended deltas, merged when read.

Parquet has no merge, and rewriting a big table for every small batch does not scale. Each batch therefore
writes one delta per touched id (see `operators.fold`); a reader folds the newest base and the deltas that it
does not hold; `compact` turns them into the next base. A delta keeps order values, so batches can be replayed,
and older writes that arrive late lose, without looking at the table while writing.

    <root>/data/stream=<s>/batch=<n>/collection=<c>/...       one directory per micro-batch of a stream
    <root>/base/<folder>/collection=<c>/bucket=<b>/...        documents as of a base; bucket: hash of the id
    <root>/bases/<k>.json                                     base k: its folder, and the batches it holds
    <root>/catalog/<k>.json                                   the declared fields of every collection, version k
    <root>/dead/stream=<s>/batch=<n>/...                      records that could not be applied

The identity of a write is the pair (stream, batch): several streams, or a stream with a new checkpoint, never
replace or skip each other's batches. A directory counts once its `_SUCCESS` marker is there, a base once its
entry is there (see `commits`), so a half-written one is never read, and two compactions at once cannot hide
each other's batches: one creates the next entry, the other starts again on top of it. A finished batch that
comes again is left as it is.

Base files are dealt by id hash, sorted by id, and carry a Bloom filter of their ids, so a question about few ids
opens few files.

The order of the writes of one id is the struct (timestamp, topic, partition, offset) of their records, which
also orders several topics or partitions of one collection; with `order="offset"` it is the bare offset, for
collections fed by one partition whose timestamps may go back.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docfold.operators import fold
from docfold.operators.versions import version_of
from docfold.streaming import commits

BASE = "_base"
ORDERS = {"time": "struct<timestamp: timestamp, topic: string, partition: int, offset: bigint>", "offset": "bigint"}
MAX_BUCKETS = 4096
NAMED_IDS = 500      # so many ids are asked for by name, which lets files be skipped by their filters
DAY_MS = 86_400_000
ENTRIES = 100         # entries of bases that stay in the log


class DocumentTable:
    def __init__(self, spark: SparkSession, root: str, order: str = "time", bucket_bytes: int = 128 << 20):
        if order not in ORDERS:
            raise ValueError(f"order must be one of {', '.join(ORDERS)}, got {order!r}")
        self.spark = self._spark = spark
        self.root, self.order, self._bucket_bytes = root.rstrip("/"), order, bucket_bytes
        self._files = commits.Files(spark)
        self._bases = commits.CommitLog(self._files, f"{self.root}/bases")
        self._catalogs = commits.CommitLog(self._files, f"{self.root}/catalog")

    # --- batches -------------------------------------------------------------------------------

    def _complete(self, kind: str) -> dict[tuple[str, int], str]:
        """(stream, batch) -> path of the finished directories of a kind; one listing."""
        out = {}
        for status in self._files.matching(f"{self.root}/{kind}/stream=*/batch=*/_SUCCESS"):
            folder = status.getPath().getParent()
            batch, stream = folder.getName(), folder.getParent().getName()
            out[stream.removeprefix("stream="), int(batch.removeprefix("batch="))] = folder.toString()
        return out

    def _pending(self, entry: dict) -> dict[tuple[str, int], str]:
        """Deltas that a base does not hold."""
        held = entry.get("holds", {})
        return {k: p for k, p in self._complete("data").items() if not commits.holds(held, *k)}

    @property
    def held(self) -> set[tuple[str, int]]:
        """The (stream, batch) pairs in the newest base."""
        found = self._bases.newest()[1].get("holds", {})
        return {(s, n) for s, (mark, others) in found.items() for n in [*range(mark + 1), *others]}

    def written(self, batch: int, stream: str = "main") -> bool:
        """Whether this very batch is in the table, as a delta or in the newest base."""
        if self._files.exists(f"{self._delta(batch, stream)}/_SUCCESS"):
            return True
        return commits.holds(self._bases.newest()[1].get("holds", {}), stream, batch)

    def _delta(self, batch: int, stream: str) -> str:
        if stream == BASE or "/" in stream:
            raise ValueError(f"not a stream name: {stream!r}")
        return f"{self.root}/data/stream={stream}/batch={batch}"

    # --- writing -------------------------------------------------------------------------------

    def ordered(self, ops: DataFrame) -> DataFrame:
        """`ops` with the order column `at`."""
        if self.order == "offset":
            return ops.withColumn("at", F.col("offset"))
        return ops.withColumn("at", F.struct(F.col("timestamp").cast("timestamp").alias("timestamp"), "topic",
                                             F.col("partition").cast("int").alias("partition"), "offset"))

    def apply(self, ops: DataFrame, batch: int, stream: str = "main", whole: bool = False) -> None:
        """Write one micro-batch. Repeating a batch of a stream leaves the same table. `whole`: no op is an update."""
        path = self._delta(batch, stream)
        if self.written(batch, stream):
            return
        fold.delta(self.ordered(ops), order="at", whole=whole).write.mode("overwrite").partitionBy("collection").parquet(path)

    def reject(self, dead: DataFrame, batch: int, stream: str = "main") -> None:
        """Write the dead letters of one micro-batch; done before its ops, so progress never passes a lost record. Keys and
        values that are not text are written as JSON, nulls kept, so that records of any schema share one table."""
        for name in ("key", "value"):
            kind = dead.schema[name].dataType
            if isinstance(kind, (T.StructType, T.MapType, T.ArrayType, T.VariantType)):
                dead = dead.withColumn(name, F.to_json(name, {"ignoreNullFields": "false"}))
            elif not isinstance(kind, (T.StringType, T.BinaryType)):
                dead = dead.withColumn(name, F.col(name).cast("string"))
        dead.write.mode("overwrite").parquet(f"{self.root}/dead/stream={stream}/batch={batch}")

    def compact(self) -> int:
        """Fold everything into a new base and return its number (-1: nothing to fold); readers switch when its entry is there."""
        return self._rebase(lambda rows: rows, whatever=False)

    def delete_all(self, collection: str) -> int:
        """The collection without documents, as of the batches written so far; the number of the new base."""
        return self._rebase(lambda rows: rows.where(F.col("collection") != collection), whatever=True)

    def _rebase(self, change, whatever: bool) -> int:
        while True:
            number, entry = self._bases.newest()
            pending = self._pending(entry)
            if not pending and not whatever:
                return number
            paths = list(pending.values()) + ([f"{self.root}/base/{entry['folder']}"] if entry else [])
            wanted = sum(self._files.size(p) for p in paths) // self._bucket_bytes
            buckets = min(MAX_BUCKETS, 1 << int(wanted).bit_length())
            folder = uuid.uuid4().hex
            rows = fold.merge_deltas(change(self._rows(entry, pending))).withColumn("bucket", self._bucket(buckets))
            (rows.repartition("collection", "bucket").sortWithinPartitions("collection", "bucket", "id")
             .write.option("parquet.bloom.filter.enabled#id", "true").partitionBy("collection", "bucket").parquet(f"{self.root}/base/{folder}"))
            made = {"folder": folder, "buckets": buckets, "holds": commits.holding(entry.get("holds", {}), list(pending))}
            if self._bases.create(number + 1, made):
                return number + 1
            self._files.delete(f"{self.root}/base/{folder}")      # another base came first; start again on top of it

    def vacuum(self, keep: int = 0, orphan_ms: int = DAY_MS) -> list[str]:
        """Remove what bases replaced, and say what was removed. `keep` newest bases are left readable as they were,
        with the deltas they do not hold: 1 gives readers the time of one compaction. Base folders without an entry
        are left by writers that stopped half-way; they go once older than `orphan_ms`."""
        numbers = self._bases.numbers()
        if len(numbers) <= keep:
            return []
        first = len(numbers) - 1 - keep
        kept = [self._bases.read(n) for n in numbers[first:]]
        old = [path for pair, path in self._complete("data").items() if all(commits.holds(e["holds"], *pair) for e in kept)]
        named = {e["folder"] for e in kept}
        folders = {s.getPath().getName(): s for s in self._files.matching(f"{self.root}/base/*") if s.getPath().getName() not in named}
        replaced = {self._bases.read(n)["folder"] for n in numbers[:first]} if folders else set()
        for name, status in folders.items():
            if name in replaced or time.time() * 1000 - status.getModificationTime() > orphan_ms:
                old.append(status.getPath().toString())
        for path in old:
            self._files.delete(path)
        # the latest entries stay, so that a slow writer finds the number it wants taken
        for n in numbers[:first]:
            if n < numbers[-1] - ENTRIES:
                self._bases.remove(n)
        return sorted(old)

    # --- reading -------------------------------------------------------------------------------

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64("collection", "id"), F.lit(buckets)).cast("int")

    def _deltas(self, pending: dict[tuple[str, int], str], before: tuple[str, int] | None = None) -> DataFrame:
        """The rows of deltas. `before`: leave out this batch and later ones of its stream."""
        paths = [p for (s, n), p in sorted(pending.items()) if before is None or s != before[0] or n < before[1]]
        # An empty batch has a marker and no files.
        paths = [p for p in paths if self._has_files(p)]
        if not paths:
            return self._spark.createDataFrame([], self._schema())
        return self._spark.read.option("basePath", f"{self.root}/data").schema(self._schema()).parquet(*paths).drop("stream", "batch")

    def _based(self, entry: dict) -> DataFrame | None:
        """The rows of a base, with `bucket`."""
        path = f"{self.root}/base/{entry['folder']}" if entry else None
        if not path or not self._has_files(path):
            return None
        return self._spark.read.schema(self._schema() + ", bucket int").parquet(path)

    def _rows(self, entry: dict, pending: dict[tuple[str, int], str]) -> DataFrame:
        """The rows of the base and of the deltas after it."""
        rows, base = self._deltas(pending), self._based(entry)
        return rows if base is None else base.drop("bucket").unionByName(rows)

    def _now(self) -> DataFrame:
        entry = self._bases.newest()[1]
        return self._rows(entry, self._pending(entry))

    def _has_files(self, path: str) -> bool:
        fs, p = self._files.at(path)
        return any(s.isDirectory() for s in fs.listStatus(p))

    def _schema(self) -> str:
        at = ORDERS[self.order]
        return f"id string, base {at}, written {at}, fields map<string, struct<at: {at}, value: array<string>>>, collection string"

    def read(self, collection: str | None = None, live: bool = False, versions: bool = False) -> DataFrame:
        """Current documents: collection, id, fields, and with `versions` the version that a conditional write has to
        name. A collection reads its own partitions only. `live` leaves out tombstone documents."""
        rows = self._now()
        if collection is not None:
            rows = rows.where(F.col("collection") == collection)
        docs = fold.documents(fold.merge_deltas(rows), keep=("written",) if versions else ())
        if versions:
            docs = docs.withColumn("version", version_of(F.col("written"), self.order)).drop("written")
        return fold.live(docs) if live else docs

    def columns(self, types: dict[str, str], collection: str | None = None) -> DataFrame:
        """Current documents with typed columns: a field of array type keeps all its values, another the first."""
        return fold.typed(self.read(collection), types)

    def marks(self, among: DataFrame, before: tuple[str, int] | None = None) -> DataFrame:
        """collection, id, base, written of the stored rows of `among` (collection, id). Reads no field values, and of the
        base only the buckets that hold an id of `among`; a few ids are asked for by name, so that filters of the
        files apply."""
        return self._among(among, before, ("collection", "id", "base", "written"))

    def _among(self, among: DataFrame, before: tuple[str, int] | None, columns: tuple[str, ...]) -> DataFrame:
        entry = self._bases.newest()[1]
        wanted = among.select("collection", "id").distinct()
        rows, base = self._deltas(self._pending(entry), before).select(*columns), self._based(entry)
        if base is not None:
            touched = {r.bucket: r["count"] for r in wanted.select(self._bucket(entry["buckets"]).alias("bucket"))
                       .groupBy("bucket").count().collect()}      # at most MAX_BUCKETS rows
            base = base.where(F.col("bucket").isin(list(touched)))
            if sum(touched.values()) <= NAMED_IDS:
                base = base.where(F.col("id").isin([r.id for r in wanted.select("id").distinct().collect()]))
            rows = rows.unionByName(base.select(*columns))
        return rows.join(wanted, ["collection", "id"], "left_semi")

    def read_among(self, among: DataFrame) -> DataFrame:
        """Current documents of the ids of `among` (collection, id): of the base, only their buckets are read."""
        rows = self._among(among, None, ("collection", "id", "base", "written", "fields"))
        return fold.documents(fold.merge_deltas(rows))

    def touched(self, collection: str, held: dict) -> DataFrame | None:
        """collection, id of what the batches outside `held` wrote to or deleted; None where there is no such batch."""
        entry = self._bases.newest()[1]
        newer = {k: p for k, p in self._pending(entry).items() if not commits.holds(held, *k)}
        if not newer:
            return None
        return self._deltas(newer).where(F.col("collection") == collection).select("collection", "id").distinct()

    @property
    def base(self) -> int:
        """Number of the newest base, -1 without one."""
        return self._bases.newest()[0]

    def snapshot(self, collection: str) -> tuple[int, dict, DataFrame, int]:
        """Newest base, the batches it and the deltas after it hold, the documents of both, and the bytes they are read from."""
        number, entry = self._bases.newest()
        pending = self._pending(entry)
        folders = [*pending.values(), *([f"{self.root}/base/{entry['folder']}"] if entry else [])]
        docs = fold.documents(fold.merge_deltas(self._rows(entry, pending).where(F.col("collection") == collection)))
        held = commits.holding(entry.get("holds", {}), list(pending))
        return number, held, docs, sum(self._files.size(f) for f in folders)

    def existing(self, among: DataFrame, before: tuple[str, int] | None = None) -> DataFrame:
        """collection, id, version of the documents that ids of `among` (collection, id) have, as of `before` this
        (stream, batch)."""
        state = self.marks(among, before).groupBy("collection", "id").agg(F.max("base").alias("b"), F.max("written").alias("w"))
        alive = state.where(F.col("w").isNotNull() & (F.col("b").isNull() | (F.col("w") >= F.col("b"))))
        return alive.select("collection", "id", version_of(F.col("w"), self.order).alias("version"))

    def dead_letters(self) -> DataFrame | None:
        paths = [p for _, p in sorted(self._complete("dead").items())]
        return self._spark.read.option("mergeSchema", "true").parquet(*paths) if paths else None

    # --- declared fields -----------------------------------------------------------------------

    def catalog(self) -> dict[str, dict[str, list]]:
        """collection -> field -> [type, multi valued, dynamic], newest version."""
        return self._catalogs.newest()[1].get("collections", {})

    def declare(self, collection: str, fields: dict[str, list] | None = None) -> list[str]:
        """T4: add the fields that the collection lacks, and the collection itself; the names added. A known field keeps
        its type. Writers that grow the catalog at the same time do not lose each other's fields."""
        while True:
            number, entry = self._catalogs.newest()
            known = entry.get("collections", {})
            missing = {n: list(f) for n, f in (fields or {}).items() if n not in known.get(collection, {})}
            if not missing and collection in known:
                return []
            grown = known | {collection: known.get(collection, {}) | missing}
            if self._catalogs.create(number + 1, {"collections": grown}):
                return sorted(missing)

    def collections(self) -> set[str]:
        """Collections that are declared or have had a write."""
        number, entry = self._bases.newest()
        folders = [*self._pending(entry).values(), *([f"{self.root}/base/{entry['folder']}"] if entry else [])]
        unescape = self._spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        found = {unescape(s.getPath().getName().removeprefix("collection="))
                 for f in folders for s in self._files.matching(f"{f}/collection=*")}
        return found | set(self.catalog())
