"""Micro-batch apply (W1): at-least-once delivery, idempotent writes."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from docfold.operators import versions
from docfold.operators.fold import atomic_split
from docfold.operators.identity import reserved_names, route
from docfold.operators.schema import Collections, declared_types, evolves, field_specs
from docfold.options import FoldOptions
from docfold.plans.ingest import classify, convert, dry_run_report, split, writes_whole
from docfold.streaming.layout import SearchLayout
from docfold.streaming.table import DocumentTable


def work_folder(spark: SparkSession, name: str) -> str:
    """A folder for progress data under the shared `spark.checkpoint.dir` of the session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("give a checkpoint folder, or set spark.checkpoint.dir to a folder all executors share")
    return f"{shared.rstrip('/')}/{name}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under `spark.checkpoint.dir`; a temporary one where that is unset and there is one machine only."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.master.startswith("local"):
            return work_folder(spark, name)      # says what to set
        return tempfile.mkdtemp(prefix=f"docfold-{name}-")
    return work_folder(spark, f"{name}-{uuid.uuid4().hex}")


def check_targets(batch: DataFrame, options: FoldOptions, collections: Collections) -> None:
    """T5 for one micro-batch: every collection it writes to exists, may be created, or the batch fails.

    Reads the topic column only; the names are as few as the topics.
    """
    rows = batch.where(F.col("value").isNotNull()) if options.behavior_on_null_values == "ignore" else batch
    names = rows.select("topic").distinct().select(route(F.col("topic"), options).alias("c")).distinct()
    for row in names.collect():
        collections.ensure(row.c)


def grow_catalog(batch: DataFrame, table: DocumentTable, options: FoldOptions) -> None:
    """T4: declare the fields that a batch of records with a declared schema brings, in the collections it writes to.

    Topics whose schema is ignored add nothing. Growth that fails is a warning, and the records are written all the same.
    """
    schema = batch.schema["value"].dataType
    if not options.schema_auto_evolve or options.schema_ignore or not isinstance(schema, T.StructType):
        return
    needed = {s.name: [s.type, s.multi_valued, s.dynamic] for s in field_specs(schema, options.compact_map_entries, reserved_names(options))}
    names = batch.where(F.col("value").isNotNull()).select("topic", route(F.col("topic"), options).alias("c")).distinct()
    for collection in sorted({row.c for row in names.collect() if evolves(options, row.topic)}):      # as few as topics
        try:
            table.declare(collection, needed)
        except Exception as e:
            warnings.warn(f"collection {collection!r} does not get its new fields: {e}")


def _refused(ops: DataFrame, table: DocumentTable, options: FoldOptions, at: tuple[str, int]) -> DataFrame:
    """topic, partition, offset, reason of the writes (with `at`) that the stored documents, or writes of the batch before
    them, keep from being applied. What the batch itself wrote when it was first delivered does not count."""
    stored = table.existing(ops, before=at)
    if options.external_version_header:
        out = versions.refused(ops, stored, table.order, must_exist=options.write_method == "ATOMIC_UPDATE")
        return out.select("topic", "partition", "offset", F.lit(versions.CONFLICT).alias("reason"))
    marked = atomic_split(stored.select("collection", "id"), ops, order="at")
    return marked.where("refused").select("topic", "partition", "offset", F.lit("document does not exist").alias("reason"))


def apply_batch(batch: DataFrame, number: int, table: DocumentTable, options: FoldOptions,
                collections: Collections | None = None, stream: str = "main") -> DataFrame | None:
    """Convert one micro-batch of a stream and write it: dead letters first, then the ops. A dry run returns its
    report (`dry_run_report`) and writes nothing. A batch that the table has already does nothing.

    Records are checked against the table's catalog, which grows first where the options allow it. With
    `behavior_on_malformed_documents=fail` the first malformed record fails the batch and nothing of it is written.
    Under ATOMIC_UPDATE a missing document is a rejected record, and with `external_version_header` a document of
    another version than the record asks for: a dead letter, or a failure.
    """
    if options.dry_run:
        return dry_run_report(convert(batch, options, declared_types(table.catalog())).ops)
    if table.written(number, stream):
        return None
    if collections is not None:
        check_targets(batch, options, collections)
    grow_catalog(batch, table, options)
    catalog = declared_types(table.catalog())
    strict = options.behavior_on_malformed_documents == "fail"
    conditional = options.write_method == "ATOMIC_UPDATE" or bool(options.external_version_header)
    whole = writes_whole(options)
    if strict and not conditional:
        table.apply(convert(batch, options, catalog).ops, number, stream, whole)
        return None
    classified = classify(batch, options, catalog).persist()      # converted once, for the ops and for the dead letters
    kept = [classified]
    try:
        converted = split(classified, batch.columns)
        ops, dead = converted.ops, converted.dead
        if conditional:
            ops = table.ordered(ops)
            record = ["topic", "partition", "offset"]
            refused = _refused(ops, table, options, (stream, number)).persist()
            kept.append(refused)
            if strict and not refused.isEmpty():
                row = refused.first()
                raise ValueError(f"batch {number} writes to documents that do not exist or have another version, "
                                 f"first {row.topic}-{row.partition}@{row.offset}: {row.reason}")
            ops = ops.join(refused.select(*record), record, "left_anti")
            # The original record goes to the dead letters, as for any other rejection.
            dead = dead.unionByName(classified.select(*batch.columns).join(refused, record), allowMissingColumns=True)
        if not strict:
            table.reject(dead, number, stream)
        table.apply(ops, number, stream, whole)
    finally:
        for frame in kept:
            frame.unpersist()
    return None


def start(changes: DataFrame, table: DocumentTable, options: FoldOptions = FoldOptions(), checkpoint: str | None = None,
          collections: Collections | None = None, compact_every: int = 100, report=None,
          layouts: Sequence[SearchLayout] = (), **trigger) -> StreamingQuery:
    """Keep `table` up to date with a change stream. Source offsets are committed after a batch is written, so a
    batch cut short is delivered again and overwrites its own directory.

    The stream's name in the table is the id that Spark keeps in its checkpoint: a new checkpoint is a new stream.
    Every `compact_every` batches the deltas become a base, and those of the base before are removed (0: never).
    `report` gets the counts of every batch of a dry run. `layouts` are made anew with every base.
    """
    spark = changes.sparkSession
    folder = checkpoint or work_folder(spark, "apply")

    def one(df: DataFrame, number: int) -> None:
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        found = apply_batch(df, number, table, options, collections, stream)
        if found is not None and report is not None:
            report(found)
        if compact_every and number % compact_every == compact_every - 1 and not options.dry_run:
            table.compact()
            table.vacuum(keep=1)
            for layout in layouts:
                layout.refresh()

    return (changes.writeStream.option("checkpointLocation", folder).trigger(**(trigger or {"availableNow": True}))
            .foreachBatch(one).start())
