"""Optimistic versions (P13, A11, W2): a write that names a version is applied only if the document still has it.

The version of a document is a number that belongs to the record which wrote it last; readers get it with the document and
hand it back. It is derived from the order value of that record, so it needs no counter, any kind of write changes it, and
a replay gives the same one. A write asks for

* nothing (NULL or 0): applied whatever is stored;
* a negative number: the document must not exist;
* 1: it must exist;
* any other number: it must exist and have that version.

Deletes are never conditional. Each outcome decides what the next write of the id meets, so the writes of one id are taken
one after the other; no more than one row of them is held at a time, however many there are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

# Tasks get this module's functions by value, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MUST_EXIST = 1
FIRST = 2      # versions lie above the special values
CONFLICT = "version conflict"
FREE, DELETE, ASKING = 0, 1, 2      # what a row does: it is written whatever is stored, deletes, or asks
_ROWS = "collection string, id string, topic string, partition int, offset bigint, stored bigint"


def version_of(at: Column, order: str = "offset") -> Column:
    """The version that a record's write gives: 60 bits of the MD5 of its offset, or of topic-partition-offset where the
    order value is (timestamp, topic, partition, offset)."""
    name = at.cast("string") if order == "offset" else F.concat_ws(
        "-", at["topic"], at["partition"].cast("string"), at["offset"].cast("string"))
    number = F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("bigint") + FIRST
    return F.when(at.isNotNull(), number)


def accepts(asked: int | None, exists: bool, stored: int | None) -> bool:
    """Whether a write that asks for `asked` is applied to a document of version `stored`."""
    if asked is None or asked == 0:
        return True
    if asked < 0:
        return not exists
    return exists and (asked == MUST_EXIST or asked == stored)


def _refused(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, of each id what is stored before its writes -> the writes refused, with the version they met."""
    key, stored = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [batch.column(n) for n in ("collection", "id")]
        ends = [c[-1].as_py() for c in names]
        # Where another id begins; the first row is compared with the batch before.
        begins = [[c[0].as_py() for c in names] != key]
        if batch.num_rows > 1:
            other = pc.or_(*[pc.coalesce(pc.not_equal(c[1:], c[:-1]), pc.not_equal(pc.is_null(c[1:]), pc.is_null(c[:-1]))) for c in names])
            begins += other.to_numpy(zero_copy_only=False).tolist()
        key = ends
        kinds, asked, own = [pc.fill_null(batch.column(n), 0).to_numpy(zero_copy_only=False).tolist() for n in ("kind", "asked", "own")]
        kept, met = [], []
        for i, (begin, kind, ask, version) in enumerate(zip(begins, kinds, asked, own)):
            if begin:
                stored = None
            if kind == DELETE:
                stored = None
            elif kind == FREE or accepts(ask, stored is not None, stored):
                stored = version
            else:
                kept.append(i)
                met.append(stored or None)      # 0: a document without a version
        found = batch.take(pa.array(kept, pa.int64()))
        yield pa.RecordBatch.from_arrays([*(found.column(n) for n in ("collection", "id", "topic", "partition", "offset")), pa.array(met, pa.int64())],
                                         names=["collection", "id", "topic", "partition", "offset", "stored"])


def refused(ops: DataFrame, stored: DataFrame, order: str = "offset", must_exist: bool = False) -> DataFrame:
    """The ops (collection, id, op, topic, partition, offset, at, version) that their asked version keeps from being applied:
    collection, id, topic, partition, offset, and `stored`, the version they met (NULL: no document).

    `stored`: collection, id, version of the documents before these ops. `must_exist`: a write that asks for nothing asks
    for an existing document. Only ids with a conditional write are sorted and walked through.
    """
    asked = F.col("version")
    if must_exist:
        asked = F.coalesce(asked, F.lit(MUST_EXIST).cast("bigint"))
    writes = ops.where((F.col("op") != "update") | (F.size("fields") > 0)).select(
        "collection", "id", F.lit(1).alias("step"), "at", "op", asked.alias("asked"), version_of(F.col("at"), order).alias("own"),
        "topic", F.col("partition").cast("int").alias("partition"), "offset")
    conditional = writes.where("op <> 'delete' AND asked <> 0").select("collection", "id").distinct()
    none = F.lit(None)
    before = stored.select(
        "collection", "id", F.lit(0).alias("step"), none.cast(writes.schema["at"].dataType).alias("at"), none.cast("string").alias("op"),
        none.cast("bigint").alias("asked"), F.col("version").alias("own"), none.cast("string").alias("topic"),
        none.cast("int").alias("partition"), none.cast("bigint").alias("offset"))
    rows = writes.unionByName(before).join(conditional, ["collection", "id"], "left_semi")
    kind = (F.when(F.col("op") == "delete", F.lit(DELETE))
            .when((F.col("step") == 1) & (F.col("asked") != 0), F.lit(ASKING)).otherwise(F.lit(FREE)))
    walked = rows.withColumn("kind", kind).repartition("collection", "id").sortWithinPartitions("collection", "id", "step", "at")
    return walked.drop("step", "at", "op").mapInArrow(_refused, _ROWS)
