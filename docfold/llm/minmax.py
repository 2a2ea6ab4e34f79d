"""Near-duplicate documents by min-max hashing.

Every permutation of the shingle hashes gives two signature values, its minimum and its maximum, so 32 permutations give
64 values: half the hash evaluations of plain MinHash, both values unbiased for Jaccard. They make 16 bands of 4 values;
at a similarity of 0.85 a pair shares no band with a probability of 1e-5, and a chain of copies has many pairs.

1. Documents with the same shingle set form a class, named by its smallest doc_id; only classes go on.
2. In every band bucket each class meets the bucket's smallest one (a star: as many pairs as members, not their square).
3. Pairs are confirmed on full shingle sets; confirmed links give components.
4. Where a bucket still holds several components, members of different components are compared too, after two exact
   bounds (set sizes, and parity bitmaps whose differing bits cannot outnumber the differing shingles). So no link
   between two components is left out, and pairs inside a component, which change nothing, are never made.

Shingles are compared by 64-bit hashes of their words. A null, empty or blank text has no shingles and is linked with
nothing; a text of fewer than five words is one shingle. Rows that repeat a doc_id are one document, linked with whatever
any of its texts is linked with. A row without doc_id gets the component of its text's other documents, if any, and is
not kept. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.llm import graphs, shared, textcore

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BAND = 4
MISS = 1e-5  # chance that a pair at the threshold shares no band
WORDS = 5
PARITY = 16  # 64-bit words of a parity bitmap
SKETCH = "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, parity array<long>"


def _rows(values: np.ndarray) -> pa.ListArray:
    """A two-dimensional array as rows of longs."""
    n, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, n * width + 1, width, dtype=np.int32), pa.array(values.astype(np.uint64).view(np.int64).ravel()))


def permutations(percent: int) -> int:
    """Permutations for the bands that a threshold needs; half of the bands are of minima, half of maxima."""
    at_threshold = (percent / 100) ** BAND
    bands = math.log(MISS) / math.log(1 - at_threshold) if at_threshold < 1 else 1
    return BAND * math.ceil(bands / 2)


def _sketches(permutations: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = textcore.Words()
        factors, shifts = textcore.seeds(permutations, 11) | np.uint64(1), textcore.seeds(permutations, 12)
        for batch in batches:
            for a, b, data, offs in textcore.pieces(batch.column(1)):
                s, at = textcore.unique_by_row(*textcore.shingles(*words.hashes(data, offs), WORDS))
                n = np.diff(at)
                signature = np.empty((b - a, 2 * permutations), np.uint64)
                for i in range(permutations):
                    h = (s ^ shifts[i]) * factors[i]
                    signature[:, i] = textcore.by_row(np.minimum, h, at, 0)
                    signature[:, permutations + i] = textcore.by_row(np.maximum, h, at, 0)
                # a band holds values of different permutations: 0-3, 4-7, ... of the minima, then of the maxima
                bands = np.zeros((b - a, 2 * permutations // BAND), np.uint64)
                for j in range(BAND):
                    bands = textcore.mix(bands * np.uint64(3) + signature[:, j::BAND])
                parity = np.empty((b - a, PARITY), np.uint64)
                bit, word = np.uint64(1) << (s & np.uint64(63)), (s >> np.uint64(6)) & np.uint64(PARITY - 1)
                for j in range(PARITY):
                    parity[:, j] = textcore.by_row(np.bitwise_xor, np.where(word == j, bit, np.uint64(0)), at, 0)
                mixed = textcore.mix(s)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)),
                     pa.array(textcore.by_row(np.add, s, at, 0).view(np.int64)), pa.array(textcore.by_row(np.add, mixed, at, 0).view(np.int64)),
                     _rows(bands), _rows(parity)], names=["doc_id", "n_shingles", "f1", "f2", "bands", "parity"])

    return task


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = textcore.Words()
    for batch in batches:
        for a, b, data, offs in textcore.pieces(batch.column(1)):
            s, at = textcore.unique_by_row(*textcore.shingles(*words.hashes(data, offs), WORDS))
            blobs = [s[x:y].tobytes() for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(blobs, pa.binary())], names=["c", "s"])


def _confirm(percent: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                # sorted sets of hashes: look the smaller one up in the larger
                place = np.searchsorted(q, p)
                place[place == len(q)] = 0
                both = int(np.count_nonzero(q[place] == p))
                keep[i] = 100 * both >= percent * (len(p) + len(q) - both)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return task


def _differing(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(1, PARITY)), F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))


def _confirmed(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Of `pairs` (a, b: classes by their doc_id) those whose shingle sets are similar enough."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = docs.join(needed, "doc_id", "left_semi")
    sets = shared.written(texts.select("doc_id", "text").mapInArrow(textcore.tidy(_sets), "c long, s binary"), "sets")
    both = (pairs.join(sets.select(F.col("c").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("c").alias("b"), F.col("s").alias("sb")), "b").select("a", "b", "sa", "sb"))
    return both.mapInArrow(textcore.tidy(_confirm(percent)), "a long, b long")


def link(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = shared.written(docs.mapInArrow(textcore.tidy(_sketches(permutations(percent))), SKETCH), "sketch")
    key = ["n_shingles", "f1", "f2"]
    classes = shared.written(sketch.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(
        F.min("doc_id").alias("c"), F.first("bands").alias("bands"), F.first("parity").alias("parity")), "classes")
    members = classes.select("c", F.posexplode("bands").alias("band", "h"))
    buckets = members.groupBy("band", "h").agg(F.min("c").alias("first"), F.max("c").alias("last")).where("first < last")
    members = shared.written(members.join(buckets, ["band", "h"]).select("band", "h", "c", "first"), "members")

    sizes = classes.select("c", F.col("n_shingles").alias("n"))
    star = members.where("first < c").select(F.col("first").alias("a"), F.col("c").alias("b")).distinct()
    close = lambda x, y: (F.least(x, y) * 100 >= F.greatest(x, y) * percent)
    star = (star.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b").where(close(F.col("na"), F.col("nb"))).select("a", "b"))
    several = (sketch.where("n_shingles > 0").groupBy("doc_id").agg(F.min("f1").alias("x"), F.max("f1").alias("y"))
               .where("x < y").select("doc_id"))
    same = (sketch.join(several, "doc_id", "left_semi").join(classes.select(*key, "c"), key)
            .select(F.col("doc_id").alias("a"), F.col("c").alias("b")).where("a <> b"))
    star = shared.written(star, "pairs")
    links = shared.written(_confirmed(docs, star, percent).unionByName(same), "links")
    roots = shared.written(graphs.components(links), "roots")

    # buckets that still hold several components
    placed = members.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    split = placed.groupBy("band", "h").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("band", "h")
    rest = placed.join(split, ["band", "h"]).join(classes.select("c", F.col("n_shingles").alias("n"), "parity"), "c")
    left = rest.select("band", "h", F.col("c").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na"), F.col("parity").alias("pa"))
    right = rest.select("band", "h", F.col("c").alias("b"), F.col("root").alias("rb"), F.col("n").alias("nb"), F.col("parity").alias("pb"))
    bound = _differing("pa", "pb") * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)
    others = left.join(right, ["band", "h"]).where((F.col("ra") < F.col("rb")) & close(F.col("na"), F.col("nb")) & bound)
    others = others.select("a", "b").distinct().join(star.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
    others = shared.written(others.join(star, ["a", "b"], "left_anti"), "pairs")
    if others.limit(1).count():
        links = links.unionByName(_confirmed(docs, others, percent))
        roots = shared.written(graphs.components(links), "roots")

    named = classes.select(*key, "c").join(roots.withColumnRenamed("node", "c"), "c", "left").select(*key, F.coalesce("root", "c").alias("root"))
    out = sketch.select("doc_id", *key).join(named, key, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
