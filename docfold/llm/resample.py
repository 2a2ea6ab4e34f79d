"""Importance resampling towards a target distribution, over hashed word n-grams.

Two passes over the texts, neither of which shuffles one:

1. A 256-byte table lower-cases A-Z and blanks what separates words, `bytes.split` yields the words. The bucket of an
   n-gram is the CRC-32 of its words joined by a space, modulo `buckets`; the CRC of a longer n-gram continues that of
   the shorter one. Counters reduce words to buckets inside a task, which sends at most `buckets` rows.
2. From source and target counts every bucket gets a gain, the log ratio of its smoothed shares in thousandths. A text's
   weight is the sum of the gains of its features.

Seeded Gumbel noise is added to the weight; the highest sums are a draw without replacement in proportion to exp(weight).
The draw is ranked over the whole table: rows are dealt by range of the score, and each range starts where those above it
end, so no task sees more than its share.

Null and empty texts have no features and weight 0. A null doc_id is noised as the text 'null' and ordered last. Rows that
repeat a doc_id are rows of their own, with the same noise; equal rows take successive ranks. Other columns are ignored.
An empty source or target counts no features; an empty table of documents gives no rows.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfold.llm import shared, wordruns

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 10_000
#: Bytes that separate words are the ASCII ones other than digits and letters.
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
CACHED = 1 << 17  # words whose CRC a task remembers
ROWS_A_RANGE = 1 << 20


class _Crc(dict):
    """CRC-32 of words, remembered for the most recent ones."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        self[word] = found = crc32(word)
        return found


def _features(text: bytes, table: bytes, longest: int, crc: _Crc) -> Iterator[tuple[int, list[int]]]:
    """(words read, CRCs of the n-grams that end in them), run by run."""
    before: list[bytes] = []  # the last words of the run before, which n-grams of this one begin with
    for words in wordruns.runs(text, table):
        if longest == 1:
            yield len(words), [crc[w] for w in words]
            continue
        joined, new = before + words, len(before)
        found = []
        for i in range(len(joined)):
            value = crc[joined[i]]
            if i >= new:
                found.append(value)
            for j in range(i + 1, min(i + longest, len(joined))):
                value = crc32(joined[j], crc32(b" ", value))
                if j >= new:
                    found.append(value)
        before = joined[-(longest - 1):]
        yield len(words), found


def _counted(buckets: int, longest: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, crc, counts = wordruns.folding(SEPARATORS), _Crc(), Counter()
        for batch in batches:
            for text in wordruns.texts(batch.column(0)):
                if longest == 1:
                    for words in wordruns.runs(text, table):
                        for word, n in Counter(words).items():
                            counts[crc[word] % buckets] += n
                else:
                    for _, found in _features(text, table, longest, crc):
                        for value, n in Counter(found).items():
                            counts[value % buckets] += n
        if counts:
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(list(counts), pa.int32()), "n": pa.array(counts.values(), pa.int64())})

    return task


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS, longest: int = 1) -> DataFrame:
    """bucket, n: features of all texts of `rows` by hash bucket; at most `buckets` rows."""
    return rows.select("text").mapInArrow(_counted(buckets, longest), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain: floor(1000 ln of the ratio of the target's smoothed share to the source's), for every bucket."""
    every = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = (every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
            .select("bucket", F.coalesce("s", F.lit(0)).cast("double").alias("s"), F.coalesce("t", F.lit(0)).cast("double").alias("t")))
    both = shared.written(both, "buckets")
    sums = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = (F.col("t") + 1) * F.lit(sums.s + buckets) / ((F.col("s") + 1) * F.lit(sums.t + buckets))
    return both.select("bucket", F.floor(F.log(ratio) * 1000).cast("long").alias("gain"))


def _weighed(gain: np.ndarray, buckets: int, longest: int):
    class Gains(_Crc):
        """Gains of words, remembered for the most recent ones."""

        def __missing__(self, word: bytes) -> int:
            if len(self) >= CACHED:
                self.clear()
            self[word] = found = int(gain[crc32(word) % buckets])
            return found

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, crc, known = wordruns.folding(SEPARATORS), _Crc(), Gains()
        for batch in batches:
            words, features, weights = [], [], []
            for text in wordruns.texts(batch.column(1)):
                n_words = n_features = weight = 0
                if longest == 1:
                    for run in wordruns.runs(text, table):
                        n_words += len(run)
                        weight += sum(map(known.__getitem__, run))
                    n_features = n_words
                else:
                    for n, found in _features(text, table, longest, crc):
                        n_words, n_features = n_words + n, n_features + len(found)
                        weight += int(gain[np.array(found, np.int64) % buckets].sum()) if found else 0
                words.append(n_words)
                features.append(n_features)
                weights.append(weight)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.int64()) for x in (words, features, weights)]],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return task


def weights(docs: DataFrame, gain: DataFrame, buckets: int = BUCKETS, longest: int = 1) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row of `docs`."""
    found = np.zeros(buckets, np.int64)
    for row in gain.collect():  # `buckets` rows
        found[row.bucket] = row.gain
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_weighed(found, buckets, longest), "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Standard Gumbel noise of a document in thousandths, fixed by seed and doc_id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000).cast("long")


def ranked(rows: DataFrame, take: int, order: list[Column]) -> DataFrame:
    """`rows` with `rank`: 1, 2, 3, ... for the first `take` by `order`, null for the others.

    Rows go to ranges of `order` and are numbered inside each; a range's numbers start after the rows of those before it.
    Equal rows would land in one range, so their hash and place in the input break ties after `order`.
    """
    spark = rows.sparkSession
    n = rows.count()
    parts = max(1, -(-n // ROWS_A_RANGE), min(n, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    placed = rows.withColumn("_tie", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(parts, *order, F.col("_tie")).withColumn("_part", F.spark_partition_id())
    placed = shared.written(placed, "ranges")
    sizes = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())  # one row a range
    starts, ahead = [], 0
    for part, size in sizes:
        starts.append((part, ahead))
        ahead += size
    first = F.broadcast(spark.createDataFrame(starts, "_part int, _ahead long"))  # one row a range
    number = F.col("_ahead") + F.row_number().over(Window.partitionBy("_part").orderBy(*order, "_tie"))
    numbered = placed.join(first, "_part").withColumn("_number", number)
    return numbered.withColumn("rank", F.when(F.col("_number") <= take, F.col("_number"))).drop("_part", "_ahead", "_number", "_tie")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, seed: int = 2024, min_words: int = 20,
             buckets: int = BUCKETS, longest: int = 1) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of `docs` (doc_id, text); rank is null where not drawn.

    `percent` % of the documents of at least `min_words` words are drawn. `target` has the texts (column text) whose
    distribution of features the draw leans to. Features are runs of 1 to `longest` words.
    """
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest), buckets)
    scored = weights(docs, gain, buckets, longest).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = shared.written(scored, "scored")
    eligible = F.col("n_words") >= min_words
    take = percent * scored.where(eligible).count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    drawn = ranked(scored.where(eligible), take, order)
    out = drawn.unionByName(scored.where(~eligible), allowMissingColumns=True)
    return out.select("doc_id", "n_features", "weight", "score", "rank")
