"""Benchmark items inside documents: size-partitioned MinHash containment search, verified exactly.

An item is contained in a document when the document has at least 80 % of the item's distinct five-word shingles (an
item of fewer words is one shingle, searched at its own length). Words are lower-cased runs without white space.

* Items are partitioned by size class (powers of two). In a class of at most u shingles, an item is sketched by its
  floor(0.2 u) + 1 smallest shingle hashes (bottom-k MinHash). A document that misses at most a fifth of the item's
  shingles holds one of these whatever its own length, so the search misses nothing, however short the item is beside it.
* Shingle hashes of every document meet the sketches in one equi-join. Spark broadcasts the sketches while they are
  below its size limit, and otherwise shuffles both sides.
* Candidates are written to the shared folder, then verified on the shingles themselves. Spark broadcasts them while they
  are below its size limit, and otherwise shuffles both sides.

Only DataFrame functions are used. Null and blank texts hold nothing and are found nowhere. Rows repeating doc_id and
text give one row per item; a null doc_id or item_id is kept as it is. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.llm import shared

WORDS = 5


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")


def runs(items: Column, size: int, join) -> Column:
    """join(list of `size` neighbours) for every run of `size` elements of the array `items`."""
    starts = F.sequence(F.lit(0), F.size(items) - size)
    made = F.transform(starts, lambda i: join([items[i + j] for j in range(size)]))
    return F.when(F.size(items) >= size, made).otherwise(F.array().cast("array<string>" if join is as_text else "array<bigint>"))


def as_text(run: list[Column]) -> Column:
    return F.concat_ws(" ", *run)


def as_hash(run: list[Column]) -> Column:
    return F.xxhash64(*run)


def sketches(items: DataFrame) -> DataFrame:
    """item_id, size (words in a shingle), h: the smallest hashes of each item's shingles."""
    least = (F.floor(F.pow(F.lit(2.0), F.ceil(F.log2(F.size("found")))) * 0.2) + 1).cast("int")
    return (items.withColumn("found", F.array_sort(F.array_distinct("hashes"))).where("size(found) > 0")
            .select("item_id", "size", F.explode(F.slice("found", F.lit(1), least)).alias("h")))


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """item_id, size, shingles (distinct texts), hashes."""
    rows = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where("size(w) > 0")
    rows = rows.withColumns({"size": F.least(F.size("w"), F.lit(WORDS)), "hw": F.transform("w", lambda x: F.xxhash64(x))})
    text, hashes = F.lit(None).cast("array<string>"), F.lit(None).cast("array<bigint>")
    for n in range(1, WORDS + 1):
        at = F.col("size") == n
        text = F.when(at, runs(F.col("w"), n, as_text)).otherwise(text)
        hashes = F.when(at, runs(F.col("hw"), n, as_hash)).otherwise(hashes)
    return rows.select("item_id", "size", F.array_distinct(text).alias("shingles"), hashes.alias("hashes"))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_text", F.xxhash64("text"))


def contained(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, _text (hash of the text), item_id, n_item, n_found for every contained item."""
    docs = keyed(docs.select("doc_id", "text"))
    items = item_shingles(benchmark)
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most five numbers
    wanted = sketches(items)
    hashed = docs.select("doc_id", "_text", F.transform(words_of(F.col("text")), lambda x: F.xxhash64(x)).alias("hw"))
    parts = [runs(F.col("hw"), n, as_hash) for n in sizes] or [F.array().cast("array<bigint>")]
    probes = hashed.select("doc_id", "_text", F.explode(F.concat(*parts) if len(parts) > 1 else parts[0]).alias("h"))
    candidates = probes.join(wanted.select("item_id", "h"), "h").select(F.col("doc_id").alias("_id"), F.col("_text").alias("_key"), "item_id").distinct()
    # written first, so that their size is known: few of them are broadcast, and no text is shuffled
    candidates = shared.written(candidates, "candidates")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key"))
    pairs = docs.join(candidates, same).select("doc_id", "_text", "text", "item_id").withColumn("w", words_of(F.col("text")))
    pairs = pairs.join(items.select(F.col("item_id").alias("i"), "size", "shingles"), F.col("item_id").eqNullSafe(F.col("i")))
    held = F.lit(None).cast("array<string>")
    for n in sizes:
        held = F.when(F.col("size") == n, runs(F.col("w"), n, as_text)).otherwise(held)
    counts = pairs.select("doc_id", "_text", "item_id", F.size("shingles").cast("long").alias("n_item"),
                          F.size(F.array_intersect(held, F.col("shingles"))).cast("long").alias("n_found"))
    return counts.where(F.col("n_found") * 100 >= F.col("n_item") * percent).distinct()


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """`docs` without the documents that contain an item."""
    bad = shared.written(contained(docs, benchmark, percent).select(F.col("doc_id").alias("_id"), F.col("_text").alias("_key")).distinct(), "contained")
    rows = keyed(docs)
    return rows.join(bad, rows["doc_id"].eqNullSafe(bad["_id"]) & (rows["_text"] == bad["_key"]), "left_anti").drop("_text")
