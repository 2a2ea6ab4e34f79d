"""SimHash near-duplicates, fingerprints compared bit plane by bit plane.

A text's fingerprint has a bit set where more than half of the XXH64 hashes (seed 42) of its three-word shingles, repeats
included, have it. Equal fingerprints form a class; links are found between classes.

1. Two fingerprints within `radius` bits are equal in at least two of radius + 2 blocks of bits, so each fingerprint goes
   into one bucket for every pair of blocks (6 buckets at a radius of 2). Buckets of one are dropped.
2. A bucket of more than `LIMIT` fingerprints is split by the same rule on the bits that its key leaves open, again until
   it is small or no more than `OPEN` bits are open, and 2^OPEN different fingerprints can share it: no bucket is capped.
3. In a task, buckets lie one after the other, sorted. Their bits are stored vertically: plane j holds bit j of 64
   fingerprints a word. Shifted by d places, the planes meet each fingerprint with the d-th after it; differing bits are
   added up by carry-save counters, 64 distances at once, and words are abandoned once all their distances exceed the
   radius. Within a bucket only links that join two parts are kept (a spanning forest), which loses no connection.
4. Connected components over fingerprints name every document by the smallest doc_id in reach.

A null or blank text has fingerprint zero and is linked like any other; a text of fewer than three words is one shingle.
Rows that repeat a doc_id are one document, linked with whatever any of its texts is linked with. A row without doc_id
links others and gets their component; null if there are none. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.llm import graphs, shared, wordruns
from docfold.operators.skew import skew_join

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS, SEED = 3, 42
#: The bytes between words.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
LIMIT = 1 << 12  # a larger bucket is split
OPEN = 12  # bits that a bucket may leave open whatever its size
CHUNK = 1 << 16  # fingerprints compared at a time, if no bucket is larger
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- fingerprints ------------------------------------------------------------------------------

def _shingle_hashes(text: bytes, table: bytes, size: int) -> Iterator[list[int]]:
    """XXH64 of the shingles of a text, run by run."""
    digest, before, seen = xxhash.xxh64_intdigest, [], False
    for words in wordruns.runs(text, table):
        words = before + words
        if len(words) >= size:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-size] + 1])
            seen = True
            yield [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1:].tolist())]
            before = words[len(words) - size + 1:]
        else:
            before = words
    if not seen and before:
        yield [digest(b" ".join(before), SEED)]


def fingerprint(text: bytes, table: bytes, size: int = WORDS) -> int:
    ones, total = np.zeros(64, np.int64), 0
    for hashes in _shingle_hashes(text, table, size):
        total += len(hashes)
        found = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(found, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def _fingerprints(size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = wordruns.folding(SPACES)
        for batch in batches:
            found = np.array([fingerprint(t, table, size) for t in wordruns.texts(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return task


# --- buckets -----------------------------------------------------------------------------------

def pair_masks(fixed: int, radius: int) -> list[int]:
    """`fixed` (bits already equal) with every pair of blocks of the other bits: keys of which two close fingerprints share one."""
    bits = [i for i in range(64) if not fixed >> i & 1]
    n = radius + 2
    blocks = [sum(1 << i for i in bits[len(bits) * k // n:len(bits) * (k + 1) // n]) for k in range(n)]
    return [fixed | a | b for a, b in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keyed(rows: DataFrame, masks: list[int]) -> DataFrame:
    """One row (mask number, key, fp) for each mask; the number is that of `masks`."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("k"))
                               for i, mask in enumerate(masks)]))
    return rows.select("fp", each.alias("x")).select("x.m", "x.k", "fp")


def buckets(fps: DataFrame, radius: int, limit: int = LIMIT) -> list[tuple[DataFrame, list[int]]]:
    """[(m, k, fp) rows of buckets to compare, and the masks that m counts]: one entry a level of splitting."""
    out, masks = [], pair_masks(0, radius)
    rows = _keyed(fps, masks)
    while True:
        rows = shared.written(rows, "buckets")
        sizes = rows.groupBy("m", "k").count().where("count > 1")
        whole = all(64 - mask.bit_count() <= OPEN for mask in masks)
        wide = [i for i, mask in enumerate(masks) if 64 - mask.bit_count() > OPEN]
        # not every mask leaves equally many bits open, so some are ready before others
        ready = (F.col("count") <= limit) | ~F.col("m").isin(wide)
        small = sizes.where(F.lit(True) if whole else ready)
        out.append((skew_join(rows, small.select("m", "k"), ["m", "k"], "inner", spread=["fp"]), masks))
        large = None if whole else sizes.where(~ready).select("m", "k")
        if large is None or not large.limit(1).count():
            return out
        finer = [pair_masks(mask, radius) for mask in masks]
        per = len(finer[0])
        crowded = skew_join(rows, large, ["m", "k"], "inner", spread=["fp"])
        masks = [m for group in finer for m in group]
        number = F.explode(F.sequence(F.col("m") * per, F.col("m") * per + (per - 1)))
        table = F.array(*[F.lit(_signed(m)) for m in masks])
        crowded = crowded.select("fp", number.alias("m"))
        rows = crowded.select("m", F.col("fp").bitwiseAND(F.get(table, F.col("m"))).alias("k"), "fp")


# --- comparison --------------------------------------------------------------------------------

def planes(values: np.ndarray) -> np.ndarray:
    """(64, words) bit planes; bit i % 64 of word i // 64 of plane j is bit j of value i. A word of zeros follows."""
    words = -(-len(values) // 64)
    padded = np.zeros(64 * words, np.uint64)
    padded[:len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")  # a row per value
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)
    return np.concatenate([packed, np.zeros((64, 1), np.uint64)], axis=1)


def _moved(plane: np.ndarray, at: np.ndarray, by: int) -> np.ndarray:
    """Words `at` of a plane, `by` (0-63) bits further on."""
    if not by:
        return plane[at]
    return (plane[at] >> np.uint64(by)) | (plane[at + 1] << np.uint64(64 - by))


def within(stored: np.ndarray, ok: np.ndarray, shift: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, lanes) of the values that differ from the value `shift` places on in at most `radius` bits.

    `ok` has the lanes to compare, a word for each 64 values; words without any are never looked at.
    """
    whole, by = divmod(shift, 64)
    at = np.flatnonzero(ok)
    live = ok[at]
    width = (radius + 1).bit_length()
    counters = np.zeros((width, len(at)), np.uint64)
    over = ~live
    for j in range(64):
        if not len(at):
            break
        carry = stored[j, at] ^ _moved(stored[j], at + whole, by)
        for c in range(width):  # add one bit to each lane's counter
            carry, counters[c] = carry & counters[c], carry ^ counters[c]
        over |= carry
        if j % 4 == 3:
            over |= _exceeds(counters, radius)
            keep = over != FULL
            if not keep.all():
                at, live, over, counters = at[keep], live[keep], over[keep], counters[:, keep]
    return at, ~over & live


def _exceeds(counters: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is above `radius`: compared from the highest bit down."""
    above, equal = np.zeros(counters.shape[1], np.uint64), np.full(counters.shape[1], FULL)
    for c in range(len(counters) - 1, -1, -1):
        if radius >> c & 1:
            equal &= counters[c]
        else:
            above |= equal & counters[c]
            equal &= ~counters[c]
    return above


def forest(fps: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """(n, 2) links between values at most `radius` bits apart, inside runs of equal `group`; enough to connect whatever is connected."""
    n = len(fps)
    _, sizes = np.unique(group, return_counts=True)
    stored = planes(fps)
    words = stored.shape[1] - 1
    parent = np.arange(n)
    out = []
    for shift in range(1, int(sizes.max())):
        same = np.zeros(64 * words, bool)
        same[:n - shift] = group[:-shift] == group[shift:]
        at, lanes = within(stored, np.packbits(same, bitorder="little").view(np.uint64), shift, radius)
        if not len(at):
            continue
        bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
        w, lane = np.nonzero(bits)
        first = at[w] * 64 + lane
        for a in first.tolist():
            x, y = _root(parent, a), _root(parent, a + shift)
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((a, a + shift))
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return fps[pairs]


def _root(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _linked(radius: int):
    def compared(m: np.ndarray, k: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        new = np.concatenate([[True], (m[1:] != m[:-1]) | (k[1:] != k[:-1])])
        links = forest(fp.view(np.uint64), np.cumsum(new), radius).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            n += len(batch)
            if n < CHUNK:
                continue
            m, k, fp = (np.concatenate(x) for x in zip(*held))
            # the last bucket may go on in the next batch
            cut = int(np.flatnonzero((m != m[-1]) | (k != k[-1]))[-1]) + 1 if m[0] != m[-1] or k[0] != k[-1] else 0
            if cut:
                yield compared(m[:cut], k[:cut], fp[:cut])
            held, n = [[m[cut:], k[cut:], fp[cut:]]], len(m) - cut
        if n:
            yield compared(*(np.concatenate(x) for x in zip(*held)))

    return task


# --- documents ---------------------------------------------------------------------------------

def link(docs: DataFrame, radius: int = 2, size: int = WORDS, limit: int = LIMIT) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of `docs` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = shared.written(docs.mapInArrow(_fingerprints(size), "doc_id long, fp long"), "prints")
    links = None
    for rows, _ in buckets(prints.select("fp").distinct(), radius, limit):
        dealt = rows.repartition("m", "k").sortWithinPartitions("m", "k", "fp")
        found = shared.written(dealt.mapInArrow(_linked(radius), "a long, b long"), "links")
        links = found if links is None else links.unionByName(found)
    several = prints.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b")
    repeated = skew_join(prints.distinct(), several.select("doc_id", "a"), ["doc_id"], "inner", spread=["fp"])
    same = repeated.select("a", F.col("fp").alias("b")).where("a <> b")
    roots = shared.written(graphs.components(links.unionByName(same)), "roots")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    placed = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = shared.written(placed, "placed")
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = skew_join(placed, named, ["root"], "inner", spread=["fp"]).select("fp", "component_id")
    out = skew_join(prints, by_print, ["fp"], "inner", spread=["doc_id"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
