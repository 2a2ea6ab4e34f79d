"""Line deduplication by an exact set-similarity join.

A line (split at \\n) is the set of its words, A-Z lower-cased. Two lines match at Jaccard >= 0.8. Of two matching lines
the later one is removed: order is doc_id, then line number; a line goes if any earlier line matches it, whether or not
that one is itself kept. Lines of fewer than `min_words` distinct words are left alone; the query and the pipeline ask for
1, so that only lines without words are.

1. Word counts over all documents go into a table of 2^20 buckets (4 MB, whatever the corpus), which orders words by
   rarity; words of equal count are ordered by hash. Any order gives right results, a rare-first one short lists.
2. Lines with equal sets: the first stays, the others go. Each task settles the copies it meets and deals one line of each
   set on by set hash, where the firsts of all tasks meet; so a common line is one row a block of lines. Sets of fewer than
   four words match equal ones only, so they are not indexed.
3. Each line puts the words of its prefix (n - ceil(0.8 n) + 1 rarest ones) into an index that is dealt by word hash.
   Entries of a word meet under the length filter, the positional filter and a parity bitmap (the differing bits cannot
   outnumber the differing words). A line is paired with the first two earlier lines that pass, for each word.
4. Pairs are verified on the full sets. A line that had more partners, and none that matched, gets all of them in a
   second round, which few lines reach; so no match is lost, and copies are not expanded into all pairs.

Words and sets are compared by 64-bit hashes. A null text has no lines, and stays null. A null doc_id orders last. Rows
repeating doc_id and text are the same lines and treated alike. Other columns pass through.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.llm import shared, textcore

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLE_BITS, CHUNKS = 20, 16
MIN_WORDS = 5
INDEXED = 4  # words of the smallest set that matches another than itself (4 of 5 words)
LAST = (1 << 63) - 1
ENTRY = np.dtype([("word", "<u4"), ("id", "<i8"), ("line", "<i4"), ("n", "<u4"), ("pos", "<u2"), ("key", "<u4"), ("parity", "<u8")])
LINE = np.dtype([("id", "<i8"), ("text", "<i8"), ("line", "<i4"), ("n", "<i4"), ("key", "<i8")])
LONG = 48  # lines of so many words or more have a parity bitmap of 128 bits, others of 64
FLUSH = 1 << 20  # words held back in a task
HELD = 1 << 18  # entries and lines held back in a task, of 34 or 42 and 32 bytes each; dealing them out takes twice as much
BATCHES = 8  # in which they leave it
FILTER_BITS = (23, 26)  # least and most bits of a filter, as a power of two: eight a row, 1 to 8 MB
PARTNERS = 2
FEW = 1 << 20  # documents of the second round that are picked by a broadcast of their ids; more are picked in the tasks
MANY = 1 << 17  # lines to remove from which on they are too many for a broadcast, and texts are dealt out to meet them


def line_offsets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets of all lines, row of each line, line number within its row)."""
    breaks = np.flatnonzero(data == 10)
    per_row = np.diff(np.searchsorted(breaks, offs)) + 1
    starts = np.sort(np.concatenate([offs[:-1], breaks + 1]))
    first = np.concatenate([[0], np.cumsum(per_row)])
    row = np.repeat(np.arange(len(per_row)), per_row)
    return np.append(starts, len(data)), row, np.arange(len(row)) - first[row]


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, table = textcore.Words(), np.zeros(1 << TABLE_BITS, np.int64)
    for batch in batches:
        found, held = [], 0
        for _, b, data, offs in textcore.pieces(batch.column(0)):
            found.append((words.hashes(data, offs)[0] >> np.uint64(64 - TABLE_BITS)).astype(np.int64))
            held += len(found[-1])
            if held >= FLUSH or b == len(batch):
                table += np.bincount(np.concatenate(found), minlength=len(table))
                found, held = [], 0
    yield _chunks(table)


def _chunks(table: np.ndarray) -> pa.RecordBatch:
    parts = table.reshape(CHUNKS, -1)
    return pa.RecordBatch.from_pydict({"chunk": pa.array(range(CHUNKS), pa.int32()), "counts": [p.tobytes() for p in parts]})


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            got = np.frombuffer(counts, np.int64)
            sums[chunk] = sums[chunk] + got if chunk in sums else got
    if sums:
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(sums), pa.int32()), "counts": [x.tobytes() for x in sums.values()]})


def word_counts(docs: DataFrame) -> np.ndarray:
    """Counts of the words of all documents by hash bucket; a table of fixed size."""
    schema = "chunk int, counts binary"
    rows = docs.select("text").mapInArrow(textcore.tidy(counted), schema).repartition(CHUNKS, "chunk").mapInArrow(summed, schema).collect()
    table = np.zeros((CHUNKS, (1 << TABLE_BITS) // CHUNKS), np.int64)
    for r in rows:
        table[r["chunk"]] += np.frombuffer(r["counts"], np.int64)
    return table.ravel()


def word_sets(words: textcore.Words, rank: np.ndarray, data: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words of each line as sorted rarity keys, offsets by line). A key is 24 bits of count, 40 of hash."""
    h, at = words.hashes(data, lines)
    keys = (rank[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] << np.uint64(40)) | (h & np.uint64((1 << 40) - 1))
    return textcore.unique_by_row(keys, at)


def firsts(lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the earliest line of each set of words, once; the lines that come after it), of rows of LINE."""
    order = np.argsort(np.ascontiguousarray(lines["key"]))
    key = lines["key"][order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    several = same[1:] | same[:-1]
    some = lines[order[several]]
    some = some[np.lexsort((some["text"], some["line"], some["id"], some["n"], some["key"]))]
    new, later = np.ones(len(some), bool), np.zeros(len(some), bool)
    new[1:] = (some["key"][1:] != some["key"][:-1]) | (some["n"][1:] != some["n"][:-1])
    first = some[np.flatnonzero(new)[np.cumsum(new) - 1]]
    for name in ("id", "line", "text"):
        later |= some[name] != first[name]
    return np.concatenate([lines[order[~several]], some[new]]), some[later]


def needed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least overlap of sets of sizes a and b at Jaccard 0.8: ceil(4 (a + b) / 9)."""
    return (4 * (a + b) + 8) // 9


def packed(e: np.ndarray, second: np.ndarray) -> bytes:
    """Entries, and the second halves of the bitmaps of those that have one."""
    return len(e).to_bytes(8, "little") + e.tobytes() + second[e["n"] >= LONG].tobytes()


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    e = np.frombuffer(blob, ENTRY, n, 8)
    second = np.zeros(n, np.uint64)
    second[e["n"] >= LONG] = np.frombuffer(blob, np.uint64, -1, 8 + n * ENTRY.itemsize)
    return e, second


def dealt(by: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by `by` mod `parts`, and where in it each part begins and the last one ends."""
    part = by % by.dtype.type(parts)
    if parts <= 1 << 16:
        part = part.astype(np.uint16)  # sorted by digits
    return np.argsort(part, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(part.astype(np.int64), minlength=parts))])


def indexed(rank, parts: int, min_words: int) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table = textcore.Words(), rank.value
        entries, halves, lines, held = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            # of lines with equal sets the later ones are settled here; one of each set goes on
            first, later = firsts(np.concatenate(lines))
            e, second = np.concatenate(entries), np.concatenate(halves)
            for held in (lines, entries, halves):
                held.clear()
            order, edges = dealt(e["word"], parts)
            line_order, line_edges = dealt(first["key"].view(np.uint64) >> np.uint64(32), parts)
            step = -(-parts // BATCHES)
            for p in range(0, parts, step):
                rows = []
                for q in range(p, min(p + step, parts)):
                    x, some = order[edges[q]:edges[q + 1]], first[line_order[line_edges[q]:line_edges[q + 1]]]
                    gone = later[q * len(later) // parts:(q + 1) * len(later) // parts]
                    if len(x) or len(some) or len(gone):
                        rows.append((q, packed(e[x], second[x]), some.tobytes(), gone.tobytes()))
                if rows:
                    part, *blobs = zip(*rows)
                    yield pa.RecordBatch.from_pydict({"part": pa.array(part, pa.int32()), **{n: pa.array(x, pa.binary()) for n, x in zip(("entries", "lines", "gone"), blobs)}})

        for batch in batches:
            for a, b, data, offs in textcore.pieces(batch.column(2)):
                ids, texts = (np.asarray(batch.column(i).slice(a, b - a)) for i in (0, 1))
                starts, row, number = line_offsets(data, offs)
                keys, at = word_sets(words, table, data, starts)
                n = np.diff(at)
                mixed = textcore.mix(keys)
                key = textcore.by_row(np.add, mixed, at, 0)
                bit, odd = np.uint64(1) << (mixed >> np.uint64(58)), (mixed >> np.uint64(57)) & np.uint64(1)
                parity = textcore.by_row(np.bitwise_xor, bit, at, 0)
                second = np.where(n >= LONG, textcore.by_row(np.bitwise_xor, bit * odd, at, 0), np.uint64(0))
                parity ^= second
                long = n >= max(min_words, 1)
                whole = np.empty(int(long.sum()), LINE)
                whole["id"], whole["text"], whole["line"] = ids[row[long]], texts[row[long]], number[long]
                whole["n"], whole["key"] = n[long], key[long].view(np.int64)
                # copies within a piece need no index entries of their own: the earliest by (id, line) stands for them
                # where ids rise from row to row, lines are in that order already
                order = np.argsort(key, kind="stable") if (ids[1:] > ids[:-1]).all() else np.lexsort((number, ids[row], key))
                alone = np.zeros(len(n), bool)
                alone[order] = np.concatenate([[True], key[order][1:] != key[order][:-1]])
                take = np.where(long & alone & (n >= INDEXED), n - (4 * n + 4) // 5 + 1, 0)
                at_line = np.repeat(np.arange(len(n)), take)
                pos = np.arange(len(at_line)) - np.repeat(np.cumsum(take) - take, take)
                e = np.empty(len(at_line), ENTRY)
                e["word"] = textcore.mix(keys[at[:-1][at_line] + pos]) >> np.uint64(32)
                e["id"], e["line"], e["n"] = ids[row[at_line]], number[at_line], n[at_line]
                e["pos"], e["key"], e["parity"] = np.minimum(pos, 65535), key[at_line] & np.uint64(0xFFFFFFFF), parity[at_line]
                entries.append(e)
                halves.append(second[at_line])
                lines.append(whole)
                held += len(e) + len(whole)
                if held >= HELD:
                    yield from flush()
                    held = 0
        if lines:
            yield from flush()

    return task


def in_order(e: np.ndarray) -> np.ndarray:
    """The order of entries by word, id and line."""
    if len(e) and len(e) < 1 << 32 and 0 <= e["id"].min() and e["id"].max() < 1 << 42 and 0 <= e["line"].min() and e["line"].max() < 1 << 21:
        place = np.empty(len(e), np.uint64)
        place[np.argsort((e["id"] << np.int64(21)) | e["line"])] = np.arange(len(e), dtype=np.uint64)
        return np.argsort((e["word"].astype(np.uint64) << np.uint64(32)) | place)
    return np.lexsort((e["line"], e["id"], e["word"]))


class Groups:
    """Entries of one part, by word, then in order of their lines; equal lines stand once, at the earliest."""

    def __init__(self, e: np.ndarray, second: np.ndarray) -> None:
        word, n, key, parity = (e[x].astype(np.uint64) for x in ("word", "n", "key", "parity"))
        tag = textcore.mix(parity ^ key ^ (n << np.uint64(40)) ^ (second * np.uint64(5)))
        order = np.argsort((word << np.uint64(32)) | (tag >> np.uint64(32)))
        e, second = e[order], second[order]
        if len(e):
            new = np.zeros(len(e), bool)
            new[0] = True
            for x in (*(np.ascontiguousarray(e[name]) for name in ("word", "parity", "key", "n")), second):
                new[1:] |= x[1:] != x[:-1]
            edge = np.flatnonzero(new)
            run = np.cumsum(new) - 1
            ids, lines = np.ascontiguousarray(e["id"]), np.ascontiguousarray(e["line"])
            least = np.minimum.reduceat(ids, edge)
            lines = np.minimum.reduceat(np.where(ids == least[run], lines, np.iinfo(np.int32).max), edge)
            e, second = e[edge], second[edge]
            e["id"], e["line"] = least, lines
            x = np.ascontiguousarray(e["word"])
            beside = x[1:] == x[:-1]
            several = np.concatenate([[False], beside]) | np.concatenate([beside, [False]])
            e, second = e[several], second[several]
        order = in_order(e)
        e, second = e[order], second[order]
        x = np.ascontiguousarray(e["word"])
        edge = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(e) else np.empty(0, np.int64)
        self.e, self.second, self.start = e, second, np.repeat(edge, np.diff(np.append(edge, len(e))))
        self.id, self.line, self.parity = (np.ascontiguousarray(e[x]) for x in ("id", "line", "parity"))
        self.n = e["n"].astype(np.int64)
        self.left = self.n - e["pos"]

    def passes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        m, n = self.n[a], self.n[b]
        least = needed(m, n)
        out = (5 * np.minimum(m, n) >= 4 * np.maximum(m, n)) & (np.minimum(self.left[a], self.left[b]) >= least)
        some = np.flatnonzero(out)
        a, b, m, n, least = (x[some] for x in (a, b, m, n, least))
        one, two = self.parity[a] ^ self.parity[b], self.second[a] ^ self.second[b]
        wide = (m >= LONG) & (n >= LONG)
        # a bitmap of 128 bits folds to the one of 64 bits
        differing = np.where(wide, np.bitwise_count(one).astype(np.int64) + np.bitwise_count(two), np.bitwise_count(one ^ two))
        out[some] = (differing <= m + n - 2 * least) & ((self.id[a] != self.id[b]) | (self.line[a] != self.line[b]))
        return out

    def first_partners(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(earlier entry, entry) for the first PARTNERS that pass, and the entries that may have more."""
        b = np.flatnonzero(np.arange(len(self.e)) > self.start)
        a, count, found, more = self.start[b].copy(), np.zeros(len(b), np.int64), [], []
        while len(b):
            ok = self.passes(a, b)
            found.append((a[ok], b[ok]))
            a, count = a + 1, count + ok
            more.append(b[(count == PARTNERS) & (a < b)])
            keep = (a < b) & (count < PARTNERS)
            a, b, count = a[keep], b[keep], count[keep]
        if not found:
            return (np.empty(0, np.int64),) * 3
        return *(np.concatenate(x) for x in zip(*found)), np.concatenate(more)

    def of_words(self, some: np.ndarray) -> bytes:
        """All entries of the words of the given entries."""
        take = np.isin(self.start, self.start[some])
        return packed(self.e[take], self.second[take])

    def partners_of(self, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All earlier partners of the wanted entries, one step back in the lists at a time."""
        b = np.flatnonzero(wanted)
        a = b - 1
        while True:
            keep = a >= self.start[b]
            a, b = a[keep], b[keep]
            if not len(b):
                return
            ok = self.passes(a, b)
            yield a[ok], b[ok]
            a = a - 1


PAIR = "id long, line int, by_id long, by_line int"
INDEX = "part int, entries binary, lines binary, gone binary"
OUT = f"{PAIR}, text long, entries binary"


def _rows(n: int, **columns) -> pa.RecordBatch:
    """n rows of OUT with the given columns, the others null."""
    types = {"id": pa.int64(), "line": pa.int32(), "by_id": pa.int64(), "by_line": pa.int32(), "text": pa.int64(), "entries": pa.binary()}
    return pa.RecordBatch.from_pydict({k: pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in types.items()})


def _pairs(e: np.ndarray, a: np.ndarray, b: np.ndarray) -> dict[str, np.ndarray]:
    rows = np.unique(np.rec.fromarrays([e["id"][b], e["line"][b], e["id"][a], e["line"][a]], names="id,line,by_id,by_line"))
    return {x: np.ascontiguousarray(rows[x]) for x in rows.dtype.names}


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First partners of the entries of each part; the lists of words with more of them; lines that equal an earlier one."""
    now, held, lines = None, [], []

    def gone(rows):
        return _rows(len(rows), **{x: np.ascontiguousarray(rows[x]) for x in ("id", "line", "text")})

    def close():
        yield gone(firsts(np.concatenate(lines))[1])
        lines.clear()
        g = Groups(*(np.concatenate(x) for x in zip(*held)))
        held.clear()
        a, b, open_entries = g.first_partners()
        pairs = _pairs(g.e, a, b)
        yield _rows(len(pairs["id"]), **pairs)
        if len(open_entries):
            yield _rows(1, entries=[g.of_words(open_entries)])

    for batch in batches:
        for part, *blobs in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
            if part != now and held:
                yield from close()
            now = part
            entries, some, later = (x.as_buffer() for x in blobs)
            held.append(unpack(entries))
            lines.append(np.frombuffer(some, LINE))
            if len(later):
                yield gone(np.frombuffer(later, LINE))
    if held:
        yield from close()


def second(found) -> Callable:
    """All partners of the lines in the filter, from the lists kept by the first round."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                g = Groups(*unpack(x.as_py()))
                for a, b in g.partners_of(in_filter(found.value, spot(g.e["id"], g.e["line"]))):
                    if len(a):
                        yield pa.RecordBatch.from_pydict(_pairs(g.e, a, b))

    return task


def spot(ids: np.ndarray, lines: np.ndarray | int = 0) -> np.ndarray:
    x = np.asarray(ids).astype(np.int64).view(np.uint64)
    return textcore.mix(x * np.uint64(31) + np.asarray(lines).astype(np.uint64))


def in_filter(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h >> np.uint64(64 - (8 * len(bits)).bit_length() + 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _marked(with_line: bool, size: int) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << size, bool)
        for batch in batches:
            h = spot(np.asarray(batch.column(0)), np.asarray(batch.column(1)) if with_line else 0)
            seen[(h >> np.uint64(64 - size)).astype(np.int64)] = True
        parts = np.packbits(seen, bitorder="little").reshape(CHUNKS, -1)
        some = [i for i in range(CHUNKS) if parts[i].any()]
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(some, pa.int32()), "bits": pa.array([parts[i].tobytes() for i in some], pa.binary())})

    return task


def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            got = np.frombuffer(bits, np.uint8)
            parts[chunk] = parts[chunk] | got if chunk in parts else got
    if parts:
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(parts), pa.int32()), "bits": [x.tobytes() for x in parts.values()]})


def membership(rows: DataFrame, with_line: bool) -> np.ndarray:
    """A filter that holds every (id, line), or every id, of `rows`; others pass with small chance. It grows with the rows
    up to 8 MB; beyond 2^23 rows more others pass."""
    schema = "chunk int, bits binary"
    size = min(max(FILTER_BITS[0], (8 * rows.count() - 1).bit_length()), FILTER_BITS[1])
    out = np.zeros((CHUNKS, (1 << size) // 8 // CHUNKS), np.uint8)
    for r in rows.mapInArrow(textcore.tidy(_marked(with_line, size)), schema).repartition(CHUNKS, "chunk").mapInArrow(united, schema).collect():
        out[r["chunk"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def sets_of(rank, docs_in, lines_in) -> Callable:
    """Word sets of the lines in the filters."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table = textcore.Words(), rank.value
        for batch in batches:
            batch = batch.filter(pa.array(in_filter(docs_in.value, spot(np.asarray(batch.column(0))))))
            for a, b, data, offs in textcore.pieces(batch.column(2)):
                ids, texts = (np.asarray(batch.column(i).slice(a, b - a)) for i in (0, 1))
                starts, row, number = line_offsets(data, offs)
                hit = np.flatnonzero(in_filter(lines_in.value, spot(ids[row], number)))
                bytes_of = memoryview(data)
                some = np.frombuffer(b"".join(bytes_of[x:y] for x, y in zip(starts[hit].tolist(), starts[hit + 1].tolist())), np.uint8)
                keys, at = word_sets(words, table, some, np.concatenate([[0], np.cumsum(starts[hit + 1] - starts[hit])]))
                full = np.flatnonzero(np.diff(at) > 0)
                hit = hit[full]
                yield pa.RecordBatch.from_pydict({"id": pa.array(ids[row[hit]]), "text": pa.array(texts[row[hit]]), "line": pa.array(number[hit].astype(np.int32)),
                                                  "words": pa.array([keys[at[i]:at[i + 1]].tobytes() for i in full.tolist()], pa.binary())})

    return task


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text, line of those rows whose two sets have Jaccard >= 0.8."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(3), batch.column(4)):
            p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(5 * both >= 4 * (len(p) + len(q) - both))
        yield batch.select([0, 1, 2]).filter(pa.array(keep, pa.bool_()))


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """id (doc_id, or 2^63 - 1 for null), text (xxhash64 of the text) and line of every line to remove, some more than once."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64("text").alias("key"), "text").where("text IS NOT NULL")
    counts = word_counts(rows)
    rank = spark.sparkContext.broadcast(np.minimum(counts, (1 << 24) - 1).astype(np.uint64))
    deal = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(counts.sum()) // 4_000_000))
    index = rows.mapInArrow(textcore.tidy(indexed(rank, 4 * deal, min_words)), INDEX).repartition(deal, "part").sortWithinPartitions("part")
    found = shared.written(index.mapInArrow(textcore.tidy(joined), OUT), "line-index")
    gone = shared.written(found.where("text IS NOT NULL").select("id", "text", "line"), "lines")

    def confirm(pairs, few=0):
        ends = pairs.select("id", "line").unionByName(pairs.select(F.col("by_id").alias("id"), F.col("by_line").alias("line")))
        ids = shared.written(ends.select("id").distinct(), "ids")
        near = [spark.sparkContext.broadcast(membership(x, w)) for x, w in ((ids.withColumn("line", F.lit(0)), False), (ends, True))]
        some = rows.join(F.broadcast(ids), "id", "left_semi") if ids.count() <= few else rows
        sets = shared.written(some.mapInArrow(textcore.tidy(sets_of(rank, *near)), "id long, text long, line int, words binary"), "line-sets")
        by = sets.select(F.col("id").alias("by_id"), F.col("line").alias("by_line"), F.col("words").alias("by_words"))
        both = pairs.join(by, ["by_id", "by_line"]).join(sets, ["id", "line"]).select("id", "text", "line", "words", "by_words")
        out = shared.written(both.mapInArrow(textcore.tidy(verified), "id long, text long, line int").distinct(), "lines")
        shared.removed(sets)
        shared.removed(ids)
        return out

    pairs = shared.written(found.where("by_id IS NOT NULL").select("id", "line", "by_id", "by_line").distinct(), "line-pairs")
    near = confirm(pairs)
    # lines that may have had more partners, and none that matched
    settled = near.unionByName(gone).select("id", "line").distinct()
    open_lines = pairs.groupBy("id", "line").count().where(F.col("count") >= PARTNERS).select("id", "line").join(settled, ["id", "line"], "left_anti")
    open_lines = shared.written(open_lines, "open-lines")
    wanted = spark.sparkContext.broadcast(membership(open_lines, True))
    again = found.where("entries IS NOT NULL").select("entries").mapInArrow(textcore.tidy(second(wanted)), PAIR).distinct()
    again = again.join(open_lines, ["id", "line"], "left_semi").join(pairs, ["id", "line", "by_id", "by_line"], "left_anti")
    again = shared.written(again, "line-pairs")
    shared.removed(found)
    out = gone.unionByName(near)
    if again.limit(1).count():
        out = out.unionByName(confirm(again, FEW))
    return out


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with repeated lines taken out of text, and the column `removed_lines`: their numbers, from 0."""
    found = repeats(docs, min_words)
    gone = (found.groupBy(F.col("id").alias("_id"), F.col("text").alias("_key"))
            .agg(F.sort_array(F.collect_set("line")).alias("removed_lines")))
    if found.count() >= MANY:  # one row a document: the texts need no sort
        gone = gone.hint("shuffle_hash")
    given, moved = shared.set_aside(docs, {"_id", "_key", "removed_lines"})
    keyed = docs.select(*given, F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_id"), F.xxhash64("text").alias("_key"))
    out = keyed.join(gone, ["_id", "_key"], "left").drop("_id", "_key", *(new for new, old in moved.items() if old.lower() == "removed_lines"))
    # rebuild only texts that lose lines
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda x, i: ~F.array_contains("removed_lines", i))
    out = out.withColumn("text", F.when(F.col("removed_lines").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text"))).withColumn(
        "removed_lines", F.coalesce("removed_lines", F.array().cast("array<int>")))
    return out.withColumnsRenamed({new: old for new, old in moved.items() if old.lower() != "removed_lines"})
