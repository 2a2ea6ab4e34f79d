"""Collocations by best-first branch-and-bound growth of phrases.

Per language, phrases of two and three words are grown from their beginnings. Counts of what is known bound the scores of
what is not, and phrases are counted only while their bound can still reach the answer:

1. Words are counted. A word's bound is the highest score there is (a pair may occur as often as its first word), so every
   word of at least `least` occurrences is expanded: pairs of such words are counted.
2. A triple occurs at most as often as its first pair, and cutting it after the first word leaves a rest that occurs at
   least as often as the triple; so its score is at most f(first two words) / f(first word), and likewise at most
   f(last two words) / f(last word). The frontier holds the pairs by bound. All whose bound reaches `floor` are expanded,
   best first: triples are counted that both bounds let reach the floor, and those that contain a pair that itself
   scores that much, because they may remove it.
3. Every phrase of at least that score is then settled. A language that has `top` of them is done; for the others the
   floor goes down, until nothing is left to expand. Ties of the last place all lie at or above the floor.

Two word tables of fixed size keep phrases that cannot matter out of the shuffles: 2^24 slots of flags by hash, an upper
bound of what is to be counted (a slot may be set by another word or pair; that costs rows, never changes a result).
Counts are combined inside tasks before they are shuffled, so a hot phrase is one row a task. Words are compared by 64-bit
hashes with their language; scores are computed in decimals of 38 digits.

A null text counts as empty, a null lang as `und`. Rows that repeat a doc_id or a text each count. Other columns are
ignored; without documents, or without a phrase that is frequent enough, there are no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfold.llm import shared, textcore
from docfold.operators.skew import skew_join

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What ends a piece, and what else lies between words.
STOPS, SPACES = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
SLOT_BITS, CHUNKS = 24, 64
FLUSH = 1 << 20  # phrases held in a task before they are combined
KNOWN, PREFIX, SUFFIX, SCORED = 1, 2, 4, 8
FEW_LANGUAGES = 10_000  # so many rows of a table by language are broadcast at most
_PAIR = np.uint64(0xD1342543DE82EF95)


# --- words of texts ----------------------------------------------------------------------------

class Pieces:
    """Words with their language, and which of them follow each other in a piece. One object per task."""

    def __init__(self) -> None:
        self.words = textcore.Words()
        self.words.space = np.zeros(256, bool)
        self.words.space[list(STOPS + SPACES)] = True
        self.stop = np.zeros(256, bool)
        self.stop[list(STOPS)] = True

    def read(self, texts: pa.Array, langs: np.ndarray):
        """(hashes, starts, ends, row, joined, bytes) for runs of rows; joined[i]: word i + 1 follows word i in one piece."""
        for a, _, data, offs in textcore.pieces(texts):
            starts, ends = self.words.spans(data, offs)
            if not len(starts):
                continue
            h, at = self.words.hashes(data, offs)
            row = np.repeat(np.arange(len(offs) - 1), np.diff(at))
            h = textcore.mix(h + langs[a + row].view(np.uint64) * _PAIR)
            stops = np.concatenate([[0], np.cumsum(self.stop[data])])
            joined = (stops[starts[1:]] == stops[ends[:-1]]) & (row[1:] == row[:-1])
            yield h, starts, ends, a + row, joined, data


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return textcore.mix(first * _PAIR + second)


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, word, h, n: the words of each batch. Only a word's first text is held."""
    pieces = Pieces()
    lower = pieces.words.lower
    for batch in batches:
        langs = batch.column(1).to_numpy(zero_copy_only=False)
        seen, place, total = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        hashes, rows, texts = [], [], []
        for h, starts, ends, row, _, data in pieces.read(batch.column(2), langs):
            u, first, n = np.unique(h, return_index=True, return_counts=True)
            at = np.searchsorted(seen, u)
            known = np.zeros(len(u), bool)
            inside = at < len(seen)
            known[inside] = seen[at[inside]] == u[inside]
            total[place[at[known]]] += n[known]
            fresh = ~known
            place = np.insert(place, at[fresh], np.arange(len(total), len(total) + int(fresh.sum())))
            seen = np.insert(seen, at[fresh], u[fresh])
            total = np.concatenate([total, n[fresh]])
            first, text = first[fresh], lower[data].tobytes()
            hashes.append(u[fresh])
            rows.append(row[first])
            texts += [text[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        if hashes:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.concatenate(rows))), pa.array(texts, pa.string()), pa.array(np.concatenate(hashes).view(np.int64)),
                 pa.array(total)], names=["lang", "word", "h", "n"])


class _Combined:
    """Rows of hashes with counts, combined before they leave the task."""

    def __init__(self, size: int) -> None:
        self.size, self.held, self.n = size, [], 0

    def add(self, keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if len(keys[0]):
            self.held.append(keys)
            self.n += len(keys[0])
        if self.n >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        keys = [np.concatenate(k) for k in zip(*self.held)]
        self.held, self.n = [], 0
        code = keys[0]
        for k in keys[1:]:
            code = pair_hash(code, k)
        order = np.argsort(code)
        del code
        new = np.zeros(len(order), bool)
        new[0] = True
        for i in range(len(keys)):  # one at a time: no second copy of all
            keys[i] = keys[i][order]
            new[1:] |= keys[i][1:] != keys[i][:-1]
        del order
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(new)))
        for i in range(len(keys)):
            keys[i] = keys[i][at].view(np.int64)
        del new, at
        for a in range(0, len(counts), 1 << 16):
            part = slice(a, a + (1 << 16))
            yield pa.RecordBatch.from_arrays([*[pa.array(k[part]) for k in keys], pa.array(counts[part].astype(np.int64))],
                                             names=[*[f"h{i + 1}" for i in range(self.size)], "n"])


def _pairs(table):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, out, flags = Pieces(), _Combined(2), table.value
        for batch in batches:
            langs = batch.column(1).to_numpy(zero_copy_only=False)
            for h, _, _, _, joined, _ in pieces.read(batch.column(2), langs):
                known = flags[_slot(h)] != 0
                at = np.flatnonzero(joined & known[1:] & known[:-1])
                yield from out.add([h[at], h[at + 1]])
        yield from out.flush()

    return task


def _triples(table):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, out, flags = Pieces(), _Combined(3), table.value
        for batch in batches:
            langs = batch.column(1).to_numpy(zero_copy_only=False)
            for h, _, _, _, joined, _ in pieces.read(batch.column(2), langs):
                if len(h) < 3:
                    continue
                f = np.where(joined, flags[_slot(pair_hash(h[:-1], h[1:]))], 0)
                first, last = f[:-1], f[1:]
                both = (first & last & KNOWN) != 0
                reach = ((first & PREFIX) != 0) & ((last & SUFFIX) != 0)
                at = np.flatnonzero(both & (reach | (((first | last) & SCORED) != 0)))
                yield from out.add([h[at], h[at + 1], h[at + 2]])
        yield from out.flush()

    return task


# --- tables of flags ---------------------------------------------------------------------------

def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The flags of a task's rows (flags, h1 and, for pairs, h2) as chunks of the table."""
    table = np.zeros(1 << SLOT_BITS, np.uint8)
    for batch in batches:
        flags = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint8)
        h = [c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns[1:]]
        np.bitwise_or.at(table, _slot(h[0] if len(h) == 1 else pair_hash(*h)), flags)
    parts = table.reshape(CHUNKS, -1)
    used = np.flatnonzero(parts.any(axis=1))
    yield pa.RecordBatch.from_pydict({"chunk": pa.array(used, pa.int32()), "flags": [parts[i].tobytes() for i in used]})


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, flags in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            got = np.frombuffer(flags, np.uint8)
            parts[chunk] = parts[chunk] | got if chunk in parts else got
    if parts:
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(parts), pa.int32()), "flags": [x.tobytes() for x in parts.values()]})


def flag_table(rows: DataFrame):
    """A broadcast table of 2^SLOT_BITS bytes, whatever the number of `rows` (flags, h1[, h2])."""
    schema, table = "chunk int, flags binary", np.zeros((CHUNKS, (1 << SLOT_BITS) // CHUNKS), np.uint8)
    # few tasks make tables, each of which may be as large as the whole
    found = rows.coalesce(64).mapInArrow(textcore.tidy(_slots), schema).repartition(16, "chunk").mapInArrow(_merged, schema)
    for row in found.collect():
        table[row.chunk] |= np.frombuffer(row["flags"], np.uint8)
    return rows.sparkSession.sparkContext.broadcast(table.ravel())


# --- scores ------------------------------------------------------------------------------------

def score(a: str, first: str, rest: str) -> Column:
    """floor(1000000 a a / (first rest)), in whole numbers of up to 38 digits."""
    return F.expr(f"CAST((1000000BD * CAST({a} AS DECIMAL(15,0)) * CAST({a} AS DECIMAL(15,0))) DIV "
                  f"(CAST({first} AS DECIMAL(15,0)) * CAST({rest} AS DECIMAL(15,0))) AS BIGINT)")


def by_language(rows: DataFrame, table: DataFrame, languages: int, spread: list[str]) -> DataFrame:
    """`rows` with the columns of `table`, one row a language."""
    if languages <= FEW_LANGUAGES:
        return rows.join(F.broadcast(table), "lang")
    return skew_join(rows, table, ["lang"], "inner", spread=spread)


def _reached(rows: DataFrame, n: int) -> DataFrame:
    """lang, floor: the score of the n-th best row of each language that has so many. Scores are counted first: a
    language has no more different ones than 1,000,001, however many rows."""
    counts = rows.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("lang").orderBy(F.col("score").desc()))
    return counts.withColumn("upto", upto).where(F.col("upto") >= n).groupBy("lang").agg(F.max("score").alias("floor"))


def _first(rows: DataFrame, n: int, order: list[Column], spread: list[str]) -> DataFrame:
    """The first n rows of each language, numbered; of the first n of each part of a language."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(*spread), F.lit(parts)))
    for keys in (["lang", "_part"], ["lang"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)
    return rows.drop("_part")


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, percent: int = 50, start: int = 3) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of every language.

    A phrase of at least `least` occurrences counts, unless a longer one of at least `percent` % of its occurrences
    contains it. `start`: the first floor is the score of the (`start` * `top`)-th pair; later ones take four times as many.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("lh"), "text")
    found = texts.mapInArrow(textcore.tidy(_words), "lang string, word string, h long, n long")
    words = shared.written(found.groupBy("lang", "word").agg(F.first("h").alias("h"), F.sum("n").alias("f")), "words")
    totals = shared.written(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    languages = totals.count()
    frequent = shared.written(words.where(F.col("f") >= least), "frequent")
    if frequent.isEmpty():
        return docs.sparkSession.createDataFrame([], "lang string, rank int, phrase string, a long, l long, r long, n long, score long")

    table = flag_table(frequent.select(F.lit(KNOWN).cast("tinyint").alias("flags"), "h"))
    pairs = texts.mapInArrow(textcore.tidy(_pairs(table)), "h1 long, h2 long, n long").groupBy("h1", "h2").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    pairs = shared.written(pairs, "pairs")
    table.unpersist()
    # a common word begins many pairs; they are narrow rows, and adaptive execution splits such a key's partition
    pairs = pairs.join(frequent.select(F.col("h").alias("h1"), "lang", F.col("f").alias("l")), "h1")
    pairs = pairs.join(frequent.select(F.col("h").alias("h2"), F.col("f").alias("r")), "h2")
    ratio = "CAST(floor(1000000BD * CAST(a AS DECIMAL(18,0)) / {0}) AS BIGINT)"
    # the bounds of triples that begin, or end, with the pair; rounded up by one, which only ever counts more
    pairs = shared.written(pairs.select(
        "lang", "h1", "h2", "a", "l", "r", score("a", "l", "r").alias("score"),
        (F.expr(ratio.format("l")) + 1).alias("begins"), (F.expr(ratio.format("r")) + 1).alias("ends")), "scored")

    open_ = shared.written(totals.select("lang").distinct(), "open")
    settled, wanted = None, start * top
    while True:
        # floor: the score of the wanted-th pair, or 0 where there are fewer
        last = _reached(by_language(pairs.select("lang", "score"), open_, languages, ["score"]), wanted)
        floors = shared.written(open_.join(last, "lang", "left").select("lang", F.coalesce("floor", F.lit(0)).alias("floor")), "floors")
        near = by_language(pairs, floors, languages, ["h1", "h2"])
        near = near.withColumn("own", F.col("score") >= F.col("floor"))
        bit = lambda x, v: F.when(x, F.lit(v)).otherwise(F.lit(0))
        flags = near.select((F.lit(KNOWN) + bit(F.col("begins") >= F.col("floor"), PREFIX) + bit(F.col("ends") >= F.col("floor"), SUFFIX)
                             + bit(F.col("own"), SCORED)).cast("tinyint").alias("flags"), "h1", "h2")
        table = flag_table(flags)
        triples = texts.mapInArrow(textcore.tidy(_triples(table)), "h1 long, h2 long, h3 long, n long")
        triples = shared.written(triples.groupBy("h1", "h2", "h3").agg(F.sum("n").alias("a")).where(F.col("a") >= least), "triples")
        table.unpersist()

        # pairs of the floor's score or more that no triple removes
        inside = (triples.select("h1", "h2", "a").unionByName(triples.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
                  .groupBy("h1", "h2").agg(F.max("a").alias("most")))
        own = near.where("own").join(inside, ["h1", "h2"], "left")
        whole = own.where(~F.coalesce(100 * F.col("most") >= percent * F.col("a"), F.lit(False)))
        whole = whole.select("lang", "floor", "h1", "h2", F.lit(None).cast("long").alias("h3"), "a", "l", "r", "score")
        # triples, by their better known halves: the cut that scores least, the first of equal ones
        front = near.select("h1", "h2", "lang", "floor", F.col("l").alias("f1"), F.col("a").alias("f12"))
        back = near.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"), F.col("r").alias("f3"))
        cut = triples.join(front, ["h1", "h2"]).join(back, ["h2", "h3"])
        cut = cut.withColumn("s1", score("a", "f1", "f23")).withColumn("s2", score("a", "f12", "f3"))
        one = F.col("s1") <= F.col("s2")
        grown = cut.select("lang", "floor", "h1", "h2", "h3", "a", F.when(one, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                           F.when(one, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
        kept = shared.written(whole.unionByName(grown.where(F.col("score") >= F.col("floor"))), "kept")

        counts = floors.join(kept.groupBy("lang").count(), "lang", "left")
        states = shared.written(counts.select("lang", ((F.col("floor") <= 0) | (F.coalesce("count", F.lit(0)) >= top)).alias("done")), "states")
        ready = by_language(kept, states.where("done").select("lang"), languages, ["h1", "h2"]).drop("floor")
        settled = ready if settled is None else settled.unionByName(ready)
        open_ = states.where("NOT done").select("lang")
        if open_.isEmpty():
            break
        wanted *= 4

    # texts of the phrases that reach the last place, ties of which are ordered by count and text
    floors = totals.select("lang", "n").join(_reached(settled, top), "lang", "left")
    best = by_language(settled, floors, languages, ["h1", "h2"]).where("floor IS NULL OR score >= floor").drop("floor")
    for i in (1, 2, 3):
        text = frequent.select(F.col("h").alias(f"h{i}"), F.col("word").alias(f"w{i}"))
        best = best.join(text, f"h{i}", "left")
    best = best.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    out = _first(best, top, [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()], ["phrase"])
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
