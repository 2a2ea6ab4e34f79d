"""Toxicity by weak supervision.

1. Terms: words, word beginnings (4 and 6 bytes) and beginnings that occur twice or more. Those count whose numbers in
   toxic and other labelled documents differ by a log-likelihood ratio of at least `EVIDENCE`, and that toxic ones hold `PURE`
   times as often; at most `TERMS` of them. Labels come from the learning folds only, from at most `LABELLED`
   documents (those with the smallest hashes of doc_id).
2. Voters: the strongest terms one by one, the others in lexicons by rank, and patterns of writing (shouting, runs of
   exclamation marks). A voter says toxic or abstains, and one more says clean where all others abstain. They vote on
   every document outside the held-out fold; the votes are counted by pattern.
3. Label model: a generative model of a hidden label, fitted to those counts by expectation-maximisation, gives each
   voter's accuracy (how often it speaks on either class); known labels of the learning folds are held fixed. The votes'
   correlations within a class are then estimated, and a voter's weight divided by one plus the sum of its own, so that
   voters that say the same thing count once; fitting goes on with these weights.
4. Classifier: logistic regression on all terms and patterns, trained on the posterior labels of the labelled documents.

A score uses the text alone, all of it. A null or empty text has no term and gets the score of such texts. With no usable
labels every score is 0. Rows that repeat a doc_id are documents of their own; a null doc_id counts as held out; a
document labelled twice is toxic if one label says so. Other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.llm import folds, shared, textcore

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LABELLED, TERMS, EVIDENCE, PURE = 12_000, 2_000, 24.0, 4
SINGLE, LEXICONS = 40, 8
PATTERNS = 3  # half capitals, only capitals, exclamation marks
SILENT = SINGLE + LEXICONS + PATTERNS
VOTERS = SILENT + 1
BEGINNINGS = (4, 6)
TWICE = np.uint64(0x5DEECE66D)  # turns the hash of a beginning into that of its repetition; the first 20 bits stay
ROUNDS, AFTER = 12, 6


class Terms:
    """Hashed words and word beginnings of texts. One object per task."""

    def __init__(self) -> None:
        self.words = textcore.Words()
        ascii_letters = np.zeros(256, bool)
        ascii_letters[65:91] = ascii_letters[97:123] = ascii_letters[128:] = True
        self.words.space = ~ascii_letters

    def kinds(self, data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(hashes, offsets by row) for words and for each length of beginning."""
        w = self.words
        starts, ends = w.spans(data, offs)
        at = np.searchsorted(starts, offs)
        w._grow(len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(w.code[data] * w.power[:len(data)], out=total[1:])
        yield textcore.mix((total[ends] - total[starts]) * w.inverse[starts]), at
        for n in BEGINNINGS:
            long = ends - starts >= n
            s = starts[long]
            yield textcore.mix((total[s + n] - total[s]) * w.inverse[s] + np.uint64(n)), np.concatenate([[0], np.cumsum(long)])[at]

    def patterns(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """PATTERNS columns of booleans."""
        upper = textcore.by_row(np.add, ((data >= 65) & (data <= 90)).astype(np.int64), offs, 0)
        lower = textcore.by_row(np.add, ((data >= 97) & (data <= 122)).astype(np.int64), offs, 0)
        marks = np.zeros(len(data), np.int64)
        marks[1:] = (data[1:] == 33) & (data[:-1] == 33)
        out = np.zeros((len(offs) - 1, PATTERNS), bool)
        out[:, 0] = (upper + lower >= 20) & (2 * upper >= upper + lower)
        out[:, 1] = (upper >= 20) & (lower == 0)
        out[:, 2] = textcore.by_row(np.add, marks, offs, 0) > 0
        return out


class Lexicon:
    """Terms by rank, with a filter over their first 20 bits for quick look-ups."""

    def __init__(self, terms: np.ndarray) -> None:
        ranked = terms.view(np.uint64)
        order = np.argsort(ranked)
        self.sorted, self.rank = ranked[order], order
        self.near = np.zeros(1 << 20, bool)
        self.near[(self.sorted >> np.uint64(44)).astype(np.int64)] = True
        self.size = len(ranked)

    def hits(self, terms: Terms, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, rank of term) pairs."""
        if not self.size:
            return (np.empty(0, np.int64),) * 2
        found = []
        for kind, (h, at) in enumerate(terms.kinds(data, offs)):
            near = np.flatnonzero(self.near[(h >> np.uint64(44)).astype(np.int64)])
            rows, h = np.searchsorted(at, near, "right") - 1, h[near]
            found.append(np.unique(self._pairs(rows, h)))
            if kind:
                pairs, n = np.unique(self._pairs(rows, h ^ TWICE), return_counts=True)
                found.append(pairs[n > 1])
        pairs = np.concatenate(found)
        return pairs // self.size, pairs % self.size

    def _pairs(self, rows: np.ndarray, h: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.sorted, h), self.size - 1)
        same = self.sorted[place] == h
        return rows[same] * self.size + self.rank[place[same]]


def voter_of(rank: np.ndarray) -> np.ndarray:
    return np.where(rank < SINGLE, rank, SINGLE + rank % LEXICONS)


def votes(lexicon: Lexicon, terms: Terms, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One bit per voter and row."""
    rows, rank = lexicon.hits(terms, data, offs)
    bits = np.zeros(len(offs) - 1, np.uint64)
    np.bitwise_or.at(bits, rows, np.uint64(1) << voter_of(rank).astype(np.uint64))
    for j, on in enumerate(terms.patterns(data, offs).T):
        bits[on] |= np.uint64(1 << (SINGLE + LEXICONS + j))
    bits[bits == 0] = np.uint64(1 << SILENT)
    return bits


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, toxic documents and other documents that hold it, from rows (toxic, text)."""
    terms = Terms()
    for batch in batches:
        for a, b, data, offs in textcore.pieces(batch.column(1)):
            toxic = np.asarray(batch.column(0).slice(a, b - a)) > 0
            for kind, (h, at) in enumerate(terms.kinds(data, offs)):
                row = np.repeat(np.arange(b - a), np.diff(at))
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])) if len(h) else order
                again = first[np.diff(np.append(first, len(h))) > 1] if kind else first[:0]
                h, row = np.concatenate([h[first], h[again] ^ TWICE]), np.concatenate([row[first], row[again]])
                values, place = np.unique(h, return_inverse=True)
                ones = np.bincount(place, toxic[row], len(values)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"term": pa.array(values.view(np.int64)), "ones": pa.array(ones),
                                                  "others": pa.array(np.bincount(place, minlength=len(values)) - ones)})


def find_terms(labelled: DataFrame) -> np.ndarray:
    """Hashes of the terms that mark toxic documents, strongest first. `labelled`: toxic, text."""
    n1, n0 = labelled.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*") - F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n1 or not n0:
        return np.empty(0, np.int64)
    rows = labelled.select("toxic", "text").mapInArrow(textcore.tidy(counted), "term long, ones long, others long")
    rows = rows.groupBy("term").agg(F.sum("ones").alias("a"), F.sum("others").alias("b")).where("a > 2")
    rate = (F.col("a") + F.col("b")) / (n1 + n0)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    llr = 2 * (part(F.col("a"), n1 * rate) + part(F.col("b"), n0 * rate) + part(n1 - F.col("a"), n1 * (1 - rate)) + part(n0 - F.col("b"), n0 * (1 - rate)))
    rows = rows.withColumn("llr", llr).where((F.col("llr") >= EVIDENCE) & (F.col("a") / n1 >= PURE * F.col("b") / n0) & (F.col("a") >= PURE * F.col("b")))
    return np.array([r["term"] for r in rows.orderBy(F.desc("llr"), "term").limit(TERMS).collect()], np.int64)


def voted(sent) -> Callable:
    """Counts of (votes, label) from rows (label or null, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, lexicon = Terms(), Lexicon(sent.value)
        for batch in batches:
            label = np.asarray(batch.column(0).fill_null(-1)).astype(np.int64)
            for a, b, data, offs in textcore.pieces(batch.column(1)):
                keys, n = np.unique(np.stack([votes(lexicon, terms, data, offs).view(np.int64), label[a:b]]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_pydict({"votes": pa.array(keys[0]), "label": pa.array(keys[1]), "n": pa.array(n.astype(np.int64))})

    return task


class LabelModel:
    """P(toxic), and per class how often each voter speaks; weight: 1 / (1 + correlations). An abstention tells nothing."""

    def __init__(self) -> None:
        self.prior, self.speaks, self.weight = 0.05, None, np.ones(VOTERS)

    def posterior(self, bits: np.ndarray) -> np.ndarray:
        """bits: rows x voters."""
        if self.speaks is None:  # to begin with, one voice or more
            return np.where(bits[:, SILENT] > 0, 0.02, 0.9)
        score = np.log(self.prior / (1 - self.prior)) + bits @ (self.weight * np.log(self.speaks[1] / self.speaks[0]))
        return 1 / (1 + np.exp(-np.clip(score, -50, 50)))


def unpacked(values: np.ndarray) -> np.ndarray:
    return ((values.view(np.uint64)[:, None] >> np.arange(VOTERS, dtype=np.uint64)) & np.uint64(1)).astype(float)


def expectations(model: LabelModel) -> Callable:
    """Sums for one step: per class the mass, each voter's mass and each pair's mass."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass, single, pair = np.zeros(2), np.zeros((2, VOTERS)), np.zeros((2, VOTERS, VOTERS))
        for batch in batches:
            bits, label, n = unpacked(np.asarray(batch.column(0))), np.asarray(batch.column(1)), np.asarray(batch.column(2))
            p = np.where(label >= 0, np.clip(label, 0, 1), model.posterior(bits))
            for y, w in ((0, (1 - p) * n), (1, p * n)):
                mass[y] += w.sum()
                single[y] += w @ bits
                pair[y] += (bits * w[:, None]).T @ bits
        yield pa.RecordBatch.from_pydict({"sums": pa.array([np.concatenate([mass, single.ravel(), pair.ravel()]).tobytes()], pa.binary())})

    return task


def fit_labels(patterns: DataFrame) -> LabelModel:
    """`patterns`: votes, label (-1: unknown), n. Every step is one pass over them; the driver sees sums of fixed size."""
    model = LabelModel()
    for step in range(ROUNDS + AFTER):
        parts = patterns.mapInArrow(expectations(model), "sums binary").collect()
        sums = np.sum([np.frombuffer(r["sums"]) for r in parts], axis=0) if parts else np.zeros(2 + 2 * VOTERS + 2 * VOTERS ** 2)
        mass, single, pair = sums[:2], sums[2:2 + 2 * VOTERS].reshape(2, VOTERS), sums[2 + 2 * VOTERS:].reshape(2, VOTERS, VOTERS)
        model.prior = float(np.clip((mass[1] + 1) / (mass.sum() + 2), 1e-4, 0.5))
        speaks = (single + 0.1) / (mass[:, None] + 1)
        speaks[1, :SILENT] = np.maximum(speaks[1], speaks[0])[:SILENT]  # a voter says toxic or nothing
        model.speaks = speaks
        if step == ROUNDS - 1:
            q = speaks[1]
            covariance = pair[1] / max(mass[1], 1e-9) - q[:, None] * q
            spread = np.sqrt(np.maximum(q * (1 - q), 1e-9))
            correlation = np.clip(covariance / spread[:, None] / spread, 0, 1)
            np.fill_diagonal(correlation, 0)
            correlation[correlation < 0.1] = 0
            model.weight = 1 / (1 + correlation.sum(axis=1))
    return model


class Classifier:
    """Logistic regression on terms and patterns."""

    def __init__(self, size: int, weights: np.ndarray | None = None, bias: float = -np.inf) -> None:
        self.size, self.weights, self.bias = size, np.zeros(size + PATTERNS) if weights is None else weights, bias

    def score(self, rows: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-(np.bincount(rows, self.weights[columns], n) + self.bias)))

    def fit(self, rows: np.ndarray, columns: np.ndarray, y: np.ndarray, steps: int = 1500, rate: float = 0.1, decay: float = 1e-4) -> None:
        """Adam on the mean log loss against soft labels."""
        self.bias = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        m = v = np.zeros(len(self.weights) + 1)
        for t in range(1, steps + 1):
            off = self.score(rows, columns, len(y)) - y
            g = np.append(np.bincount(columns, off[rows], len(self.weights)), off.sum()) / len(y)
            g[:-1] += decay * self.weights
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            self.weights, self.bias = self.weights - step[:-1], self.bias - step[-1]


def columns_of(lexicon: Lexicon, terms: Terms, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows, rank = lexicon.hits(terms, data, offs)
    more, which = np.nonzero(terms.patterns(data, offs))
    return np.concatenate([rows, more]), np.concatenate([rank, lexicon.size + which])


def featured(sent) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, lexicon = Terms(), Lexicon(sent.value)
        for batch in batches:
            for a, b, data, offs in textcore.pieces(batch.column(2)):
                rows, columns = columns_of(lexicon, terms, data, offs)
                order = np.argsort(rows, kind="stable")
                at = np.searchsorted(rows[order], np.arange(b - a + 1))
                columns = columns[order].astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(a, b - a), "label": pa.array(np.asarray(batch.column(1).slice(a, b - a)).astype(np.int64)),
                    "votes": pa.array(votes(lexicon, terms, data, offs).view(np.int64)),
                    "columns": pa.array([columns[x:y].tobytes() for x, y in zip(at[:-1], at[1:])], pa.binary())})

    return task


def learn(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Terms, weights and bias."""
    spark = docs.sparkSession
    known = labels.where(F.col("toxic").isNotNull() & ~folds.held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(F.col("toxic").cast("long")).alias("toxic"))
    known = shared.written(folds.sample(known, LABELLED), "labels")  # at most LABELLED rows
    texts = docs.select("doc_id", "text").where(~folds.held_out(F.col("doc_id")))
    labelled = texts.join(F.broadcast(known), "doc_id")
    found = find_terms(labelled)
    lexicon, sent = Lexicon(found), spark.sparkContext.broadcast(found)
    patterns = (texts.join(F.broadcast(known), "doc_id", "left").select("toxic", "text").mapInArrow(textcore.tidy(voted(sent)), "votes long, label long, n long")
                .groupBy("votes", "label").agg(F.sum("n").alias("n")))
    model = fit_labels(shared.written(patterns, "votes"))
    rows = labelled.select("doc_id", "toxic", "text").mapInArrow(textcore.tidy(featured(sent)), "doc_id long, label long, votes long, columns binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["votes"]))
    classifier = Classifier(lexicon.size)
    if rows and lexicon.size:
        columns = [np.frombuffer(r["columns"], np.int32) for r in rows]
        # posterior of the votes and of the label, which is a voter that is nearly always right
        vote = model.posterior(unpacked(np.array([r["votes"] for r in rows], np.int64)))
        label = np.where(np.array([r["label"] for r in rows]) > 0, 0.98, 0.02)
        y = vote * label / (vote * label + (1 - vote) * (1 - label))
        classifier.fit(np.repeat(np.arange(len(rows)), [len(c) for c in columns]), np.concatenate(columns), y)
    return found, classifier.weights, classifier.bias


def scored(sent) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, (found, weights, bias) = Terms(), sent.value
        lexicon, classifier = Lexicon(found), Classifier(len(found), weights, bias)
        for batch in batches:
            scores = [np.empty(0)]
            for a, b, data, offs in textcore.pieces(batch.column(0)):
                scores.append(classifier.score(*columns_of(lexicon, terms, data, offs), b - a))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(np.concatenate(scores))], names=[*batch.schema.names[1:], "score"])

    return task


def score(docs: DataFrame, learned: tuple[np.ndarray, np.ndarray, float], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of `docs`, score and predicted. Name text twice to keep it: it is read once and passed on."""
    sent = docs.sparkSession.sparkContext.broadcast(learned)
    rows = docs.select(F.col("text").alias("_text"), *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]) + ", score double"
    return rows.mapInArrow(textcore.tidy(scored(sent)), schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
