"""Language of texts by sparse multinomial logistic regression on TF-IDF character n-grams.

Features are n-grams of one to three characters of the lower-cased text, with every run of other characters than letters
as one space, hashed to 2^16 columns; weights are term frequency x inverse document frequency, scaled to length one.

* Document frequencies count all learning documents (one table of fixed size).
* The regression is fitted with follow-the-regularised-leader (per-coordinate steps) under an elastic-net penalty, whose
  L1 part leaves most weights at zero, on at most `PER_LANGUAGE` documents of each language: those with the smallest
  hashes of doc_id. Languages with fewer documents use them all.
* A tenth of these documents sets the temperature that calibrates the probabilities, and takes no part in the fit.

Learning uses text and lang of documents outside the held-out fold. A prediction uses the text alone, all of it. Texts
that are null or hold no letter are `und` with score 0; so are all if nothing could be learned. Ties go to the lang that
is first in code point order. Rows that repeat a doc_id are documents of their own; other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docfold.llm import folds, textcore

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COLUMNS = 1 << 16
ORDERS = 3
PER_LANGUAGE = 600
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.05, 0.01, 3


class Grams:
    """Hashed n-grams of texts. One object per task."""

    def __init__(self) -> None:
        points = np.arange(0x110000, dtype=np.uint32)
        self.lower, self.letter = points, np.zeros(len(points), bool)
        for c in range(0x40000):  # planes from the fourth on hold no letters
            s = chr(c)
            if s.isalpha():
                self.letter[c] = True
                low = s.lower()
                if len(low) == 1 and low != s:
                    self.lower[c] = ord(low)

    def normal(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(characters, offsets by row, whether a row has a letter); each row begins and ends with a space."""
        points, at = textcore.characters(data, offs)
        points = np.minimum(points, 0x10FFFF)
        known = self.letter[points]
        some = textcore.by_row(np.maximum, known.astype(np.uint8), at, 0) > 0
        points = np.where(known, self.lower[points], np.uint32(32))
        points = np.insert(points, np.concatenate([at[:-1], at[1:]]), np.uint32(32))
        at = at + 2 * np.arange(len(at))
        keep = np.ones(len(points), bool)
        keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
        keep[at[:-1]] = True
        return points[keep], np.concatenate([[0], np.cumsum(keep)])[at], some

    def rows(self, data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(columns, counts) of each row; none for a row without letters."""
        c, at, some = self.normal(data, offs)
        c = c.astype(np.uint64)
        hashes, h = [], np.zeros(len(c), np.uint64)
        for order in range(ORDERS):
            if order:
                h = h[:-1]
            h = h * np.uint64(0x100000001B3) + c[order:] + np.uint64(order * 7919)
            hashes.append((textcore.mix(h) >> np.uint64(64 - 16)).astype(np.int64))
        for a, b, ok in zip(at[:-1].tolist(), at[1:].tolist(), some.tolist()):
            if not ok:
                yield np.empty(0, np.int64), np.empty(0)
                continue
            found = np.concatenate([x[a:b - order] for order, x in enumerate(hashes) if b - order > a])
            if len(found) > 20_000:
                counts = np.bincount(found, minlength=COLUMNS)
                columns = np.flatnonzero(counts)
                yield columns, counts[columns].astype(float)
            else:
                found.sort()
                first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
                yield found[first], np.diff(np.append(first, len(found))).astype(float)


def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams, table, n = Grams(), np.zeros(COLUMNS, np.int64), 0
    for batch in batches:
        for _, _, data, offs in textcore.pieces(batch.column(0)):
            for columns, _ in grams.rows(data, offs):
                table[columns] += 1
                n += 1
    parts = table.reshape(16, -1)
    yield pa.RecordBatch.from_pydict({"chunk": pa.array(range(16), pa.int32()), "counts": [p.tobytes() for p in parts], "n": [n] * 16})


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list] = {}
    for batch in batches:
        for chunk, counts, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            now = sums.setdefault(chunk, [0, 0])
            now[0] = now[0] + np.frombuffer(counts, np.int64)
            now[1] += n
    if sums:
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(sums), pa.int32()), "counts": [x[0].tobytes() for x in sums.values()], "n": [x[1] for x in sums.values()]})


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    schema = "chunk int, counts binary, n long"
    rows = texts.mapInArrow(frequencies, schema).repartition(16, "chunk").mapInArrow(merged, schema).collect()
    table, n = np.zeros((16, COLUMNS // 16), np.int64), 0
    for r in rows:
        table[r["chunk"]] += np.frombuffer(r["counts"], np.int64)
        n = max(n, r["n"])
    return np.log((n + 1) / (table.ravel() + 1)) + 1


def scaled(columns: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts * idf[columns]
    return x / max(np.sqrt(x @ x), 1e-12)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, seed: int = 1) -> np.ndarray:
    """Weights (columns x classes) by follow-the-regularised-leader on (columns, values, class) rows."""
    z, n = np.zeros((COLUMNS + 1, classes)), np.zeros((COLUMNS + 1, classes))
    rng = np.random.default_rng(seed)

    def weights(z, n):
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, w, 0.0)

    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            columns, values, y = rows[i]
            columns, values = np.append(columns, COLUMNS), np.append(values, 1.0)
            w = weights(z[columns], n[columns])
            score = values @ w
            p = np.exp(score - score.max())
            p /= p.sum()
            p[y] -= 1
            g = values[:, None] * p
            step = (np.sqrt(n[columns] + g * g) - np.sqrt(n[columns])) / ALPHA
            z[columns] += g - step * w
            n[columns] += g * g
    return weights(z, n)


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the scores that makes the labels likeliest, by golden-section search on its logarithm."""
    def loss(t):
        s = scores / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return (np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean()

    low, high, ratio = -4.0, 4.0, (np.sqrt(5) - 1) / 2
    while high - low > 1e-3:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2)) if len(y) else 1.0


class Model:
    def __init__(self, langs: list[str], weights: np.ndarray, idf: np.ndarray, heat: float) -> None:
        self.langs, self.weights, self.idf, self.heat = langs, weights.astype(np.float32), idf.astype(np.float32), heat


def learn(docs: DataFrame) -> Model | None:
    """None when no document of the learning folds has both a language and a letter."""
    spark = docs.sparkSession
    rows = docs.where(~folds.held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    # the PER_LANGUAGE smallest hashes of each language; ids first, so that texts are read only for those
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id")
    chosen = rows.select("doc_id", "lang").withColumn("r", F.row_number().over(order)).where(F.col("r") <= PER_LANGUAGE).select("doc_id", "lang")
    some = rows.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            for a, b, data, offs in textcore.pieces(batch.column(2)):
                found = list(grams.rows(data, offs))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(a, b - a), "lang": batch.column(1).slice(a, b - a),
                    "columns": pa.array([x[0].astype(np.int32).tobytes() for x in found], pa.binary()), "counts": pa.array([x[1].astype(np.int32).tobytes() for x in found], pa.binary())})

    got = some.select("doc_id", "lang", "text").mapInArrow(features, "doc_id long, lang string, columns binary, counts binary").collect()
    idf = inverse_frequencies(rows.select("text"))
    data = [(r["doc_id"], r["lang"], np.frombuffer(r["columns"], np.int32), np.frombuffer(r["counts"], np.int32)) for r in got]
    data = sorted((x for x in data if len(x[2])), key=lambda x: (x[0], x[1]))
    if not data:
        return None
    langs = sorted({x[1] for x in data})
    ready = [(c, scaled(c, n.astype(float), idf), langs.index(lang)) for _, lang, c, n in data]
    tenth = textcore.mix(np.array([x[0] for x in data], np.int64).view(np.uint64)) % np.uint64(10) == 0
    weights = fit([x for x, t in zip(ready, tenth) if not t] or ready, len(langs))
    left = [x for x, t in zip(ready, tenth) if t]
    scores = np.array([np.append(v, 1.0) @ weights[np.append(c, COLUMNS)] for c, v, _ in left]).reshape(-1, len(langs))
    return Model(langs, weights, idf, temperature(scores, np.array([y for *_, y in left], int)))


def predictor(shared_model) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, model = Grams(), shared_model.value and Model(**shared_model.value)
        for batch in batches:
            for a, b, data, offs in textcore.pieces(batch.column(2)):
                langs, scores = [], []
                for columns, counts in grams.rows(data, offs):
                    if model is None or not len(columns):
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    s = (scaled(columns, counts, model.idf) @ model.weights[columns] + model.weights[COLUMNS]) / model.heat
                    p = np.exp(s - s.max())
                    best = int(np.argmax(p))
                    langs.append(model.langs[best])
                    scores.append(float(p[best] / p.sum()))
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(a, b - a), "held_out": batch.column(1).slice(a, b - a),
                                                  "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())})

    return task


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    known = docs.sparkSession.sparkContext.broadcast(model and vars(model))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), folds.held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(predictor(known), "doc_id long, held_out boolean, lang_pred string, score double")
