"""Approximate nearest neighbours by inner product on robust-pruned directed graphs.

Equal vectors form a class that stands once in the index; a class keeps its `k` + 1 smallest vec_ids, all that an answer
can need. Classes are dealt by hash to shards of about `SHARD` vectors, and inside a shard to bands of like lengths, one
graph each: the lengths of a band differ by a factor of 2^(1/`BANDS`) at most, so no long vector hides the others. Inner
products become distances by one more coordinate, sqrt(M^2 - |x|^2) with M the band's largest length, 0 for a query. A
graph grows in rounds that double it: greedy beam searches from an entry point propose neighbours, robust pruning keeps a
candidate unless a kept one is `ALPHA` times nearer to it, edges are made in both directions and pruned again where a
node has too many. A node whose in-edges all were pruned away gets one back. Every query is searched by beam in every
shard, in blocks, from the longest band down; it leaves a shard when |q| M of the next band cannot reach its worst
answer there. The best of all shards are its answer, scored in double precision on the original vectors.

Every row with a usable vector is indexed; there is no sample. Vectors that are null, zero, of another length than the
most common one, or hold null or non-finite components take no part, nor do rows without vec_id. Of a vec_id with several
vectors the first in array order counts. Ties go to the smaller vec_id. Other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docfold.llm import shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD = 8192
BANDS = 2  # to a doubling of the length
DEGREE, BEAM, SEARCH_BEAM, ALPHA = 32, 56, 160, 1.2
QUERIES = 4096  # in a block


def distances(x: np.ndarray, nodes: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances from each query to its row of nodes (-1: infinitely far)."""
    d = ((x[nodes] - q[:, None, :]) ** 2).sum(axis=2)
    d[nodes < 0] = np.inf
    return d


def beam_search(x: np.ndarray, edges: np.ndarray, entry: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """For all queries at once: the `beam` nearest nodes met with their squared distances, and the nodes expanded step by step."""
    n = len(q)
    best = np.full((n, beam), -1, np.int64)
    far = np.full((n, beam), np.inf, np.float32)
    done = np.zeros((n, beam), bool)
    best[:, 0], far[:, 0] = entry, ((x[entry] - q) ** 2).sum(axis=1)
    seen = np.zeros((n, len(x)), bool) if n * len(x) <= 1 << 26 else None
    if seen is not None:
        seen[:, entry] = True
    visited = []
    active = np.arange(n)
    while len(active):
        open_ = ~done[active] & (best[active] >= 0)
        some = open_.any(axis=1)
        active = active[some]
        if not len(active):
            break
        at = open_[some].argmax(axis=1)  # rows are sorted by distance
        node = best[active, at]
        done[active, at] = True
        step = np.full(n, -1, np.int64)
        step[active] = node
        visited.append(step)
        near = edges[node].copy()
        if seen is not None:
            known = seen[active[:, None], np.maximum(near, 0)]
            near[known] = -1
            r, c = np.nonzero(near >= 0)
            seen[active[r], near[r, c]] = True
        else:
            near[(near[:, :, None] == best[active][:, None, :]).any(axis=2)] = -1
        d = distances(x, near, q[active])
        # merge and keep the nearest
        ids = np.concatenate([best[active], near], axis=1)
        ds = np.concatenate([far[active], d.astype(np.float32)], axis=1)
        marks = np.concatenate([done[active], np.zeros(near.shape, bool)], axis=1)
        order = np.argsort(ds, axis=1, kind="stable")[:, :beam]
        best[active] = np.take_along_axis(ids, order, 1)
        far[active] = np.take_along_axis(ds, order, 1)
        done[active] = np.take_along_axis(marks, order, 1)
        best[active] = np.where(np.isinf(far[active]), -1, best[active])
    return best, far, visited


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float = ALPHA) -> np.ndarray:
    """For each point the candidates (-1: none) that survive, nearest first; for many points at once."""
    d = distances(x, candidates, x[points])
    d[candidates == points[:, None]] = np.inf
    order = np.argsort(d, axis=1, kind="stable")
    candidates, d = np.take_along_axis(candidates, order, 1), np.take_along_axis(d, order, 1)
    d[:, 1:][(candidates[:, 1:] == candidates[:, :-1]) & ~np.isinf(d[:, 1:])] = np.inf  # repeats are equally far, side by side
    v = x[candidates]
    norms = (v * v).sum(axis=2)
    alive = ~np.isinf(d)
    out = np.full((len(points), degree), -1, np.int64)
    rows = np.arange(len(points))
    for k in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        rows_on = rows[some]
        first = alive[some].argmax(axis=1)
        out[rows_on, k] = candidates[rows_on, first]
        chosen = v[rows_on, first]
        between = norms[some] + norms[rows_on, first][:, None] - 2 * np.einsum("rcd,rd->rc", v[some], chosen)
        alive[some] &= alpha * alpha * between > d[some]
        alive[rows_on, first] = False
    return out


class Graph:
    """Directed graph over the rows of x."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = np.ascontiguousarray(x, np.float32)
        self.edges = np.full((len(x), DEGREE), -1, np.int64)
        self.entry = int(((self.x - self.x.mean(axis=0)) ** 2).sum(axis=1).argmin())
        order = np.random.default_rng(5).permutation(len(x))
        order = np.concatenate([[self.entry], order[order != self.entry]])
        done, size = 1, 32
        while done < len(order):
            self._insert(order[done:done + size])
            done += size
            size = min(done, 1024)
        self._reach(order)

    def _insert(self, points: np.ndarray) -> None:
        best, _, visited = beam_search(self.x, self.edges, self.entry, self.x[points], BEAM)
        candidates = np.concatenate([best, np.stack(visited, axis=1)], axis=1) if visited else best
        # the points of a round also propose their nearest fellows
        gram = self.x[points]
        d = (gram ** 2).sum(1)[:, None] + (gram ** 2).sum(1) - 2 * gram @ gram.T
        np.fill_diagonal(d, np.inf)
        fellows = points[np.argpartition(d, min(8, len(points) - 1), axis=1)[:, :8]]
        self._link(points, np.concatenate([candidates, fellows], axis=1))

    def _link(self, points: np.ndarray, candidates: np.ndarray) -> None:
        for i in range(0, len(points), 256):
            self.edges[points[i:i + 256]] = robust_prune(self.x, points[i:i + 256], candidates[i:i + 256], DEGREE)
        source = np.repeat(points, DEGREE)
        target = self.edges[points].ravel()
        new = (target >= 0) & (self.edges[target] != source[:, None]).all(axis=1)
        source, target = source[new], target[new]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, n = np.unique(target, return_index=True, return_counts=True)
        wide = np.full((len(nodes), DEGREE + int(n.max(initial=0))), -1, np.int64)
        wide[:, :DEGREE] = self.edges[nodes]
        row = np.repeat(np.arange(len(nodes)), n)
        wide[row, DEGREE + np.arange(len(source)) - first[row]] = source
        fits = (wide >= 0).sum(axis=1) <= DEGREE
        packed = np.take_along_axis(wide, np.argsort(wide < 0, axis=1, kind="stable"), 1)
        self.edges[nodes[fits]] = packed[fits][:, :DEGREE]
        rest, full = nodes[~fits], packed[~fits]
        for i in range(0, len(rest), 256):
            part = full[i:i + 256]
            part = part[:, :int((part >= 0).sum(axis=1).max())]
            self.edges[rest[i:i + 256]] = robust_prune(self.x, rest[i:i + 256], part, DEGREE)

    def _reach(self, order: np.ndarray) -> None:
        """Give every node that cannot be reached from the entry an edge from a reachable one."""
        while True:
            met = np.zeros(len(self.x), bool)
            met[self.entry] = True
            front = np.array([self.entry])
            while len(front):
                nxt = np.unique(self.edges[front])
                nxt = nxt[nxt >= 0]
                front = nxt[~met[nxt]]
                met[front] = True
            lost = order[~met[order]]
            if not len(lost):
                return
            best, _, _ = beam_search(self.x, self.edges, self.entry, self.x[lost[:256]], BEAM)
            for point, near in zip(lost[:256], best):
                near = near[near >= 0]
                near = near[met[near]]
                free = [y for y in near if (self.edges[y] < 0).any()]
                y = free[0] if free else near[0]
                slot = int(np.argmax(self.edges[y] < 0)) if free else DEGREE - 1
                self.edges[y, slot] = point
                met[point] = True


GRAPH = "shard int, top double, entry int, ids binary, vectors binary, edges binary, size int"
FOUND = "query_id long, c long, score double"


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array<double>) of the rows that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(sound & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    rows = rows.where(F.size("v") == (sizes[0]["n"] if sizes else 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def lengths(x: np.ndarray) -> np.ndarray:
    """Of the rows, without overflow of the squares."""
    most = np.abs(x).max(axis=1)
    return most * np.sqrt(((x / most[:, None]) ** 2).sum(axis=1))


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """The rows over the largest length `top`, with the coordinate that makes them equally long."""
    x = x / top
    return np.concatenate([x, np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0))[:, None]], axis=1)


def build(classes: DataFrame, shards: int) -> DataFrame:
    """One row per shard and band of lengths: its graph. `classes`: c, v."""

    def task(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c")
        x, ids = np.stack(pdf["v"].to_list()).astype(np.float64), pdf["c"].to_numpy(np.int64)
        long = lengths(x)
        band = np.floor(BANDS * (np.log2(long.max()) - np.log2(long))).astype(np.int64)
        out = []
        for b in np.unique(band):
            at = band == b
            top = float(long[at].max())
            g = Graph(lifted(x[at], top))
            out.append((key[0], top, g.entry, ids[at].tobytes(), x[at].tobytes(), g.edges.astype(np.int32).tobytes(), int(at.sum())))
        return pd.DataFrame(out, columns=["shard", "top", "entry", "ids", "vectors", "edges", "size"])

    placed = classes.withColumn("shard", F.pmod(F.xxhash64("c"), F.lit(shards)).cast("int"))
    return shared.written(placed.groupBy("shard").applyInPandas(task, GRAPH), "graphs")


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row: higher score first, ties to the smaller id; places without an entry score -inf."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


def search(graphs: DataFrame, queries: DataFrame, shards: int, blocks: int, k: int) -> DataFrame:
    """query_id, c, score: the k best classes of each query in each shard. `queries`: query_id, block, v."""

    def task(key: tuple, graph: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(graph) or not len(asked):
            return pd.DataFrame({"query_id": [], "c": [], "score": []})
        graph = graph.sort_values("top", ascending=False)
        query_ids = asked["query_id"].to_numpy()
        q = np.stack(asked["v"].to_list()).astype(np.float64)
        long = lengths(q)
        # a query's length changes no order; length 1 keeps the search well scaled
        unit = np.concatenate([q / long[:, None], np.zeros((len(q), 1))], axis=1).astype(np.float32)
        found, scores = np.full((len(q), k), -1, np.int64), np.full((len(q), k), -np.inf)
        for g in graph.itertuples():
            active = np.flatnonzero(long * g.top * (1 + 1e-9) >= scores[:, -1])
            if not len(active):
                break
            x = np.frombuffer(g.vectors, np.float64).reshape(g.size, -1)
            space = lifted(x, g.top).astype(np.float32)
            edges = np.frombuffer(g.edges, np.int32).reshape(g.size, -1).astype(np.int64)
            ids = np.frombuffer(g.ids, np.int64)
            for i in range(0, len(active), 1024):
                part = active[i:i + 1024]
                best, _, _ = beam_search(space, edges, int(g.entry), unit[part], max(SEARCH_BEAM, 2 * k))
                row, col = np.nonzero(best >= 0)
                score, near = np.full(best.shape, -np.inf), np.full(best.shape, -1, np.int64)
                score[row, col] = np.einsum("ij,ij->i", q[part[row]], x[best[row, col]])
                near[row, col] = ids[best[row, col]]
                found[part], scores[part] = best_of(np.concatenate([found[part], near], axis=1), np.concatenate([scores[part], score], axis=1), k)
        row, col = np.nonzero(~np.isneginf(scores))
        return pd.DataFrame({"query_id": query_ids[row], "c": found[row, col], "score": scores[row, col]})

    spread = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))  # each block visits each shard
    return spread.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(task, FOUND)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for every row of `queries` (vec_id, embedding) its k nearest other rows of `vectors`."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    order = Window.partitionBy("v").orderBy("vec_id")
    members = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    members = shared.written(members.withColumn("c", F.first("vec_id").over(order)), "members")  # c: the class's smallest vec_id
    classes = members.where("r = 1").select("c", "v")
    n = classes.count()
    asked = usable(queries).select(F.col("vec_id").alias("query_id"), "v")
    total = asked.count()
    blocks = max(1, -(-total // QUERIES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id", "v"), F.lit(blocks)).cast("int"))
    shards = max(1, -(-n // SHARD))
    graphs = build(classes, shards)
    found = search(graphs, asked, shards, blocks, k + 1)
    by_class = Window.partitionBy("query_id").orderBy(F.desc("score"), "c")
    kept = found.withColumn("r", F.row_number().over(by_class)).where(F.col("r") <= k + 1).drop("r")
    # classes, then their members without the query itself
    better = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = kept.join(members.select("c", "vec_id"), "c").where("vec_id <> query_id")
    return (out.withColumn("rank", F.row_number().over(better)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
