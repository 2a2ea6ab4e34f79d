"""Cutting an ordered op log into runs and batches (A14-A16). Every step is blocked, see `blocks`."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from docfold.operators.blocks import BLOCK, WIDTH, before, inside, row_index, with_block


def runs(ops: DataFrame, part: Sequence[str] = ("collection",), order: str = "offset", kind: str = "op",
         width: int = WIDTH) -> DataFrame:
    """Maximal runs of consecutive ops of one kind: part, run (0-based), kind, n, first/last order value."""
    part = list(part)
    w = inside(part, order)
    marked = with_block(ops.select(*part, order, kind), order, width).withColumn(
        "_new", F.coalesce((F.col(kind) != F.lag(kind).over(w)).cast("int"), F.lit(0)))
    islands = (
        marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*part, BLOCK, "_island")
        .agg(F.first(kind).alias(kind), F.count(F.lit(1)).alias("n"), F.min(order).alias("first"),
             F.max(order).alias("last"))
    )
    edges = islands.groupBy(*part, BLOCK).agg(
        F.min_by(kind, "_island").alias("_head"), F.max_by(kind, "_island").alias("_tail"),
        F.count(F.lit(1)).alias("_islands"))
    blocks = Window.partitionBy(*part).orderBy(BLOCK)
    # A block whose head continues the run of the block before it starts one run less.
    edges = edges.withColumn(
        "_joined", F.coalesce((F.col("_head") == F.lag("_tail").over(blocks)).cast("int"), F.lit(0)))
    edges = edges.select(*part, BLOCK, (
        F.coalesce(F.sum(F.col("_islands") - F.col("_joined")).over(before(part)), F.lit(0)) - F.col("_joined")
    ).alias("_base"))
    return (
        islands.join(edges, [*part, BLOCK])
        .groupBy(*part, (F.col("_base") + F.col("_island")).alias("run"))
        .agg(F.first(kind).alias(kind), F.sum("n").alias("n"), F.min("first").alias("first_" + order),
             F.max("last").alias("last_" + order))
    )


def batches_by_count(ops: DataFrame, size: int, part: Sequence[str] = ("collection",), order: str = "offset",
                     name: str = "batch", width: int = WIDTH) -> DataFrame:
    """`name` = number of the batch when every `size` ops, adds and deletes alike, close one."""
    if size < 1:
        raise ValueError("batch size must be >= 1")
    indexed = row_index(ops, part, order, "_index", width)
    return indexed.withColumn(name, F.floor(F.col("_index") / F.lit(size)).cast("bigint")).drop("_index")


# Tasks get this module's functions by value, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# --- greedy batches ------------------------------------------------------------------------------
#
# A batch closes on the op that brings it to the byte cap (or to the op count), so where a batch starts
# depends on everything before it. What a block of ops does to an incoming open batch (`fill` bytes,
# `have` ops) is decided by the first op that closes it, and that op lies within the first `size` ops or
# the first `cap` bytes of the block. A block is therefore a small table: "if the first closing op is
# number j, the batch left open at the end holds (fill, have) and so many batches closed". Tables of
# neighbouring blocks compose into a table of the same form, which gives a tree of bounded pieces:
# blocks -> groups of blocks -> parts, and back down with the carried state.

_TABLE = "reach array<bigint>, fill array<bigint>, have array<bigint>, cuts array<bigint>, total bigint, count bigint"
_GROUP_BLOCKS = 1024
_NO_SIZE = 1 << 62


class _Table:
    """`reach[j]` bytes of the first j+1 ops; `fill`, `have`, `cuts`: outcome when op j closes the open batch."""

    def __init__(self, reach, fill, have, cuts, total, count):
        self.reach, self.fill, self.have, self.cuts = (np.asarray(a, dtype=np.int64) for a in (reach, fill, have, cuts))
        self.total, self.count = int(total), int(count)

    @classmethod
    def of_weights(cls, weights: np.ndarray, cap: int, size: int) -> "_Table":
        n = len(weights)
        sums = np.concatenate(([0], np.cumsum(weights, dtype=np.int64)))
        nxt = np.minimum(np.searchsorted(sums[1:], sums[:-1] + cap, side="left"), np.arange(n) + size - 1) \
            if n else np.zeros(0, dtype=np.int64)
        # fill/have/cuts of a batch that STARTS at op i, worked out from the end of the block.
        fill, have, cuts = (np.zeros(n + 1, dtype=np.int64) for _ in range(3))
        for i in range(n - 1, -1, -1):
            j = int(nxt[i])
            if j >= n:
                fill[i], have[i] = sums[n] - sums[i], n - i
            else:
                fill[i], have[i], cuts[i] = fill[j + 1], have[j + 1], cuts[j + 1] + 1
        # An empty open batch closes latest, so later ops are never the first to close.
        last = min(n, int(nxt[0]) + 1) if n else 0
        kept = np.arange(1, last + 1)
        if size >= _NO_SIZE:
            # Without an op count only an op with bytes can close, so ops that weigh nothing are not listed.
            kept = kept[weights[:last] > 0]
        return cls(sums[kept], fill[kept], have[kept], cuts[kept] + 1, sums[n], n)

    def apply(self, fill: int, have: int, cap: int, size: int) -> tuple[int, int, int]:
        """State after the block and batches closed in it, for an open batch of `fill` bytes and `have` ops."""
        j = min(int(np.searchsorted(self.reach, cap - fill, side="left")), size - have - 1)
        if j < len(self.reach):
            return int(self.fill[j]), int(self.have[j]), int(self.cuts[j])
        return fill + self.total, have + self.count, 0

    def then(self, other: "_Table", cap: int, size: int) -> "_Table":
        after = [other.apply(f, h, cap, size) for f, h in zip(self.fill.tolist(), self.have.tolist())]
        fill, have, cuts = ([a[k] for a in after] for k in range(3))
        cuts = [c + d for c, d in zip(cuts, self.cuts.tolist())]
        # Not closed by this block: only reachable while its ops fit, then the other block decides.
        if self.total < cap and self.count < size:
            # Every op of this block that can close is listed; those of the next continue the list.
            return _Table(np.concatenate((self.reach, self.total + other.reach)),
                          np.concatenate((fill, other.fill)), np.concatenate((have, other.have)),
                          np.concatenate((cuts, other.cuts)), self.total + other.total, self.count + other.count)
        return _Table(self.reach, fill, have, cuts, self.total + other.total, self.count + other.count)

    def row(self) -> list:
        return [self.reach.tolist(), self.fill.tolist(), self.have.tolist(), self.cuts.tolist(), self.total, self.count]


def _tables(pdf: pd.DataFrame) -> Iterator[_Table]:
    for r in pdf.itertuples(index=False):
        yield _Table(r.reach, r.fill, r.have, r.cuts, r.total, r.count)


def batches_by_bytes(ops: DataFrame, cap: int, bytes_col: str = "bytes", size: int | None = None,
                     part: Sequence[str] = ("collection",), order: str = "offset", name: str = "batch",
                     width: int = WIDTH) -> DataFrame:
    """`name` = number of the batch when the op that reaches `cap` bytes closes it.

    Deletes weigh 0. With `size`, an op count closes a batch too, whichever comes first.
    """
    if cap < 1:
        raise ValueError("byte cap must be >= 1")
    part = list(part)
    limit = int(size) if size else _NO_SIZE
    types = {f.name: f.dataType.simpleString() for f in ops.schema.fields}
    keys = ", ".join(f"`{p}` {types[p]}" for p in part)
    group = "_group"
    rows = with_block(ops, order, width).withColumn(bytes_col, F.coalesce(F.col(bytes_col), F.lit(0)).cast("bigint"))
    slim = rows.select(*part, BLOCK, order, bytes_col)

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        table = _Table.of_weights(pdf[bytes_col].to_numpy(np.int64), cap, limit)
        head = [pdf[c].iloc[0] for c in (*part, BLOCK)]
        return pd.DataFrame([head + table.row()], columns=[*part, BLOCK, "reach", "fill", "have", "cuts", "total", "count"])

    per_block = slim.groupBy(*part, BLOCK).applyInPandas(summarise, f"{keys}, {BLOCK} bigint, {_TABLE}") \
        .withColumn(group, F.floor(F.col(BLOCK) / F.lit(_GROUP_BLOCKS)).cast("bigint"))

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(BLOCK)
        tables = _tables(pdf)
        table = next(tables)
        for other in tables:
            table = table.then(other, cap, limit)
        head = [pdf[c].iloc[0] for c in (*part, group)]
        return pd.DataFrame([head + table.row()], columns=[*part, group, "reach", "fill", "have", "cuts", "total", "count"])

    per_group = per_block.groupBy(*part, group).applyInPandas(compose, f"{keys}, {group} bigint, {_TABLE}")

    def walk(pdf: pd.DataFrame, at: str, state: tuple[int, int, int]) -> pd.DataFrame:
        pdf = pdf.sort_values(at)
        entry = []
        fill, have, batch = state
        for table in _tables(pdf):
            entry.append((fill, have, batch))
            fill, have, closed = table.apply(fill, have, cap, limit)
            batch += closed
        out = pdf[[*part, at]].reset_index(drop=True)
        out[["_fill", "_have", "_batch"]] = np.asarray(entry, dtype=np.int64).reshape(-1, 3)
        return out

    state = "_fill bigint, _have bigint, _batch bigint"
    group_entry = per_group.groupBy(*part).applyInPandas(
        lambda pdf: walk(pdf, group, (0, 0, 0)), f"{keys}, {group} bigint, {state}")

    def descend(tables: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        start = tuple(int(x) for x in entry[["_fill", "_have", "_batch"]].iloc[0])
        return walk(tables, BLOCK, start)

    block_entry = per_block.groupBy(*part, group).cogroup(group_entry.groupBy(*part, group)).applyInPandas(
        descend, f"{keys}, {BLOCK} bigint, {state}")

    def number(pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        fill, have, batch = (int(x) for x in entry[["_fill", "_have", "_batch"]].iloc[0])
        out = np.empty(len(pdf), dtype=np.int64)
        for i, w in enumerate(pdf[bytes_col].to_numpy(np.int64)):
            out[i] = batch
            fill, have = fill + int(w), have + 1
            if fill >= cap or have >= limit:
                fill, have, batch = 0, 0, batch + 1
        return pd.DataFrame({**{p: pdf[p].to_numpy() for p in part}, order: pdf[order].to_numpy(), name: out})

    numbers = slim.groupBy(*part, BLOCK).cogroup(block_entry.groupBy(*part, BLOCK)).applyInPandas(
        number, f"{keys}, `{order}` {types[order]}, `{name}` bigint")
    return ops.join(numbers, [*part, order])
