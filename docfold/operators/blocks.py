"""Ordered scans over long sequences, cut into blocks so that no task ever holds a whole sequence.

A running value over `part` ordered by `order` is computed in three steps: a window inside each
(part, block), one row per block with what later blocks need, and a window over those few rows. The
row window and the join that brings the carry back share one shuffle on (part, block).

`order` is a bigint that is unique inside `part`, so a block never holds more than `width` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = "_block"
WIDTH = 1 << 18


def with_block(df: DataFrame, order: str, width: int = WIDTH) -> DataFrame:
    return df.withColumn(BLOCK, F.expr(f"`{order}` div {width}L"))


def inside(part: Sequence[str], order: str):
    """Window over the rows of one block."""
    return Window.partitionBy(*part, BLOCK).orderBy(order)


def before(part: Sequence[str]):
    """Window over the blocks that precede a block."""
    return Window.partitionBy(*part).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def with_carry(rows: DataFrame, part: Sequence[str], aggs: Sequence[Column], carries: dict[str, Column]) -> DataFrame:
    """Add to every row the `carries`, expressions over the per-block `aggs` of the preceding blocks."""
    part = list(part)
    summary = rows.groupBy(*part, BLOCK).agg(*aggs)
    carried = summary.select(*part, BLOCK, *[c.over(before(part)).alias(n) for n, c in carries.items()])
    return rows.join(carried, [*part, BLOCK])


def running_max(df: DataFrame, part: Sequence[str], order: str, value: str, name: str, width: int = WIDTH) -> DataFrame:
    """`name` = max of `value` over the earlier rows of the part (NULL on its first row)."""
    rows = with_carry(with_block(df, order, width), part, [F.max(value).alias("_m")], {"_carry": F.max("_m")})
    local = F.max(value).over(inside(part, order).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn(name, F.greatest(local, "_carry")).drop(BLOCK, "_carry")


def row_index(df: DataFrame, part: Sequence[str], order: str, name: str, width: int = WIDTH) -> DataFrame:
    """`name` = 0-based position of the row in its part."""
    rows = with_carry(with_block(df, order, width), part, [F.count(F.lit(1)).alias("_n")], {"_carry": F.sum("_n")})
    local = F.row_number().over(inside(part, order)) - 1
    return rows.withColumn(name, local + F.coalesce("_carry", F.lit(0))).drop(BLOCK, "_carry")
