"""The fold that learning leaves out, and bounded samples of rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """crc32 of doc_id as text, mod 5, is 0. A null doc_id counts as held out: nothing is learned from it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def sample(rows: DataFrame, n: int, by: str = "doc_id") -> DataFrame:
    """The n rows with the smallest hash of `by`: the same ones in every run, however the rows are spread."""
    return rows.withColumn("_h", F.xxhash64(F.lit("sample"), by)).orderBy("_h", by).limit(n).drop("_h")
