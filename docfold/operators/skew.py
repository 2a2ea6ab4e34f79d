"""A join that one hot key cannot serialise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def skew_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", *,
              spread: Sequence[str], parts: int | None = None) -> DataFrame:
    """Join `left` (any number of rows per key) with `right` (ONE row per key), `how` inner or left.

    A key with more left rows than an even share, all rows over `parts` (the shuffle partitions), is hot: its left
    rows are spread over ceil(rows / share) salts by a hash of the `spread` columns, and its single right row is copied
    to each. Fewer than `parts` keys can be hot, which bounds the broadcast, and their salts add up to less than
    2 x `parts`; the others take the ordinary shuffle join. The salt is a function of the row, so a recomputed task
    sends every row to the same place.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    keys = list(keys)
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    share = counts.agg((F.sum("_rows") / parts).alias("_share"))
    hot = (counts.where(F.col("_rows") > share.scalar())
           .select(*keys, F.ceil(F.col("_rows") / share.scalar()).cast("int").alias("_salts")))
    hot = F.broadcast(hot)      # fewer rows than `parts`
    salt = F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_salts")).cast("int"), F.lit(0))
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted = left.join(hot, keys, "left").withColumn("_salt", salt).drop("_salts")
    copied = right.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return salted.join(copied, [*keys, "_salt"], how).drop("_salt")
