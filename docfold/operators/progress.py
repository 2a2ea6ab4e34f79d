"""Progress and counters (M1-M5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from docfold.operators.skew import skew_join

PARTITION = ("topic", "partition")


def safe_offsets(acks: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """M1: offset that may be committed per (topic, partition).

    The earliest un-acked offset, else one past the last acked; a partition with nothing tracked keeps its
    `current` offset (topic, partition, offset).
    """
    tracked = acks.groupBy(*PARTITION).agg(
        F.coalesce(F.min(F.when(~F.col("acked"), F.col("offset"))), F.max("offset") + 1).alias("safe_offset"))
    if current is None:
        return tracked
    # Both sides have one row per partition.
    return current.withColumnRenamed("offset", "_current").join(tracked, list(PARTITION), "full_outer").select(
        *PARTITION, F.coalesce("safe_offset", "_current").alias("safe_offset"))


def counters(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """M2: written / failed / retries / queue summed over parts."""
    return parts.groupBy(*by).agg(*[
        F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("written", "failed", "retries", "queue")])


def weighted_latency(parts: DataFrame, mean: str, count: str, by: Sequence[str] = ()) -> DataFrame:
    """M3: mean over parts weighted by their counts; parts without calls are skipped, nothing at all gives 0.0."""
    used = F.col(count) > 0
    total = F.sum(F.when(used, F.col(count)))
    weighted = F.sum(F.when(used, F.col(mean) * F.col(count)))
    return parts.groupBy(*by).agg(
        F.when(total > 0, weighted / total).otherwise(F.lit(0.0)).alias("mean_ms"),
        F.coalesce(total, F.lit(0)).cast("bigint").alias("calls"))


def stalled(attempts: DataFrame, now: int, timeout_ms: int, by: Sequence[str] = ()) -> DataFrame:
    """M4: last success, the first failure no later success followed, and whether that is longer ago than the timeout.

    `attempts`: `at` (epoch millis) and `ok`. A timeout of -1 never stalls.
    """
    keys = list(by) or ["_all"]
    rows = attempts if by else attempts.withColumn("_all", F.lit(0))
    last = rows.groupBy(*keys).agg(F.max(F.when(F.col("ok"), F.col("at"))).alias("last_success"))
    failures = skew_join(rows.where(~F.col("ok")), last, keys, "inner", spread=["at"])
    since = failures.where(F.col("last_success").isNull() | (F.col("at") >= F.col("last_success"))) \
        .groupBy(*keys).agg(F.min("at").alias("failing_since"))
    late = F.lit(False) if timeout_ms < 0 else F.coalesce(F.lit(now) - F.col("failing_since") > timeout_ms, F.lit(False))
    return last.join(since, keys, "left").select(
        *by, F.coalesce("last_success", F.lit(0)).cast("bigint").alias("last_success"),
        F.col("failing_since").cast("bigint").alias("failing_since"), late.alias("stalled"))


def latency_stats(samples: DataFrame, value: str, by: Sequence[str] = (), ranks: Sequence[float] = (0.95, 0.99),
                  steps: int = 1000) -> DataFrame:
    """M5: exact mean and nearest-rank percentiles (the value at position ceil(p * n) of the sorted samples).

    No task holds a group: samples are counted per distinct value first, the values are cut into `steps`
    ranges at approximate quantiles of all of them (one bounded sketch; it only balances the ranges, ranks
    are exact), and cumulative counts are windows inside one range plus a carry from the ranges before.
    """
    by = list(by) or ["_all"]
    rows = samples.where(F.col(value).isNotNull())
    if by == ["_all"]:
        rows = rows.withColumn("_all", F.lit(0))
    counts = rows.groupBy(*by, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    # Look-up in two steps of about sqrt(steps) comparisons: every `stride`-th cut first, then those between.
    stride = max(2, round(steps ** 0.5))
    fractions = F.array(*[F.lit(i / steps) for i in range(1, steps)])
    cuts = counts.agg(F.percentile_approx("v", fractions, F.lit(10 * steps)).alias("all")).select(F.struct(
        "all", F.filter("all", lambda c, i: (i + 1) % stride == 0).alias("coarse"))).scalar()
    below = lambda array: F.size(F.filter(array, lambda c: c < F.col("v")))
    ranged = counts.withColumn("_cuts", cuts).withColumn("_coarse", below(F.col("_cuts.coarse")) * stride).withColumn(
        "_range", F.col("_coarse") + below(F.slice("_cuts.all", F.col("_coarse") + 1, F.lit(stride - 1)))
    ).drop("_cuts", "_coarse")
    per_range = ranged.groupBy(*by, "_range").agg(F.sum("n").alias("_n"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_range.select(*by, "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
                             F.sum("_n").over(group).alias("_total"))
    inside = Window.partitionBy(*by, "_range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    reached = ranged.withColumn("_upto", F.sum("n").over(inside)).join(carry, [*by, "_range"]) \
        .withColumn("_upto", F.col("_upto") + F.col("_before"))

    def at(p: float):
        return F.min(F.when(F.col("_upto") >= F.greatest(F.lit(1), F.ceil(F.lit(p) * F.col("_total"))), F.col("v")))

    out = reached.groupBy(*by).agg(
        (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean"),
        *[at(p).alias(f"p{round(p * 100):d}") for p in ranks], F.sum("n").alias("samples"))
    return out.drop("_all")
