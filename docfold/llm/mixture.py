"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are aggregated by pattern, the set of sources they belong to. A pattern supplies its tokens up to `repeats`
times, each further copy at a higher cost (0, 1, 4, 9, ...: convex, so cheap copies are used first); every source has a
quota. The flow that fills the quotas at least cost says how many tokens each pattern gives in each copy. Full copies
go to every document of the pattern; the last, partial copy goes to documents in the order of a seeded hash until its
tokens are reached (the document that crosses the line is taken if that brings the sum nearer).

The flow runs on the driver over one row per pattern, which is bounded by the source catalog, not by the documents.
The choice of documents is distributed: hash buckets are summed first, and only the bucket where a pattern's line
falls is ordered, so a source with most of the rows is never sorted in one task.

Nulls: a null text has size 0, a null source is the source null, ordered last. A null doc_id hashes as the empty text.
Size-0 documents take 0 words. Repeated rows are documents of their own. An empty table gives an empty result.
Other columns pass through; those named like an output column are replaced by it.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docfold.llm import shared

REPEATS = 3
SEED = "mix-1"
BUCKETS = 65536
PATTERNS = 100_000  # the most of which a row each is broadcast
OUTPUTS = {"size", "pattern", "tokens", "target", "copies", "taken"}
INNER = OUTPUTS | {"order", "bucket", "words", "full", "rest", "line", "before", "ahead", "more"}


def size_of(text: Column) -> Column:
    """Number of words: runs of characters other than space and \\x09-\\x0D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cyclic_weights(sources: list[str | None], weights: tuple[float, ...] = (5, 2, 1)) -> dict[str | None, float]:
    """Sources in code point order, null last, with the weights in turn."""
    order = sorted((s for s in sources if s is not None), key=lambda s: s.encode("utf-8")) + [None] * (None in sources)
    return {s: weights[i % len(weights)] for i, s in enumerate(order)}


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], repeats: int = REPEATS, total: int | None = None) -> dict[str | None, float]:
    """Share `total` (default: sum(sizes)) by weight; a source stops at `repeats` times its size and the excess is shared again.

    The sources that stop are the first ones by size / weight, so one pass in that order finds them.
    """
    left, weight, out = float(sum(sizes.values()) if total is None else total), float(sum(weights[s] for s in sizes)), {}
    for s in sorted(sizes, key=lambda s: (repeats * sizes[s] / weights[s], s is None, s or "")):
        share = left / weight * weights[s]
        if repeats * sizes[s] < share:
            out[s] = float(repeats * sizes[s])
            left, weight = left - out[s], weight - weights[s]
        else:
            out[s] = share
            # every later source has the same ratio of share to weight and more room, so `left` and `weight` stay
    return out


def _route(start: tuple, room: dict, givers: dict[str | None, dict], dead: set) -> list | None:
    """Pattern, source, pattern, ..., source: the shortest way from `start` to a source with room, or None.

    A pattern passes tokens to its sources, a source hands back those of patterns that give to it. What a vain search met
    is closed: no later way leads out of it, as room never grows.
    """
    before: dict = {}
    queue = deque([start])
    met = {start}
    while queue:
        pattern = queue.popleft()
        for s in pattern:
            if s in before or s not in room:
                continue
            before[s] = pattern
            if room[s] > 0:
                way = [s, pattern]
                while way[-1] != start:
                    back = before["from", way[-1]]
                    way += [back, before[back]]
                return way[::-1]
            for q in givers[s]:
                if q not in met and q not in dead:
                    met.add(q)
                    before["from", q] = s
                    queue.append(q)
    dead |= met
    return None


def flow(patterns: dict[tuple, int], quotas: dict[str | None, float], repeats: int = REPEATS) -> dict[tuple, list[float]]:
    """Tokens that each pattern gives in its first, second, ... copy: min-cost flow by cheapest augmenting paths.

    Only a token's copy costs, so paths are cheapest first when all first copies go before all second ones.
    """
    used = {p: [0.0] * repeats for p in patterns}
    room = dict(quotas)
    givers: dict[str | None, dict[tuple, float]] = {s: {} for s in quotas}
    dead: set[tuple] = set()
    for copy in range(repeats):
        for p, tokens in patterns.items():
            while p not in dead and used[p][copy] < tokens:
                way = _route(p, room, givers, dead)
                if way is None:
                    break
                left = tokens - used[p][copy]
                most = min([left, room[way[-1]], *(givers[s][q] for s, q in zip(way[1::2], way[2::2]))])
                used[p][copy] = float(tokens) if most == left else used[p][copy] + most
                room[way[-1]] -= most
                for q, s in zip(way[0::2], way[1::2]):
                    givers[s][q] = givers[s].get(q, 0.0) + most
                for s, q in zip(way[1::2], way[2::2]):
                    givers[s][q] -= most
                    if givers[s][q] <= 0:
                        del givers[s][q]
    return used


def mix(docs: DataFrame, members: Column, weights, repeats: int = REPEATS, seed: str = SEED, spark: SparkSession | None = None) -> DataFrame:
    """`docs` with size, pattern (sorted members), tokens of its pattern, copies and taken = copies * size.

    `members`: array of the sources that a document belongs to. `weights`: dict by source, or a function of the list of sources.
    """
    spark = spark or docs.sparkSession
    given, moved = shared.set_aside(docs, INNER)
    order = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.select(*given, size_of(F.col("text")).alias("size"), F.array_sort(F.array_distinct(members)).alias("pattern"), order.alias("order"))
    rows = rows.withColumn("bucket", F.conv(F.substring("order", 1, 4), 16, 10).cast("int"))
    totals = rows.groupBy("pattern").agg(F.sum("size").alias("tokens")).collect()  # one row per pattern
    patterns = {tuple(r["pattern"]): r["tokens"] for r in totals}
    sources = {s for p in patterns for s in p}
    chosen = weights(list(sources)) if callable(weights) else weights
    whole = {s: sum(t for p, t in patterns.items() if s in p) for s in sources}
    goal = targets(whole, chosen, repeats, sum(patterns.values()))
    used = flow(patterns, goal, repeats)
    source_of = {p: p[0] if len(p) == 1 else None for p in patterns}
    plan = spark.createDataFrame(
        [(list(p), patterns[p], float(goal[source_of[p]]) if len(p) == 1 else None, sum(x == patterns[p] for x in used[p]) if patterns[p] else 0,
          next((x for x in used[p] if 0 < x < patterns[p]), 0.0)) for p in sorted(patterns, key=str)],
        "pattern array<string>, tokens long, target double, full int, rest double")
    # where the running sum of each pattern's documents, in hash order, passes `rest`
    sums = rows.groupBy("pattern", "bucket").agg(F.sum("size").alias("words"))
    ordered = Window.partitionBy("pattern").orderBy("bucket")
    before = F.coalesce(F.sum("words").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    small = F.broadcast if len(patterns) <= PATTERNS else (lambda df: df)
    lines = (sums.withColumn("before", before).join(small(plan.select("pattern", "rest")), "pattern")
             .where("before <= rest AND before + words > rest AND rest > 0").select("pattern", F.col("bucket").alias("line"), "before"))
    plan = plan.join(lines, "pattern", "left")
    placed = rows.join(small(plan), "pattern")  # one row per pattern
    at_line = F.col("bucket") == F.col("line")
    within = Window.partitionBy("pattern", "bucket").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = (placed.where(at_line).withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
            .withColumn("more", (F.col("ahead") + F.col("size") / 2 <= F.col("rest")).cast("int")).drop("ahead"))
    inner = placed.where(~F.coalesce(at_line, F.lit(False))).withColumn(
        "more", (F.col("rest") > 0).cast("int") * F.coalesce(F.col("bucket") < F.col("line"), F.lit(True)).cast("int"))
    out = inner.unionByName(edge)
    out = (out.withColumn("copies", F.when(F.col("size") > 0, F.col("full") + F.col("more")).otherwise(0))
           .withColumn("taken", F.col("copies") * F.col("size"))
           .drop("order", "bucket", "full", "rest", "line", "before", "more", *(new for new, old in moved.items() if old.lower() in OUTPUTS)))
    return out.withColumnsRenamed({new: old for new, old in moved.items() if old.lower() not in OUTPUTS})


def mix_sources(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Every document belongs to its own source; weights 5, 2, 1 in turn."""
    mixed = mix(docs.drop("source_size"), F.array("source"), cyclic_weights, seed=seed)
    return mixed.withColumnRenamed("tokens", "source_size")
