"""Columns of clashing names, repeated and null ids, odd lengths, deep pages."""

import random
import time

import brute
import numpy as np
import pytest
from docfold.llm import graphann, htmltext, langid, lines, mixture
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string"


def documents(spark):
    rows = [(i, f"a line of words number {i % 7}\nand another one of {i}", "en", "abc"[i % 3]) for i in range(60)]
    return spark.createDataFrame([*rows, (None, None, None, None), (None, "", "en", "a")], DOCS)


def test_mixture_with_clashing_columns(spark):
    docs = documents(spark)
    names = sorted(mixture.INNER | {"source_size", "Line_"})
    wide = docs.select("*", *(F.concat(F.lit(n + " "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias(n) for n in names))
    plain, got = mixture.mix_sources(docs), mixture.mix_sources(wide)
    assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    kept = [n for n in names if n not in mixture.OUTPUTS and n != "source_size"]
    assert set(got.columns) == set(plain.columns) | set(kept)
    for r in got.collect():
        assert all(r[n] == f"{n} {'null' if r.doc_id is None else r.doc_id}" for n in kept)


def test_line_dedup_with_clashing_columns(spark):
    docs = documents(spark)
    names = ["removed_lines", "_id", "_key", "id", "key", "line", "words", "c", "first"]
    wide = docs.select("*", *(F.lit(n).alias(n) for n in names))
    plain, got = lines.dedup(docs, 1), lines.dedup(wide, 1)
    assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert all(r[n] == n for r in got.collect() for n in names[1:])


def test_equal_lines_of_null_and_repeated_ids(spark):
    same = "one and the same line of words"
    docs = spark.createDataFrame([(None, same + "\nalpha"), (None, same + "\nbeta"), (7, same + "\ngamma"), (7, same + "\ndelta")], "doc_id long, text string")
    got = lines.dedup(docs, 1).collect()
    assert sum(same in r.text for r in got) == 1 and [r.doc_id for r in got if same in r.text] == [7]
    twice = docs.limit(0).unionByName(spark.createDataFrame([(3, same)] * 2, "doc_id long, text string"))
    assert [r.text for r in lines.dedup(twice, 1).collect()] == [same] * 2     # rows repeated whole are the same lines


def test_flow_of_many_sources_is_quick():
    rng = random.Random(4)
    patterns = {(f"s{i:04}",): rng.randint(0, 1000) for i in range(5000)}
    sizes = {p[0]: n for p, n in patterns.items()}
    quotas = mixture.targets(sizes, mixture.cyclic_weights(list(sizes)))
    began = time.monotonic()
    used = mixture.flow(patterns, quotas)
    assert all(sum(used[s,]) == pytest.approx(quotas[s]) for s in quotas) and time.monotonic() - began < 20


def cheapest(patterns, quotas, repeats):
    """Least cost of the greatest flow, one token at a time by Bellman-Ford over all nodes."""
    used, given, room = dict.fromkeys(patterns, 0), {(p, s): 0 for p in patterns for s in p}, dict(quotas)
    cost = 0
    while True:
        reach = {}
        for p in sorted(patterns, key=lambda p: used[p] // patterns[p] if patterns[p] else 99):
            if not patterns[p] or used[p] >= repeats * patterns[p]:
                continue
            ways, queue = {p: [p]}, [p]
            for node in queue:
                steps = node if isinstance(node, tuple) else [q for q, s in given if s == node and given[q, s] > 0]
                for x in steps:
                    if x not in ways:
                        ways[x] = [*ways[node], x]
                        queue.append(x)
            ends = [x for x in ways if not isinstance(x, tuple) and room[x] > 0]
            if ends:
                reach = ways[ends[0]]
                break
        if not reach:
            return sum(used.values()), cost
        cost += (used[reach[0]] // patterns[reach[0]]) ** 2
        used[reach[0]] += 1
        room[reach[-1]] -= 1
        for p, s in zip(reach[::2], reach[1::2]):
            given[p, s] += 1
        for s, p in zip(reach[1::2], reach[2::2]):
            given[p, s] -= 1


def test_flow_costs_least():
    rng = random.Random(6)
    for _ in range(150):
        sources = "abcde"[:rng.randint(1, 5)]
        patterns = {tuple(sorted(rng.sample(sources, rng.randint(1, len(sources))))): rng.randint(0, 6) for _ in range(rng.randint(1, 6))}
        quotas = {s: rng.randint(0, 15) for s in sources}
        used = mixture.flow(patterns, {s: float(q) for s, q in quotas.items()})
        got = sum(map(sum, used.values())), sum(k * k * x for u in used.values() for k, x in enumerate(u))
        assert got == cheapest(patterns, quotas, 3), (patterns, quotas)
        assert all(b == 0 or a == patterns[p] for p, u in used.items() for a, b in zip(u, u[1:]))


@pytest.mark.parametrize("name", ["unit", "log-normal", "one outlier", "huge"])
def test_nearest_neighbours_of_any_lengths(spark, name):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(2000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if name == "log-normal":
        x *= rng.lognormal(0, 1, (len(x), 1))
    elif name == "one outlier":
        x[123] *= 1e4
    elif name == "huge":
        x *= 10.0 ** rng.uniform(100, 150, (len(x), 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found: dict[int, set] = {}
    for r in graphann.nearest(df, df.where("vec_id % 20 = 0"), 20).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, len(x), 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    assert hits / (20 * len(found)) >= 0.95 and len(found) == 100


def test_deep_and_unclosed_pages_take_linear_work():
    began = time.monotonic()
    for page in ("<div>x" * 40_000, "<p>x<div>" * 40_000, "<ul><li>x" * 40_000, "x</b>" * 40_000, "<div class=a>" * 40_000 + "x</p>" * 40_000):
        found = htmltext.blocks(page)
        assert 1 <= len(found) <= 40_000 and len({place for place, _ in found}) <= 4
    assert time.monotonic() - began < 60


def test_letters_of_all_planes_are_letters(spark):
    rows = [(i, "the plain words of a text " * 3, "en") for i in range(20)] + [(100, "\U00030000\U00031350 \U00030001", None), (101, "123 \U0001F600 _", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, langid.learn(docs)).collect()}
    assert got[100] == "en" and got[101] == "und"


def test_learners_of_repeated_ids_agree(spark):
    rows = [(i % 10, f"text {i} of a document " * 3, "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    a, b = langid.learn(docs), langid.learn(docs.orderBy(F.desc("text")).repartition(5))
    assert np.array_equal(a.weights, b.weights) and a.heat == b.heat


def test_article_blocks_of_the_other_parser():
    assert brute.article_blocks("<nav>n</nav><article><h1>a &amp;\n b</h1><p>c<b>d</b></article><p>e") == ["a & b", "cd"]
