"""Importance resampling, collocations and SimHash against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import sha256
from itertools import combinations
from zlib import crc32

import brute
import numpy as np
import pytest
import xxhash
from docfold.llm import bitslice, phrases, resample, wordruns

DOC = "doc_id long, text string, lang string, weight string, rank int, fp long, h1 string, score double"


def documents(spark, rows):
    """Rows (doc_id, text, lang) with columns whose names clash with those the operators use."""
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 0.5) for r in rows], DOC)


def texts(seed: int, n: int = 60) -> list[str | None]:
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", "New", "york", "city", "Ärger", "ΩΩ", "x1", "don't", "a-b", " z", "\x0bq", "e.g", "İI"]
    out = [None, "", " \n\t ", "one", "One. Two", "the of, the of", "\x00 nul"]
    for _ in range(n):
        w, size = [], rng.choice([2, 10, 40, 120])
        while len(w) < size:
            w += ["new", "York", "City"] if rng.random() < 0.2 else [rng.choice(vocabulary)]
        out.append("".join(x + rng.choice([" ", " ", " ", "  ", "\t", "\n", ". ", "! "]) for x in w))
    return out


# --- importance resampling ---------------------------------------------------------------------

def resampled(docs, target, percent, longest, buckets):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(text):
        w = word.findall(brute.lower(text or ""))
        return len(w), [crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = (Counter(f for x in rows for f in features(x)[1]) for rows in ([d[1] for d in docs], target))
    S, T = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in docs:
        n, found = features(text)
        h = int(sha256(f"2024:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[f] for f in found)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= 20])
    drawn = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = drawn[:percent * len(drawn) // 100]
    order = sorted([(r[0], *r[1:4], k + 1) for k, r in enumerate(drawn)], key=str)
    every = sorted([(r[0], *r[1:4]) for r in out], key=str)
    return every, order


@pytest.mark.parametrize("longest,buckets", [(1, 10_000), (3, 97)])
def test_resampling_matches_plain_python(spark, longest, buckets):
    docs = [(i * 7 % 101, t) for i, t in enumerate(texts(1))] + [(None, "the of " * 15), (3, "new york city " * 9), (3, "new york city " * 9)]
    target = [t for t in texts(2, 5)] + ["new york city", None]
    got = resample.resample(documents(spark, [(i, t, "en") for i, t in docs]), spark.createDataFrame([(t, 1) for t in target], "text string, n int"),
                            percent=50, buckets=buckets, longest=longest).collect()
    every, drawn = resampled(docs, target, 50, longest, buckets)
    assert sorted([tuple(r)[:4] for r in got], key=str) == every
    assert sorted([tuple(r) for r in got if r.rank], key=str) == drawn and drawn


def test_resampling_of_nothing(spark):
    none = documents(spark, [])
    target = spark.createDataFrame([], "item_id int, text string")
    assert resample.resample(none, target).count() == 0
    got = resample.resample(documents(spark, [(1, "a " * 30, None)] * 30), target).collect()
    assert sorted(r.rank for r in got if r.rank) == [1, 2, 3] and {r.n_features for r in got} == {30}


def test_ranks_over_many_ranges(spark):
    rows = spark.range(5000).selectExpr("id % 7 AS score", "id % 900 AS doc_id")
    from pyspark.sql import functions as F

    got = resample.ranked(rows, 3000, [F.col("score").desc(), F.col("doc_id").asc()]).collect()
    want = sorted(((i % 7, i % 900) for i in range(5000)), key=lambda r: (-r[0], r[1]))
    assert [(r.score, r.doc_id) for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == want[:3000] and len(got) == 5000


def test_runs_keep_words_whole():
    text = ("word " * 50 + "x" * 300 + " é" * 40).encode()
    table = wordruns.folding(b" \n")
    for limit in (1, 7, 64, 1 << 20):
        assert [w for r in wordruns.runs(text, table, limit) for w in r] == text.split()


# --- collocations ------------------------------------------------------------------------------

def collocations(docs, top, least, percent):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found, candidates = [], {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            if len(p) == 2 and any(100 * b >= percent * a for q, b in candidates.items() if len(q) == 3 and p in (q[:2], q[1:])):
                continue
            score, k = min((int(Fraction(1_000_000 * a * a, counts[p[:k]] * counts[p[k:]])), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.mark.parametrize("top,least,percent,start", [(2000, 3, 50, 3), (5, 2, 50, 1), (12, 4, 90, 1), (1, 2, 10, 1)])
def test_collocations_match_plain_python(spark, top, least, percent, start):
    docs = [(lang, t) for i, t in enumerate(texts(3, 80)) for lang in [(None, "en", "de", "und")[i % 4]]] + [("fr", "a. b, c")]
    got = phrases.collocations(documents(spark, [(i, t, lang) for i, (lang, t) in enumerate(docs)]), top, least, percent, start).collect()
    want = collocations(docs, top, least, percent)
    assert sorted(tuple(r) for r in got) == want and len({w[0] for w in want}) == 3


def test_collocations_of_one_fixed_passage_and_of_nothing(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    got = phrases.collocations(documents(spark, [(i, passage, "en") for i in range(12)]), 20).collect()
    assert sorted(tuple(r) for r in got) == collocations([("en", passage)] * 12, 20, 10, 50)
    assert phrases.collocations(documents(spark, []), 20).count() == 0
    assert phrases.collocations(documents(spark, [(1, None, None)]), 20).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, first, rest = 987654321012, 987654321013, 998877665544
    row = spark.createDataFrame([(a, first, rest)], "a long, l long, r long").select(phrases.score("a", "l", "r").alias("s")).first()
    assert row.s == 1_000_000 * a * a // (first * rest)


# --- SimHash -----------------------------------------------------------------------------------

def simhash(text):
    w = brute.words(text)
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_matches_plain_python(spark):
    rng = random.Random(5)
    base = [t for t in texts(4, 25) if t] * 2
    near = [t.replace("york", "park", 1) for t in base if len(t) > 300]
    docs = list(zip(rng.sample(range(500), len(base) + len(near) + 3), base + near + [None, "", "two words"]))
    docs += [(docs[0][0], docs[5][1]), (None, near[0]), (None, "quite another text of its own"), docs[3]]
    got = bitslice.link(documents(spark, [(i, t, None) for i, t in docs]), radius=4).collect()
    prints = [(i, simhash(t)) for i, t in docs]
    pairs = [(a, b) for a, b in combinations(range(len(docs)), 2)
             if (prints[a][1] ^ prints[b][1]).bit_count() <= 4 or (docs[a][0] is not None and docs[a][0] == docs[b][0])]
    root = brute.roots(pairs, range(len(docs)))
    least = {r: min((docs[i][0] for i in root if root[i] == r and docs[i][0] is not None), default=None) for r in root.values()}
    want = [(i, f"{p:016x}", least[root[k]]) for k, (i, p) in enumerate(prints)]
    assert sorted([tuple(r) for r in got], key=str) == sorted(want, key=str)
    assert any(i is not None and c != i for i, _, c in want)


def test_simhash_of_nothing_and_of_one_text(spark):
    assert bitslice.link(documents(spark, [])).count() == 0
    got = bitslice.link(documents(spark, [(7, "same text here", None), (None, "same text here", None)] * 20)).collect()
    assert {r.component_id for r in got} == {7} and len(got) == 40


def test_long_texts_are_hashed_run_by_run(monkeypatch):
    text = " ".join(f"word{i}" for i in range(3000)).encode()
    table = wordruns.folding(bitslice.SPACES)
    whole = bitslice.fingerprint(text, table)
    monkeypatch.setattr(wordruns.runs, "__defaults__", (50,))
    assert bitslice.fingerprint(text, table) == whole == simhash(text.decode())


def components(fps, radius):
    pairs = [(a, b) for a, b in combinations(sorted(fps), 2) if (a ^ b).bit_count() <= radius]
    return brute.roots(pairs, fps)


@pytest.mark.parametrize("radius", [1, 2, 3, 6])
def test_forest_of_bit_planes_connects_what_brute_force_does(radius):
    rng = random.Random(radius)
    fps, group = [], []
    for g, size in enumerate((2, 300, 3, 130, 64, 65, 2)):
        centre = rng.getrandbits(64)
        some = {centre}
        while len(some) < size:
            flips = rng.sample(range(64), rng.choice([1, 2, 3, 9]))
            some.add(rng.choice(sorted(some)) ^ sum(1 << b for b in flips))
        fps += sorted(some)
        group += [g] * size
    got = bitslice.forest(np.array(fps, np.uint64), np.array(group), radius).tolist()
    for g in set(group):
        mine = [f for f, x in zip(fps, group) if x == g]
        want = components(mine, radius)
        assert brute.roots([p for p in got if p[0] in want], mine) == want


def test_crowded_buckets_are_split_and_nothing_is_lost(spark):
    rng = random.Random(9)
    fps = {rng.getrandbits(8) << rng.choice([0, 8, 40]) | rng.getrandbits(6) << 20 for _ in range(1200)}
    rows = spark.createDataFrame([(f if f < 1 << 63 else f - (1 << 64),) for f in fps], "fp long")
    links, levels = [], 0
    for found, masks in bitslice.buckets(rows, 2, limit=16):
        levels += 1
        dealt = found.repartition(3, "m", "k").sortWithinPartitions("m", "k", "fp")
        links += [tuple(x % (1 << 64) for x in r) for r in dealt.mapInArrow(bitslice._linked(2), "a long, b long").collect()]
    assert levels > 1 and all((a ^ b).bit_count() <= 2 for a, b in links)
    assert brute.roots(links, fps) == components(fps, 2)


# --- memory of tasks ---------------------------------------------------------------------------

def test_phrases_held_in_a_task_take_little_memory():
    rng = np.random.default_rng(5)
    parts = [[rng.integers(0, 400, 1 << 14).astype(np.uint64) for _ in range(2)] for _ in range(256)]
    held, got, want = phrases._Combined(2), Counter(), Counter()
    largest = 0
    for keys in parts:
        want.update(zip(*(k.tolist() for k in keys)))
        for batch in held.add(keys):
            for a, b, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                got[a, b] += n
        largest = max(largest, held.n)
    for batch in held.flush():
        for a, b, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            got[a, b] += n
    assert got == want and largest <= 1 << 20


def test_words_of_a_batch_hold_one_text_each(monkeypatch):
    """A word that stands in many pieces of a batch is one row, and its text was made once."""
    import pyarrow as pa
    from docfold.llm import textcore

    monkeypatch.setattr(textcore, "PIECE_BYTES", 64)
    monkeypatch.setattr(textcore.pieces, "__defaults__", (64,))
    made = ["Ab c, d" + " Ärger ab" * 3, None, "c AB x. y", "ab c d e f g " * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 4), pa.array([7] * 4, pa.int64()), pa.array(made)], names=["lang", "lh", "text"])
    out = [b for b in phrases._words(iter([batch, batch]))]
    want = Counter(w for t in made for w in re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", brute.lower(t or "")))
    for b in out:
        assert dict(zip(b.column(1).to_pylist(), b.column(3).to_pylist())) == want and len(b) == len(want) == len(set(b.column(2).to_pylist()))
    assert len(out) == 2
