"""The folds against applying the ops one by one."""

import random

import pytest
from pyspark.sql import functions as F

from docfold.operators import fold

FIELDS = ["a", "b", "c", "d"]
OPS = "collection string, id string, op string, offset bigint, fields map<string, string>"


def log(seed, n, kinds, ids=12):
    rng = random.Random(seed)
    out = []
    for offset in range(n):
        op = rng.choices(list(kinds), list(kinds.values()))[0]
        fields = None
        if op != "delete":
            fields = {f: rng.choice([None, f"{f}{offset}"]) if op == "update" else f"{f}{offset}"
                      for f in rng.sample(FIELDS, rng.randint(0 if op == "update" else 1, len(FIELDS)))}
        # One id takes a third of all ops.
        name = "hot" if rng.random() < 0.34 else f"id{rng.randrange(ids)}"
        out.append((rng.choice(["x", "y"]), name, op, offset, fields))
    return out


def one_by_one(ops, start=(), create=True):
    docs, refused = {k: dict(v) for k, v in start}, []
    for c, i, op, offset, fields in sorted(ops, key=lambda o: o[3]):
        key = (c, i)
        if op == "delete":
            docs.pop(key, None)
        elif op == "replace":
            docs[key] = dict(fields)
        elif fields:
            if key not in docs and not create:
                refused.append(offset)
                continue
            doc = docs.setdefault(key, {})
            for f, v in fields.items():
                doc.pop(f, None)
                if v is not None:
                    doc[f] = v
    return docs, refused


def as_dict(df):
    return {(r.collection, r.id): dict(r.fields) for r in df.collect()}


MIXES = [{"replace": 5, "delete": 1}, {"update": 5, "delete": 1}, {"update": 6, "replace": 2, "delete": 1}, {"update": 1}]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("mix", range(len(MIXES)))
def test_fields(spark, seed, mix):
    ops = log(seed, 400, MIXES[mix])
    expected, _ = one_by_one(ops)
    assert as_dict(fold.apply_fields(spark.createDataFrame(ops, OPS).repartition(5))) == expected


@pytest.mark.parametrize("seed", range(3))
def test_deltas_combine_in_any_grouping(spark, seed):
    ops = log(seed, 400, MIXES[2])
    expected, _ = one_by_one(ops)
    random.Random(seed).shuffle(ops)
    parts = [ops[i::3] for i in range(3)]
    deltas = None
    for p in parts + parts[:1]:                 # the first part is delivered twice
        d = fold.delta(spark.createDataFrame(p, OPS))
        deltas = d if deltas is None else deltas.unionByName(d)
    assert as_dict(fold.documents(fold.merge_deltas(deltas))) == expected


@pytest.mark.parametrize("seed", range(3))
def test_columns(spark, seed):
    ops = log(seed, 400, MIXES[2])
    expected, _ = one_by_one(ops)
    df = spark.createDataFrame(ops, OPS).where((F.col("op") != "update") | (F.size("fields") > 0))
    carried = {f: F.map_contains_key("fields", f) for f in FIELDS}
    wide = df.select("*", *[F.try_element_at("fields", F.lit(f)).alias(f) for f in FIELDS])
    got = fold.apply_columns(wide, FIELDS, carried=carried)
    assert {(r.collection, r.id): {f: r[f] for f in FIELDS if r[f] is not None} for r in got.collect()} == expected


@pytest.mark.parametrize("seed", range(3))
def test_atomic(spark, seed):
    ops = log(seed, 300, MIXES[1])
    start = [(("x", "hot"), {"a": "old", "d": "kept"}), (("y", "id3"), {"b": "old"}), (("x", "untouched"), {"c": "z"})]
    expected, refused = one_by_one(ops, start, create=False)
    target = spark.createDataFrame([(c, i, f) for (c, i), f in start], "collection string, id string, fields map<string,string>")
    df = spark.createDataFrame(ops, OPS)
    assert as_dict(fold.apply_atomic(target, df)) == expected
    assert sorted(r.offset for r in fold.atomic_rejects(target, df).collect()) == refused


@pytest.mark.parametrize("seed", range(3))
def test_whole_documents(spark, seed):
    ops = log(seed, 300, MIXES[0])
    expected, _ = one_by_one(ops)
    assert as_dict(fold.apply_index(spark.createDataFrame(ops, OPS))) == expected


@pytest.mark.parametrize("seed", range(3))
def test_version_guard(spark, seed):
    rng = random.Random(seed)
    rows = [("x", f"i{rng.randrange(4)}", rng.choice(["replace", "delete"]), rng.randrange(60), n) for n in range(200)]
    stored, applied = {}, []
    for c, i, op, version, n in rows:
        ok = i not in stored or version > stored[i][1]
        applied.append(ok)
        if ok:
            stored[i] = (op, version, n)
    df = spark.createDataFrame(rows, "collection string, id string, op string, version bigint, arrival bigint")
    state = fold.by_version(df, "version", "arrival")
    assert {r.id: (r.op, r.version, r.arrival) for r in state.collect()} == stored
    trace = fold.version_guard_trace(df, "version", "arrival", width=7).orderBy("arrival")
    assert [r.applied for r in trace.collect()] == applied


def test_soft_delete_outlives_a_late_write(spark):
    rows = [("c", "6", "replace", 10, 1, "v10"), ("c", "6", "delete", 20, 2, None), ("c", "6", "replace", 15, 3, "resurrected"),
            ("c", "1", "replace", 10, 4, "NEW"), ("c", "1", "replace", 5, 5, "STALE"), ("c", "1", "replace", 20, 6, "NEWEST")]
    df = spark.createDataFrame(rows, "collection string, id string, op string, _offset_ver bigint, arrival bigint, name string")
    docs = fold.soft_deletes(df, "_offset_ver", "arrival")
    assert {(r.id, r._offset_ver, r.name, r._deleted) for r in docs.collect()} == {("6", 20, None, True), ("1", 20, "NEWEST", None)}
    assert [r.id for r in fold.live(docs).collect()] == ["1"]
    assert fold.purge_deleted(docs, "_offset_ver", 21).count() == 1 and fold.purge_deleted(docs, "_offset_ver", 20).count() == 2
    assert fold.delete_all(docs).count() == 0


def test_apply_order_examples(spark):
    rows = [("t", "u1", "delete", 100, None), ("t", "u1", "replace", 101, {"n": "recreated"}), ("t", "u2", "replace", 200, {"n": "x"}),
            ("t", "u2", "delete", 201, None), ("t", "a", "replace", 300, {"n": "a1"}), ("t", "b", "replace", 301, {"n": "b1"}),
            ("t", "a", "delete", 302, None), ("t", "a", "replace", 303, {"n": "a2"}), ("t", "b", "delete", 304, None)]
    got = as_dict(fold.apply_index(spark.createDataFrame(rows, OPS)))
    assert got == {("t", "u1"): {"n": "recreated"}, ("t", "a"): {"n": "a2"}}
