"""The stored table: commits, conditional writes, declared fields, existence by bucket."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from docfold.operators import fold, versions
from docfold.operators.schema import Collections, MissingCollection
from docfold.options import FoldOptions
from docfold.plans.ingest import classify, convert, split
from docfold.sources.changes import CHANGE_SCHEMA, read_changes
from docfold.streaming import commits, table as stored
from docfold.streaming.apply import apply_batch, start
from docfold.streaming.state import decide_writes
from docfold.streaming.table import DocumentTable
from test_streaming import OPS, docs, frame

WARN = {"behavior_on_malformed_documents": "warn", "behavior_on_null_values": "delete"}


def put(spark, table, number, *rows, stream="main", options=FoldOptions(**WARN)):
    """Rows are (offset, key, value)."""
    apply_batch(frame(spark, [("t", 0, o, k, v, None, None) for o, k, v in rows]), number, table, options, stream=stream)


# --- commits -----------------------------------------------------------------------------------

def test_an_entry_is_created_once(spark, tmp_path):
    log = commits.CommitLog(commits.Files(spark), str(tmp_path / "log"))
    assert log.newest() == (-1, {}) and log.numbers() == []
    won = []

    def create(k):
        if log.create(0, {"by": k}):
            won.append(k)

    threads = [threading.Thread(target=create, args=(k,)) for k in range(12)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and log.newest() == (0, {"by": won[0]})
    assert not [p.name for p in (tmp_path / "log").iterdir() if p.name.startswith("_")]


def test_held_batches_stay_one_number_a_stream():
    held = {}
    for n in range(0, 1000, 10):
        held = commits.holding(held, [("a", n + i) for i in range(10)])
    assert held == {"a": [999, []]} and commits.holds(held, "a", 999) and not commits.holds(held, "a", 1000) and not commits.holds(held, "b", 0)
    gaps = commits.holding({}, [("a", 5), ("a", 0), ("a", 2)])
    assert gaps == {"a": [0, [2, 5]]} and not commits.holds(gaps, "a", 1) and commits.holding(gaps, [("a", 1)]) == {"a": [2, [5]]}


def test_two_compactions_at_once_lose_no_batch(spark, tmp_path, monkeypatch):
    """The second compaction reads the table before the first one commits, and writes its base after."""
    first, second = (DocumentTable(spark, str(tmp_path / "table")) for _ in range(2))
    put(spark, first, 0, (1, "a", '{"n":1}'), stream="one")
    create, other = commits.CommitLog.create, []

    def late(log, number, entry):
        if log._folder.endswith("bases") and not other:
            other.append(True)
            put(spark, second, 0, (2, "b", '{"n":2}'), stream="two")
            assert second.compact() == 0
            put(spark, second, 1, (3, "c", '{"n":3}'), stream="two")
        return create(log, number, entry)

    monkeypatch.setattr(commits.CommitLog, "create", late)
    assert first.compact() == 1
    want = {("t", "a"): {"n": ["1"]}, ("t", "b"): {"n": ["2"]}, ("t", "c"): {"n": ["3"]}}
    assert docs(first.read()) == want and first.held == {("one", 0), ("two", 0), ("two", 1)}
    first.vacuum()
    assert docs(second.read()) == want and len(list((tmp_path / "table" / "base").iterdir())) == 1


def test_two_streams_that_compact_all_the_time(spark, tmp_path):
    queries, want = [], {}
    for s in "xy":
        folder = str(tmp_path / f"log{s}")
        for n in range(4):
            rows = [("t", 0, 10 * n + i, f"{s}{i}", '{"n":%d}' % n, None, None) for i in range(n + 1)]
            frame(spark, rows).coalesce(1).write.mode("append").parquet(folder)
            want |= {("t", f"{s}{i}"): {"n": [str(n)]} for i in range(n + 1)}
        changes = read_changes(spark, path=folder, streaming=True, options={"maxFilesPerTrigger": "1"})
        queries.append(start(changes, DocumentTable(spark, str(tmp_path / "table"), "offset"), FoldOptions(), str(tmp_path / f"p{s}"), compact_every=1))
    assert all(q.awaitTermination(240) for q in queries)
    table = DocumentTable(spark, str(tmp_path / "table"), "offset")
    assert docs(table.read()) == want
    table.compact()
    assert {mark for mark, others in table._bases.newest()[1]["holds"].values() if not others} == {3}


def test_vacuum_keeps_what_a_kept_base_lacks(spark, tmp_path, monkeypatch):
    table = DocumentTable(spark, str(tmp_path / "table"))
    for n in range(3):
        put(spark, table, n, (n, f"k{n}", '{"n":1}'))
        table.compact()
    orphan = tmp_path / "table" / "base" / "half"
    orphan.mkdir()
    assert len(table.vacuum(keep=1)) == 3 and len(table.read().collect()) == 3 and orphan.exists()
    assert str(orphan) in " ".join(table.vacuum(keep=1, orphan_ms=-1))
    monkeypatch.setattr(stored, "ENTRIES", 1)
    assert len(table.vacuum()) == 2 and table._bases.numbers() == [1, 2] and len(table.read().collect()) == 3


def test_delete_all_of_a_stored_collection(spark, tmp_path):
    table = DocumentTable(spark, str(tmp_path / "table"))
    assert table.delete_all("t") == 0 and table.read().count() == 0
    put(spark, table, 0, (1, "a", '{"n":1}'), (2, "b", '{"n":2}'))
    put(spark, table, 1, (3, "c", '{"n":1}'), options=FoldOptions(collection="u", collection_naming_strategy="STATIC"))
    table.delete_all("t")
    assert docs(table.read()) == {("u", "c"): {"n": ["1"]}}
    put(spark, table, 2, (4, "a", '{"m":1}'))
    put(spark, table, 0, (1, "a", '{"n":1}'), (2, "b", '{"n":2}'))
    assert docs(table.read("t")) == {("t", "a"): {"m": ["1"]}}


# --- existence ---------------------------------------------------------------------------------

def test_untouched_buckets_are_not_read(spark, tmp_path):
    table = DocumentTable(spark, str(tmp_path / "table"), bucket_bytes=1 << 9)
    put(spark, table, 0, *[(i, f"k{i}", '{"n":1}') for i in range(200)])
    put(spark, table, 1, *[(200 + i, f"k{i}", None) for i in range(0, 200, 3)])
    table.compact()
    put(spark, table, 2, (500, "new", '{"n":1}'), (501, "k1", None))
    asked = [("t", k) for k in ("k0", "k1", "k2", "k4", "new", "no such")]
    among = spark.createDataFrame(asked, "collection string, id string")
    want = {"k2", "k4", "new"}
    assert {r.id for r in table.existing(among).collect()} == want
    entry = table._bases.newest()[1]
    assert entry["buckets"] >= 8
    touched = {r.b for r in among.select(table._bucket(entry["buckets"]).alias("b")).collect()}
    spoiled = [p for p in (tmp_path / "table" / "base").rglob("bucket=*/*.parquet") if int(p.parent.name.removeprefix("bucket=")) not in touched]
    assert spoiled
    for p in spoiled:
        p.write_bytes(b"no such bucket was asked for")
    assert {r.id for r in table.existing(among).collect()} == want
    stored_ids, stored.NAMED_IDS = stored.NAMED_IDS, 2
    try:
        assert {r.id for r in table.existing(among).collect()} == want
    finally:
        stored.NAMED_IDS = stored_ids


def test_filters_of_few_ids_reach_the_base_files(spark, tmp_path):
    table = DocumentTable(spark, str(tmp_path / "table"))
    put(spark, table, 0, (1, "a", '{"n":1}'), (2, "b", '{"n":2}'))
    table.compact()
    marks = table.marks(spark.createDataFrame([("t", "a")], "collection string, id string"))
    plan = marks._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "bucket" in scan.partition("PartitionFilters")[2] and "EqualTo(id,a)" in scan and "fields" not in scan


# --- conditional writes ------------------------------------------------------------------------

VERSIONED = FoldOptions(external_version_header="ver", **WARN)


def asking(spark, rows):
    """Rows are (offset, key, value, asked)."""
    made = [("t", 0, o, k, v, None if a is None else [{"key": "ver", "value": str(a).encode()}], None) for o, k, v, a in rows]
    return spark.createDataFrame(made, CHANGE_SCHEMA)


def version(spark, offset, order="offset"):
    at = F.lit(offset) if order == "offset" else F.struct(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(offset).alias("offset"))
    return spark.range(1).select(versions.version_of(at, order).alias("v")).first().v


@pytest.mark.parametrize("order", ["offset", "time"])
def test_versions_of_stored_documents(spark, tmp_path, order):
    table = DocumentTable(spark, str(tmp_path / "table"), order)
    v = {o: version(spark, o, order) for o in range(12)}
    apply_batch(asking(spark, [(0, "a", '{"n":0}', None), (1, "b", '{"n":1}', 1), (2, "c", '{"n":2}', -1), (3, "a", '{"n":3}', v[0])]), 0, table, VERSIONED)
    assert {r.id: r.version for r in table.read(versions=True).collect()} == {"a": v[3], "c": v[2]}
    table.compact()
    second = [(4, "a", '{"n":4}', v[0]), (5, "a", '{"n":5}', v[3]), (6, "c", '{"n":6}', -1), (7, "c", None, None), (8, "c", '{"n":8}', v[2]),
              (9, "c", '{"n":9}', -5), (10, "d", '{"n":10}', 77), (11, "d", '{"n":11}', 0)]
    for _ in range(2):
        apply_batch(asking(spark, second), 1, table, VERSIONED)
    assert docs(table.read()) == {("t", "a"): {"n": ["5"]}, ("t", "c"): {"n": ["9"]}, ("t", "d"): {"n": ["11"]}}
    dead = {(r.offset, r.reason, r.value) for r in table.dead_letters().collect()}
    assert dead == {(o, versions.CONFLICT, '{"n":%d}' % o) for o in (1, 4, 6, 8, 10)}
    table.compact()
    apply_batch(asking(spark, second), 1, table, VERSIONED)      # held by the base: neither documents nor dead letters change
    assert {(r.offset, r.reason, r.value) for r in table.dead_letters().collect()} == dead


def test_a_conflict_fails_a_strict_batch(spark, tmp_path):
    table = DocumentTable(spark, str(tmp_path / "table"))
    with pytest.raises(ValueError, match="version conflict"):
        apply_batch(asking(spark, [(1, "a", "{}", 1)]), 0, table, FoldOptions(external_version_header="ver"))
    assert table.read().count() == 0
    apply_batch(asking(spark, [(1, "a", "{}", 1)]), 0, table, FoldOptions(**WARN))      # without the option the header says nothing
    assert table.read().count() == 1


def test_partial_updates_with_versions(spark, tmp_path):
    """Under ATOMIC_UPDATE a write that names no version asks for an existing document; one that does, for that."""
    table = DocumentTable(spark, str(tmp_path / "table"), "offset")
    put(spark, table, 0, (0, "a", '{"n":0,"m":0}'))
    atomic = FoldOptions(write_method="ATOMIC_UPDATE", external_version_header="ver", **WARN)
    rows = [(1, "a", '{"n":1}', version(spark, 0)), (2, "b", '{"n":2}', None), (3, "c", '{"n":3}', -1), (4, "a", '{"m":null}', version(spark, 0)), (5, "a", "{}", 99)]
    apply_batch(asking(spark, rows), 1, table, atomic)
    assert docs(table.read()) == {("t", "a"): {"n": ["1"], "m": ["0"]}, ("t", "c"): {"n": ["3"]}}
    assert {r.offset for r in table.dead_letters().collect()} == {2, 4}


@pytest.mark.parametrize("seed", [1, 2])
def test_conditional_streams_against_one_by_one(spark, tmp_path, seed):
    rng, plain, rows, dead = random.Random(seed), {}, [], set()
    v = [r.v for r in spark.range(120).select(versions.version_of(F.col("id")).alias("v"), "id").orderBy("id").collect()]
    for o in range(120):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(4)}"
        value = None if rng.random() < 0.1 else '{"n":%d}' % o
        asked = rng.choice([None, 0, 1, -1, plain.get(key, (None, 9))[1], plain.get(key, (None, 9))[1], rng.choice(v)])
        rows.append((o, key, value, asked))
        if value is None:
            plain.pop(key, None)
        elif versions.accepts(asked, key in plain, plain.get(key, (None, None))[1]):
            plain[key] = (o, v[o])
        else:
            dead.add(o)
    folder, at = str(tmp_path / "log"), 0
    while at < len(rows):
        step = rng.randint(10, 60)
        asking(spark, rows[at:at + step]).coalesce(1).write.mode("append").parquet(folder)
        at += step
    table = DocumentTable(spark, str(tmp_path / "table"), "offset")
    changes = read_changes(spark, path=folder, streaming=True, options={"maxFilesPerTrigger": "1"})
    start(changes, table, VERSIONED, str(tmp_path / "progress"), compact_every=2).awaitTermination()
    assert docs(table.read()) == {("t", k): {"n": [str(o)]} for k, (o, _) in plain.items()}
    assert {r.offset for r in table.dead_letters().collect()} == dead and dead


def decided(spark, tmp_path, rows, rule, **kw):
    """A stream over the files of `ops` so far, on one checkpoint."""
    folder, name = str(tmp_path / "ops"), f"later_{rule}_{len(rows)}_{rows[0][1]}"
    spark.createDataFrame(rows, OPS).coalesce(1).write.mode("append").parquet(folder)
    out = str(tmp_path / name)
    q = decide_writes(spark.readStream.schema(OPS).parquet(folder), rule, **kw).writeStream.outputMode("update").foreachBatch(
        lambda df, n: df.write.mode("append").parquet(out)).option("checkpointLocation", str(tmp_path / "progress")).trigger(once=True).start()      # with a time limit, a stream is never at its end
    assert q.awaitTermination(120)
    return {(r.id, r.offset): r.applied for r in spark.read.parquet(out).collect()}


def test_must_exist_across_batches(spark, tmp_path):
    assert decided(spark, tmp_path, [("a", 1, "set", None, 1)], "must_exist") == {("a", 1): False}
    assert decided(spark, tmp_path, [("a", 2, "delete", None, 2), ("a", 3, "set", None, 3)], "must_exist") == {("a", 2): True, ("a", 3): False}


def test_state_that_was_not_written_for_long_is_forgotten(spark, tmp_path):
    """A guard remembers the delete at 20, until it has expired: then an older write is taken."""
    assert decided(spark, tmp_path, [("a", 20, "delete", None, 1)], "guard", ttl_ms=1) == {("a", 20): True}
    assert decided(spark, tmp_path, [("a", 15, "set", None, 2)], "guard", ttl_ms=1) == {("a", 15): True}


# --- declared fields ---------------------------------------------------------------------------

def typed(spark, rows, schema, topic="t"):
    """Rows are (offset, value as a tuple)."""
    return spark.createDataFrame([(topic, 0, o, f"k{o}", v) for o, v in rows],
                                 f"topic string, partition int, offset bigint, key string, value struct<{schema}>")


def test_a_batch_grows_the_catalog_and_later_ones_keep_to_it(spark, tmp_path):
    table, options = DocumentTable(spark, str(tmp_path / "table"), "offset"), FoldOptions(schema_auto_evolve=True, **WARN)
    apply_batch(typed(spark, [(1, (170, ["x"]))], "height_cm: bigint, tags: array<string>"), 0, table, options)
    assert table.catalog() == {"t": {"height_cm": ["plong", False, False], "tags": ["string", True, False]}}
    apply_batch(typed(spark, [(2, ("tall", "n")), (3, (" 0180", "m"))], "height_cm: string, nick: string"), 1, table, options)
    assert table.catalog()["t"] == {"height_cm": ["plong", False, False], "tags": ["string", True, False], "nick": ["string", False, False]}
    assert docs(table.read()) == {("t", "k1"): {"height_cm": ["170"], "tags": ["x"]}, ("t", "k3"): {"height_cm": ["180"], "nick": ["m"]}}
    assert [tuple(r)[3:] for r in table.dead_letters().select("topic", "partition", "offset", "key", "value", "reason").collect()] == [
        ("k2", '{"height_cm":"tall","nick":"n"}', "field height_cm is no plong")]
    # JSON records are held to the catalog, and never grow it
    put(spark, table, 2, (9, "j", '{"height_cm":"x","new":1}'), (10, "l", '{"height_cm":null,"new":1}'))
    assert ("t", "l") in docs(table.read()) and ("t", "j") not in docs(table.read()) and "new" not in table.catalog()["t"]
    with pytest.raises(Exception, match="no plong"):
        apply_batch(typed(spark, [(11, ("tall",))], "height_cm: string"), 3, table, FoldOptions())


@pytest.mark.parametrize("off", [{}, {"schema_auto_evolve": True, "schema_ignore": True}, {"schema_auto_evolve": True, "topic_schema_ignore": ("t",)}])
def test_schemas_that_are_ignored_declare_nothing(spark, tmp_path, off):
    table = DocumentTable(spark, str(tmp_path / "table"), "offset")
    batch = typed(spark, [(1, (1,))], "n: int").unionByName(typed(spark, [(2, (2,))], "n: int", "other"))
    apply_batch(batch, 0, table, FoldOptions(**off))
    assert set(table.catalog()) == ({"other"} if "topic_schema_ignore" in off else set()) and table.read().count() == 2


def test_two_writers_grow_one_catalog(spark, tmp_path, monkeypatch):
    first, second = (DocumentTable(spark, str(tmp_path / "table")) for _ in range(2))
    create, other = commits.CommitLog.create, []

    def late(log, number, entry):
        if not other:
            other.append(second)
            second.declare("c", {"b": ["pint", False, False]})
        return create(log, number, entry)

    monkeypatch.setattr(commits.CommitLog, "create", late)
    assert first.declare("c", {"a": ["string", False, False], "b": ["string", False, False]}) == ["a"]
    assert first.catalog() == {"c": {"a": ["string", False, False], "b": ["pint", False, False]}}


def test_growth_that_fails_is_a_warning(spark, tmp_path, monkeypatch):
    table = DocumentTable(spark, str(tmp_path / "table"), "offset")
    monkeypatch.setattr(table, "declare", lambda *a: 1 / 0)
    with pytest.warns(UserWarning, match="does not get its new fields"):
        apply_batch(typed(spark, [(1, (1,))], "n: int"), 0, table, FoldOptions(schema_auto_evolve=True))
    assert table.read().count() == 1


def test_every_type_of_a_declared_field(spark):
    catalog = {"t": {"i": "pint", "l": "plong", "f": "pfloat", "d": "pdouble", "b": "boolean", "at": "pdate", "s": "string"}}
    good = '{"i":"2147483647","l":[1,null,"-9"],"f":"1e3","d":" 2.5 ","b":"true","at":"2024-01-02T03:04:05Z","s":"anything","x":"tall"}'
    bad = {"i": "2147483648", "l": '"1.5"', "f": '"f"', "d": '"d"', "b": '"maybe"', "at": '"soon"'}
    rows = [(0, good)] + [(n + 1, '{"%s":%s}' % kv) for n, kv in enumerate(bad.items())]
    found = convert(frame(spark, [("t", 0, o, str(o), v, None, None) for o, v in rows]), FoldOptions(**WARN), catalog)
    assert [r.id for r in found.ops.collect()] == ["0"]
    assert {r.key: r.reason for r in found.dead.collect()} == {str(n + 1): f"field {k} is no {catalog['t'][k]}" for n, k in enumerate(bad)}
    other = convert(frame(spark, [("u", 0, 1, "1", '{"i":"x"}', None, None)]), FoldOptions(**WARN), catalog)
    assert other.ops.count() == 1


def test_targets_are_the_collections_of_the_table(spark, tmp_path):
    table = DocumentTable(spark, str(tmp_path / "table"))
    rows = frame(spark, [("t x", 0, 1, "a", '{"n":1}', None, None)])
    strict, made = FoldOptions(external_resource_usage="REQUIRED"), FoldOptions(schema_auto_create=True)
    for options in (strict, FoldOptions()):
        with pytest.raises(MissingCollection):
            apply_batch(rows, 0, table, options, Collections(spark, table, options))
    apply_batch(rows, 0, table, made, Collections(spark, table, made))
    assert table.catalog() == {"t x": {}} and table.collections() == {"t x"}
    apply_batch(rows, 1, table, strict, Collections(spark, table, strict))
    undeclared = DocumentTable(spark, str(tmp_path / "other"))
    apply_batch(rows, 0, undeclared, FoldOptions())
    undeclared.compact()
    assert undeclared.collections() == {"t x"}


# --- one conversion, one shuffle ------------------------------------------------------------------

@pytest.mark.parametrize("method", ["INDEX", "ATOMIC_UPDATE"])
def test_classified_records_are_the_converted_ones(spark, method):
    rows = [("t", 0, 0, "a", '{"i":" 07"}', None, None), ("t", 0, 1, "b", '{"i":"x"}', None, None), ("t", 0, 2, "a", None, None, None),
            ("t", 0, 3, "c", "[1]", None, None), ("t", 0, 4, None, '{"i":1}', None, None), ("t", 0, 5, None, None, None, None),
            ("t", 0, 6, "d", "{}", None, None), ("t", 0, 7, "e", "not JSON", None, None)]
    log, options, catalog = frame(spark, rows), FoldOptions(write_method=method, **WARN), {"t": {"i": "plong"}}
    two, one = convert(log, options, catalog), split(classify(log, options, catalog), log.columns)
    for a, b in ((two.ops, one.ops), (two.dead, one.dead)):
        assert a.schema.simpleString() == b.schema.simpleString()
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert {r.offset for r in one.dead.collect()} == {1, 3, 4, 7}


def test_whole_documents_fold_in_one_shuffle(spark):
    rows = [("t", "a", "replace", 0, {"x": ["1"], "y": ["2"]}), ("t", "a", "replace", 3, {"x": ["3"]}), ("t", "b", "replace", 1, {"x": ["4"]}),
            ("t", "b", "delete", 2, None), ("t", "c", "delete", 4, None), ("t", "c", "replace", 5, {}), ("t", "d", "replace", None, {"z": ["5"]})]
    ops = spark.createDataFrame(rows, "collection string, id string, op string, offset bigint, fields map<string, array<string>>")
    one, two = fold.delta(ops, whole=True), fold.delta(ops)
    assert one.schema.simpleString() == two.schema.simpleString()
    assert docs(fold.documents(one)) == docs(fold.documents(two)) == {("t", "a"): {"x": ["3"]}, ("t", "c"): {}}
    assert docs(fold.documents(fold.merge_deltas(one.unionByName(two)))) == docs(fold.documents(two))
    assert one._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
