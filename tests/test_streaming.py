"""Streams give what the batch gives, whatever the micro-batches are."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from docfold.operators import fold
from docfold.operators.schema import Collections, MissingCollection
from docfold.options import FoldOptions
from docfold.plans.ingest import convert
from docfold.sources.changes import CHANGE_SCHEMA, read_changes, unwrap_key
from docfold.streaming.apply import apply_batch, start, work_folder
from docfold.streaming.state import decide_writes
from docfold.streaming.table import DocumentTable


def changes(seed, n, bad=0.0):
    rng = random.Random(seed)
    out = []
    for offset in range(n):
        key = None if rng.random() < bad else json.dumps({"id": "hot" if rng.random() < 0.33 else f"u{rng.randrange(9)}"})
        value = None
        if rng.random() < 0.85:
            value = json.dumps({f: rng.choice([None, offset, {"x": [offset, None]}]) for f in rng.sample("abc", rng.randint(0, 3))})
        out.append((f"t{offset % 2}", 0, offset, key, value, None, None))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, CHANGE_SCHEMA)


def docs(df):
    return {(r.collection, r.id): r.fields for r in df.collect()}


def files(spark, rows, folder, seed):
    """The log as Parquet files of random size, read one per micro-batch."""
    rng, at = random.Random(seed), 0
    while at < len(rows):
        step = rng.randint(5, 60)
        frame(spark, rows[at:at + step]).coalesce(1).write.mode("append").parquet(folder)
        at += step
    return unwrap_key(read_changes(spark, path=folder, streaming=True, options={"maxFilesPerTrigger": "1"}))


@pytest.mark.parametrize("method", ["INDEX", "UPSERT"])
def test_stream_equals_batch(spark, tmp_path, method):
    rows = changes(1, 150, bad=0.05)
    options = FoldOptions(write_method=method, behavior_on_null_values="delete", drop_invalid_message=True)
    batch = convert(unwrap_key(frame(spark, rows)), options)
    table = DocumentTable(spark, str(tmp_path / "table"))
    start(files(spark, rows, str(tmp_path / "log"), 2), table, options, str(tmp_path / "progress")).awaitTermination()
    expected = docs(fold.apply_fields(batch.ops))
    assert expected and docs(table.read()) == expected
    assert {r.offset for r in table.dead_letters().collect()} == {r.offset for r in batch.dead.collect()}
    assert docs(table.read("t1")) == {k: v for k, v in expected.items() if k[0] == "t1"}
    assert table.compact() == 0 and docs(table.read()) == expected and table.compact() == 0
    held = table.held
    assert len(held) > 1 and len(table.vacuum()) == len(held) and table.vacuum() == [] and docs(table.read()) == expected
    # An old batch delivered again changes nothing, a late older write loses, a newer one wins.
    (stream, first) = min(held)
    apply_batch(unwrap_key(frame(spark, rows[:20])), first, table, options, stream=stream)
    apply_batch(unwrap_key(frame(spark, rows[:20])), 99, table, options, stream=stream)
    assert docs(table.read()) == expected
    new = frame(spark, [("t1", 0, 999, '{"id":"hot"}', '{"z":1}', None, None)])
    apply_batch(unwrap_key(new), 100, table, options, stream=stream)
    apply_batch(unwrap_key(new), 100, table, options, stream=stream)
    assert docs(table.read())[("t1", "hot")]["z"] == ["1"]


def test_a_new_checkpoint_after_a_compaction_loses_nothing(spark, tmp_path):
    options, table = FoldOptions(), DocumentTable(spark, str(tmp_path / "table"))
    for n, checkpoint in enumerate("ab"):
        folder = str(tmp_path / f"log{checkpoint}")
        frame(spark, [("t", 0, n, f"k{n}", '{"n":%d}' % n, None, None)]).write.parquet(folder)
        start(read_changes(spark, path=folder, streaming=True), table, options, str(tmp_path / checkpoint), compact_every=1).awaitTermination()
    assert docs(table.read()) == {("t", "k0"): {"n": ["0"]}, ("t", "k1"): {"n": ["1"]}}
    assert len({s for s, _ in table.held}) == 2


def test_two_streams_keep_their_own_batches(spark, tmp_path):
    table = DocumentTable(spark, str(tmp_path / "table"))
    apply_batch(frame(spark, [("t", 0, 1, "a", '{"n":1}', None, None)]), 0, table, FoldOptions(), stream="one")
    apply_batch(frame(spark, [("t", 0, 2, "b", '{"n":2}', None, None)]), 0, table, FoldOptions(), stream="two")
    assert set(docs(table.read())) == {("t", "a"), ("t", "b")}
    table.compact()
    apply_batch(frame(spark, [("t", 0, 3, "c", '{"n":3}', None, None)]), 0, table, FoldOptions(), stream="three")
    assert set(docs(table.read())) == {("t", "a"), ("t", "b"), ("t", "c")}
    with pytest.raises(ValueError, match="stream name"):
        table.apply(table.read(), 0, "_base")


def test_two_topics_in_one_collection_are_ordered_by_time(spark, tmp_path):
    at = [datetime.datetime(2024, 1, 1, 0, 0, s) for s in range(3)]
    rows = [("t1", 0, 1000, "a", '{"n":"old"}', None, at[0]), ("t2", 0, 5, "a", '{"n":"new"}', None, at[1])]
    one = FoldOptions(collection="c", collection_naming_strategy="STATIC")
    for order, want in (("time", "new"), ("offset", "old")):
        table = DocumentTable(spark, str(tmp_path / order), order)
        for n, row in enumerate(rows):
            apply_batch(frame(spark, [row]), n, table, one)
        assert docs(table.read()) == {("c", "a"): {"n": [want]}}


@pytest.mark.parametrize("policy", ["warn", "fail"])
def test_an_atomic_batch_delivered_twice(spark, tmp_path, policy):
    table = DocumentTable(spark, str(tmp_path / "table"))
    apply_batch(frame(spark, [("t", 0, 1, "a", '{"n":1}', None, None)]), 0, table, FoldOptions())
    atomic = FoldOptions(write_method="ATOMIC_UPDATE", behavior_on_null_values="delete", behavior_on_malformed_documents=policy)
    batch = frame(spark, [("t", 0, 2, "a", '{"n":5}', None, None), ("t", 0, 3, "a", None, None, None)])
    for _ in range(2):
        apply_batch(batch, 1, table, atomic)
        assert docs(table.read()) == {}
        dead = table.dead_letters()
        assert dead is None or dead.count() == 0


def test_a_record_that_carries_stamped_names(spark):
    options = FoldOptions(offset_version_field="ver", source_field="_src", mapping_version="3")
    value = '{"ver":99,"_src":"mine","_deleted":"x","_mapping_version":"y","n":1}'
    row = convert(frame(spark, [("t", 0, 7, "a", value, None, None)]), options).ops.first()
    assert row.fields["ver"] == ["7"] and row.fields["n"] == ["1"] and row.fields["_src"] != ["mine"] and row.fields["_mapping_version"] == ["3"]
    assert "_deleted" not in row.fields


def test_live_view_purge_and_typed_columns(spark, tmp_path):
    table = DocumentTable(spark, str(tmp_path / "table"))
    options = FoldOptions(offset_version_field="ver", behavior_on_null_values="delete")
    rows = [("t", 0, 1, "a", '{"n":1,"tags":["x","y"],"bad":"q"}', None, None), ("t", 0, 2, "b", '{"n":2}', None, None), ("t", 0, 3, "b", None, None, None)]
    apply_batch(frame(spark, rows), 0, table, options)
    assert set(docs(table.read())) == {("t", "a"), ("t", "b")} and set(docs(table.read(live=True))) == {("t", "a")}
    assert fold.purge_deleted(table.read(), "ver", 3).count() == 2 and fold.purge_deleted(table.read(), "ver", 4).count() == 1
    got = {r.id: (r.n, r.tags, r.bad) for r in table.columns({"n": "bigint", "tags": "array<string>", "bad": "int"}).collect()}
    assert got["a"] == (1, ["x", "y"], None)


def test_a_dry_run_reports(spark, tmp_path):
    table = DocumentTable(spark, str(tmp_path / "table"))
    rows = frame(spark, [("t", 0, 1, "a", "{}", None, None), ("t", 0, 2, "b", None, None, None)])
    report = apply_batch(rows, 0, table, FoldOptions(dry_run=True, behavior_on_null_values="delete")).first()
    assert (report.would_write, report.would_delete) == (1, 1) and table.read().count() == 0


def test_replay_after_a_restart(spark, tmp_path):
    rows = changes(3, 60)
    options = FoldOptions(behavior_on_null_values="delete")
    table = DocumentTable(spark, str(tmp_path / "table"))
    for n, part in enumerate((rows[:30], rows[30:], rows[30:])):
        apply_batch(unwrap_key(frame(spark, part)), min(n, 1), table, options)
    (tmp_path / "table" / "data" / "stream=main" / "batch=9").mkdir()          # a write that never finished
    assert docs(table.read()) == docs(fold.apply_fields(convert(unwrap_key(frame(spark, rows)), options).ops))


def test_malformed_batch_fails_and_writes_nothing(spark, tmp_path):
    table = DocumentTable(spark, str(tmp_path / "table"))
    with pytest.raises(Exception, match="malformed record"):
        apply_batch(frame(spark, [("t", 0, 1, "a", "5", None, None)]), 0, table, FoldOptions())
    assert table.read().count() == 0 and table.dead_letters() is None
    apply_batch(frame(spark, [("t", 0, 1, "a", "{}", None, None)]), 0, table, FoldOptions(dry_run=True))
    assert table.read().count() == 0


def test_updates_of_existing_documents_only(spark, tmp_path):
    table = DocumentTable(spark, str(tmp_path / "table"))
    apply_batch(frame(spark, [("t", 0, 1, "a", '{"n":1,"m":2}', None, None)]), 0, table, FoldOptions())
    atomic = FoldOptions(write_method="ATOMIC_UPDATE", behavior_on_null_values="delete", behavior_on_malformed_documents="warn")
    rows = [("t", 0, 2, "a", '{"n":5}', None, None), ("t", 0, 3, "b", '{"n":6}', None, None), ("t", 0, 4, "a", '{"m":null}', None, None)]
    apply_batch(frame(spark, rows), 1, table, atomic)
    assert docs(table.read()) == {("t", "a"): {"n": ["5"]}}
    assert [(r.offset, r.value, r.reason) for r in table.dead_letters().collect()] == [(3, '{"n":6}', "document does not exist")]
    apply_batch(frame(spark, [("t", 0, 5, "a", None, None, None), ("t", 0, 6, "a", '{"n":7}', None, None)]), 2, table, atomic)
    assert docs(table.read()) == {} and {r.offset for r in table.dead_letters().collect()} == {3, 6}
    with pytest.raises(ValueError, match="do not exist"):
        apply_batch(frame(spark, [("t", 0, 7, "a", '{"n":8}', None, None)]), 3, table, FoldOptions(write_method="ATOMIC_UPDATE"))


def test_targets_must_exist(spark, tmp_path):
    table = DocumentTable(spark, str(tmp_path / "table"))
    rows = frame(spark, [("t", 0, 1, "a", '{"n":1}', None, None), ("gone", 0, 2, "a", None, None, None)])
    strict = FoldOptions(external_resource_usage="REQUIRED")
    with pytest.raises(MissingCollection):
        apply_batch(rows, 0, table, strict, Collections(spark, str(tmp_path / "targets"), strict))
    assert table.read().count() == 0
    made = FoldOptions(schema_auto_create=True)
    apply_batch(rows, 0, table, made, Collections(spark, str(tmp_path / "targets"), made))
    assert [p.name for p in (tmp_path / "targets").iterdir()] == ["collection=t"] and table.read().count() == 1


def test_work_folder_comes_from_the_session(spark):
    assert work_folder(spark, "apply").startswith(spark.conf.get("spark.checkpoint.dir"))


OPS = "id string, offset bigint, op string, version bigint, arrival bigint"


def decided(spark, tmp_path, batches, rule):
    folder = str(tmp_path / "ops")
    for rows in batches:
        spark.createDataFrame(rows, OPS).coalesce(1).write.mode("append").parquet(folder)
    name = f"decided_{rule}"
    stream = spark.readStream.schema(OPS).option("maxFilesPerTrigger", 1).parquet(folder)
    q = decide_writes(stream, rule).writeStream.outputMode("update").format("memory").queryName(name) \
        .option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()
    q.awaitTermination()
    return {(r.id, r.offset): r.applied for r in spark.table(name).collect()}


def test_optimistic_versions_across_batches(spark, tmp_path):
    got = decided(spark, tmp_path, [
        [("a", 1, "set", 0, 1), ("a", 2, "set", 3, 2), ("a", 3, "set", 3, 3), ("b", 4, "set", 1, 4)],
        [("a", 5, "set", 4, 5), ("b", 6, "set", -1, 6), ("a", 7, "delete", None, 7), ("a", 8, "set", 1, 8), ("a", 9, "set", 7, 9)]], "optimistic")
    assert got == {("a", 1): True, ("a", 2): True, ("a", 3): False, ("b", 4): False, ("a", 5): True, ("b", 6): True,
                   ("a", 7): True, ("a", 8): False, ("a", 9): False}


def test_guard_across_batches(spark, tmp_path):
    got = decided(spark, tmp_path, [
        [("6", 10, "set", None, 1)], [("6", 20, "delete", None, 2)],
        [("6", 15, "set", None, 3), ("6", 19, "set", None, 4), ("6", 21, "set", None, 5), ("6", 14, "delete", None, 6)]], "guard")
    assert got == {("6", 10): True, ("6", 20): True, ("6", 15): False, ("6", 19): False, ("6", 21): True, ("6", 14): False}
