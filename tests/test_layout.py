"""The typed, clustered copy of a collection against the fold of the whole table."""

import json
import random

import pytest

from docfold.operators import search
from docfold.options import FoldOptions
from docfold.streaming.apply import apply_batch, start
from docfold.streaming.layout import SearchLayout, column_types
from docfold.streaming.table import DocumentTable
from pyspark.sql import functions as F
from test_streaming import files, frame

OPTIONS = FoldOptions(behavior_on_null_values="delete", write_method="UPSERT")
FIELDS = {"n": ["plong", False, False], "name": ["string", False, False], "tags": ["string", True, False]}


def put(spark, table, number, rng, ids, count=40):
    rows = []
    for i in range(count):
        key = rng.choice(ids)
        value = None if rng.random() < 0.15 else json.dumps({"n": rng.choice([None, 5, rng.randint(0, 1000)]), "name": rng.choice("xyz"), "tags": ["a", "b"][:rng.randint(0, 2)]})
        rows.append(("t", 0, number * count + i, f'{{"id":"{key}"}}', value, None, None))
    apply_batch(frame(spark, rows), number, table, OPTIONS)


def made(spark, tmp_path):
    table = DocumentTable(spark, str(tmp_path / "table"))
    table.declare("t", FIELDS)
    return table


def rows(df):
    return sorted(map(tuple, df.select("id", "n", "name", F.array_join("tags", ",")).collect()), key=str)


def wanted(table, low=None, high=None):
    types = {"n": "bigint", "name": "string", "tags": "array<string>"}
    docs = table.columns(types, "t")
    return rows(docs.where(search.in_range(F.col("n"), low, high)) if low is not None or high is not None else docs)


def test_searches_equal_the_fold_at_every_moment(spark, tmp_path):
    rng, table = random.Random(3), made(spark, tmp_path)
    ids = [f"d{i}" for i in range(60)]
    layout = SearchLayout(table, "t", "n", file_bytes=4000)
    assert rows(layout.read()) == [] and layout.files() == []

    def same():
        for low, high in ((None, None), (5, 5), (100, 400), (None, 50), (990, None), (2000, None)):
            assert rows(layout.read(low, high)) == wanted(table, low, high), (low, high)

    put(spark, table, 0, rng, ids)
    same()                                                   # no copy yet
    assert layout.refresh() == 0 and len(layout.files()) > 1
    same()
    put(spark, table, 1, rng, ids)                           # batches after the copy, with deletes and partial updates
    put(spark, table, 2, rng, ids[:5])
    same()
    table.compact()
    same()                                                   # a copy of an older base is not read
    assert layout.refresh() == 1
    put(spark, table, 3, rng, ids)
    same()
    table.delete_all("t")
    same()
    assert wanted(table) == []
    put(spark, table, 4, rng, ids)
    assert [layout.refresh(), layout.refresh()] == [2, 3]
    same()
    kept = [p.name for p in (tmp_path / "table/search/t.n/data").iterdir()]
    assert len(kept) == 2 and {int(p.stem) for p in (tmp_path / "table/search/t.n").glob("[0-9]*.json")} == {2, 3}


def test_a_range_opens_the_files_it_meets_and_the_filter_reaches_the_scan(spark, tmp_path):
    table = made(spark, tmp_path)
    hot = 400                                                # one value of a third of all documents
    data = [("t", 0, i, f'{{"id":"d{i}"}}', json.dumps({"n": hot if i % 3 == 0 else i}), None, None) for i in range(1200)]
    apply_batch(frame(spark, data), 0, table, OPTIONS)
    layout = SearchLayout(table, "t", "n", file_bytes=3000)
    layout.refresh()
    every, some = layout.files(), layout.files(1100, 1110)
    assert len(every) >= 6 and len(some) <= 2 and len(layout.files(hot, hot)) >= 2 and layout.files(5000) == []
    found = layout.read(1100, 1110)
    assert {f.rpartition("/")[2] for f in found.inputFiles()} == {f.rpartition("/")[2] for f in some}
    plan = found.select("id", "n")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(n,1100)" in plan and "LessThanOrEqual(n,1110)" in plan and "ReadSchema: struct<id:string,n:bigint>" in plan
    assert found.count() == sum(i % 3 > 0 for i in range(1100, 1111))
    top = search.page(layout.read(1000), [("n", "desc"), ("id", "asc")], 5, ["id", "n"])
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert [r.n for r in top.collect()] == [1199, 1198, 1196, 1195, 1193]


def test_two_writers_make_two_copies(spark, tmp_path, monkeypatch):
    table = made(spark, tmp_path)
    put(spark, table, 0, random.Random(1), ["a", "b", "c"])
    one, two = SearchLayout(table, "t", "n"), SearchLayout(table, "t", "n")
    create, met = type(one._log).create, []

    def second_first(log, number, entry):
        if log is one._log and not met:
            met.append(two.refresh())
        return create(log, number, entry)

    monkeypatch.setattr(type(one._log), "create", second_first)
    assert one.refresh() == 1 and met == [0] and rows(one.read()) == wanted(table)


def test_a_stream_keeps_its_copies_up_to_date(spark, tmp_path):
    rng = random.Random(5)
    data = [("t", 0, i, f'{{"id":"d{rng.randint(0, 30)}"}}', json.dumps({"n": i}), None, None) for i in range(150)]
    table = made(spark, tmp_path)
    layout = SearchLayout(table, "t", "n")
    start(files(spark, data, str(tmp_path / "log"), 2), table, OPTIONS, str(tmp_path / "progress"), compact_every=2, layouts=[layout]).awaitTermination()
    assert layout.files() and rows(layout.read()) == wanted(table)


def test_columns_of_declared_fields():
    assert column_types({"a": ["pint", False, False], "b": ["pdate", True, False], "c_*": ["string", True, True]}) == {"a": "int", "b": "array<timestamp>"}


def test_the_field_of_the_order_is_single_valued(spark, tmp_path):
    with pytest.raises(ValueError, match="no single-valued field"):
        SearchLayout(made(spark, tmp_path), "t", "tags")


def test_a_batch_of_one_row_group_is_converted_by_many_tasks(spark, tmp_path, monkeypatch):
    from docfold.plans import pipeline_queries

    events = spark.range(4000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), (F.col("id") % 90).alias("user_id"),
        F.when(F.col("id") % 7 == 0, "error").otherwise("view").alias("event_type"), F.lit(1.5).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 80).alias("props"))
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    shares, apply = [], pipeline_queries.apply_batch

    def counted(batch, number, *more):
        shares.append([r["count"] for r in batch.groupBy(F.spark_partition_id()).count().collect()])
        return apply(batch, number, *more)

    monkeypatch.setattr(pipeline_queries, "apply_batch", counted)
    found = pipeline_queries.pipeline_search(spark, str(tmp_path)).collect()
    last = {i % 90: i for i in range(4000)}
    wanted = sorted(((-(i % 80), str(u)) for u, i in last.items() if i % 7 and 10 <= i % 80 <= 60))[:50]
    assert [(r.id, r.k) for r in found] == [(u, -k) for k, u in wanted]
    assert [sum(s) for s in shares] == [1000] * 4
    assert all(max(s) <= 250 for s in shares)
