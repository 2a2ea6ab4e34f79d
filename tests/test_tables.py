"""Target schema, triage and search on small tables."""

import pytest
from pyspark.sql import functions as F

from docfold.operators import fold, schema, search, triage
from docfold.options import FoldOptions


# --- schema ------------------------------------------------------------------------------------

def test_evolution_adds_and_never_retypes(spark):
    v1 = spark.sql("SELECT 1 age, 2.0D score, array('x') tags, named_struct('city', 'c') address")
    v2 = spark.sql("SELECT 'old' age, 'n' nickname, map('a', 'b') attributes, array(named_struct('sku', 's', 'qty', 1)) orders")
    known, needed = schema.field_catalog(spark, v1.schema), schema.field_catalog(spark, v2.schema)
    on = FoldOptions(schema_auto_evolve=True)
    grown = {r.name: (r.type, r.multi_valued, r.dynamic) for r in schema.evolve(known, needed, on).collect()}
    assert grown["age"] == ("pint", False, False) and grown["nickname"] == ("string", False, False)
    assert grown["attributes.*"] == ("string", True, True) and grown["orders.qty"] == ("pint", True, False)
    for off in (FoldOptions(), FoldOptions(schema_auto_evolve=True, schema_ignore=True), FoldOptions(schema_auto_evolve=True, topic_schema_ignore=("t",))):
        assert schema.evolve(known, needed, off, "t").count() == 5 - 1
    wide = schema.widen(v1, v2)
    assert wide.schema["age"].dataType.simpleString() == "int" and {r.age for r in wide.collect()} == {1, None}


def test_collections(spark, tmp_path):
    def collections(**kw):
        return schema.Collections(spark, str(tmp_path), FoldOptions(**kw))

    collections(external_resource_usage="UNUSED").ensure("users")
    for kw in (dict(external_resource_usage="REQUIRED", schema_auto_create=True), dict()):
        with pytest.raises(schema.MissingCollection):
            collections(**kw).ensure("users")
    made = collections(schema_auto_create=True)
    made.ensure("users")
    made.ensure("")
    assert (tmp_path / "collection=users").is_dir()
    collections(external_resource_usage="REQUIRED").ensure("users")


def test_long_strings(spark):
    essay = "ß" * 12_000
    df = spark.createDataFrame([(essay, essay, essay, [essay, "x"])], "id string, _src string, first_name string, l array<string>")
    row = schema.cap_strings(df).first()
    assert (len(row.id), len(row._src), len(row.first_name), [len(x) for x in row.l]) == (12_000, 12_000, 8_000, [8_000, 1])
    assert df.select(schema.indexed_term(F.col("first_name")).alias("t")).first().t is None


def test_copy_fields(spark):
    df = spark.sql("SELECT 'ada' first_name, array('Gold', NULL) custom_field_5_value_4, 'x' other, '12' id UNION ALL SELECT NULL, NULL, 'y', 'abc'")
    out = schema.copy_field(schema.copy_fields(df, ["first_name", "*_value_4"], "_text"), "id", "id_sort", "bigint")
    assert {(r.id, tuple(r._text or ()), r.id_sort) for r in out.collect()} == {("12", ("ada", "Gold"), 12), ("abc", (), None)}


# --- triage ------------------------------------------------------------------------------------

def test_one_bad_document_is_rejected_alone(spark):
    df = spark.createDataFrame([("dlq-1", "170", ["1"]), ("dlq-2", "tall", ["2"]), ("dlq-3", None, ["3", "x"]), ("dlq-4", None, [None])],
                               "id string, height_cm string, n array<string>")
    good, bad = triage.conform(df, {"height_cm": "bigint", "n": "int"})
    assert {(r.id, r.height_cm) for r in good.collect()} == {("dlq-1", 170), ("dlq-4", None)}
    assert {(r.id, r.field) for r in bad.collect()} == {("dlq-2", "height_cm"), ("dlq-3", "n")}


@pytest.mark.parametrize("code,remote,missing,transport,expected", [
    (400, True, False, False, "rejected"), (409, True, False, False, "rejected"), (413, True, False, False, "rejected"),
    (400, False, True, False, "fatal"), (400, False, False, True, "retriable"), (400, True, True, True, "rejected"),
    (429, True, False, False, "retriable"), (500, True, False, False, "retriable"), (503, False, False, False, "retriable"),
    (401, True, False, False, "fatal"), (403, True, False, True, "fatal"), (404, True, False, False, "fatal"), (405, True, False, False, "fatal"),
    (None, False, False, True, "retriable"), (None, False, False, False, "fatal")])
def test_responses(spark, code, remote, missing, transport, expected):
    df = spark.createDataFrame([(code, remote, missing, transport)], "c int, r boolean, m boolean, t boolean")
    assert df.select(triage.response_class(*[F.col(c) for c in "crmt"]).alias("k")).first().k == expected


def test_optimistic_batch(spark):
    target = spark.createDataFrame([("a", 7)], "id string, version bigint")
    ops = spark.createDataFrame([("a", 7), ("a", 6), ("a", 1), ("a", -1), ("a", 0), ("a", None), ("b", 7), ("b", 1), ("b", -1), ("b", 0)], "id string, version bigint")
    got = [(r.id, r.version, r.outcome == "applied") for r in fold.optimistic_batch(target, ops).collect()]
    assert set(got) == {("a", 7, True), ("a", 6, False), ("a", 1, True), ("a", -1, False), ("a", 0, True), ("a", None, True),
                        ("b", 7, False), ("b", 1, False), ("b", -1, True), ("b", 0, True)}


# --- search ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def shops(spark):
    return spark.createDataFrame([
        ("1", 1, 70, 8, 3.0, "3", ["Bakery", "Rye bread", "open 100%"], "52.52,13.405"),
        ("2", 4, 310, 20, 30.0, "30", ["Tailor", "c*d"], "0,0"), ("3", 10, 15, 300, 300.0, "300", None, "bad"),
        ("4", None, None, None, None, "kiosk", ["y" * 9000 + "pickle"], None)],
        "id string, status int, area bigint, rank int, num double, txt string, words array<string>, location string")


def found(df):
    return {r.id for r in df.collect()}


def test_filters(shops):
    col = F.col
    assert found(search.find(shops, search.term(col("status"), "4"))) == {"2"}
    assert found(search.find(shops, search.any_of(col("status"), ["1", "4"]))) == {"1", "2"}
    assert found(search.find(shops, search.in_range(col("status"), high=4))) == {"1", "2"}
    assert found(search.find(shops, search.in_range(col("area"), 70, 310, low_open=True))) == {"2"}
    assert found(search.find(shops, search.in_range(col("area"), 15, 310, high_open=True))) == {"1", "3"}
    assert found(search.find(shops, search.in_range(col("status")))) == {"1", "2", "3"}
    assert found(search.find(shops, search.matches_ignoring_case(col("txt"), "KIOSK"))) == {"4"}
    assert found(search.find(shops, search.matches_ignoring_case(col("txt"), "KIOSK", limit=4))) == set()
    assert found(search.find(shops, search.negate(col("status") == 1))) == {"2", "3", "4"}
    assert found(search.find(shops, search.exists(col("status")), search.starts_with(col("txt"), "3"))) == {"1", "2", "3"}
    assert found(search.find(shops, search.has_element(col("words"), "Tailor"))) == {"2"}
    assert search.hits(shops, search.exists(col("status"))).first().num_found == 3
    assert found(search.find(shops, search.near(col("location"), 52.52, 13.405, 10))) == {"1"}


def test_a_number_against_a_text_column_is_text(shops):
    assert found(search.find(shops, search.term_in(shops, "txt", 30))) == {"2"}
    assert found(search.find(shops, search.term_in(shops, "num", "30"))) == {"2"}


@pytest.mark.parametrize("words,expected", [
    ("bread", {"1"}), ("RYE bakery", {"1"}), ("rye tailor", set()), ("c*d", {"2"}), ("pickle", {"4"}), ("", {"1", "2", "3", "4"}), ("%", {"1"})])
def test_search_anything(shops, words, expected):
    assert found(search.find(shops, search.search_anything(F.col("words"), words))) == expected


def test_search_with_a_term_limit(shops):
    assert found(search.find(shops, search.search_anything(F.col("words"), "pickle", limit=8000))) == set()


@pytest.mark.parametrize("sort,expected", [
    ([("area", "desc"), ("id", "asc")], "2134"), ([("area", "asc"), ("id", "asc")], "3124"),
    ([("rank", "desc"), ("id", "asc")], "3214"), ([("num", "desc"), ("txt", "desc"), ("id", "asc")], "3214"),
    ([("num", "asc"), ("txt", "asc"), ("id", "asc")], "1234")])
def test_sorts(shops, sort, expected):
    rows = search.page(shops, sort, 10, ["id"], "pos").collect()
    assert "".join(r.id for r in sorted(rows, key=lambda r: r.pos)) == expected
    with pytest.raises(ValueError):
        search.page(shops, [("id", "up")], 1)


def test_cursor_pages_in_number_order(spark):
    df = schema.copy_field(spark.createDataFrame([(i,) for i in ("3", "8", "12", "120", "15")], "id string"), "id", "id_sort", "bigint")
    assert [r.id for r in search.cursor_page(df, "id_sort", None, 10).collect()] == ["3", "8", "12", "15", "120"]
    assert [r.id for r in search.cursor_page(df, "id_sort", 12, 10).collect()] == ["15", "120"]


def test_pages_plan_as_top_k_and_filters_reach_the_scan(spark):
    parts = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    plan = search.page(search.find(parts, search.in_range(F.col("p_size"), 3, 9)), [("p_size", "desc"), ("p_partkey", "asc")], 5, ["p_partkey"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert "GreaterThanOrEqual(p_size,3)" in text and "p_name" not in text
