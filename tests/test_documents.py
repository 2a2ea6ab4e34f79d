"""Conversion of records: encoding, flattening, identity, stamps, geometry."""

import struct

import pytest
from pyspark.sql import functions as F, types as T

from docfold.functions.encode import encode
from docfold.functions.geo import point_to_latlon, geometry_to_latlon, within_km
from docfold.functions.headers import ascii_long
from docfold.operators.flatten import effective, fields_map, flatten, leaves, written_names
from docfold.operators.identity import document_bytes, document_id, route, source_json, stored_document_bytes
from docfold.operators.schema import field_specs
from docfold.operators.variant import variant_fields
from docfold.options import FoldOptions
from docfold.plans.ingest import convert


def one(df):
    return df.first().asDict(recursive=True)


@pytest.fixture(scope="module")
def all_types(spark):
    return spark.sql("""SELECT 'u1' id, '40.7,-74.0' location, 1Y i8, 2S i16, 3 i32, 4L i64, 1.5F f32, 2.5D f64, true flag, 'Ada' name,
      X'0102' avatar, unhex(repeat('FF', 100)) signature, 1234.56BD balance, timestamp'2026-07-06 12:00:00Z' created_at,
      date'1815-12-10' birth, time'01:00:00' login, array('x', 'y', 'z') tags, named_struct('lat', 40.7D, 'lon', -74.0D) home,
      map('floor', 102) attrs""")


def test_all_types(all_types):
    doc = one(flatten(all_types, keep=["id"]))
    assert doc["balance"] == "1234.56" and doc["created_at"] == "2026-07-06T12:00:00Z"
    assert doc["birth"] == "1815-12-10T00:00:00Z" and doc["login"] == "1970-01-01T01:00:00Z"
    assert doc["avatar"] == "AQI=" and len(doc["signature"]) == 136 and "\n" not in doc["signature"]
    assert doc["tags"] == ["x", "y", "z"] and doc["home.lat"] == 40.7 and doc["attrs.*"] == {"attrs.floor": [102]}
    assert (doc["i8"], doc["i16"], doc["i32"], doc["i64"], doc["f32"], doc["f64"], doc["flag"]) == (1, 2, 3, 4, 1.5, 2.5, True)


@pytest.mark.parametrize("settings", [
    {"spark.sql.session.timeZone": "America/New_York"}, {"spark.sql.ansi.enabled": "false"}, {"spark.sql.chunkBase64String.enabled": "true"}])
def test_session_settings_do_not_matter(spark, all_types, settings):
    expected = one(flatten(all_types, keep=["id"]))
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert one(flatten(all_types, keep=["id"])) == expected
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_field_types(all_types):
    specs = {s.name: (s.type, s.multi_valued, s.dynamic) for s in field_specs(all_types.schema)}
    assert specs["i8"][0] == specs["i16"][0] == specs["i32"][0] == "pint" and specs["i64"][0] == "plong"
    assert specs["f32"][0] == "pfloat" and specs["f64"][0] == "pdouble" and specs["flag"][0] == "boolean"
    assert specs["balance"][0] == specs["avatar"][0] == specs["name"][0] == "string"
    assert specs["created_at"][0] == specs["birth"][0] == specs["login"][0] == "pdate"
    assert specs["tags"] == ("string", True, False) and specs["attrs.*"] == ("pint", True, True)
    kv = {s.name: (s.type, s.multi_valued) for s in field_specs(all_types.schema, compact=False)}
    assert kv["attrs.key"] == ("string", True) and kv["attrs.value"] == ("pint", True)
    nested = T.StructType.fromDDL("m map<string,struct<a:int>>, l map<string,array<bigint>>")
    assert {s.name: s.type for s in field_specs(nested)} == {"m.*": "string", "l.*": "plong"}


def test_deep_nesting_and_written_names(spark):
    df = spark.sql("""SELECT named_struct('name', 'ACME', 'address', named_struct('city', 'X', 'geo', named_struct('lat', 1D, 'lon', 2D))) employer""")
    assert one(flatten(df)) == {"employer.name": "ACME", "employer.address.city": "X", "employer.address.geo.lat": 1.0, "employer.address.geo.lon": 2.0}
    assert written_names(df.schema["employer"].dataType, "e") == ["e.name", "e.address.city", "e.address.geo.lat", "e.address.geo.lon"]
    assert written_names(T.ArrayType(T.StructType.fromDDL("a int")), "l") == ["l.a"]
    many = T.MapType(T.StringType(), T.IntegerType())
    assert written_names(many, "m") == [] and written_names(many, "m", compact=False) == ["m.key", "m.value"]


def test_logical_arrays_and_long_instants(spark):
    df = spark.sql("""SELECT array(timestamp'2026-01-01 00:00:00.001Z', timestamp'1969-12-31 23:59:59.999999Z') stamps,
      array(1.10BD, NULL, 2.00BD) amounts, array(X'01', X'02') blobs, timestamp_ntz'2020-02-29 10:00:00.5' ntz""")
    assert one(flatten(df)) == {"stamps": ["2026-01-01T00:00:00.001Z", "1969-12-31T23:59:59.999Z"], "amounts": ["1.10", "2.00"],
                                "blobs": ["AQ==", "Ag=="], "ntz": "2020-02-29T10:00:00.500Z"}


def partial(spark, sql, **kw):
    df = spark.sql(sql)
    return df.select(fields_map(leaves(df.schema, clearing=True, **kw), True).alias("f")).first().f


def test_what_a_partial_record_carries(spark):
    assert partial(spark, "SELECT 1 id, CAST(NULL AS STRING) name, named_struct('city', 'Paris', 'zip', CAST(NULL AS STRING)) address") == {
        "name": None, "address.city": ["Paris"], "address.zip": None}
    assert partial(spark, "SELECT CAST(NULL AS STRUCT<city: STRING, zip: STRING>) address") == {"address.city": None, "address.zip": None}
    # A null inside a list never clears what another element carries; a list of nothing says nothing.
    assert partial(spark, "SELECT array(named_struct('label', CAST(NULL AS STRING)), named_struct('label', 'vip')) tags") == {"tags.label": ["vip"]}
    assert partial(spark, "SELECT array(named_struct('label', CAST(NULL AS STRING))) tags") == {"tags.label": None}
    assert partial(spark, "SELECT CAST(array() AS ARRAY<STRUCT<label: STRING>>) tags, CAST(array(NULL) AS ARRAY<INT>) n") == {}
    assert partial(spark, "SELECT CAST(NULL AS ARRAY<INT>) n") == {"n": None}
    assert partial(spark, "SELECT CAST(NULL AS MAP<STRING, INT>) m, map('a', 1, 'b', CAST(NULL AS INT)) o") == {"o.a": ["1"], "o.b": None}
    assert partial(spark, "SELECT CAST(NULL AS MAP<STRING, INT>) m, map('b', CAST(NULL AS INT)) o", compact=False) == {"m.key": None, "m.value": None}


@pytest.mark.parametrize("text,compact,expected", [
    ('{"id":1,"promises":[{"name":"a","n":1},{"name":"b"}],"x":null}', True, {"promises.name": ["a", "b"], "promises.n": ["1"]}),
    ('{"scores":{"42":"answer","7":700},"100":"top"}', True, {"scores.42": ["answer"], "scores.7": ["700"], "100": ["top"]}),
    ('{"attrs":{"hair":"brown","eyes":"blue","no":null},"t":true}', False, {"attrs.key": ["eyes", "hair"], "attrs.value": ["blue", "brown"], "t": ["true"]}),
    ('{"a":[[1,[2,null]],3],"f":1.50,"e":1e3,"big":9223372036854775807,"s":"{\\"x\\":1}"}', True,
     {"a": ["1", "2", "3"], "f": ["1.5"], "e": ["1000.0"], "big": ["9223372036854775807"], "s": ['{"x":1}']}),
    ('{"💙":"日本語","empty":{},"none":[]}', True, {"💙": ["日本語"]}),
    ('{"id":5}', True, {}), ("[1]", True, None), ("5", True, None), ("{bad", True, None),
    ("{" + '"a":{' * 60 + '"b":[1,2]' + "}" * 61, True, {".".join("a" * 60) + ".b": ["1", "2"]}),
])
def test_schemaless(spark, text, compact, expected):
    df = spark.createDataFrame([(text,)], "j string").select(variant_fields(F.try_parse_json("j"), compact).alias("f"))
    assert df.first().f == expected


def test_many_children_and_many_keys(spark):
    children = ",".join(f'{{"id":{i},"t":"c{i}"}}' for i in range(5000))
    keys = ",".join(f'"k{i:04d}":{i}' for i in range(3000))
    df = spark.createDataFrame([(f'{{"c":[{children}],"m":{{{keys}}}}}',)], "j string").select(variant_fields(F.parse_json("j")).alias("f"))
    f = df.first().f
    assert f["c.id"] == [str(i) for i in range(5000)] and f["m.k2999"] == ["2999"] and len(f) == 3002


def test_noop_records(spark):
    df = spark.createDataFrame([({},), ({"a": None},)], "f map<string,array<string>>")
    assert [r[0] for r in df.select(effective(F.col("f"), True)).collect()] == [False, True]
    assert [r[0] for r in df.select(effective(F.col("f"), True, stamped=True)).collect()] == [True, True]
    assert [r[0] for r in df.select(effective(F.col("f"), False)).collect()] == [True, True]


# --- identity ----------------------------------------------------------------------------------

@pytest.mark.parametrize("options,expected", [
    (dict(), "logs-2026"), (dict(collection="c"), "c"), (dict(collection="c", collection_naming_strategy="static"), "c"),
    (dict(collection_naming_strategy="STATIC"), "logs-2026"), (dict(collection="logs-.*=>logs", collection_naming_strategy="TOPIC_REGEX"), "logs"),
    (dict(collection="logs=>x", collection_naming_strategy="topic_regex"), "logs-2026"),
    (dict(collection="(\\w+)-(\\d+) => $2-$1", collection_naming_strategy="TOPIC_REGEX"), "2026-logs"),
    (dict(collection_naming_strategy="no-such"), "logs-2026")])
def test_routes(spark, options, expected):
    df = spark.createDataFrame([("logs-2026",)], "topic string")
    assert df.select(route(F.col("topic"), FoldOptions(**options)).alias("c")).first().c == expected


def ids(spark, key, value="NULL", **options):
    df = spark.sql(f"SELECT 't' topic, 3 partition, 7L offset, {key} key, {value} value")
    return df.select(document_id(df.schema, FoldOptions(**options)).alias("id")).first().id


def test_ids(spark):
    assert ids(spark, "'usr/42 💙'") == "usr/42 💙" and ids(spark, "42L") == "42" and ids(spark, "CAST(NULL AS STRING)") is None
    assert ids(spark, "42L", id_coerce_to_string=False) == 42 and ids(spark, "true") == "true"
    assert ids(spark, "X'01'") is None and ids(spark, "named_struct('id', 1)") is None
    assert ids(spark, "'k'", id_strategy="topic_partition_offset") == "t-3-7" and ids(spark, "'k'", key_ignore=True) == "t-3-7"
    assert ids(spark, "'k'", topic_key_ignore=("t",)) == "t-3-7" and ids(spark, "'k'", topic_key_ignore=("u",)) == "k"
    field = dict(id_strategy="RECORD_FIELD", id_field="a.b")
    assert ids(spark, "'k'", "named_struct('a', named_struct('b', 5))", **field) == "5"
    assert ids(spark, "'k'", "named_struct('a', map('b', 5))", **field) == "5"
    assert ids(spark, "'k'", "named_struct('a', 5)", **field) is None and ids(spark, "'k'", "named_struct('z', 5)", **field) is None
    assert ids(spark, "'k'", "parse_json('{\"a\":{\"b\":\"x\"}}')", **field) == "x"
    assert ids(spark, "'k'", "parse_json('{\"a\":{\"b\":{}}}')", **field) is None
    assert ids(spark, "'k'", "parse_json('{\"a\":7}')", **field) is None
    assert ids(spark, "'k'", "named_struct('a', named_struct('b', 5))", key_ignore=True, **field) == "5"
    assert len(ids(spark, "'k'", use_autogenerated_ids=True)) == 36


@pytest.mark.parametrize("text,expected", [
    ("42", 42), (" \t+42\n", 42), ("-7", -7), ("", None), ("  ", None), ("-", None), ("1 2", None), ("1x", None), ("0x10", None),
    ("9223372036854775807", 2**63 - 1), ("-9223372036854775808", -2**63), ("9223372036854775808", None), ("007", 7), ("--1", None), ("٣", None)])
def test_header_numbers(spark, text, expected):
    assert spark.createDataFrame([(text,)], "t string").select(ascii_long(F.col("t")).alias("v")).first().v == expected


def test_source_json(spark):
    df = spark.sql("""SELECT named_struct('id', '7', 'n', CAST(NULL AS INT), 'custom_field_5', 1, 'b', X'0102', 't', timestamp'2026-01-01 00:00:00Z',
      'l', array(named_struct('custom_field_1', 2)), 'm', map(1, date'2026-01-02')) v""")
    text = df.select(source_json(F.col("v"), df.schema["v"].dataType, ["custom_field_"]).alias("s")).first().s
    assert text == '{"id":"7","n":null,"b":"AQI=","t":"2026-01-01T00:00:00Z","l":[{"custom_field_1":2}],"m":{"1":"2026-01-02T00:00:00Z"}}'
    millis = df.select(source_json(F.col("v"), df.schema["v"].dataType, iso_dates=False).alias("s")).first().s
    assert '"t":1767225600000' in millis and '"1":1767312000000' in millis


def test_byte_estimate(spark):
    df = spark.sql("SELECT 'é💙' a, 5 n, true b, CAST(NULL AS STRING) z, array('x', 'yy') l, map('k', 1) m")
    size = df.select(document_bytes(leaves(df.schema), F.lit("id1"), T.StringType()).alias("n")).first().n
    assert size == 16 + (4 + 6) + (2 + 6) + (2 + 16) + (2 + 16) + (2 + 2) + (2 + 4) + (6 + 16)
    stored = df.select(stored_document_bytes(df.drop("m")).alias("n")).first().n
    assert stored == 16 + (2 + 6) + (2 + 16) + (2 + 16) + (2 + 2 + 4)


# --- geometry ----------------------------------------------------------------------------------

def point(order, kind, srid, *xs):
    return struct.pack(order + "BI", 1 if order == "<" else 0, kind) + (b"" if srid is None else struct.pack(order + "I", srid)) + struct.pack(
        order + "d" * len(xs), *xs)


@pytest.mark.parametrize("wkb,expected", [
    (bytes.fromhex("010100000098dd938785f652c0b81e85eb51584440"), "40.69,-75.8519"),
    (bytes.fromhex("0101000020e6100000a301bc0512644140a52c431ceb0a4040"), "32.0853,34.7818"),
    (point(">", 1, None, 34.7818, 32.0853), "32.0853,34.7818"), (point(">", 0x20000001, 4326, 34.7818, 32.0853), "32.0853,34.7818"),
    (point("<", 1001, None, 2.5, 1.5, 99.0), "1.5,2.5"), (point("<", 0x80000001, None, 2.5, 1.5, 99.0), "1.5,2.5"),
    (point("<", 1, None, -0.00002, 0.00001), "0.00001,-0.00002"), (point("<", 1, None, 0.0, 40.0), "40,0"),
    (point("<", 1, None, -0.0, 123456789012.5), "123456789012.5,0"), (point(">", 1, None, 5e-324, 1e22), "10000000000000000000000,0." + "0" * 323 + "49"),
    (None, None), (bytes(5), None), (b"\x07" + point("<", 1, None, 1.0, 2.0)[1:], None), (point("<", 2, None, 1.0, 2.0), None),
    (point("<", 1, None, float("nan"), float("nan")), None), (point("<", 1, None, 34.8, float("nan")), None),
    (point("<", 0x20000001, None, 1.0, 2.0), None), (point("<", 1, None, float("inf"), 1.0), None)])
def test_points(spark, wkb, expected):
    df = spark.createDataFrame([(wkb,)], "w binary")
    assert df.select(point_to_latlon(F.col("w")).alias("p")).first().p == expected


def test_geometry_column(spark):
    df = spark.createDataFrame([(1, (point("<", 1, None, 2.0, 1.0), 4326)), (2, (b"abc", 0)), (3, None)], "id int, location struct<wkb:binary,srid:int>")
    assert [r.location for r in geometry_to_latlon(df).orderBy("id").collect()] == ["1,2", None, None]
    plain = df.drop("location")
    assert geometry_to_latlon(plain) is plain
    assert one(geometry_to_latlon(plain.withColumn("location", F.lit("x")))) == {"id": 1, "location": None}


def test_radius(spark):
    rows = [("ny", 40.7128, -74.006), ("near", 40.75, -74.0), ("null", None, None), ("far", 0.0, 0.0), ("dateline", 0.0, 179.99), ("pole", 89.99, 100.0)]
    df = spark.createDataFrame(rows, "n string, lat double, lon double")
    found = lambda *a: {r.n for r in df.where(within_km(F.col("lat"), F.col("lon"), *a)).collect()}
    assert found(40.7128, -74.006, 10) == {"ny", "near"} and found(0, -179.99, 10) == {"dateline"} and found(89.99, -80.0, 10) == {"pole"}


# --- all together ------------------------------------------------------------------------------

LOG = "topic string, partition int, offset bigint, key string, value string, headers array<struct<key:string,value:binary>>"


def test_convert(spark):
    rows = [("t", 0, 1, "u1", '{"id":"x","name":"Ada","_mapping_version":"old"}', [("v", b"12")]), ("t", 0, 2, None, '{"a":1}', []),
            ("t", 0, 3, "u1", "5", []), ("t", 0, 4, "u1", None, []), ("t", 0, 5, None, None, []), ("t", 0, 6, "u2", "{oops", [])]
    df = spark.createDataFrame(rows, LOG)
    options = FoldOptions(collection="users", mapping_version="7", external_version_header="v", source_field="_src",
                          behavior_on_null_values="delete", behavior_on_malformed_documents="ignore")
    got = convert(df, options)
    ops = {r.offset: (r.collection, r.id, r.op, r.version, r.fields) for r in got.ops.collect()}
    src = '{"_mapping_version":"old","id":"x","name":"Ada"}'
    assert ops == {1: ("users", "u1", "replace", 12, {"name": ["Ada"], "_mapping_version": ["7"], "_src": [src]}), 4: ("users", "u1", "delete", None, None)}
    assert {r.offset: r.reason for r in got.dead.collect()} == {2: "missing id", 3: "unsupported value type", 6: "unsupported value type"}
    assert {r.offset: r.value for r in got.dead.collect()}[3] == "5"
    assert [r.offset for r in convert(df, FoldOptions(behavior_on_malformed_documents="warn")).ops.collect()] == [1]
    with pytest.raises(Exception, match="malformed record"):
        convert(df, FoldOptions()).ops.collect()
    with pytest.raises(Exception, match="tombstone record"):
        convert(df, FoldOptions(behavior_on_null_values="fail", drop_invalid_message=True)).ops.collect()


def test_convert_versioned_and_partial(spark):
    rows = [("t", 0, 1, "u1", '{"a":1}', []), ("t", 0, 2, "u1", None, []), ("t", 0, 3, "u2", '{"id":9}', []), ("t", 0, 4, "u2", '{"a":null}', [])]
    df = spark.createDataFrame(rows, LOG)
    soft = convert(df, FoldOptions(offset_version_field="_offset_ver", behavior_on_null_values="delete")).ops
    assert {r.offset: (r.op, r.fields) for r in soft.collect()}[2] == ("replace", {"_offset_ver": ["2"], "_deleted": ["true"]})
    ups = convert(df, FoldOptions(write_method="upsert")).ops
    assert {r.offset: r.fields for r in ups.collect()} == {1: {"a": ["1"]}, 4: {"a": None}}
    stamped = convert(df, FoldOptions(write_method="UPSERT", mapping_version="1")).ops
    assert {r.offset for r in stamped.collect()} == {1, 3, 4}


def test_options():
    o = FoldOptions.from_properties({"write.method": "upsert", "batch.size": "10", "key.ignore": "true", "topic.key.ignore": "a, b"})
    assert (o.write_method, o.batch_size, o.key_ignore, o.topic_key_ignore) == ("UPSERT", 10, True, ("a", "b"))
    for bad in (dict(write_method="MERGE"), dict(batch_size=0), dict(offset_version_field="v", write_method="UPSERT"),
                dict(collection_naming_strategy="TOPIC_REGEX", collection="x"), dict(behavior_on_null_values="x"), dict(retry_timeout_ms=-2)):
        with pytest.raises(ValueError):
            FoldOptions(**bad)
    with pytest.raises(ValueError):
        FoldOptions.from_properties({"no.such": "1"})
    assert FoldOptions.from_properties({"product.collection": "c", "product.offset.version.field": "ver"}).offset_version_field == "ver"


def test_typed_text_is_one_encoding(spark):
    assert spark.range(1).select(encode(F.lit("x"), T.StringType()).alias("e")).first().e == "x"
