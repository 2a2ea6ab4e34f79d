"""Flattening, encoding and target schema on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docfold.functions.encode import base64_text, decimal_text, iso_instant
from docfold.operators.flatten import fields_map, flatten, leaves
from docfold.operators.schema import (
    cap_strings, copy_field, copy_fields, evolve, field_catalog, indexed_term, missing_fields)
from docfold.operators.triage import conform
from docfold.operators.variant import variant_fields
from docfold.options import FoldOptions
from docfold.plans import demo
from docfold.plans.registry import query
from docfold.sources.tables import table

# Lengths of the text lines of every document.
_LINES = "l AS (SELECT doc_id AS id, [length(x) for x in string_split(text, chr(10))] AS n FROM documents)"


def _joined(values: str) -> str:
    """A list as the text `array_join` gives, NULL for an empty one."""
    return f"nullif(array_to_string({values}, ','), '')"


_TAGS = "['t' || (x % 7) for x in n if x % 2 = 1]"


def _long(df, fields):
    """(id, field, vals) rows of a fields map."""
    return df.select("id", F.explode(fields).alias("field", "v")).select(
        "id", "field", F.array_join("v", ",").alias("vals"))


@query("q_flatten_struct", """SELECT c_custkey AS id, c_name AS "customer.name", n_name AS "customer.nation.name",
  r_name AS "customer.nation.region.name", c_acctbal AS acctbal
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def flatten_struct(spark, sf):
    return flatten(demo.customer_records(spark, sf), keep=["id"])


@query("q_null_elision", """SELECT event_id AS id, CASE WHEN event_type = 'error' THEN 'info.kind' ELSE 'info.amount,info.kind' END AS names
FROM events""")
def null_elision(spark, sf):
    e = table(spark, sf, "events")
    rows = e.select(F.col("event_id").alias("id"), F.struct(
        F.when(F.col("event_type") != "error", F.col("value")).alias("amount"), F.col("event_type").alias("kind")).alias("info"))
    return rows.select("id", F.array_join(F.map_keys(fields_map(leaves(rows.schema))), ",").alias("names"))


@query("q_flatten_array", f"WITH {_LINES} SELECT id, {_joined(_TAGS)} AS tags FROM l")
def flatten_array(spark, sf):
    rows = demo.text_records(spark, sf).select("id", F.col("lines.tag").alias("tags"))
    return flatten(rows, keep=["id"]).select("id", F.array_join("tags", ",").alias("tags"))


@query("q_flatten_struct_array", f"""WITH {_LINES} SELECT id, {_joined("range(len(n))")} AS "lines.pos", {_joined("n")} AS "lines.chars",
  {_joined("[x / 2 for x in n]")} AS "lines.half", {_joined(_TAGS)} AS "lines.tag" FROM l""")
def flatten_struct_array(spark, sf):
    flat = flatten(demo.text_records(spark, sf), keep=["id"])
    return flat.select("id", *[F.array_join(f"`{c}`", ",").alias(c) for c in flat.columns if c != "id"])


@query("q_flatten_map_array", f"""WITH {_LINES}, k AS (
  SELECT id, 'by_line.even' AS field, {_joined("[x for x in n if x % 2 = 0]")} AS vals FROM l
  UNION ALL SELECT id, 'by_line.odd', {_joined("[x for x in n if x % 2 = 1]")} FROM l)
SELECT * FROM k WHERE vals IS NOT NULL""")
def flatten_map_array(spark, sf):
    rows = demo.text_records(spark, sf).select("id", F.transform("lines", lambda x: F.create_map(
        F.when(x["tag"].isNull(), F.lit("even")).otherwise(F.lit("odd")), x["chars"])).alias("by_line"))
    return _long(rows, fields_map(leaves(rows.schema)))


@query("q_flatten_map_compact", """SELECT doc_id AS id, 'attrs.' || lang AS field, CAST(n_chars AS VARCHAR) AS vals FROM documents
UNION ALL SELECT doc_id, 'attrs.' || source, CAST(doc_id AS VARCHAR) FROM documents""")
def flatten_map_compact(spark, sf):
    rows = demo.text_maps(spark, sf)
    return _long(rows, fields_map(leaves(rows.schema)))


@query("q_flatten_map_kv", """SELECT doc_id AS id, lang || ',' || source AS "attrs.key", n_chars || ',' || doc_id AS "attrs.value" FROM documents""")
def flatten_map_kv(spark, sf):
    flat = flatten(demo.text_maps(spark, sf), keep=["id"], compact=False)
    return flat.select("id", *[F.array_join(f"`{c}`", ",").alias(c) for c in flat.columns if c != "id"])


@query("q_flatten_nested_array", f"""WITH {_LINES} SELECT id,
  {_joined("[(i || ',' || n[i + 1]) for i in range(len(n))]")} AS pairs FROM l""")
def flatten_nested_array(spark, sf):
    rows = demo.text_records(spark, sf).select("id", F.transform("lines", lambda x: F.array(
        x["pos"].cast("bigint"), F.lit(None).cast("bigint"), x["chars"])).alias("pairs"))
    return flatten(rows, keep=["id"]).select("id", F.array_join("pairs", ",").alias("pairs"))


@query("q_flatten_variant", f"""WITH {_LINES}, k AS (
  SELECT id, 'lines.pos' AS field, {_joined("range(len(n))")} AS vals FROM l UNION ALL SELECT id, 'lines.chars', {_joined("n")} FROM l
  UNION ALL SELECT id, 'lines.tag', {_joined(_TAGS)} FROM l
  UNION ALL SELECT id, 'deep.a.b.c', CAST(id AS VARCHAR) || ',x,y' FROM l)
SELECT * FROM k WHERE vals IS NOT NULL""")
def flatten_variant(spark, sf):
    rows = demo.text_records(spark, sf)
    line = F.transform("lines", lambda x: F.struct(x["pos"].alias("pos"), x["chars"].alias("chars"), x["tag"].alias("tag")))
    deep = F.concat(F.lit('{"a":[{"b":{"c":['), F.col("id").cast("string"), F.lit(',["x"],null]}},null,{"b":{"c":"y"}}]}'))
    text = F.concat(F.lit('{"id":1,"empty":[],"lines":'), F.to_json(line, {"ignoreNullFields": "false"}),
                    F.lit(',"deep":'), deep, F.lit("}"))
    return _long(rows, variant_fields(F.parse_json(text)))


@query("q_iso_instant", """SELECT event_id AS id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN extract(millisecond FROM ts) % 1000 = 0 THEN ''
    ELSE '.' || lpad(CAST(CAST(extract(millisecond FROM ts) AS INTEGER) % 1000 AS VARCHAR), 3, '0') END || 'Z' AS at,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at_second, strftime(ts, '%Y-%m-%dT00:00:00Z') AS day
FROM events""")
def iso_instants(spark, sf):
    e = table(spark, sf, "events")
    rows = e.select(F.col("event_id").alias("id"), F.col("ts").alias("at"),
                    F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("at_second"), F.col("ts").cast("date").alias("day"))
    return rows.select("id", *[iso_instant(F.col(c), rows.schema[c].dataType).alias(c) for c in ("at", "at_second", "day")])


@query("q_decimal_string", """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
  CAST(CAST(l_discount AS DECIMAL(18,8)) AS VARCHAR) AS discount FROM lineitem""")
def decimal_strings(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     decimal_text(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
                     decimal_text(F.col("l_discount").cast("decimal(18,8)")).alias("discount"))


@query("q_base64", """SELECT doc_id, md5(to_base64(encode(text))) AS digest, CAST(length(to_base64(encode(text))) AS INTEGER) AS size
FROM documents""")
def base64_texts(spark, sf):
    d = table(spark, sf, "documents")
    text = base64_text(F.col("text").cast("binary"))
    return d.select("doc_id", F.md5(text).alias("digest"), F.length(text).alias("size"))


@query("q_primitives", """SELECT p_partkey AS id, p_size AS "p.size", p_retailprice AS "p.price", p_size > 25 AS "p.large",
  p_name AS "p.name" FROM part""")
def primitives(spark, sf):
    p = table(spark, sf, "part")
    rows = p.select(F.col("p_partkey").alias("id"), F.struct(
        F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"), (F.col("p_size") > 25).alias("large"),
        F.col("p_name").alias("name")).alias("p"))
    return flatten(rows, keep=["id"])


@query("q_noop_skip", """SELECT user_id, count(*) FILTER (WHERE event_type <> 'click') AS written,
  count(*) FILTER (WHERE event_type = 'click') AS skipped FROM events GROUP BY user_id""")
def noop_skip(spark, sf):
    from docfold.operators.flatten import effective

    e = table(spark, sf, "events")
    text = F.when(F.col("event_type") == "click", F.lit('{"id":5}')).when(
        F.col("event_type") == "view", F.lit('{"id":5,"gone":null}')).otherwise(F.col("props"))
    keep = effective(variant_fields(F.parse_json(text), partial=True), True)
    return e.select("user_id", keep.alias("keep")).groupBy("user_id").agg(
        F.count_if("keep").alias("written"), F.count_if(~F.col("keep")).alias("skipped"))


@query("q_clear_fields", """SELECT c_custkey AS id, f.field FROM customer,
  (VALUES ('addr.nation'), ('addr.geo.key'), ('addr.geo.segment')) f(field) WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, 'rank' FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_custkey, 'tags.key' FROM customer WHERE c_mktsegment = 'MACHINERY'
UNION ALL SELECT c_custkey, 'tags.value' FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def clear_fields(spark, sf):
    c = table(spark, sf, "customer")
    rows = c.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") >= 0, F.struct(F.col("c_nationkey").alias("nation"), F.struct(
            F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment")).alias("geo"))).alias("addr"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.array("c_nationkey")).alias("rank"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.create_map(F.lit("n"), F.col("c_nationkey"))).alias("tags"))
    fields = fields_map(leaves(rows.schema, compact=False, clearing=True), partial=True)
    return rows.select("id", F.explode(fields).alias("field", "v")).where(F.col("v").isNull()).select("id", "field")


# --- target schema -----------------------------------------------------------------------------

def _usage(df):
    """How many documents carry each field."""
    names = F.explode(F.map_keys(fields_map(leaves(df.schema))))
    return df.select(names.alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("documents"))


@query("q_field_catalog", f"""WITH {_LINES}
SELECT 'lines.pos' AS name, 'pint' AS type, true AS multi_valued, false AS dynamic, count(*) AS documents FROM l
UNION ALL SELECT 'lines.chars', 'plong', true, false, count(*) FROM l UNION ALL SELECT 'lines.half', 'pdouble', true, false, count(*) FROM l
UNION ALL SELECT 'lines.tag', 'string', true, false, count(*) FROM l WHERE len({_TAGS}) > 0""")
def field_catalog_query(spark, sf):
    rows = demo.text_records(spark, sf)
    catalog = field_catalog(spark, rows.drop("id").schema)
    return catalog.join(_usage(rows), "name", "left")


@query("q_field_catalog_map", """SELECT 'attrs.*' AS name, 'plong' AS type, true AS multi_valued, true AS dynamic,
  (SELECT count(*) FROM documents) AS documents, count(DISTINCT k) AS keys FROM (SELECT lang AS k FROM documents UNION ALL SELECT source FROM documents)""")
def field_catalog_map(spark, sf):
    rows = demo.text_maps(spark, sf)
    catalog = field_catalog(spark, rows.drop("id").schema)
    flat = flatten(rows, keep=["id"])
    used = flat.select(F.lit("attrs.*").alias("name"), F.map_keys("`attrs.*`").alias("k")).where(F.size("k") > 0)
    counts = used.groupBy("name").agg(F.count(F.lit(1)).alias("documents"))
    keys = used.select("name", F.explode("k").alias("k")).groupBy("name").agg(F.count_distinct("k").alias("keys"))
    return catalog.join(counts, "name", "left").join(keys, "name", "left")


@query("q_schema_evolve", f"""WITH {_LINES}
SELECT 'lines.tag' AS name, 'string' AS type, true AS multi_valued, false AS dynamic, count(*) AS documents FROM l WHERE len({_TAGS}) > 0
UNION ALL SELECT 'lines.half', 'pdouble', true, false, count(*) FROM l""")
def schema_evolve(spark, sf):
    rows = demo.text_records(spark, sf)
    before = rows.select(F.transform("lines", lambda x: F.struct(
        x["pos"].cast("string").alias("pos"), x["chars"].alias("chars"))).alias("lines"))
    known = field_catalog(spark, before.schema)
    needed = field_catalog(spark, rows.drop("id").schema)
    grown = evolve(known, needed, FoldOptions(schema_auto_evolve=True))
    return missing_fields(known, grown).join(_usage(rows), "name", "left")


@query("q_conformance_reject", """SELECT event_id AS id, 'height_cm' AS field, 'tall' AS height_cm FROM events
WHERE event_type = 'signup'""")
def conformance_reject(spark, sf):
    e = table(spark, sf, "events")
    docs = e.select(F.col("event_id").alias("id"), F.when(F.col("event_type") == "signup", F.lit("tall")).otherwise(
        F.col("user_id").cast("string")).alias("height_cm"))
    _, rejected = conform(docs, {"height_cm": "bigint"})
    return rejected.select("id", "field", "height_cm")


@query("q_string_cap", """SELECT doc_id, CAST(length(left(text, 8000)) AS INTEGER) AS kept, md5(left(text, 8000)) AS digest,
  CAST(length(text) AS INTEGER) AS source, CASE WHEN length(text) <= 8000 THEN md5(lower(text)) END AS term FROM documents""")
def string_cap(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", F.col("text").alias("_src"))
    capped = cap_strings(d)
    return capped.select("doc_id", F.length("text").alias("kept"), F.md5("text").alias("digest"),
                         F.length("_src").alias("source"), F.md5(indexed_term(F.col("_src"))).alias("term"))


@query("q_copy_field", """SELECT CAST(c_custkey AS VARCHAR) AS id, c_custkey AS id_sort, c_name || '|' ||
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment || '|' ELSE '' END || CAST(c_nationkey AS VARCHAR) AS _text
FROM customer""")
def copy_field_query(spark, sf):
    c = table(spark, sf, "customer")
    docs = c.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("first_name"),
                    F.when(F.col("c_mktsegment") != "BUILDING", F.array("c_mktsegment")).alias("custom_field_1_value_1"),
                    F.col("c_nationkey").alias("custom_field_2_value_1"))
    docs = copy_field(copy_fields(docs, ["first_name", "*_value_1"], "_text"), "id", "id_sort", "bigint")
    return docs.select("id", "id_sort", F.array_join("_text", "|").alias("_text"))
