"""Sources, routing, identity and stamps on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from docfold.functions.geo import geometry_to_latlon
from docfold.functions.headers import header_version
from docfold.operators.flatten import flatten, leaves
from docfold.operators.identity import (
    delete_id, document_bytes, document_id, reserved_names, route, source_json, stamps)
from docfold.operators.variant import variant_fields
from docfold.options import FoldOptions
from docfold.plans import demo
from docfold.plans.registry import query
from docfold.sources.changes import decode_json, unwrap_key
from docfold.sources.tables import table

_LOG = """log AS (
  SELECT 'events-' || event_type AS topic, CAST(user_id % 4 AS INTEGER) AS part, event_id AS "offset",
         user_id, event_type, ts, value AS amount, CASE WHEN event_type <> 'error' THEN props END AS value
  FROM events)"""


@query("q_changes_scan", f"""WITH {_LOG}
SELECT topic, part AS "partition", count(*) AS records, min("offset") AS first_offset, max("offset") AS last_offset,
       count(*) FILTER (WHERE value IS NULL) AS tombstones
FROM log GROUP BY topic, part""")
def changes_scan(spark, sf):
    log = demo.change_log(spark, sf)
    return log.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.count_if(F.col("value").isNull()).alias("tombstones"))


@query("q_json_decode", """SELECT event_id AS "offset", CAST(props->>'$.k' AS BIGINT) AS k FROM events
WHERE event_type <> 'error'""")
def json_decode(spark, sf):
    log = demo.change_log(spark, sf).where(F.col("value").isNotNull())
    return log.select("offset", F.try_variant_get(decode_json(F.col("value")), "$.k", "bigint").alias("k"))


@query("q_key_unwrap", """SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS key FROM events""")
def key_unwrap(spark, sf):
    return unwrap_key(demo.change_log(spark, sf), "id").select("offset", "key")


@query("q_geo_latlon", """WITH p AS (
  SELECT c_custkey AS id, CAST(32 + (c_custkey % 65536) / 2048.0 AS DECIMAL(18,12)) AS lat,
         CAST(-(32 + (c_custkey % 65536) / 4096.0) AS DECIMAL(18,12)) AS lon FROM customer)
SELECT id, CASE WHEN id % 6 < 4 THEN
  rtrim(rtrim(CAST(lat AS VARCHAR), '0'), '.') || ',' || rtrim(rtrim(CAST(lon AS VARCHAR), '0'), '.') END AS location
FROM p""")
def geo_latlon(spark, sf):
    return geometry_to_latlon(demo.wkb_points(spark, sf))


def _routed(spark, sf, options):
    log = demo.change_log(spark, sf)
    return log.groupBy("topic", route(F.col("topic"), options).alias("collection")).agg(F.count(F.lit(1)).alias("records"))


@query("q_route_topic", f"WITH {_LOG} SELECT topic, topic AS collection, count(*) AS records FROM log GROUP BY topic")
def route_topic(spark, sf):
    return _routed(spark, sf, FoldOptions())


@query("q_route_static", f"WITH {_LOG} SELECT topic, 'users' AS collection, count(*) AS records FROM log GROUP BY topic")
def route_static(spark, sf):
    return _routed(spark, sf, FoldOptions(collection="users", collection_naming_strategy="static"))


@query("q_route_regex", f"""WITH {_LOG}
SELECT topic, CASE WHEN topic IN ('events-click', 'events-view') THEN 'web_' || substr(topic, 8) ELSE topic END AS collection,
       count(*) AS records FROM log GROUP BY 1, 2""")
def route_regex(spark, sf):
    return _routed(spark, sf, FoldOptions(collection="events-(click|view) => web_$1", collection_naming_strategy="TOPIC_REGEX"))


@query("q_id_key", """SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS id FROM events""")
def id_key(spark, sf):
    log = unwrap_key(demo.change_log(spark, sf))
    return log.select("offset", document_id(log.schema, FoldOptions()).alias("id"))


@query("q_id_field", """SELECT c_custkey AS custkey, 'NATION_' || c_nationkey AS id FROM customer""")
def id_field(spark, sf):
    rows = demo.customer_records(spark, sf).select("id", F.struct("customer").alias("value"), F.lit(None).cast("string").alias("key"))
    options = FoldOptions(id_strategy="RECORD_FIELD", id_field="customer.nation.name")
    return rows.select(F.col("id").alias("custkey"), document_id(rows.schema, options).alias("id"))


@query("q_id_tpo", f"""WITH {_LOG} SELECT "offset", topic || '-' || part || '-' || "offset" AS id FROM log""")
def id_tpo(spark, sf):
    log = demo.change_log(spark, sf)
    return log.select("offset", document_id(log.schema, FoldOptions(id_strategy="TOPIC_PARTITION_OFFSET")).alias("id"))


@query("q_id_uuid", "SELECT count(*) AS records, count(*) AS ids, count(*) AS well_formed FROM events")
def id_uuid(spark, sf):
    """Random ids: as many different ones as records, each in the form of a version 4 UUID."""
    log = demo.change_log(spark, sf)
    ids = log.select(document_id(log.schema, FoldOptions(use_autogenerated_ids=True)).alias("id"))
    form = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    # Counted per id first: an id must be drawn once only.
    each = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return each.agg(F.sum("n").alias("records"), F.count(F.lit(1)).alias("ids"), F.sum(F.when(F.col("id").rlike(form), F.col("n")).otherwise(0)).alias("well_formed"))


@query("q_id_key_ignored", f"""WITH {_LOG}
SELECT "offset", CASE WHEN topic IN ('events-view', 'events-click') THEN topic || '-' || part || '-' || "offset"
                      ELSE CAST(user_id AS VARCHAR) END AS id FROM log""")
def id_key_ignored(spark, sf):
    log = unwrap_key(demo.change_log(spark, sf))
    options = FoldOptions(topic_key_ignore=("events-view", "events-click"))
    return log.select("offset", document_id(log.schema, options).alias("id"))


@query("q_id_numeric", """SELECT event_id AS "offset", user_id AS id FROM events""")
def id_numeric(spark, sf):
    log = demo.change_log(spark, sf).withColumn("key", F.col("user_id"))
    return log.select("offset", document_id(log.schema, FoldOptions(id_coerce_to_string=False)).alias("id"))


@query("q_reserved_drop", """SELECT CAST(user_id AS VARCHAR) AS id, event_id AS "offset",
  'event,nested.id' AS names, event_type || ',' || event_id AS vals FROM events""")
def reserved_drop(spark, sf):
    log = unwrap_key(demo.change_log(spark, sf))
    options = FoldOptions(mapping_version="7")
    value = F.to_json(F.struct(F.lit("mine").alias("id"), F.lit("old").alias("_mapping_version"),
                               F.col("event_type").alias("event"), F.struct(F.col("offset").alias("id")).alias("nested")))
    fields = variant_fields(F.parse_json(value), reserved=reserved_names(options))
    rows = log.select(document_id(log.schema, options).alias("id"), "offset", fields.alias("f"))
    return rows.select("id", "offset", F.array_join(F.map_keys("f"), ",").alias("names"),
                       F.array_join(F.flatten(F.map_values("f")), ",").alias("vals"))


@query("q_mapping_version", """SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS id, 'v7' AS _mapping_version
FROM events""")
def mapping_version(spark, sf):
    log = unwrap_key(demo.change_log(spark, sf))
    options = FoldOptions(mapping_version="v7")
    return log.select("offset", document_id(log.schema, options).alias("id"),
                      *[c.alias(n) for n, c in stamps(log.schema, options).items()])


@query("q_offset_version", """SELECT CAST(user_id AS VARCHAR) AS id, event_id AS _offset_ver FROM events""")
def offset_version(spark, sf):
    log = unwrap_key(demo.change_log(spark, sf))
    options = FoldOptions(offset_version_field="_offset_ver")
    return log.select(document_id(log.schema, options).alias("id"),
                      *[c.alias(n) for n, c in stamps(log.schema, options).items()])


@query("q_header_version", """SELECT event_id AS "offset",
  CASE WHEN event_type NOT IN ('signup', 'view') THEN event_id END AS version FROM events""")
def header_versions(spark, sf):
    log = demo.change_log(spark, sf)
    return log.select("offset", header_version(F.col("headers"), "ver", log.schema["headers"].dataType).alias("version"))


@query("q_source_json", """SELECT c_custkey AS id, '{"customer":{"name":"' || c_name || '","nation":{"name":"' || n_name ||
  '","region":{"name":"' || r_name || '"}}},"rich":' || CASE WHEN c_acctbal > 5000 THEN 'true' ELSE 'null' END || '}' AS _src
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def source_json_query(spark, sf):
    rows = demo.customer_records(spark, sf)
    value = F.struct("customer", F.when(F.col("acctbal") > 5000, F.lit(True)).alias("rich"))
    typed = rows.select("id", value.alias("value"))
    return typed.select("id", source_json(F.col("value"), typed.schema["value"].dataType).alias("_src"))


@query("q_source_exclude", """SELECT event_id AS "offset", '{"event":"' || event_type || '","nested":{"custom_field_2":1}}' AS _src
FROM events""")
def source_exclude(spark, sf):
    log = demo.change_log(spark, sf)
    text = F.to_json(F.struct(F.col("event_type").alias("event"), F.col("offset").alias("custom_field_1"),
                              F.lit(3).alias("funnel_lead_9"), F.struct(F.lit(1).alias("custom_field_2")).alias("nested")))
    return log.select("offset", source_json(
        F.parse_json(text), T.VariantType(), ("custom_field_", "funnel_lead_")).alias("_src"))


@query("q_doc_bytes", """WITH l AS (SELECT doc_id, [length(x) for x in string_split(text, chr(10))] AS n FROM documents)
SELECT doc_id AS id, CAST(16 + 4 + 2 * length(CAST(doc_id AS VARCHAR)) + len(n) * (3 * 16 + 2 * (length('lines.pos') + length('lines.chars') + length('lines.half')))
  + len([x for x in n if x % 2 = 1]) * (2 * length('lines.tag') + 4) AS BIGINT) AS bytes FROM l""")
def doc_bytes(spark, sf):
    rows = demo.text_records(spark, sf)
    doc_id = F.col("id").cast("string")
    return rows.select("id", document_bytes(leaves(rows.schema), doc_id, T.StringType()).alias("bytes"))
