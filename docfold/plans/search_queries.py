"""Search on the given tables (Q1-Q20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docfold.functions.geo import within_km
from docfold.operators import fold, search
from docfold.operators.schema import copy_fields
from docfold.plans import demo
from docfold.plans.registry import query
from docfold.sources.tables import table

# Children of a document: its text lines. Those whose length is odd have a tag; some tags are actionable.
_LINES = """ch AS (SELECT doc_id, doc_id || '-' || (pos - 1) AS id, CAST(length(x) AS BIGINT) AS chars,
    CASE WHEN length(x) % 2 = 1 THEN 't' || (length(x) % 7) END AS tag
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)),
act AS (SELECT * FROM ch WHERE tag IN ('t1', 't3'))"""
# Children of a customer: their orders; open and partly filled ones are actionable.
_ORDERS = "act AS (SELECT * FROM orders WHERE o_orderstatus IN ('O', 'P'))"


@query("q_term", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey = 42")
def term(spark, sf):
    o = table(spark, sf, "orders")
    return search.find(o, search.term_in(o, "o_custkey", "42")).select("o_orderkey", "o_custkey", "o_orderstatus")


@query("q_find", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '2-HIGH'")
def find(spark, sf):
    o = table(spark, sf, "orders")
    return search.find(o, search.term(F.col("o_orderstatus"), "P"), search.term(F.col("o_orderpriority"), "2-HIGH")).select(
        "o_orderkey", "o_totalprice")


@query("q_in", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def any_of(spark, sf):
    o = table(spark, sf, "orders")
    return search.find(o, search.any_of(F.col("o_orderpriority"), ["1-URGENT", "5-LOW"])).select("o_orderkey", "o_orderpriority")


@query("q_range", """SELECT 'closed' AS kind, p_partkey FROM part WHERE p_size BETWEEN 17 AND 19
UNION ALL SELECT 'upto', p_partkey FROM part WHERE p_size <= 4 UNION ALL SELECT 'above', p_partkey FROM part WHERE p_size > 40""")
def ranges(spark, sf):
    p = table(spark, sf, "part")
    size = F.col("p_size")
    kinds = {"closed": search.in_range(size, 17, 19), "upto": search.in_range(size, high=4), "above": search.in_range(size, 40, low_open=True)}
    # One scan: each part reports the ranges it is in.
    found = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in kinds.items()]))
    return p.select(F.explode(found).alias("kind"), "p_partkey")


@query("q_ci_match", "SELECT p_partkey, p_name FROM part WHERE lower(p_name) = 'red bolt'")
def ci_match(spark, sf):
    p = table(spark, sf, "part")
    return search.find(p, search.matches_ignoring_case(F.col("p_name"), "RED Bolt")).select("p_partkey", "p_name")


@query("q_search_anything", """WITH t AS (SELECT doc_id, unnest([text, lang, source]) AS v FROM documents),
w AS (SELECT doc_id, max(CASE WHEN contains(lower(v), 'the') THEN 1 ELSE 0 END) AS a,
  max(CASE WHEN contains(lower(v), 'src1') THEN 1 ELSE 0 END) AS b FROM t GROUP BY doc_id)
SELECT doc_id FROM w WHERE a = 1 AND b = 1""")
def search_anything(spark, sf):
    d = copy_fields(table(spark, sf, "documents"), ["text", "lang", "source"], "_text")
    return search.find(d, search.search_anything(F.col("_text"), "The SRC1")).select("doc_id")


@query("q_multivalue_term", """SELECT doc_id AS id FROM documents
WHERE list_contains(['t' || (length(x) % 7) for x in string_split(text, chr(10)) if length(x) % 2 = 1], 't3')""")
def multivalue_term(spark, sf):
    return search.find(demo.text_records(spark, sf), search.has_element(F.col("lines.tag"), "t3")).select("id")


@query("q_exists", f"WITH {_ORDERS} SELECT DISTINCT o_custkey AS id FROM act")
def exists(spark, sf):
    return search.find(demo.customer_orders(spark, sf), search.exists(F.col("latest_open"))).select("id")


@query("q_prefix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 're%'")
def prefix(spark, sf):
    return search.find(table(spark, sf, "part"), search.starts_with(F.col("p_name"), "re")).select("p_partkey", "p_name")


@query("q_not", """SELECT CAST(user_id AS VARCHAR) AS id FROM events GROUP BY user_id HAVING arg_max(event_type, event_id) <> 'error'""")
def negation(spark, sf):
    ops = demo.user_ops(spark, sf)
    docs = fold.soft_deletes(ops.withColumn("ver", F.col("offset")), "ver", "offset")
    return search.find(docs, search.negate(F.col("_deleted") == True)).select("id")  # noqa: E712


@query("q_geofilt", """WITH g AS (SELECT c_custkey AS id, c_custkey * 37 % 1800 / 10.0 - 90 AS lat, c_custkey * 91 % 3600 / 10.0 - 180 AS lon FROM customer)
SELECT id FROM g WHERE 2 * 6371.0087714 * asin(least(1.0, sqrt(pow(sin(radians(lat - 40.7128) / 2), 2)
  + cos(radians(lat)) * cos(radians(40.7128)) * pow(sin(radians(lon + 74.006) / 2), 2)))) <= 2500""")
def geofilt(spark, sf):
    c = table(spark, sf, "customer")
    lat, lon = demo.customer_location(F.col("c_custkey"))
    return search.find(c, within_km(lat, lon, 40.7128, -74.006, 2500)).select(F.col("c_custkey").alias("id"))


def _sortable(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("id"), "c_nationkey", "c_mktsegment",
                    F.when(F.col("c_acctbal") > 9000, F.col("c_acctbal")).alias("height"))


@query("q_sort_missing_last", """WITH s AS (SELECT c_custkey AS id, CASE WHEN c_acctbal > 9000 THEN c_acctbal END AS height FROM customer),
a AS (SELECT 'asc' AS direction, id, height, row_number() OVER (ORDER BY height ASC NULLS LAST, id) AS pos FROM s),
d AS (SELECT 'desc' AS direction, id, height, row_number() OVER (ORDER BY height DESC NULLS LAST, id) AS pos FROM s)
SELECT direction, id, height, CAST(pos AS INTEGER) AS pos FROM (SELECT * FROM a UNION ALL SELECT * FROM d) WHERE pos <= 200""")
def sort_missing_last(spark, sf):
    docs = _sortable(spark, sf).select("id", "height")
    pages = [search.page(docs, [("height", d), ("id", "asc")], 200, position="pos").withColumn("direction", F.lit(d)) for d in ("asc", "desc")]
    return pages[0].unionByName(pages[1])


@query("q_sort_multi", """SELECT id, pos FROM (SELECT c_custkey AS id, CAST(row_number() OVER (
  ORDER BY c_nationkey DESC, c_mktsegment, c_custkey) AS INTEGER) AS pos FROM customer) WHERE pos <= 100""")
def sort_multi(spark, sf):
    return search.page(_sortable(spark, sf), [("c_nationkey", "desc"), ("c_mktsegment", "asc"), ("id", "asc")], 100, ["id"], "pos")


@query("q_topk", """SELECT id, value FROM (SELECT CAST(user_id AS VARCHAR) AS id, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
WHERE event_type <> 'error' ORDER BY value DESC, id LIMIT 20""")
def topk(spark, sf):
    docs = fold.apply_index(demo.user_ops(spark, sf))
    return search.page(docs, [("value", "desc"), ("id", "asc")], 20, ["id", "value"])


@query("q_custom_field", """SELECT p_partkey AS id, p_brand AS custom_field_5_sort_value FROM part WHERE p_type = 'ECONOMY'
ORDER BY p_brand, p_partkey LIMIT 20""")
def custom_field(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("custom_field_5_value_4"),
                                        F.col("p_brand").alias("custom_field_5_sort_value"))
    found = search.find(p, search.term(F.col("custom_field_5_value_4"), "ECONOMY"))
    return search.page(found, [("custom_field_5_sort_value", "asc"), ("id", "asc")], 20, ["id", "custom_field_5_sort_value"])


@query("q_cursor_page", "SELECT c_custkey AS id_sort FROM customer WHERE c_nationkey = 5 AND c_custkey > 40 ORDER BY c_custkey LIMIT 10")
def cursor_page(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id_sort"), "c_nationkey")
    return search.cursor_page(search.find(c, search.term(F.col("c_nationkey"), "5")), "id_sort", 40, 10, ["id_sort"])


@query("q_count", "SELECT count(*) AS num_found FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 100000")
def count(spark, sf):
    return search.hits(table(spark, sf, "orders"), search.term(F.col("o_orderstatus"), "P"), search.in_range(F.col("o_totalprice"), 100000, low_open=True))


_TOP = "SELECT id, tag, chars FROM act WHERE {parents} ORDER BY chars DESC, id LIMIT 20"


@query("q_recent_children", f"WITH {_LINES} " + _TOP.format(
    parents="doc_id IN (SELECT doc_id FROM act GROUP BY doc_id ORDER BY max(chars) DESC, doc_id LIMIT 20)"))
def recent_children(spark, sf):
    return search.recent_children(
        demo.line_parents(spark, sf), "longest_actionable", "_src", "children",
        "struct<id:string,tag:string,chars:bigint>", "tag", "chars", demo.ACTIONABLE, 20, [("id", "asc")], "id")


@query("q_top_hits", f"WITH {_LINES} " + _TOP.format(parents="true"))
def top_hits(spark, sf):
    docs = demo.line_parents(spark, sf)
    return search.top_children(docs, F.col("children"), "tag", "chars", demo.ACTIONABLE, 20, [("id", "asc")])


@query("q_latest_actionable", f"WITH {_LINES} SELECT ch.doc_id AS id, max(chars) FILTER (WHERE tag IN ('t1', 't3')) AS longest_actionable FROM ch GROUP BY ch.doc_id")
def latest_actionable(spark, sf):
    return demo.line_parents(spark, sf).select("id", "longest_actionable")


@query("q_latest_open", f"""WITH {_ORDERS} SELECT o_custkey AS id, CAST(max(o_orderdate) FILTER (WHERE o_orderstatus IN ('O', 'P')) AS VARCHAR) AS latest_open,
  count(*) FILTER (WHERE o_orderstatus IN ('O', 'P')) AS open_total FROM orders GROUP BY o_custkey""")
def latest_open(spark, sf):
    return demo.customer_orders(spark, sf).withColumn("latest_open", F.col("latest_open").cast("string"))


@query("q_facet_total", f"WITH {_ORDERS} SELECT count(*) AS total FROM act")
def facet_total(spark, sf):
    return demo.customer_orders(spark, sf).agg(F.sum("open_total").alias("total"))
