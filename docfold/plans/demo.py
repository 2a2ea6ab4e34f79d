"""The given tables in the shapes the engine works on: change log, nested records, document tables.

Nothing here is cut down: every frame covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docfold.functions.encode import iso_instant
from docfold.sources.tables import table

ACTIONABLE = ("t1", "t3")


def change_log(spark: SparkSession, sf: str) -> DataFrame:
    """`events` as change records: one topic per event type, `error` events are tombstones."""
    return change_records(table(spark, sf, "events"))


def change_records(events: DataFrame) -> DataFrame:
    """Rows of `events` as change records."""
    return events.select(
        F.concat(F.lit("events-"), "event_type").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.format_string('{"id": %d}', "user_id").alias("key"),
        F.when(F.col("event_type") != "error", F.col("props")).alias("value"),
        _headers().alias("headers"),
        F.col("ts").alias("timestamp"),
        "user_id", "event_type", "ts", F.col("value").alias("amount"),
    )


def _headers() -> Column:
    """Header `ver`: an older copy first, then the offset with blanks around; `signup` has no number, `view` no header."""
    def header(text: Column) -> Column:
        return F.struct(F.lit("ver").alias("key"), F.encode(text, "UTF-8").alias("value"))

    number = F.concat(F.lit(" +"), F.col("event_id").cast("string"), F.lit("\n"))
    last = F.when(F.col("event_type") == "signup", F.lit("n/a")).otherwise(number)
    both = F.array(header(F.lit("0")), header(last))
    return F.when(F.col("event_type") == "view", F.filter(both, lambda h: F.lit(False))).otherwise(both)


def wkb_points(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a `location` geometry: latitude 32 + n/2048, longitude -(32 + n/4096), n from the key.

    The forms alternate: little and big endian, with SRID, with Z, a line string, and a cut value.
    """
    c = table(spark, sf, "customer")
    n = F.pmod("c_custkey", F.lit(65536))
    lat = F.lpad(F.hex(F.lit(0x4040000000000000) + n * F.lit(1 << 36)), 16, "0")
    lon = F.lpad(F.hex(F.shiftleft(n, 35) + F.lit(0x4040000000000000)), 16, "0")
    lon = F.concat(F.lit("C"), F.substring(lon, 2, 15))

    def swapped(h: Column) -> Column:
        return F.regexp_replace(F.reverse(h), "(.)(.)", "$2$1")

    big = F.concat(F.lit("0000000001"), lon, lat)
    little = F.concat(F.lit("0101000000"), swapped(lon), swapped(lat))
    srid = F.concat(F.lit("0101000020E6100000"), swapped(lon), swapped(lat))
    with_z = F.concat(F.lit("00000003E9"), lon, lat, lat)
    line = F.concat(F.lit("0000000002"), lon, lat)
    form = F.pmod("c_custkey", F.lit(6))
    text = (F.when(form == 0, little).when(form == 1, big).when(form == 2, srid).when(form == 3, with_z)
            .when(form == 4, line).otherwise(F.substring(big, 1, 30)))
    return c.select(F.col("c_custkey").alias("id"), F.struct(F.unhex(text).alias("wkb"), F.lit(4326).alias("srid")).alias("location"))


def user_ops(spark: SparkSession, sf: str) -> DataFrame:
    """`events` as ops on user documents: an `error` deletes the user, anything else replaces the document."""
    e = table(spark, sf, "events")
    return e.select(
        F.lit("users").alias("collection"), F.col("user_id").cast("string").alias("id"),
        F.when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("replace")).alias("op"),
        F.col("event_id").alias("offset"), "event_type", "value")


def arrival(offset: Column) -> Column:
    """A shuffled arrival order: the low ten bits come first. Different offsets (0 to 2^63 - 1) keep different arrivals."""
    return offset.bitwiseAND(F.lit(1023)) * F.lit(1 << 53) + F.shiftright(offset, 10)


def json_ops(spark: SparkSession, sf: str) -> DataFrame:
    """`events` as JSON records under partial updates.

    Each event type carries its own field, `purchase` also clears `view`, `error` deletes.
    """
    e = table(spark, sf, "events")
    text = F.when(F.col("event_type") == "purchase", F.to_json(
        F.struct(F.col("value").alias("purchase"), F.lit(None).cast("string").alias("view")), {"ignoreNullFields": "false"})
    ).when(F.col("event_type") != "error", F.concat(
        F.lit('{"'), F.col("event_type"), F.lit('": '), F.col("value").cast("string"), F.lit("}")))
    return e.select(
        F.lit("users").alias("collection"), F.col("user_id").cast("string").alias("id"),
        F.when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("update")).alias("op"),
        F.col("event_id").alias("offset"), text.alias("value"))


def customer_records(spark: SparkSession, sf: str) -> DataFrame:
    """customer -> nation -> region as a nested struct."""
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    return (
        c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(F.col("c_custkey").alias("id"), F.struct(
            F.col("c_name").alias("name"),
            F.struct(F.col("n_name").alias("name"), F.struct(F.col("r_name").alias("name")).alias("region")).alias("nation"),
        ).alias("customer"), F.col("c_acctbal").alias("acctbal"))
    )


def text_records(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as nested records, whole text: one struct per text line. Even-sized lines have no `tag`.

    The list is made inside the row, so no record's children are gathered by a shuffle.
    """
    d = table(spark, sf, "documents")
    size = F.length
    line = lambda x, i: F.struct(
        i.alias("pos"), size(x).cast("bigint").alias("chars"), (size(x) / F.lit(2)).alias("half"),
        F.when(size(x) % 2 == 1, F.concat(F.lit("t"), (size(x) % 7).cast("string"))).alias("tag"))
    return d.select(F.col("doc_id").alias("id"), F.transform(F.split("text", "\n"), line).alias("lines"))


def text_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with an open map: language -> size, source -> id, and a key that carries a NULL."""
    d = table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("id"), F.create_map(
        "lang", "n_chars", F.lit("none"), F.lit(None).cast("bigint"), "source", "doc_id").alias("attrs"))


def line_parents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their text lines as children, the source JSON, and the longest actionable line as derived key.

    The children are made inside the row, so a document with very many of them meets no shuffle.
    """
    from docfold.operators.search import latest_actionable

    d = text_records(spark, sf)
    child = lambda x: F.struct(F.concat_ws("-", "id", x["pos"]).alias("id"), x["tag"].alias("tag"), x["chars"].alias("chars"))
    docs = d.select("id", F.transform("lines", child).alias("children"))
    return docs.select("*", F.to_json(F.struct("id", "children")).alias("_src"),
                       latest_actionable(F.col("children"), "tag", "chars", ACTIONABLE).alias("longest_actionable"))


def customer_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with the date of their latest open order and the number of open ones; combined before the shuffle."""
    o = table(spark, sf, "orders")
    is_open = F.col("o_orderstatus").isin("O", "P")
    return o.groupBy(F.col("o_custkey").alias("id")).agg(
        F.max(F.when(is_open, F.col("o_orderdate"))).alias("latest_open"), F.count_if(is_open).alias("open_total"))


def customer_location(key: Column) -> tuple[Column, Column]:
    """A latitude and longitude made from the customer key: there is no geo column in the tables."""
    lat = F.pmod(key * F.lit(37), F.lit(1800)) / F.lit(10.0) - F.lit(90.0)
    lon = F.pmod(key * F.lit(91), F.lit(3600)) / F.lit(10.0) - F.lit(180.0)
    return lat, lon
