"""The whole pipeline on the given tables: change log -> micro-batches -> stored table -> documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docfold.operators import search, versions
from docfold.operators.schema import declared_types
from docfold.options import FoldOptions
from docfold.plans import demo
from docfold.plans.ingest import convert
from docfold.plans.registry import query
from docfold.sources.changes import unwrap_key
from docfold.sources.tables import table
from docfold.streaming.apply import apply_batch, scratch_folder
from docfold.streaming.layout import SearchLayout
from docfold.streaming.table import DocumentTable

BATCHES = 4
TASK_EVENTS = 500_000      # of a batch in one task, about
_USERS = {"collection": "users", "collection_naming_strategy": "STATIC", "behavior_on_null_values": "delete", "behavior_on_malformed_documents": "warn"}


def _batched(spark: SparkSession, sf: str) -> DataFrame:
    """The change log with `batch`: four even parts of the offsets.

    The events of a part lie side by side in the table, in row groups that one or two tasks read. They are dealt out by
    offset before anything is made of them, or those tasks would convert the whole batch. Few tasks do it better than
    `spark.sql.shuffle.partitions` of them, as each one opens a file for every partition of the fold.
    """
    events = table(spark, sf, "events")
    upto = events.agg(F.max("event_id") + 1).scalar()
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-events.count() // (BATCHES * TASK_EVENTS)))
    log = unwrap_key(demo.change_records(events.repartition(tasks, "event_id")))
    return log.withColumn("batch", F.floor(F.col("offset") * BATCHES / upto).cast("int"))


def _applied(documents: DocumentTable, log: DataFrame, options: FoldOptions, deliveries=range(BATCHES), compact_after: int | None = None) -> None:
    for n, batch in enumerate(deliveries):
        apply_batch(log.where(F.col("batch") == batch).drop("batch"), batch, documents, options)
        if n == compact_after:
            documents.compact()


# --- conditional writes ------------------------------------------------------------------------

def _known(log: DataFrame) -> DataFrame:
    """user_id, batch, last: the offset of the user's last free write of the batches before."""
    free = log.where("offset % 5 = 0 AND value IS NOT NULL").groupBy("user_id", "batch").agg(F.max("offset").alias("last"))
    later = F.explode(F.sequence(F.col("batch") + 1, F.lit(BATCHES)))
    return free.select("user_id", later.alias("batch"), "last").groupBy("user_id", "batch").agg(F.max("last").alias("last"))


def _asking(log: DataFrame, known: DataFrame) -> DataFrame:
    """Events that ask, by number: for nothing, an existing document, none, the version of the user's last free write of
    the batches before, and a version that no document has."""
    log = log.join(known, ["user_id", "batch"], "left")
    kind = F.col("offset") % 5
    asked = (F.when(kind == 1, F.lit("1")).when(kind == 2, F.lit("-1"))
             .when(kind == 3, versions.version_of(F.col("last")).cast("string")).when(kind == 4, F.lit("7")))
    header = F.struct(F.lit("ver").alias("key"), F.encode(asked, "UTF-8").alias("value"))
    return log.withColumn("headers", F.array(header))


@query("q_external_version", f"""WITH RECURSIVE e AS (SELECT *, CAST(floor(event_id * {BATCHES} / (max(event_id) OVER () + 1)) AS INTEGER) AS batch,
  2 + CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 15) AS BIGINT) AS ver FROM events),
free AS (SELECT user_id, batch, event_id, ver FROM e WHERE event_id % 5 = 0 AND event_type <> 'error'),
o AS MATERIALIZED (SELECT e.event_id, e.user_id, e.ver, e.event_type = 'error' AS del, row_number() OVER (PARTITION BY e.user_id ORDER BY e.event_id) AS rn,
  CASE e.event_id % 5 WHEN 1 THEN 1 WHEN 2 THEN -1 WHEN 4 THEN 7
    WHEN 3 THEN (SELECT arg_max(f.ver, f.event_id) FROM free f WHERE f.user_id = e.user_id AND f.batch < e.batch) END AS asked FROM e),
walk(user_id, rn, event_id, ok, stored) AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), true, CAST(NULL AS BIGINT) FROM o
  UNION ALL SELECT user_id, rn, event_id, ok, CASE WHEN del THEN NULL WHEN ok THEN ver ELSE stored END FROM (
    SELECT o.user_id, o.rn, o.event_id, o.del, o.ver, w.stored, del OR asked IS NULL OR (asked < 0 AND w.stored IS NULL)
      OR (w.stored IS NOT NULL AND asked >= 0 AND (asked = 1 OR asked = w.stored)) AS ok
    FROM walk w JOIN o ON o.user_id = w.user_id AND o.rn = w.rn + 1)),
final AS (SELECT user_id, arg_max(coalesce(stored, -1), rn) AS stands FROM walk GROUP BY user_id)
SELECT o.event_id, w.ok AS applied, o.ver = stands AS stands FROM walk w JOIN o USING (event_id) JOIN final ON final.user_id = o.user_id""")
def external_version(spark, sf):
    """Which events a stored table takes when each may ask for a version, and which document stands in the end."""
    log = _batched(spark, sf)
    known = _known(log).persist()      # every batch asks for it
    documents = DocumentTable(spark, scratch_folder(spark, "versions"), order="offset")
    _applied(documents, _asking(log, known), FoldOptions(**_USERS, external_version_header="ver"), compact_after=1)
    known.unpersist()
    dead = documents.dead_letters().where(F.col("reason") == versions.CONFLICT).select("offset", F.lit(False).alias("applied"))
    docs = documents.read("users", versions=True).select(F.col("id").cast("bigint").alias("user_id"), F.col("version").alias("stored"))
    out = log.select("offset", "user_id").join(dead, "offset", "left").join(docs, "user_id", "left")
    return out.select(F.col("offset").alias("event_id"), F.coalesce("applied", F.lit(True)).alias("applied"),
                      F.coalesce(F.col("stored") == versions.version_of(F.col("offset")), F.lit(False)).alias("stands"))


# --- the stored table --------------------------------------------------------------------------

_LAST = """SELECT {columns} FROM events QUALIFY row_number() OVER (PARTITION BY user_id{more} ORDER BY event_id DESC) = 1"""


@query("q_stream_fold", f"""SELECT CAST(user_id AS VARCHAR) AS id, CAST(props->>'$.k' AS BIGINT) AS k FROM
  ({_LAST.format(columns="*", more="")}) WHERE event_type <> 'error'""")
def stream_fold(spark, sf):
    """Events in micro-batches, one of them delivered again after a compaction that holds it: the documents of one fold."""
    documents = DocumentTable(spark, scratch_folder(spark, "fold"), order="offset")
    _applied(documents, _batched(spark, sf), FoldOptions(**_USERS), deliveries=(0, 1, 2, 1, 3, 0), compact_after=2)
    return documents.columns({"k": "bigint"}, "users").select("id", "k")


@query("q_delete_all", f"""SELECT 'events-' || event_type AS collection, CAST(user_id AS VARCHAR) AS id, CAST(props->>'$.k' AS BIGINT) AS k FROM
  ({_LAST.format(columns="*", more=", event_type")}) WHERE event_type NOT IN ('error', 'view')
  OR event_type = 'view' AND floor(event_id * {BATCHES} / (SELECT max(event_id) + 1 FROM events)) = {BATCHES - 1}""")
def delete_all(spark, sf):
    """A collection emptied between two micro-batches keeps what was written after."""
    documents = DocumentTable(spark, scratch_folder(spark, "emptied"), order="offset")
    log, options = _batched(spark, sf), FoldOptions(behavior_on_null_values="delete")
    _applied(documents, log, options, deliveries=range(BATCHES - 1))
    documents.delete_all("events-view")
    _applied(documents, log, options, deliveries=[BATCHES - 1])
    return documents.columns({"k": "bigint"}).select("collection", "id", "k")


@query("q_pipeline_search", f"""SELECT CAST(user_id AS VARCHAR) AS id, CAST(props->>'$.k' AS BIGINT) AS k FROM
  ({_LAST.format(columns="*", more="")}) WHERE event_type <> 'error' AND CAST(props->>'$.k' AS BIGINT) BETWEEN 10 AND 60
ORDER BY k DESC, id LIMIT 50""")
def pipeline_search(spark, sf):
    """Events to documents to a typed copy in the order of a field, to the first page of a range: with batches that came
    after the copy."""
    documents = DocumentTable(spark, scratch_folder(spark, "searched"), order="offset")
    documents.declare("users", {"k": ["plong", False, False]})
    log, options = _batched(spark, sf), FoldOptions(**_USERS)
    _applied(documents, log, options, deliveries=range(BATCHES - 1), compact_after=1)
    layout = SearchLayout(documents, "users", "k")
    layout.refresh()
    _applied(documents, log, options, deliveries=[BATCHES - 1])
    return search.page(layout.read(10, 60), [("k", "desc"), ("id", "asc")], 50, ["id", "k"])


# --- declared fields ---------------------------------------------------------------------------

@query("q_pipeline_rejects", """SELECT event_id AS "offset", CASE event_type WHEN 'signup' THEN 'field height_cm is no plong'
  WHEN 'click' THEN 'field joined is no pdate' END AS reason, CASE WHEN event_type NOT IN ('signup', 'click') THEN CAST(user_id AS VARCHAR) END AS height_cm
FROM events WHERE event_type <> 'error'""")
def pipeline_rejects(spark, sf):
    """Records with a value that its declared field cannot take become dead letters; the others land."""
    kind = F.col("event_type")
    value = (F.when(kind == "signup", F.format_string('{"height_cm": ["3", "tall"], "joined": "2024-01-02T03:04:05Z"}'))
             .when(kind == "click", F.format_string('{"height_cm": %d, "joined": "soon"}', "user_id"))
             .when(kind == "view", F.format_string('{"height_cm": " 00%d ", "joined": null}', "user_id"))
             .otherwise(F.format_string('{"height_cm": %d, "other": "tall"}', "user_id")))
    log = unwrap_key(demo.change_log(spark, sf)).where(kind != "error").withColumn("value", value)
    found = convert(log, FoldOptions(**_USERS), {"users": {"height_cm": "plong", "joined": "pdate"}})
    good = found.ops.select("offset", F.lit(None).cast("string").alias("reason"), F.array_join(F.col("fields")["height_cm"], ",").alias("height_cm"))
    return good.unionByName(found.dead.select("offset", "reason", F.lit(None).cast("string").alias("height_cm")))


@query("q_pipeline_evolve", """SELECT CAST(o_orderkey AS VARCHAR) AS id, 'pdouble' AS price_type, o_totalprice AS price,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority, NULL::VARCHAR AS reason
FROM orders WHERE o_orderkey % 2 = 0 OR o_orderpriority <> '1-URGENT'
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'pdouble', NULL, NULL, NULL, 'field price is no pdouble' FROM orders WHERE o_orderkey % 2 = 1 AND o_orderpriority = '1-URGENT'""")
def pipeline_evolve(spark, sf):
    """Records of a second schema add the field they bring; a field whose type they change keeps the first one, and
    records whose value does not fit it are rejected."""
    o = table(spark, sf, "orders")
    envelope = [F.lit("orders").alias("topic"), F.lit(0).alias("partition"), F.col("o_orderkey").alias("offset"),
                F.col("o_orderkey").cast("string").alias("key")]
    first = o.where("o_orderkey % 2 = 0").select(*envelope, F.struct(F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status")).alias("value"))
    text = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("on request")).otherwise(F.col("o_totalprice").cast("string"))
    second = o.where("o_orderkey % 2 = 1").select(*envelope, F.struct(text.alias("price"), F.col("o_orderpriority").alias("priority")).alias("value"))
    documents = DocumentTable(spark, scratch_folder(spark, "evolved"), order="offset")
    options = FoldOptions(schema_auto_evolve=True, behavior_on_malformed_documents="warn")
    for n, batch in enumerate((first, second)):
        apply_batch(batch, n, documents, options)
    kind = F.lit(declared_types(documents.catalog())["orders"]["price"]).alias("price_type")
    docs = documents.columns({"price": "double", "status": "string", "priority": "string"}, "orders")
    dead = documents.dead_letters().select(F.col("key").alias("id"), "reason")
    return docs.select("id", kind, "price", "status", "priority", F.lit(None).cast("string").alias("reason")).unionByName(
        dead.select("id", kind, F.lit(None).cast("double").alias("price"), F.lit(None).cast("string").alias("status"),
                    F.lit(None).cast("string").alias("priority"), "reason"))
