"""Applying changes, triage and progress on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from docfold.functions.encode import utf16_bytes
from docfold.operators import fold, progress, segment, triage
from docfold.operators.identity import document_id
from docfold.operators.variant import is_object, variant_fields
from docfold.options import FoldOptions
from docfold.plans import demo
from docfold.plans.ingest import convert
from docfold.plans.registry import query
from docfold.sources.changes import decode_json, unwrap_key
from docfold.sources.tables import table

# --- folds -------------------------------------------------------------------------------------


@query("q_apply_index", """SELECT CAST(o_custkey AS VARCHAR) AS id, o_orderkey AS orderkey, o_orderstatus AS status, o_totalprice AS price
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def apply_index(spark, sf):
    o = table(spark, sf, "orders")
    ops = o.select(F.lit("customers").alias("collection"), F.col("o_custkey").cast("string").alias("id"), F.lit("replace").alias("op"),
                   F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("orderkey"),
                   F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    docs = fold.apply_index(ops, order=F.struct("at", "orderkey"))
    return docs.select("id", "orderkey", "status", "price")


_LATEST = """SELECT CAST(user_id AS VARCHAR) AS id, event_id AS "offset", event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM {source}) WHERE rn = 1"""


@query("q_apply_delete", _LATEST.format(source="events") + " AND event_type <> 'error'")
def apply_delete(spark, sf):
    return fold.apply_index(demo.user_ops(spark, sf)).drop("collection")


@query("q_tombstone_ignore", _LATEST.format(source="events WHERE event_type <> 'error'"))
def tombstone_ignore(spark, sf):
    log = unwrap_key(triage.tombstones(demo.change_log(spark, sf).withColumn("k", F.col("user_id")), "ignore"))
    ops = log.select(F.lit("users").alias("collection"), F.col("key").alias("id"), F.lit("replace").alias("op"), "offset",
                     "event_type", F.col("amount").alias("value"))
    return fold.apply_index(ops).drop("collection")


@query("q_apply_order", """SELECT 'users-' || (event_id % 2) AS collection, CAST(user_id AS VARCHAR) AS id, max(event_id) AS "offset",
  arg_max(event_type, event_id) <> 'error' AS alive FROM events GROUP BY ALL""")
def apply_order(spark, sf):
    ops = demo.user_ops(spark, sf).withColumn("collection", F.concat(F.lit("users-"), F.pmod("offset", F.lit(2)).cast("string")))
    return fold.latest(ops).select("collection", "id", "offset", (F.col("op") != "delete").alias("alive"))


@query("q_redelivery", _LATEST.format(source="events") + " AND event_type <> 'error'")
def redelivery(spark, sf):
    ops = demo.user_ops(spark, sf)
    return fold.apply_index(ops.unionByName(demo.user_ops(spark, sf))).drop("collection")


@query("q_apply_upsert", """WITH base AS (SELECT user_id, max(event_id) FILTER (WHERE event_type = 'error') AS gone FROM events GROUP BY user_id),
live AS (SELECT e.* FROM events e JOIN base b USING (user_id) WHERE b.gone IS NULL OR e.event_id > b.gone),
sets AS (
  SELECT user_id, event_id, event_type AS field, CAST(value AS VARCHAR) AS v FROM live
  UNION ALL SELECT user_id, event_id, 'view', NULL FROM live WHERE event_type = 'purchase')
SELECT CAST(user_id AS VARCHAR) AS id, field, v AS vals FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, field ORDER BY event_id DESC) AS rn FROM sets) WHERE rn = 1 AND v IS NOT NULL""")
def apply_upsert(spark, sf):
    ops = demo.json_ops(spark, sf)
    ops = ops.withColumn("fields", variant_fields(decode_json(F.col("value")), partial=True)).drop("value")
    docs = fold.apply_fields(ops)
    return docs.select("id", F.explode("fields").alias("field", "v")).select("id", "field", F.array_join("v", ",").alias("vals"))


@query("q_apply_null_clears", """WITH base AS (SELECT user_id, max(event_id) FILTER (WHERE event_type = 'error') AS gone,
    max(event_id) FILTER (WHERE event_type <> 'error') AS written FROM events GROUP BY user_id),
live AS (SELECT e.* FROM events e JOIN base b USING (user_id) WHERE (b.gone IS NULL OR e.event_id > b.gone) AND event_type <> 'error'),
w AS (SELECT user_id,
  max(event_id) FILTER (WHERE event_type = 'click') AS c, max(event_id) FILTER (WHERE event_type IN ('view', 'purchase')) AS v,
  max(event_id) FILTER (WHERE event_type = 'purchase') AS p FROM live GROUP BY user_id)
SELECT CAST(w.user_id AS VARCHAR) AS id, ec.value AS click, CASE WHEN ev.event_type = 'view' THEN ev.value END AS view, ep.value AS purchase
FROM w LEFT JOIN events ec ON ec.event_id = w.c LEFT JOIN events ev ON ev.event_id = w.v LEFT JOIN events ep ON ep.event_id = w.p""")
def apply_null_clears(spark, sf):
    e = table(spark, sf, "events")
    kind = F.col("event_type")
    ops = e.select(F.col("user_id").cast("string").alias("id"), F.when(kind == "error", F.lit("delete")).otherwise(F.lit("update")).alias("op"),
                   F.col("event_id").alias("offset"), "event_type",
                   *[F.when(kind == f, F.col("value")).alias(f) for f in ("click", "view", "purchase")])
    carried = {"click": kind == "click", "view": kind.isin("view", "purchase"), "purchase": kind == "purchase"}
    return fold.apply_columns(ops, ["click", "view", "purchase"], carried=carried)


def _atomic(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    target = c.where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").cast("string").alias("id"), F.create_map(
            F.lit("name"), F.col("c_name"), F.lit("status"), F.lit("new")).alias("fields"))
    gone = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 450000)
    ops = o.select(F.col("o_custkey").cast("string").alias("id"), F.when(gone, F.lit("delete")).otherwise(F.lit("update")).alias("op"),
                   F.col("o_orderkey").alias("offset"), F.create_map(
                       F.lit("status"), F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")),
                       F.lit("priority"), F.col("o_orderpriority")).alias("fields"))
    return target, ops


_GONE = "o_orderpriority = '1-URGENT' AND o_totalprice > 450000"


@query("q_apply_atomic", f"""WITH last AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1),
gone AS (SELECT DISTINCT o_custkey FROM orders WHERE {_GONE})
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
  CASE WHEN o_orderkey IS NULL THEN 'new' WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS status, o_orderpriority AS priority
FROM customer LEFT JOIN last ON c_custkey = o_custkey
WHERE c_acctbal >= 0 AND c_custkey NOT IN (SELECT o_custkey FROM gone)""")
def apply_atomic(spark, sf):
    docs = fold.apply_atomic(*_atomic(spark, sf))
    return docs.select("id", *[F.try_element_at("fields", F.lit(f)).alias(f) for f in ("name", "status", "priority")])


@query("q_atomic_rejects", f"""WITH first_gone AS (SELECT o_custkey, min(o_orderkey) AS at FROM orders WHERE {_GONE} GROUP BY o_custkey)
SELECT CAST(o.o_custkey AS VARCHAR) AS id, o.o_orderkey AS "offset", 409 AS code FROM orders o
LEFT JOIN customer ON c_custkey = o.o_custkey AND c_acctbal >= 0 LEFT JOIN first_gone g ON g.o_custkey = o.o_custkey
WHERE NOT ({_GONE}) AND (c_custkey IS NULL OR o.o_orderkey > g.at)""")
def atomic_rejects(spark, sf):
    return fold.atomic_rejects(*_atomic(spark, sf)).select("id", "offset", "code")


def _versioned(spark, sf):
    ops = demo.user_ops(spark, sf)
    return ops.withColumn("arrival", demo.arrival(F.col("offset"))).withColumn("_offset_ver", F.floor(F.col("offset") / 3).cast("bigint"))


_VERSIONED = "SELECT *, (event_id & 1023) * 9007199254740992 + (event_id >> 10) AS arrival, event_id // 3 AS ver FROM events"
_GUARDED = f"""SELECT * FROM ({_VERSIONED}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ver DESC, arrival) = 1"""


@query("q_version_guard", f"""SELECT CAST(user_id AS VARCHAR) AS id, ver AS _offset_ver, event_type, value FROM ({_GUARDED})""")
def version_guard(spark, sf):
    state = fold.by_version(_versioned(spark, sf), "_offset_ver", "arrival")
    return state.select("id", "_offset_ver", "event_type", "value")


@query("q_version_guard_trace", f"""SELECT CAST(user_id AS VARCHAR) AS id, arrival, ver AS _offset_ver,
  coalesce(ver > max(ver) OVER (PARTITION BY user_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS applied
FROM ({_VERSIONED})""")
def version_guard_trace(spark, sf):
    trace = fold.version_guard_trace(_versioned(spark, sf), "_offset_ver", "arrival")
    return trace.select("id", "arrival", "_offset_ver", "applied")


@query("q_soft_delete", f"""SELECT CAST(user_id AS VARCHAR) AS id, ver AS _offset_ver,
  CASE WHEN event_type <> 'error' THEN event_type END AS event_type, CASE WHEN event_type <> 'error' THEN value END AS value,
  CASE WHEN event_type = 'error' THEN true END AS _deleted FROM ({_GUARDED})""")
def soft_delete(spark, sf):
    return fold.soft_deletes(_versioned(spark, sf), "_offset_ver", "arrival").select("id", "_offset_ver", "event_type", "value", "_deleted")


@query("q_live_view", f"""SELECT CAST(user_id AS VARCHAR) AS id, ver AS _offset_ver, event_type FROM ({_GUARDED}) WHERE event_type <> 'error'""")
def live_view(spark, sf):
    docs = fold.soft_deletes(_versioned(spark, sf), "_offset_ver", "arrival")
    return fold.live(docs).select("id", "_offset_ver", "event_type")


@query("q_optimistic_batch", """WITH last AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1),
ask AS (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 + o_orderkey % 3 ELSE -1 END AS asked FROM last)
SELECT CAST(o_custkey AS VARCHAR) AS id, asked AS version, CASE WHEN CASE WHEN asked = 1 THEN c_custkey IS NOT NULL WHEN asked < 0 THEN c_custkey IS NULL
  ELSE coalesce(2 + c_nationkey % 3 = asked, false) END THEN 'applied' ELSE 'conflict' END AS outcome
FROM ask LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal >= 0""")
def optimistic_batch(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    target = c.where(F.col("c_acctbal") >= 0).select(F.col("c_custkey").cast("string").alias("id"), (F.col("c_nationkey") % 3 + 2).alias("version"))
    asked = F.when(F.col("o_orderstatus") == "F", F.lit(1)).when(F.col("o_orderstatus") == "O", F.col("o_orderkey") % 3 + 2).otherwise(F.lit(-1))
    ops = fold.latest(o.select(F.col("o_custkey").cast("string").alias("id"), F.col("o_orderkey").alias("offset"),
                               asked.cast("bigint").alias("version")), keys=("id",))
    return fold.optimistic_batch(target, ops).select("id", "version", "outcome")


# --- op log ------------------------------------------------------------------------------------

def _lanes(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        F.concat(F.lit("users-"), F.pmod("user_id", F.lit(4)).cast("string")).alias("collection"), F.col("event_id").alias("offset"),
        F.when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("set")).alias("op"),
        F.when(F.col("event_type") != "error", F.lit(16) + utf16_bytes(F.col("props")) + utf16_bytes(F.col("event_type")))
        .otherwise(F.lit(0)).cast("bigint").alias("bytes"))


_LANES = """lanes AS (SELECT 'users-' || (user_id % 4) AS collection, event_id AS "offset",
  CASE WHEN event_type = 'error' THEN 'delete' ELSE 'set' END AS op,
  CASE WHEN event_type = 'error' THEN 0 ELSE 16 + 2 * length(props) + 2 * length(event_type) END AS bytes FROM events)"""


@query("q_runs", f"""WITH {_LANES},
m AS (SELECT *, CASE WHEN op = lag(op) OVER (PARTITION BY collection ORDER BY "offset") THEN 0 ELSE 1 END AS s FROM lanes),
r AS (SELECT *, sum(s) OVER (PARTITION BY collection ORDER BY "offset") - 1 AS run FROM m)
SELECT collection, CAST(run AS BIGINT) AS run, any_value(op) AS op, count(*) AS n, min("offset") AS first_offset, max("offset") AS last_offset
FROM r GROUP BY collection, run""")
def runs(spark, sf):
    return segment.runs(_lanes(spark, sf))


_BATCH_COLUMNS = """count(*) AS n, count(*) FILTER (WHERE op = 'delete') AS deletes, min("offset") AS first_offset,
  max("offset") AS last_offset, CAST(sum(bytes) AS BIGINT) AS bytes"""


def _batch_report(rows):
    return rows.groupBy("collection", "batch").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("op") == "delete").alias("deletes"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"), F.sum("bytes").alias("bytes"))


@query("q_batches_count", f"""WITH {_LANES},
b AS (SELECT *, (row_number() OVER (PARTITION BY collection ORDER BY "offset") - 1) // 500 AS batch FROM lanes)
SELECT collection, batch, {_BATCH_COLUMNS} FROM b GROUP BY collection, batch""")
def batches_count(spark, sf):
    return _batch_report(segment.batches_by_count(_lanes(spark, sf), 500))


@query("q_batches_bytes", f"""WITH RECURSIVE {_LANES},
p AS (SELECT *, row_number() OVER (PARTITION BY collection ORDER BY "offset") AS rn,
        sum(bytes) OVER (PARTITION BY collection ORDER BY "offset") AS upto FROM lanes),
cut(collection, batch, first_rn, last_rn, done) AS (
  SELECT collection, CAST(0 AS BIGINT), CAST(1 AS BIGINT), min(rn) FILTER (WHERE upto >= 20000), any_value(20000) FROM p GROUP BY collection
  UNION ALL
  SELECT c.collection, c.batch + 1, c.last_rn + 1, (SELECT min(rn) FROM p WHERE p.collection = c.collection AND p.rn > c.last_rn
      AND p.upto >= 20000 + (SELECT upto FROM p q WHERE q.collection = c.collection AND q.rn = c.last_rn)), c.done
  FROM cut c WHERE c.last_rn IS NOT NULL)
SELECT p.collection, cut.batch, {_BATCH_COLUMNS} FROM p JOIN cut ON p.collection = cut.collection AND p.rn >= cut.first_rn
  AND p.rn <= coalesce(cut.last_rn, p.rn) GROUP BY p.collection, cut.batch""")
def batches_bytes(spark, sf):
    return _batch_report(segment.batches_by_bytes(_lanes(spark, sf), 20_000))


@query("q_dry_run", f"""WITH {_LANES} SELECT collection, count(*) FILTER (WHERE op = 'set') AS would_write,
  count(*) FILTER (WHERE op = 'delete') AS would_delete, CAST(sum(bytes) AS BIGINT) AS bytes FROM lanes GROUP BY collection""")
def dry_run(spark, sf):
    from docfold.plans.ingest import dry_run_report

    return dry_run_report(_lanes(spark, sf))


# --- triage ------------------------------------------------------------------------------------

def _questionable(spark, sf):
    """Some records lose their key, some values are no documents."""
    log = unwrap_key(demo.change_log(spark, sf)).where(F.col("value").isNotNull())
    kind = F.col("event_type")
    return log.withColumn("key", F.when(kind != "view", F.col("key"))).withColumn(
        "value", F.when(kind == "click", F.get_json_object("value", "$.k")).otherwise(F.col("value")))


_REASON = "CASE event_type WHEN 'view' THEN 'missing id' WHEN 'click' THEN 'unsupported value type' END"


@query("q_malformed", f"""SELECT event_id AS "offset", {_REASON} AS reason FROM events WHERE event_type <> 'error'""")
def malformed(spark, sf):
    rows = _questionable(spark, sf)
    is_document = is_object(decode_json(F.col("value")))
    return rows.select("offset", triage.malformed_reason(document_id(rows.schema, FoldOptions()), is_document).alias("reason"))


@query("q_dead_letter", f"""SELECT 'events-' || event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
  CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END AS key,
  CASE WHEN event_type = 'click' THEN props->>'$.k' ELSE props END AS value, {_REASON} AS reason
FROM events WHERE event_type IN ('view', 'click')""")
def dead_letter(spark, sf):
    rows = _questionable(spark, sf)
    is_document = is_object(decode_json(F.col("value")))
    marked = rows.withColumn("reason", triage.malformed_reason(document_id(rows.schema, FoldOptions()), is_document))
    _, dead = triage.split_malformed(marked, "warn")
    return dead.select("topic", "partition", "offset", "key", "value", "reason")


@query("q_response_triage", """WITH r AS (SELECT event_id, [400, 401, 404, 409, 413, 429, 500, 503][1 + user_id % 8] AS code,
  event_type <> 'view' AS remote, event_type = 'view' AND value > 50 AS missing, event_type = 'view' AND value < 5 AS transport FROM events)
SELECT event_id, CASE
  WHEN code IN (400, 409, 413) AND (remote OR NOT (missing OR transport)) THEN 'rejected'
  WHEN code = 429 OR code >= 500 OR transport THEN 'retriable' ELSE 'fatal' END AS class FROM r""")
def response_triage(spark, sf):
    e = table(spark, sf, "events")
    codes = F.array(*[F.lit(c) for c in (400, 401, 404, 409, 413, 429, 500, 503)])
    code = F.get(codes, F.pmod("user_id", F.lit(8)).cast("int"))
    view = F.col("event_type") == "view"
    return e.select("event_id", triage.response_class(
        code, ~view, view & (F.col("value") > 50), view & (F.col("value") < 5)).alias("class"))


@query("q_poison_isolation", """SELECT CAST(user_id AS VARCHAR) AS id, max(event_id) AS "offset", arg_max(user_id, event_id) AS height_cm
FROM events WHERE event_type <> 'signup' GROUP BY user_id""")
def poison_isolation(spark, sf):
    e = table(spark, sf, "events")
    ops = e.select(F.col("user_id").cast("string").alias("id"), F.lit("replace").alias("op"), F.col("event_id").alias("offset"),
                   F.when(F.col("event_type") == "signup", F.lit("tall")).otherwise(F.col("user_id").cast("string")).alias("height_cm"))
    good, _ = triage.conform(ops, {"height_cm": "bigint"})
    return fold.apply_index(good, keys=("id",))


# --- progress ----------------------------------------------------------------------------------

@query("q_safe_offsets", """WITH t AS (SELECT 'events-' || event_type AS topic, CAST(user_id % 4 AS INTEGER) AS part, event_id,
  value > 1 AS acked, event_type FROM events)
SELECT topic, part AS "partition", CASE WHEN event_type = 'view' THEN max(event_id) + 1
  ELSE coalesce(min(event_id) FILTER (WHERE NOT acked), max(event_id) + 1) END AS safe_offset FROM t GROUP BY topic, part, event_type""")
def safe_offsets(spark, sf):
    log = demo.change_log(spark, sf)
    current = log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("offset"))
    acks = log.where(F.col("event_type") != "view").select("topic", "partition", "offset", (F.col("amount") > 1).alias("acked"))
    return progress.safe_offsets(acks, current)


def _parts(spark, sf):
    log = demo.change_log(spark, sf)
    kind = F.col("event_type")
    return log.select("topic", "partition", F.when(kind != "error", 1).otherwise(0).alias("written"), F.when(kind == "error", 1).otherwise(0).alias("failed"),
                      (F.col("amount") > 100).cast("int").alias("retries"), F.lit(0).alias("queue"), F.col("amount"))


@query("q_counters", """SELECT 'events-' || event_type AS topic, count(*) FILTER (WHERE event_type <> 'error') AS written,
  count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE value > 100) AS retries, CAST(0 AS BIGINT) AS queue
FROM events GROUP BY event_type""")
def counters(spark, sf):
    return progress.counters(_parts(spark, sf), ["topic"])


@query("q_weighted_latency", """WITH p AS (SELECT event_type, user_id, avg(value) AS mean, count(*) FILTER (WHERE value > 10) AS calls FROM events GROUP BY ALL)
SELECT event_type, round(sum(mean * calls) FILTER (WHERE calls > 0) / sum(calls), 6) AS mean_ms, CAST(sum(calls) AS BIGINT) AS calls FROM p GROUP BY event_type""")
def weighted_latency(spark, sf):
    e = table(spark, sf, "events")
    parts = e.groupBy("event_type", "user_id").agg(F.avg("value").alias("mean"), F.count_if(F.col("value") > 10).alias("calls"))
    out = progress.weighted_latency(parts, "mean", "calls", ["event_type"])
    return out.withColumn("mean_ms", F.round("mean_ms", 6))


@query("q_stalled", """WITH a AS (SELECT user_id, event_type <> 'error' AS ok, epoch_us(ts) // 1000 AS t FROM events),
l AS (SELECT user_id, max(t) FILTER (WHERE ok) AS last_success FROM a GROUP BY user_id),
f AS (SELECT a.user_id, min(t) AS failing_since FROM a JOIN l USING (user_id) WHERE NOT ok AND (last_success IS NULL OR t >= last_success) GROUP BY 1)
SELECT user_id, coalesce(last_success, 0) AS last_success, failing_since, coalesce(1706659200000 - failing_since > 86400000, false) AS stalled
FROM l LEFT JOIN f USING (user_id)""")
def stalled(spark, sf):
    e = table(spark, sf, "events")
    # 2024-01-31 00:00 UTC; the tables end the day before.
    at = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    attempts = e.select("user_id", at.alias("at"), (F.col("event_type") != "error").alias("ok"))
    return progress.stalled(attempts, 1706659200000, 86_400_000, ["user_id"])


@query("q_latency_stats", """SELECT event_type, round(avg(value), 6) AS mean, quantile_disc(value, 0.95) AS p95,
  quantile_disc(value, 0.99) AS p99, count(*) AS samples FROM events GROUP BY event_type""")
def latency_stats(spark, sf):
    out = progress.latency_stats(table(spark, sf, "events"), "value", ["event_type"])
    return out.withColumn("mean", F.round("mean", 6))


# --- the pipeline's own order and stamps ------------------------------------------------------------

_ONE = {"collection": "users", "collection_naming_strategy": "STATIC", "offset_version_field": "ver", "behavior_on_null_values": "delete"}


@query("q_multi_topic_order", """SELECT CAST(user_id AS VARCHAR) AS id, event_id AS ver, event_type = 'error' AS deleted FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, 'events-' || event_type DESC, event_id DESC) = 1""")
def multi_topic_order(spark, sf):
    """Several topics feed one collection: the last record by (timestamp, topic, partition, offset) stands."""
    ops = convert(unwrap_key(demo.change_log(spark, sf)), FoldOptions(**_ONE)).ops
    ops = ops.withColumn("at", F.struct("timestamp", "topic", "partition", "offset"))
    docs = fold.apply_fields(ops, order="at")
    return fold.typed(docs, {"ver": "bigint", "_deleted": "boolean"}).select("id", "ver", F.coalesce("_deleted", F.lit(False)).alias("deleted"))


@query("q_stamp_collision", "SELECT event_id, event_id AS ver, event_id % 7 AS n FROM events")
def stamp_collision(spark, sf):
    """Records that carry the names of stamps: the stamp wins, and the batch goes on."""
    text = F.format_string('{"ver": 1, "_deleted": true, "n": %d}', F.col("offset") % 7)
    log = unwrap_key(demo.change_log(spark, sf)).withColumn("value", text)
    ops = convert(log, FoldOptions(**_ONE)).ops
    return fold.typed(ops.withColumn("id", F.col("offset").cast("string")), {"ver": "bigint", "n": "bigint"}).select(
        F.col("id").cast("bigint").alias("event_id"), "ver", "n")
