"""The registered queries of the operators here, with their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.llm import (
    bitslice, decontam, folds, graphann, htmltext, langid, lines, minmax, mixture, phrases, pii, resample, toxicity, warc)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def add(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), s AS (
  SELECT source, size, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM (SELECT source, sum(size)::BIGINT AS size FROM d GROUP BY source)
), r AS (
  SELECT *, row_number() OVER o AS k,
         sum(size) OVER () - coalesce(sum(3 * size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
         sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight
  FROM s WINDOW o AS (ORDER BY 3 * size / w, source NULLS LAST)
), f AS (
  SELECT room::DOUBLE / weight AS unit, k AS first FROM r WHERE 3 * size >= room::DOUBLE / weight * w ORDER BY k LIMIT 1
), t AS (
  SELECT source, r.size AS source_size, CASE WHEN k < first THEN (3 * r.size)::DOUBLE ELSE unit * w END AS target FROM r, f
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN (target >= source_size)::INT + (target >= 2 * source_size)::INT + (target >= 3 * source_size)::INT ELSE 0 END AS copies
  FROM t
), o AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.copies, p.target - p.copies * p.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix-1:' || coalesce(d.doc_id::VARCHAR, '')), d.doc_id NULLS FIRST, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (copies + (rest > 0 AND ahead + size / 2.0 <= rest)::INT))::BIGINT AS taken
FROM o
"""


@query("op2_mixture", MIX_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of sources at weights 5, 2, 1 takes from every document."""
    return mixture.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first FROM p),
b AS (SELECT *, array_to_string(list_transform(string_split(hex, ''), lambda c: substr(
        '0000000100100011010001010110011110001001101010111100110111101111', 4 * (position(c IN '0123456789abcdef') - 1) + 1, 4)), '') AS bits FROM h)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + list_sum(list_transform(range(0, 5), lambda j: (substr(bits, (5 * i + j + 1)::INT, 1) = '1')::INT * [16, 8, 4, 2, 1][j + 1]))::INT, 1)), '') AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NULL OR page_id = first THEN NULL ELSE first END AS refers_to
FROM b
"""


@query("op10_warc", WARC_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.round_trip(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_minmax_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with at least 85 % of their five-word shingles in common."""
    return minmax.link(table(spark, sf_dir, "documents"))


@query("op4_line_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier one."""
    out = lines.dedup(table(spark, sf_dir, "documents"), min_words=1)
    return out.select("doc_id", "text", F.size("removed_lines").cast("long").alias("n_removed"),
                      F.array_join(F.col("removed_lines").cast("array<string>"), ",").alias("removed_lines"))


@query("op1_pii")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, and the terms that disclose it."""
    return pii.report(table(spark, sf_dir, "documents"))


LEAK_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
s AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t
      FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT *, least(len(w), 5) AS n FROM b WHERE len(w) > 0))),
g AS (SELECT DISTINCT doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS t
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM s))),
c AS (SELECT doc_id, item_id, count(*) AS n_found FROM g JOIN s USING (n, t) GROUP BY ALL),
m AS (SELECT item_id, count(*) AS n_item FROM s GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_found FROM c JOIN m USING (item_id) WHERE 100 * n_found >= 80 * n_item
"""


@query("op6_decontamination", LEAK_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item."""
    return decontam.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_text")


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    learned = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    rows = docs.withColumn("held_out", folds.held_out(F.col("doc_id")))
    return toxicity.score(rows, learned, keep=("doc_id", "held_out"))


@query("op7_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.learn(docs))


@query("op5_nearest")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return graphann.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


@query("op9_html_text")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return htmltext.extract(pages, htmltext.learn(pages))


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RESAMPLE_SQL = rf"""
WITH RECURSIVE bit(b, k, v) AS (
  SELECT b, 0, b::BIGINT FROM range(256) r(b)
  UNION ALL SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(3988292384, v // 2) ELSE v // 2 END FROM bit WHERE k < 8
), crc AS MATERIALIZED (SELECT list(v ORDER BY b) AS t FROM bit WHERE k = 8),
d AS MATERIALIZED (SELECT row_number() OVER () AS i, doc_id,
      coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS MATERIALIZED (SELECT unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
u AS MATERIALIZED (SELECT i, unnest(w) AS w FROM d),
x AS (SELECT w, hex(encode(w)) AS h, t FROM (SELECT w FROM u UNION SELECT w FROM b), crc),
g AS MATERIALIZED (SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2),
      lambda k: ('0x' || substr(h, (2 * k + 1)::INT, 2))::BIGINT)), lambda c, y: xor(c // 256, t[(xor(c, y) & 255) + 1]))) % 10000 AS bucket FROM x),
s AS (SELECT bucket, count(*) AS n FROM u JOIN g USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN g USING (w) GROUP BY bucket),
z AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
        / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
m AS (SELECT i, sum(gain)::BIGINT AS weight FROM u JOIN g USING (w) JOIN z USING (bucket) GROUP BY i),
o AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score
      FROM d LEFT JOIN m USING (i)),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS k,
        10 * count(*) FILTER (WHERE n_features >= 20) OVER () // 100 AS take FROM o)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND k <= take THEN k END AS rank FROM r
"""


@query("op11_resample", RESAMPLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the words of the benchmark texts."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


PHRASE_SQL = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("text")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS a FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k) GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS v FROM f WHERE k > 1 AND a >= 10),
e AS MATERIALIZED (SELECT *, array_to_string(v[1:j], ' ') AS front, array_to_string(v[j + 1:], ' ') AS back FROM c, (SELECT unnest([1, 2]) AS j) WHERE j < k),
cut AS (SELECT e.lang, e.k, e.phrase, e.a, j, l.a AS l, r.a AS r, (1000000::HUGEINT * e.a * e.a) // (l.a::HUGEINT * r.a) AS score
  FROM e JOIN f l ON l.lang = e.lang AND l.phrase = e.front JOIN f r ON r.lang = e.lang AND r.phrase = e.back),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner2 AS (SELECT lang, array_to_string(v[i:i + 1], ' ') AS phrase, max(a) AS most FROM c, (SELECT unnest([1, 2]) AS i) WHERE k = 3 GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inner2 USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * b.a)
SELECT lang, (row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)))::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""


@query("op12_phrases", PHRASE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest collocations of two and three words in every language."""
    out = phrases.collocations(table(spark, sf_dir, "documents"))
    return out.withColumn("rank", F.col("rank").cast("long"))


@query("op13_simhash")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose fingerprints differ in two bits at most."""
    return bitslice.link(table(spark, sf_dir, "documents"))
