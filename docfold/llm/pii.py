r"""Personal data, and the terms that give it away.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers, found by pattern and check. They are the
protected entities: an entity is one value of one kind (digits only for cards and phones, lower case for e-mails).

Terms are words of letters and digits within `REACH` characters of an entity in the same document. Over all documents

    n(e), n(t)   documents with entity e, with term t        n(e, t)   documents with t near e
    PMI(e, t) = log2(N n(e, t) / (n(e) n(t)))                IC(e)     = log2(N / n(e))

PMI / IC is the share of e's information that t discloses: 1 when t occurs only near e. A pair counts with two different
surroundings at least, so the copies of one passage are not evidence. At a share of `GENERALISE` the term is generalised
wherever it stands near e (a word becomes its shape: WORD, NAME, NUMBER), at `REMOVE` it is removed.

Spans are positions in code points, end exclusive. Only DataFrame functions are used: positions come from the lengths of
the pieces between matches. Patterns are possessive and start where a run starts, so long runs take linear time.
A null text is empty. Rows that repeat doc_id and text get the same result; a null doc_id is kept. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.llm import shared

KINDS = ("email", "ip", "card", "phone")
REACH = 60
GENERALISE, REMOVE = 0.7, 0.9
BLOCK = 256  # matches whose positions are summed in one go

#: Patterns with the same leftmost matches as the plain ones, without their backtracking. Those of cards and phones match
#: whole runs of the right number of digits only: a plain match always ends where its run does.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9](?:[\x20().-]*+[0-9]){9,14}+(?![\x20().-]*+[0-9])",
}
#: What a text must hold before a pattern is tried.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TERM = r"[\p{L}\p{N}]+"
SPAN = "array<struct<start:bigint,k:int,end:bigint,value:string>>"


def luhn(digits: Column) -> Column:
    """Digits (at most 19) pass the Luhn check."""
    total = F.lit(0)
    padded = F.lpad(digits, 20, "0")
    for i in range(20):
        d = F.substring(padded, i + 1, 1).cast("int")
        doubled = d * 2
        total = total + (F.when(doubled > 9, doubled - 9).otherwise(doubled) if i % 2 == 0 else d)
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|(?=\.|$))(?:\.|$)){4}$")
    if kind in ("card", "phone"):
        digits = F.regexp_replace(value, "[^0-9]", "")
        n = F.length(digits)
        return n.between(14, 19) & luhn(digits) if kind == "card" else n.between(10, 15)
    return F.lit(True)


def entity(kind: str, value: Column) -> Column:
    """The value that all ways of writing it share."""
    plain = F.lower(value) if kind == "email" else F.regexp_replace(value, "[^0-9.]" if kind == "ip" else "[^0-9]", "")
    return F.concat(F.lit(kind + ":"), plain)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<at, value>> of all matches of `pattern`, at = code points before the match.

    Positions are summed in blocks, so that no long array is copied for each of its items.
    """
    zero = F.struct(F.lit(0).cast("long").alias("p"), F.array().cast("array<struct<at:bigint,value:string>>").alias("out"))
    none = F.struct(F.lit(0).cast("long").alias("p"), F.array().cast("array<struct<p:bigint,out:array<struct<at:bigint,value:string>>>>").alias("out"))

    def within(acc, x):
        at = acc["p"] + F.length(x["b"])
        return F.struct((at + F.length(x["m"])).alias("p"), F.array_append(acc["out"], F.struct(at.alias("at"), x["m"].alias("value"))).alias("out"))

    def across(acc, block):
        return F.struct((acc["p"] + block["p"]).alias("p"), F.array_append(acc["out"], F.struct(acc["p"].alias("p"), block["out"].alias("out"))).alias("out"))

    def placed(steps):
        firsts = F.sequence(F.lit(1), F.size(steps), F.lit(BLOCK))
        blocks = F.transform(firsts, lambda i: F.aggregate(F.slice(steps, i, BLOCK), zero, within))
        return F.flatten(F.transform(F.aggregate(blocks, none, across)["out"], lambda block: F.transform(
            block["out"], lambda x: F.struct((x["at"] + block["p"]).alias("at"), x["value"].alias("value")))))

    # between has one piece more than found; zipped, the last one has no match
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.filter(F.arrays_zip(F.split(text, pattern, -1).alias("b"), found.alias("m")), lambda x: x["m"].isNotNull())
    out = F.get(F.transform(F.array(steps), placed), F.lit(0))  # one evaluation of `steps`
    return F.when(text.rlike(pattern), out).otherwise(F.array().cast("array<struct<at:bigint,value:string>>"))


def spans_of(text: Column, kind: str) -> Column:
    """Valid base spans of one kind: array<struct<start, k, end, value>>, value being the entity."""
    found = F.filter(matches(text, PATTERNS[kind]), lambda x: valid(kind, x["value"]))
    made = F.transform(found, lambda x: F.struct(x["at"].alias("start"), F.lit(KINDS.index(kind)).alias("k"),
                                                 (x["at"] + F.length(x["value"])).alias("end"), entity(kind, x["value"]).alias("value")))
    need = NEEDS[kind]
    guard = F.contains(text, F.lit(need)) if need else F.lit(True)
    return F.when(guard, made).otherwise(F.array()).cast(SPAN)


def base(docs: DataFrame) -> DataFrame:
    """doc_id, text, key (hash of the text), one array of spans per kind, and `spans`: all by start, then kind."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    rows = rows.withColumns({kind: spans_of(F.col("text"), kind) for kind in KINDS})
    return rows.withColumn("spans", F.array_sort(F.concat(*KINDS)))


def windows(text: Column, spans: Column) -> Column:
    """For each span the text up to REACH characters before and after it, as far as its neighbours."""

    def window(s, i):
        before = F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(0)
        after = F.coalesce(F.get(spans, i + 1)["start"], s["end"] + REACH)
        begin = F.least(F.greatest(s["start"] - REACH, before, F.lit(0)), s["start"])
        width = F.greatest(F.least(F.lit(REACH).cast("long"), after - s["end"]), F.lit(0))
        return F.struct(s["value"].alias("e"), begin.alias("begin"), F.substring(text, (begin + 1).cast("int"), (s["start"] - begin).cast("int")).alias("left"),
                        s["end"].alias("stop"), width.alias("width"), F.substring(text, (s["end"] + 1).cast("int"), width.cast("int")).alias("right"))

    return F.transform(spans, window)


def _terms(piece: Column, at: Column, cut_left: Column, cut_right: Column) -> Column:
    """Terms of a piece of text with their positions; a term that the piece's edge may cut is left out."""
    found = F.transform(matches(piece, TERM), lambda x: F.struct(F.lower(x["value"]).alias("t"), (at + x["at"]).alias("start"),
                                                                 (at + x["at"] + F.length(x["value"])).alias("end")))
    end = at + F.length(piece)
    return F.filter(found, lambda x: ~(cut_left & (x["start"] == at)) & ~(cut_right & (x["end"] == end)))


def surroundings(rows: DataFrame) -> DataFrame:
    """One row per entity occurrence and nearby term: doc_id, key, e, context (hash of all its terms), t, start, end."""
    one = rows.select("doc_id", "key", F.explode("windows").alias("w")).select("doc_id", "key", "w.*")
    near = F.concat(_terms(F.col("left"), F.col("begin"), F.col("begin") > 0, F.lit(False)),
                    _terms(F.col("right"), F.col("stop"), F.lit(False), F.length("right") == F.col("width")))
    one = one.select("doc_id", "key", "e", near.alias("near"))
    one = one.withColumn("context", F.xxhash64(F.array_sort(F.transform("near", lambda x: x["t"]))))
    return one.select("doc_id", "key", "e", "context", F.explode("near").alias("n")).select("doc_id", "key", "e", "context", "n.t", "n.start", "n.end")


def disclosing(docs: DataFrame, near: DataFrame, rows: DataFrame) -> DataFrame:
    """e, t, share: the pairs whose disclosed share reaches GENERALISE. Counts are over all documents."""
    per_doc = near.groupBy("doc_id", "key", "e", "t").agg(F.min("context").alias("lo"), F.max("context").alias("hi"))
    pairs = (per_doc.groupBy("e", "t").agg(F.count("*").alias("n_et"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
             .where("lo < hi AND n_et > 1"))
    n_e = rows.select(F.explode(F.array_distinct(F.transform("spans", lambda s: s["value"]))).alias("e")).groupBy("e").agg(F.count("*").alias("n_e"))
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("t"))
    n_t = words.groupBy("t").agg(F.count("*").alias("n_t"))
    joined = pairs.join(n_e, "e").join(n_t, "t").withColumn("n", F.lit(rows.count()))
    pmi = F.log2(F.col("n") * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    share = F.when(F.col("n") > F.col("n_e"), pmi / F.log2(F.col("n") / F.col("n_e"))).otherwise(0.0)
    return joined.select("e", "t", share.alias("share")).where(F.col("share") >= GENERALISE)


def term_spans(near: DataFrame, pairs: DataFrame) -> DataFrame:
    """doc_id, key, terms: array<struct<start, end, share>> of the terms that disclose an entity near them."""
    hits = near.join(pairs, ["e", "t"]).groupBy("doc_id", "key", "start", "end").agg(F.max("share").alias("share"))
    return hits.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "share"))).alias("terms"))


def analyse(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of the text), base spans by kind and together, and `terms`, for every row of `docs`."""
    rows = base(docs).withColumn("windows", windows(F.col("text"), F.col("spans"))).drop("text")
    rows = shared.written(rows, "spans")
    near = surroundings(rows)
    terms = term_spans(near, disclosing(docs, near, rows)).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "terms")
    rows = rows.drop("windows")
    out = rows.join(terms, rows["doc_id"].eqNullSafe(terms["_id"]) & (rows["key"] == terms["_key"]), "left").drop("_id", "_key")
    return out.withColumn("terms", F.coalesce("terms", F.array().cast("array<struct<start:bigint,end:bigint,share:double>>")))


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in (*KINDS, "term")))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["k"]], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts by kind, digest of the base spans, all spans, and how many terms were found."""
    found = analyse(docs)
    bare = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end")))
    extra = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("k"), s["end"].alias("end")))
    return found.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(_listed(F.col("spans")), 256).alias("base_sha256"),
                        _listed(F.array_sort(F.concat(bare, extra))).alias("spans"), F.size("terms").cast("long").alias("n_terms"))


def sanitise(docs: DataFrame) -> DataFrame:
    """doc_id and text with base spans replaced by [KIND], and disclosing terms generalised to a shape or removed.

    Where base spans overlap, the earlier one is replaced as far as the other's start.
    """
    texts = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("_key", F.xxhash64("text"))
    found = analyse(docs).dropDuplicates(["doc_id", "key"])
    found = texts.join(found, texts["_id"].eqNullSafe(found["doc_id"]) & (texts["_key"] == found["key"]))
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    marks = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), names[s["k"]].alias("by")))

    def shape(s):
        term = F.substring(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        kind = F.when(term.rlike(r"^\p{N}+$"), "[NUMBER]").when(term.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["share"] >= REMOVE, "").otherwise(kind).alias("by"))

    edits = F.array_sort(F.concat(marks, F.transform("terms", shape)))
    zero = F.struct(F.lit(0).cast("long").alias("p"), F.lit("").alias("out"))

    def cut(a, b):
        return F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int"))

    done = F.aggregate(edits, zero, lambda acc, s: F.struct(
        F.greatest(acc["p"], s["end"]).alias("p"),
        F.concat(acc["out"], F.when(s["start"] > acc["p"], cut(acc["p"], s["start"])).otherwise(""), s["by"]).alias("out")))
    return found.select("doc_id", "text", done.alias("done")).select(
        "doc_id", F.concat("done.out", F.expr("substring(text, CAST(done.p AS INT) + 1)")).alias("text"))
