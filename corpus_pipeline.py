"""From raw documents to a training mix: the stages, each written as Parquet and reread as the next one's input.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of documents;
the last one adds what the mix takes. Nulls, empty texts and repeated rows are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.llm import decontam, lines, minmax, mixture, shared, toxicity
from docfold.llm.catalog import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts toxic go."""
    learned = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, learned, keep=COLUMNS).where("predicted = 0").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, and n_chars follows; so do documents of which no word is left."""
    out = lines.dedup(docs.select(*COLUMNS), min_words=1)
    emptied = (F.size("removed_lines") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    length = F.when(F.size("removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", length).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays; documents without words stay.

    Near-duplicates have at least 80 % of their five-word shingles in common.
    """
    linked = minmax.link(docs, percent=80).where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    rows = docs.select(*COLUMNS)
    return rows.join(linked, "doc_id", "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often; those that it takes no word of are left out."""
    mixed = mixture.mix_sources(docs.select(*COLUMNS)).where("taken > 0")
    return mixed.select(*COLUMNS, "size", "source_size", "target", "copies", "taken")


STAGES = [("toxicity", toxic), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("mix", mix)]

#: Toxicity scores come from a trained model, which SQL cannot express; tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
