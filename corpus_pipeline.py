"""The corpus pipeline: quality, line dedup, near duplicates, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; run()
writes each result as Parquet and reads it again as the next stage's docs. All stages but the last
return the columns of `documents`, whatever other columns the table has.

Defined results, stage by stage: null and empty texts are scored as one empty line, never start a
match, are near nothing, have no tokens to budget and are packed as their closing id; texts of any
length are taken whole; rows that repeat a document are scored alike, count once in line dedup,
are near each other under one doc_id and so stay together, are mixed as one and packed each; of
equal texts the least doc_id stays in the third stage, and rows without doc_id do; an empty table
passes through all stages.

SQL can't express the classifier, the mix or the packing, so there is no ORACLE_SQL; tests/llm/test_pipeline.py holds
every stage against brute force on its own input (the classifier's scores for the weights it learnt).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import jaccard, lines, mixing, packing, quality
from tessera.llm._tables import materialize, read

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores below quality.KEEP_FROM go."""
    field = quality.teach(docs, read(spark, sf_dir, "labels"))
    return quality.score_quality(docs.select(*COLUMNS), field).filter(F.col("score") >= quality.KEEP_FROM).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go; a document that loses all its text with them goes too."""
    out = lines.line_dedup(docs.select(*COLUMNS))
    out = out.filter((F.col("lines_removed") == 0) | (F.trim("text") != ""))
    return out.withColumn("n_chars", F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates (five words, 0.8) the least doc_id stays."""
    found = jaccard.jaccard_components(docs.select("doc_id", "text"))
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of domains, languages and sources by mixing.WEIGHTS, each document once at most."""
    return mixing.mix_sources(docs.select(*COLUMNS), mixing.source_path(), weights=mixing.WEIGHTS, share=mixing.SHARE, epochs=1).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most packing.CAPACITY tokens and their places in sequences."""
    return packing.pack_documents(docs.select("doc_id", "text"), packing.default_tokenizer())


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("source_mixing", mix),
    ("best_fit_packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
