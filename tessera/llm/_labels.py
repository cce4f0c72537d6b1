"""Bounded samples of labelled documents for the classifiers.

A document belongs to the held-out fold when crc32 of its doc_id as text is divisible by 5; only
the other rows teach. Of these the `most` with the smallest hash of doc_id are taken, so the
sample is the same in every run and the driver's part has a fixed bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._tables import materialize

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def teaching_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """doc_id, text, label of at most `most` labelled documents outside the held-out fold."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # at most `most` short rows: safe to broadcast
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def within(sample: DataFrame, size: str, most: int, name: str) -> DataFrame:
    """Rows of a sample (doc_id and others), in the same order of hashes, as long as their sizes add up to
    at most `most`: what the driver gets is bounded whatever the documents look like."""
    kept = materialize(sample, name)
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id", size).rowsBetween(Window.unboundedPreceding, 0)
    sums = kept.select("doc_id", size).withColumn("upto", F.sum(size).over(order))  # a few thousand short rows
    if (sums.agg(F.max("upto")).first()[0] or 0) <= most:
        return kept
    chosen = sums.filter(F.col("upto") <= most).select("doc_id").distinct()
    return kept.join(F.broadcast(chosen), "doc_id", "left_semi")
