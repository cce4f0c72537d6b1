"""Statistics of snapshots that merge: each snapshot is read once, when it comes.

A summary is two small tables. `totals`: one row of sums, and sketches of the distinct names and organisations, for
a fast estimate. `values`: per column each distinct value with its number of rows and where it first stood. Both
merge by adding up, so statistics and most frequent values of any set of snapshots come from their summaries,
exactly: a value's rows are all counted, wherever it is frequent. Values are counted per task before they are dealt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.errors import MissingInputError
from tessera.functions import names
from tessera.operators import register

#: Sketches of 2^12 slots: a standard error of 1.6 %.
SLOTS = 12
SUMS = ("total_rows", "skilled_rows", "a_rated_rows", "filtered_rows")
#: Columns whose eligible rows' values are counted; `organisation` is the normalised name.
COUNTED = ("name", "organisation", "town", "county")


def totals(rows: DataFrame, normalise: Callable[[Column], Column] = names.normalise) -> DataFrame:
    """One row: the register's sums, and the sketches."""
    skilled, rated = register.is_skilled_worker(F.col("route")), register.is_a_rated(F.col("rating"))
    sketch = lambda c: F.hll_sketch_agg(F.when(skilled & rated, F.concat(F.lit("="), c)), SLOTS)  # noqa: E731  # sketches leave out empty texts
    return rows.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(skilled).alias("skilled_rows"), F.count_if(rated).alias("a_rated_rows"), F.count_if(skilled & rated).alias("filtered_rows"), sketch(F.col("name")).alias("names"), sketch(normalise(F.col("name"))).alias("organisations"))


def values(rows: DataFrame, normalise: Callable[[Column], Column] = names.normalise) -> DataFrame:
    """column, value, n_rows, first_pos of the eligible rows; null values are values."""
    keyed = register.eligible(rows).withColumn("organisation", normalise(F.col("name")))
    long_ = keyed.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in COUNTED])), "pos")
    return long_.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"), F.min("pos").alias("first_pos"))


def write(rows: DataFrame, path: str, nth: int, normalise: Callable[[Column], Column] = names.normalise) -> None:
    """The summary of snapshot `nth` (which orders first positions over snapshots); one folder each. Values are
    written first and totals last, so a summary that was cut off has no totals and is not read."""
    values(rows, normalise).withColumn("nth", F.lit(nth)).write.mode("overwrite").parquet(f"{path}/values")
    totals(rows, normalise).withColumn("nth", F.lit(nth)).write.mode("overwrite").parquet(f"{path}/totals")


def _all(spark: SparkSession, paths: Iterable[str], part: str) -> DataFrame:
    found = [spark.read.parquet(f"{p}/{part}") for p in paths]
    if not found:
        raise MissingInputError("no summaries")
    return reduce(DataFrame.unionByName, found)


def merged_values(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Values of all rows together; `first` is the snapshot and position where one first stood."""
    return _all(spark, paths, "values").groupBy("column", "value").agg(F.sum("n_rows").alias("n_rows"), F.min(F.struct("nth", "first_pos")).alias("first"))


def stats(spark: SparkSession, paths: list[str]) -> DataFrame:
    """What register.stats() says of all snapshots' rows together; exact."""
    sums = _all(spark, paths, "totals").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS])
    there = merged_values(spark, paths).filter(F.col("value").isNotNull())
    distinct = there.agg(F.count_if(F.col("column") == "name").alias("unique_names"), F.count_if(F.col("column") == "organisation").alias("organisations"))
    out = sums.crossJoin(distinct)  # one row each
    return out.withColumn("merged", F.col("unique_names") - F.col("organisations"))


def estimates(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row: sums, and the distinct names and organisations as the merged sketches estimate them; reads totals only."""
    count = lambda c: F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c)
    return _all(spark, paths, "totals").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS], count("names"), count("organisations"))


def top_values(spark: SparkSession, paths: list[str], column: str, n: int = 10) -> DataFrame:
    """The n most frequent values of a counted column over all snapshots; ties in order of first appearance."""
    found = merged_values(spark, paths).filter(F.col("column") == column)
    return found.orderBy(F.desc("n_rows"), "first").limit(n).select(F.col("value").alias(column), "n_rows", F.col("first.nth").alias("first_snapshot"), F.col("first.first_pos").alias("first_pos"))
