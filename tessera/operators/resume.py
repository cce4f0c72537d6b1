"""Resumable runs: what is left to do, in batches, and merging what several runs wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.errors import BatchSettingsError
from tessera.functions import values
from tessera.stored import stored


def processed(*outputs: DataFrame, key: str = "org_name") -> DataFrame:
    """The distinct keys of all outputs and checkpoints."""
    out = outputs[0].select(key)
    for more in outputs[1:]:
        out = out.union(more.select(key))
    return out.distinct()


def pending(rows: DataFrame, done: DataFrame, key: str = "org_name") -> DataFrame:
    return rows.join(done.select(key).distinct(), key, "left_anti")


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with `place` from 0 in the given order, without a global sort in one task: rows are
    range-partitioned, written, counted per partition, and numbered inside theirs."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(rows.repartitionByRange(width, *order).withColumn("_part", F.spark_partition_id()), "numbered")
    counts = dealt.groupBy("_part").count()  # one row per partition
    before = counts.select(F.col("_part").alias("_p"), F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return dealt.withColumn("_in", inside).join(before, F.col("_part") == F.col("_p")).withColumn("place", F.col("_before") + F.col("_in")).drop("_part", "_p", "_before", "_in")


def batches(rows: DataFrame, order: list[str], size: int, start: int = 1, count: int | None = None) -> DataFrame:
    """rows with `batch` from 1 in order; only batches from `start`, `count` of them."""
    if size < 1 or start < 1 or (count is not None and count < 1):
        raise BatchSettingsError(f"size {size}, start {start}, count {count}")
    out = numbered(rows, order).withColumn("batch", (F.floor(F.col("place") / size) + 1).cast("long")).filter(F.col("batch") >= start)
    return out if count is None else out.filter(F.col("batch") < start + count)


def keep_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key; a row limit per key is pushed below the shuffle."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


def latest(rows: DataFrame, key: str, *by: str) -> DataFrame:
    """Per key the row with the greatest `by`, by one aggregation."""
    rest = [c for c in rows.columns if c != key and c not in by]
    return rows.groupBy(key).agg(F.max(F.struct(*by, *rest)).alias("_top")).select(key, *[F.col(f"_top.{c}").alias(c) for c in (*by, *rest)])


def counters(rows: DataFrame, done: DataFrame, size: int, key: str = "org_name") -> DataFrame:
    """One row: total, processed, unprocessed, batches, remaining."""
    total = rows.agg(F.count(F.lit(1)).alias("total_rows"))
    kept = rows.select(key).join(done.select(key).distinct(), key, "left_semi").agg(F.count_distinct(key).alias("processed"))
    left = pending(rows, done, key).agg(F.count(F.lit(1)).alias("unprocessed"))
    out = total.crossJoin(kept).crossJoin(left)  # one row each
    return out.withColumns({"batches": F.ceil(F.col("unprocessed") / size).cast("long"), "remaining": F.greatest(F.lit(0), F.col("total_rows") - F.col("processed")).cast("long")})


def coerce(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The columns in a fixed order; missing ones are ''."""
    return rows.select(*[values.text(F.col(f"`{c}`")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in columns])
