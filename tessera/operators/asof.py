"""As-of joins: with every row the values that held at its time.

No row meets a range of others: both sides are put together, ordered by time within their key, and a
running last value is taken. A key's rows are further dealt by periods of time, so that a hot key isn't
one task; what a period begins with comes from one row per key and period that says how the last one
ended, and only these are ordered over all of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, key: str, time: str, valid_from: str, columns: list[str], period: str = "month") -> DataFrame:
    """left with `columns` of the right row of its key that has the latest valid_from at or before its time; null
    where there is none, or no key or time. Of right rows with one key and valid_from the one with the greatest
    columns holds; each left row is returned once, repeated ones too. period: as in date_trunc."""
    rows = left.select(F.col(key).alias("_key"), F.col(time).cast("timestamp").alias("_at"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"))
    given = right.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    given = given.select(F.col(key).alias("_key"), F.col(valid_from).cast("timestamp").alias("_at"), F.lit(0).alias("_side"), F.struct(F.col(valid_from).cast("timestamp").alias("at"), *columns).alias("_value"))
    both = rows.unionByName(given, allowMissingColumns=True).withColumn("_period", F.date_trunc(period, "_at"))
    # rows without key or time find nothing; they are dealt by themselves
    spread = F.when(F.col("_key").isNull() | F.col("_at").isNull(), F.pmod(F.xxhash64("_row"), F.lit(4096))).otherwise(0)
    both = both.withColumn("_spread", spread)
    here = Window.partitionBy("_key", "_period", "_spread").orderBy("_at", "_side", "_value").rowsBetween(Window.unboundedPreceding, 0)
    within = both.withColumn("_held", F.last("_value", ignorenulls=True).over(here)).filter("_side = 1").drop("_value", "_side", "_at")
    ends = both.filter("_at IS NOT NULL AND _key IS NOT NULL").groupBy("_key", "_period").agg(F.max("_value").alias("_end"))
    before = F.last("_end", ignorenulls=True).over(Window.partitionBy("_key").orderBy("_period").rowsBetween(Window.unboundedPreceding, -1))
    begins = ends.select(F.col("_key").alias("_k"), F.col("_period").alias("_p"), before.alias("_begin")).filter("_begin IS NOT NULL")
    out = within.join(begins, (F.col("_key") == F.col("_k")) & (F.col("_period") == F.col("_p")), "left")
    value = F.when(F.col("_key").isNull() | F.col("_period").isNull(), F.lit(None)).otherwise(F.coalesce("_held", "_begin"))
    return out.select("_row", value.alias("_got")).select(*[F.col("_row")[c].alias(c) for c in left.columns], *[F.col("_got")[c].alias(c) for c in columns])


def history(*snapshots: tuple[DataFrame, Column]) -> DataFrame:
    """Snapshots under each other, each with the day from which it holds as `valid_from`."""
    out = None
    for df, day in snapshots:
        one = df.withColumn("valid_from", day.cast("date"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no snapshots")
    return out
