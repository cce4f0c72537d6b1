"""Rows dealt over all shuffle partitions, where their bytes say nothing of the work on them.

A file of short, alike rows is read in a task or two, and AQE merges partitions that compress well; regular
expressions on names, or a sort, then wait for a few tasks. A number of partitions that is given is left as it is.

Each task of a shuffle reads a piece of every task before it, so a chain of steps that are all dealt over all
partitions costs their square, whatever the rows. Whole tables are dealt so once; what steps make of them, thinly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: From so many partitions on, a file a partition and task is more than a sort by partition costs.
MANY = 100
#: Partitions of thinly dealt rows: so many a core at least, which evens tasks out, and one of so many of all.
PER_CORE = 4
SHARE = 4


def width(spark: SparkSession) -> int:
    """The partitions that rows are dealt over: the shuffle partitions, but from MANY on more than the number up to
    which each task of a shuffle opens a file per partition: 200 tasks open 40,000 by Spark's defaults."""
    asked, by_file = int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    return by_file + 1 if MANY <= asked <= by_file else asked


def dealt(df: DataFrame, *key: str) -> DataFrame:
    """df dealt by key over all partitions."""
    return df.repartition(width(df.sparkSession), *key)


def thinly(df: DataFrame, *key: str) -> DataFrame:
    """df dealt by key over as many partitions as keep all cores busy, or a share of all where that is more."""
    spark = df.sparkSession
    return df.repartition(min(width(spark), max(PER_CORE * spark.sparkContext.defaultParallelism, width(spark) // SHARE)), *key)


def spread(df: DataFrame) -> DataFrame:
    """df dealt thinly by all that a row holds: evenly, unless rows are equal."""
    return thinly(df, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
