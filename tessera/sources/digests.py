"""Tables that can be compared without reading them whole.

A row's bucket and digest follow its content, so rows are dealt evenly whatever their keys, and equal rows
are counted before they are dealt, so a row that repeats is no hot bucket. Per bucket the number of rows and
the sums of their hashes are kept; two tables are compared by these first, and only rows of buckets that differ
are read (tables stored here) or dealt (any two tables). A changed row touches two buckets, an added one one.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.errors import OutputError
from tessera.sources import snapshots

BUCKETS = 256
#: Beyond so many differing buckets none is left out by name; the result is the same.
MOST_NAMED = 10_000
_INTERNAL = ("_bucket", "_times")
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def _row(df: DataFrame) -> Column:
    """SHA-256 of a row's content, the same for any order of columns."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns) if c not in _INTERNAL]), _JSON), 256)


def _part(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("_bucket", (F.conv(F.substring(_row(df), 57, 8), 16, 10).cast("long") % buckets).cast("int"))


def _sums(dealt: DataFrame, times: Column) -> DataFrame:
    """One row a bucket: rows, and four sums of parts of their digests."""
    digest = dealt.select("_bucket", _row(dealt).alias("_d"), times.cast("decimal(18,0)").alias("_t"))
    return digest.groupBy("_bucket").agg(F.sum("_t").cast("long").alias("n"), F.concat_ws(",", *[F.sum(_part(F.col("_d"), k) * F.col("_t")).cast("decimal(38,0)").cast("string") for k in range(4)]).alias("digest"))


def _differing(a: DataFrame, b: DataFrame) -> list[int]:
    """Buckets whose digests differ, or that one side lacks; at most their number."""
    both = a.select("_bucket", "n", "digest", F.lit(0).alias("side")).union(b.select("_bucket", "n", "digest", F.lit(1)))
    odd = both.groupBy("_bucket").agg(F.count(F.lit(1)).alias("k"), F.count_distinct("n", "digest").alias("versions")).filter("k < 2 OR versions > 1")
    return sorted(r[0] for r in odd.select("_bucket").collect())


def _only(dealt: DataFrame, odd: list[int]) -> DataFrame:
    return dealt.filter(F.col("_bucket").isin(odd)) if len(odd) <= MOST_NAMED else dealt


def _check(a: DataFrame, b: DataFrame) -> list[str]:
    kinds = lambda df: sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields if f.name not in _INTERNAL)
    if kinds(a) != kinds(b):
        raise OutputError(f"other columns: {kinds(a)}, {kinds(b)}")
    return [c for c in a.columns if c not in _INTERNAL]


def _compare(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with how often each side has them, where that differs; both have `_times`."""
    quoted = [F.col(f"`{c}`") for c in columns]
    both = a.select(*quoted, F.col("_times").alias("n_first"), F.lit(0).cast("long").alias("n_second")).union(b.select(*quoted, F.lit(0).cast("long"), "_times"))
    return both.groupBy(*quoted).agg(F.sum("n_first").alias("n_first"), F.sum("n_second").alias("n_second")).filter("n_first <> n_second")


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(f"{path}/rows")


def write(df: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """df as a table of distinct rows with their number, in a folder per bucket, and its digests beside it.

    Give about a bucket per file of the size you want: 256 of 256 MB are 64 GB, 100 TB take 400,000. Columns have
    to be ones that can be grouped, and none may be called `_bucket` or `_times`.
    """
    if clash := set(_INTERNAL) & set(df.columns):
        raise OutputError(f"columns {sorted(clash)} have names that the table needs")
    spark = df.sparkSession
    counted = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_times"))
    _bucketed(counted, buckets).repartition("_bucket").write.mode("errorifexists").partitionBy("_bucket").parquet(f"{path}/rows")
    _sums(_rows(spark, path, counted.schema), F.col("_times")).write.mode("errorifexists").parquet(f"{path}/digests")
    snapshots.write_json(spark, f"{path}/digest_layout.json", {"buckets": buckets, "schema": counted.schema.json()})


def _stored(spark: SparkSession, path: str) -> tuple[int, DataFrame, DataFrame]:
    layout = snapshots.read_json(spark, f"{path}/digest_layout.json")
    return layout["buckets"], _rows(spark, path, T.StructType.fromJson(json.loads(layout["schema"]))), spark.read.parquet(f"{path}/digests")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows as they were given, each as often as it was."""
    table = _stored(spark, path)[1]
    return table.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), "_times"))).drop("_again", *_INTERNAL)


def stored_differences(spark: SparkSession, first: str, second: str) -> DataFrame:
    """Rows that two stored tables have not equally often, with n_first and n_second; reads only buckets whose digests
    differ. Tables with other numbers of buckets are compared whole."""
    (n, a, da), (m, b, db) = _stored(spark, first), _stored(spark, second)
    columns = _check(a, b)
    if n == m:
        odd = _differing(da, db)
        a, b = (_only(x, odd) for x in (a, b))
    return _compare(a, b, columns)


def differences(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The same of any two tables: both are read twice at most, and only rows of buckets that differ are dealt."""
    columns = _check(a, b)
    x, y = _bucketed(a, buckets), _bucketed(b, buckets)
    odd = _differing(_sums(x, F.lit(1)), _sums(y, F.lit(1)))
    once = F.lit(1).cast("long")
    return _compare(*[_only(t, odd).withColumn("_times", once) for t in (x, y)], columns)
