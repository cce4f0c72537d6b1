"""Tables in hash buckets, without a metastore.

A bucketed table keeps its rows dealt by key: joins on the key read it as it lies, with no exchange, and a
filter on key values reads only the buckets these are in. Spark keeps the layout in its catalogue, which
may end with the session; so it is also written beside the files, and read() declares the table again.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.errors import MissingInputError
from tessera.sources import snapshots
from tessera.sources.tables import exists, filesystem

LAYOUT = "_layout.json"


def write(df: DataFrame, path: str, key: str, buckets: int | None = None) -> None:
    """df in files by bucket of `key`, each in order of it: one file a bucket."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tessera_{uuid.uuid4().hex}"
    df.repartition(n, key).write.mode("errorifexists").option("path", path).bucketBy(n, key).sortBy(key).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # its files stay; their folder may be moved yet
    snapshots.write_json(spark, f"{path}/{LAYOUT}", {"id": name, "key": key, "buckets": n, "columns": [[f.name, f.dataType.simpleString()] for f in df.schema.fields]})


def read(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, f"{path}/{LAYOUT}"):
        raise MissingInputError(path)
    x = snapshots.read_json(spark, f"{path}/{LAYOUT}")
    fs, p = filesystem(spark, path)
    where = fs.makeQualified(p).toString()
    name = f"{x['id']}_{hashlib.md5(where.encode()).hexdigest()}"
    columns, quoted = ", ".join(f"`{n}` {t}" for n, t in x["columns"]), where.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{x['key']}`) SORTED BY (`{x['key']}`) INTO {x['buckets']} BUCKETS LOCATION '{quoted}'")
    return spark.table(name)
