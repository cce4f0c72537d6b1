"""Session plumbing shared by the operators: code shipping, durable tables and input reading."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an Arrow batch on its way to or from a Python worker; Spark's own bound is in rows first.
BATCH_BYTES = 4 << 20
_PACKAGE = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes, as texts may be long, and make this package
    importable on executors (where PYTHONPATH doesn't already)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = str(_PACKAGE.parent)
    if root in [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]:
        return
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="tessera-"), "tessera_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, str(p.relative_to(_PACKAGE.parent)))
    sc.addPyFile(target)  # Spark's own file server hands it to the executors
    sc._tessera_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only where that is unset and driver and executors are one
    process (tests) a local one. Executors elsewhere couldn't see the driver's folder, so that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tessera-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tessera/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_texts(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The named columns and `body`: the whole text as UTF-8 bytes, null taken as empty."""
    return docs.select(*keep, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
