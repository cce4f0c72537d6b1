"""Intermediate tables in the folder that driver and executors share, and this package's code on executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tessera.errors import SharedFolderError


_PACKAGE = Path(__file__).resolve().parent


def ship(spark: SparkSession) -> None:
    """Make this package importable on executors, where PYTHONPATH doesn't already."""
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
    """What spark.checkpoint.dir names. Where it is unset, a local folder serves as long as driver and
    executors are one process; executors elsewhere couldn't see it, so that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise SharedFolderError("spark.checkpoint.dir has to name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tessera-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written and read back: computed once, and lost executors cost nothing that was written."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/tessera/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete a stored() table that is needed no more."""
    if path := getattr(df, "_tessera_path", None):
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
