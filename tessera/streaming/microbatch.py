"""Matching register files as they arrive.

A file source feeds micro-batches to the same plan as a batch run. Spark's checkpoint says which
files are done, and organisations that another run has matched are left out. Each batch is a run of the
ledger under the query's id and its own number: one that is repeated after a failure, wherever that came,
is left out if it was finished and is a new run if it wasn't. Batch runs and streams may share an output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera import stored
from tessera.operators import register, resume
from tessera.plans import steps
from tessera.sources import ledger, tables


def register_stream(spark: SparkSession, folder: str, max_files: int = 16) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in register.COLUMNS])
    return spark.readStream.schema(schema).option("header", True).option("escape", '"').option("maxFilesPerTrigger", max_files).csv(folder)


def match_stream(spark: SparkSession, folder: str, registry_path: str, out_dir: str, checkpoint: str) -> StreamingQuery:
    """Start matching with a table of companies or a match index; processes what is there and stops (trigger availableNow)."""

    def batch(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        key = f"stream {session.sparkContext.getLocalProperty('sql.streaming.queryId')} {number}"
        if ledger.finished(session, out_dir, key):
            return
        orgs = register.register(register.coerce(rows)).drop("pos")
        matched, saw = steps.done(session, out_dir, orgs)
        part = stored.stored(resume.pending(orgs, matched), "arrived")
        stored_index = tables.exists(session, f"{registry_path}/postings")
        steps.add_run(part, steps.read_match_index(session, registry_path) if stored_index else session.read.parquet(registry_path), out_dir, key, saw)
        stored.release(part)

    return register_stream(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(stream: DataFrame, time: str = "ts", key: str = "event_type", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per key and window of event time; rows later than the watermark are dropped."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), key, "n")
