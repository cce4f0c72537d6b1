"""Keyed state over streams: the first row of every key by its own time, and sessions.

Rows may come in any order within `late`: an answer is given once the watermark says that no earlier row can
come. What comes later still is dropped and counted (`late_rows`). State is dealt by key, and a key's state is one
row, so a hot key costs its rows' transfer but no memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.stored import ship

_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
_OUT = "_key string, _at long, _row string"
_STATE = "at long, tie string, row string, given boolean"


def keep_first(rows: DataFrame, key: str, time: str, tie: str, late: str, forget_after: int | None = None) -> DataFrame:
    """Of a stream (or table) the first row of every key, by `time`, then `tie`, then all columns' text; append mode.

    A row is given once the watermark has passed its time, so keys whose first row is later than the last watermark
    are still open when a stream stops. Whole numbers in `tie` go by value, others by code points of their text.
    Rows without key or time are no one's. forget_after: seconds of event time after a key's row was given until
    the key is forgotten and starts anew; None: never. Over a table, resume.keep_first is the same and cheaper.
    """
    spark, schema = rows.sparkSession, rows.schema
    ship(spark)
    whole = isinstance(schema[tie].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    # whole numbers as text that sorts by value: shifted to be positive, of one length
    rank = F.lpad((F.col(tie).cast("decimal(38,0)") + F.lit(str(1 << 63)).cast("decimal(38,0)")).cast("string"), 20, "0") if whole else F.col(tie).cast("string")
    forget = None if forget_after is None else forget_after * 1000

    def first(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            at, order, row, given = state.get
            if given:
                state.remove()
                return
            state.update((at, "", "", True))
            if forget is not None:
                state.setTimeoutTimestamp(max(at // 1000, state.getCurrentWatermarkMs()) + forget + 1)
            yield pd.DataFrame({"_key": [k[0]], "_at": [at], "_row": [row]})
            return
        if state.exists and state.get[3]:
            for _ in frames:
                pass
            if forget is not None:  # an update without a new timeout would lose the old one
                state.setTimeoutTimestamp(max(state.get[0] // 1000, state.getCurrentWatermarkMs()) + forget + 1)
            return
        best = tuple(state.get[:3]) if state.exists else None
        for part in frames:
            for found in part[["_at", "_tie", "_row"]].sort_values(["_at", "_tie", "_row"]).head(1).itertuples(index=False):
                found = (int(found[0]), found[1], found[2])
                best = found if best is None or found < best else best
        state.update((*best, False))
        state.setTimeoutTimestamp(max(best[0] // 1000 + 1, state.getCurrentWatermarkMs() + 1))

    known = rows.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn("_when", F.col(time).cast("timestamp")).withWatermark("_when", late)
    packed = known.select(F.col(key).cast("string").alias("_key"), "_when", F.unix_micros("_when").alias("_at"), F.coalesce(rank, F.lit("")).alias("_tie"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), _JSON).alias("_row"))
    out = packed.groupBy("_key").applyInPandasWithState(first, _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(F.from_json("_row", schema, _JSON).alias("r")).select("r.*")


def sessions(rows: DataFrame, key: str, time: str, gap: str, late: str) -> DataFrame:
    """Sessions per key: rows less than `gap` apart, with their number; all in Spark's own state."""
    known = rows.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).withWatermark(time, late)
    out = known.groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("first_time"), F.max(time).alias("last_time"))
    return out.select(key, "first_time", "last_time", "n")


def late_rows(query: StreamingQuery) -> int:
    """How many rows a query has dropped as later than its watermark, as far as its progress is kept
    (`spark.sql.streaming.numRecentProgressUpdates` batches)."""
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p["stateOperators"])
