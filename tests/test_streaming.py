"""Keyed state: streams of files against the same rows as a table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import resume
from tessera.streaming import state

DAY = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "id long, who string, at timestamp, said string, n double"


def stream(spark, folder, files):
    """A stream with a batch for each of the files, in their order."""
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/part={k:03d}")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")


def run(df, folder):
    q = df.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).format("parquet").start(f"{folder}/out")
    q.awaitTermination()
    return q, df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out")


def row(id, who, minutes, said="", n=None):
    return (id, who, None if minutes is None else DAY + dt.timedelta(minutes=minutes), said, n)


def test_first_of_a_stream_out_of_order(spark, tmp_path):
    deal = random.Random(3)
    rows = [row(k, deal.choice(["a", "b", "c", "", "dé", None, "hot", "hot", "hot"]), deal.choice([None, *range(60)]), deal.choice(['x "y"\n', "", None]), deal.choice([None, 0.1, 3.0, float(k)])) for k in range(-40, 160)]
    rows += rows[:20]
    deal.shuffle(rows)
    files = [rows[k::4] for k in range(4)] + [[row(999, "end", 10_000)]]
    q, got = run(state.keep_first(stream(spark, tmp_path, files), "who", "at", "id", "2 hours"), tmp_path)
    table = spark.createDataFrame(rows, SCHEMA).filter("who IS NOT NULL AND at IS NOT NULL")
    expect = resume.keep_first(table, ["who"], [F.col("at"), F.col("id")])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expect.collect())) and expect.count() == 6
    assert state.late_rows(q) == 0


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    # a batch drops what was late by the watermark that the batch before it had
    files = [[row(1, "a", 50)], [row(2, "z", 300)], [row(7, "z", 301)], [row(3, "a", 10), row(4, "b", 20), row(5, "c", 290)], [row(6, "z", 9000)]]
    q, got = run(state.keep_first(stream(spark, tmp_path, files), "who", "at", "id", "1 hour"), tmp_path)
    assert sorted((r["who"], r["id"]) for r in got.collect()) == [("a", 1), ("c", 5), ("z", 2)]
    assert state.late_rows(q) == 2


@pytest.mark.parametrize("forget, ids", [(None, [1]), (3600, [1, 4])])
def test_forgotten_keys_start_anew(spark, tmp_path, forget, ids):
    files = [[row(1, "a", 0)], [row(2, "z", 100)], [row(3, "a", 110)], [row(5, "z", 1000)], [row(6, "z", 1001)], [row(4, "a", 2000)], [row(7, "z", 9000)]]
    _, got = run(state.keep_first(stream(spark, tmp_path, files), "who", "at", "id", "1 minute", forget), tmp_path)
    assert sorted(r["id"] for r in got.filter("who = 'a'").collect()) == ids


def test_sessions_of_a_stream(spark, tmp_path):
    files = [[row(1, "a", 40), row(2, "a", 0), row(9, None, 5)], [row(3, "a", 20), row(4, "b", 7), row(5, "a", 90)], [row(6, "z", 9000)]]
    _, got = run(state.sessions(stream(spark, tmp_path, files), "who", "at", "30 minutes", "3 hours"), tmp_path)
    assert sorted((r["who"], r["n"]) for r in got.collect()) == [("a", 1), ("a", 3), ("b", 1)]
