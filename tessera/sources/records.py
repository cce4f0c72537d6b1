"""CSV files whose quoted cells hold line breaks, read in as many tasks as others.

Where a line begins, a reader is either between records or inside a quoted cell, and which of the two
depends on all the file before. But what a split does to either state doesn't: every split's lines are
read once for both, which gives a function of two states, and a running composition of these functions
over the splits (one row each) says in which state every split begins. Then the splits are cut into
records in parallel. A record that goes on into other splits is put together from its pieces; there is one
at most where a split ends. Records are parsed by Spark's own CSV parser.

A quote opens a cell only at the cell's beginning, as for Spark's reader: in `5" pipe,3` it is a letter.
Blank lines between records are no records. Lines end in a line feed, alone or after a carriage return.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.stored import ship

_CELL = r'(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+)?'
_BETWEEN = re.compile(rf"(?:{_CELL},)*+{_CELL}", re.S)
_INSIDE = re.compile(r'(?:[^"]++|"")*+', re.S)
_CLOSED = re.compile(r'"[^,]*+', re.S)
WHOLE, HEAD, MIDDLE, TAIL = range(4)


def inside_after(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted cell."""
    at = 0
    if inside:
        at = _INSIDE.match(line).end()
        if at == len(line):
            return True
        at = _CLOSED.match(line, at).end()
        if at == len(line):
            return False
        at += 1
    return _BETWEEN.match(line, at).end() != len(line)


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, start (of the split), value: the lines of every split, in their order within a task."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def split_states(found: DataFrame) -> DataFrame:
    """file, start, inside, inside_after: whether each split begins, and ends, inside a quoted cell."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, states, out = None, (False, True), []
        for batch in batches:
            for file, start, value in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, start) != key:
                    if key is not None:
                        out.append((*key, *states))
                    key, states = (file, start), (False, True)
                if value is not None:
                    a = inside_after(value, states[0])
                    states = (a, a if states[0] == states[1] else inside_after(value, states[1]))
        if key is not None:
            out.append((*key, *states))
        yield pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.bool_(), pa.bool_()))], names=["file", "start", "after_between", "after_inside"])

    quoted = found.withColumn("value", F.when(F.contains("value", F.lit('"')), F.col("value")))
    each = quoted.mapInArrow(compose, "file string, start long, after_between boolean, after_inside boolean")
    order = Window.partitionBy("file").orderBy("start")  # one row a split
    a, b = F.col("after_between"), F.col("after_inside")
    flips = each.withColumn("flips", F.sum((a & ~b).cast("int")).over(order))
    # the last split that ends in one state whatever it began in, and the flips since then
    fixed = flips.withColumn("fixed", F.last(F.when(a == b, F.struct(a.cast("int").alias("state"), "flips")), ignorenulls=True).over(order))
    after = F.coalesce((F.col("fixed.state") + F.col("flips") - F.col("fixed.flips")) % 2, F.col("flips") % 2) == 1
    return fixed.withColumn("inside_after", after).withColumn("inside", F.coalesce(F.lag("inside_after").over(order), F.lit(False))).select("file", "start", "inside", "inside_after")


def cut(found: DataFrame, inside: set[tuple[str, int]]) -> DataFrame:
    """file, start, nth, piece (WHOLE, HEAD, MIDDLE, TAIL), value: the records that begin in each split, and the
    pieces of those that cross its ends. inside: the splits that begin inside a quoted cell."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, nth, now, began = None, [], 0, False, False
        out: list[tuple] = []

        def add(piece: int) -> None:
            nonlocal nth
            text = "\n".join(held)
            if piece != WHOLE or text.strip():
                out.append((*key, nth, piece, text))
                nth += piece in (WHOLE, TAIL)
            held.clear()

        def close() -> None:
            if held:
                add(MIDDLE if began else TAIL)

        for batch in batches:
            for file, start, value in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, start) != key:
                    close()
                    key, nth = (file, start), 0
                    now = began = key in inside
                now = inside_after(value, now) if '"' in value else now
                held.append(value if now else value.removesuffix("\r"))
                if not now:
                    add(HEAD if began else WHOLE)
                    began = False
            yield pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate(_TYPES)], names=_NAMES)
            out.clear()
        close()
        if out:
            yield pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate(_TYPES)], names=_NAMES)

    return found.mapInArrow(work, "file string, start long, nth long, piece int, value string")


_TYPES = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
_NAMES = ["file", "start", "nth", "piece", "value"]


def joined(pieces: DataFrame) -> DataFrame:
    """Records that cross splits, whole: a tail, the pieces after it, and a head."""
    order = Window.partitionBy("file").orderBy("start", "piece")  # a head stands before its split's tail; both are rare
    owner = F.last(F.when(F.col("piece") == TAIL, F.struct("start", "nth")), ignorenulls=True).over(order)
    put = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece", "value"))), lambda x: x["value"]), "\n")
    owned = pieces.withColumn("owner", owner).withColumn("at", F.col("start"))
    return owned.groupBy("file", "owner").agg(put.alias("value")).select("file", F.col("owner.start").alias("start"), F.col("owner.nth").alias("nth"), "value")


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, start, nth, value: the text of every record but the files' headers."""
    ship(spark)
    found = lines(spark, path)
    # what the driver gets is fewer rows than it has splits to plan: those that begin or end inside a cell
    crossing = [tuple(r) for r in split_states(found).filter("inside OR inside_after").collect()]
    inside = {(file, start) for file, start, began, _ in crossing if began}
    out = cut(found, inside).filter(F.col("piece") == WHOLE).select("file", "start", "nth", "value")
    if crossing:
        keys = spark.createDataFrame([(f, s) for f, s, *_ in crossing], "file string, start long")
        out = out.union(joined(cut(found.join(F.broadcast(keys), ["file", "start"], "left_semi"), inside).filter(F.col("piece") != WHOLE)))
    return out.filter(~((F.col("start") == 0) & (F.col("nth") == 0)))


def read(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The records' cells as text under the given names, and `_place`, their order."""
    names = [f"c{k}" for k in range(len(columns))]
    cells = F.from_csv("value", ", ".join(f"{n} string" for n in names), {"escape": '"', "multiLine": "true"})
    parsed = records(spark, path).select(cells.alias("cells"), F.struct("file", "start", "nth").alias("_place"))
    return parsed.select(*[F.col(f"cells.{n}").alias(c) for n, c in zip(names, columns)], "_place")
