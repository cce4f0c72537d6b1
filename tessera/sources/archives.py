"""Archives as a data source: each member is read by a task of its own, on the executors.

The driver reads the archives' directories only. A member can't be split while it is compressed, so its
lines are written to a staging folder as one file, as they come, and read from there like any file: in
as many tasks as it has splits. pyarrow opens the archives (local, HDFS, S3 or Google Cloud paths).

Other file systems only Spark can read. There an archive's bytes are read as text is, in splits, and dealt
by member, so that a task has those of one member, in order (see spark_lines).
"""

from __future__ import annotations

import io
import zipfile
from bisect import bisect_right
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.sources import records
from tessera.stored import ship

BLOCK = 1 << 20
#: Bytes of an archive in a row, as spark_lines deals them: thousands of rows are one Arrow batch.
PIECE = 1 << 12
SCHEMES = ("", "file", "hdfs", "s3", "gs", "gcs")


LINES = "member string, value binary"


def reachable(path: str) -> bool:
    """Whether the executors' Python can open such a path."""
    scheme, found, _ = path.partition(":")
    return not found or "/" in scheme or scheme in SCHEMES


def _located(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (pafs.LocalFileSystem(), path) if path.startswith("/") or ":" not in path else pafs.FileSystem.from_uri(path)


@contextmanager
def _opened(path: str) -> Iterator[zipfile.ZipFile]:
    files, place = _located(path)
    with files.open_input_file(place) as f, zipfile.ZipFile(f) as z:
        yield z


def archives(path: str) -> list[str]:
    """The archive itself, or those in a folder."""
    files, place = _located(path)
    if files.get_file_info(place).type != pafs.FileType.Directory:
        return [path]
    found = files.get_file_info(pafs.FileSelector(place))
    return sorted(f"{path.rstrip('/')}/{x.base_name}" for x in found if x.base_name.lower().endswith(".zip"))


def members(z: zipfile.ZipFile, every: bool, suffix: str) -> list[tuple[int, zipfile.ZipInfo]]:
    """An archive's members with such names, or the first one, each with its place in the directory (two may have
    the same name)."""
    found = [(nth, m) for nth, m in enumerate(z.infolist()) if not m.is_dir() and m.filename.lower().endswith(suffix)]
    return found if every else found[:1]


def lines_of(f: io.BufferedIOBase, member: str) -> Iterator[pa.RecordBatch]:
    """The lines of an open member, a block at a time."""

    def batch(found: list[bytes]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([member] * len(found)), pa.array(found, pa.binary())], names=["member", "value"])

    rest: list[bytes] = []
    while block := f.read(BLOCK):
        *found, last = block.split(b"\n")
        if found:
            found[0] = b"".join([*rest, found[0]])
            rest = []
            yield batch(found)
        rest.append(last)
    if any(rest):
        yield batch([b"".join(rest)])


@dataclass
class Member(InputPartition):
    path: str
    nth: int


class ZipReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.every, self.suffix = options["path"], options.get("every", "true") == "true", options.get("suffix", ".csv")

    def partitions(self) -> list[Member]:
        out = []
        for path in archives(self.path):
            with _opened(path) as z:
                out += [Member(path, nth) for nth, _ in members(z, self.every, self.suffix)]
        return out or [Member("", 0)]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        with _opened(partition.path) as z:
            member = z.infolist()[partition.nth]
            with z.open(member) as f:
                yield from lines_of(f, f"{partition.path}!{member.filename}")


class ZipLines(DataSource):
    """Lines (bytes) of the members of archives. Options: path (an archive or a folder of them), every (else the
    first member of an archive only), suffix of the members' names."""

    @classmethod
    def name(cls) -> str:
        return "zip_lines"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> ZipReader:
        return ZipReader(self.options)


def zip_lines(spark: SparkSession, path: str, every: bool = True, suffix: str = ".csv") -> DataFrame:
    ship(spark)
    spark.dataSource.register(ZipLines)
    return spark.read.format("zip_lines").option("every", str(every).lower()).option("suffix", suffix).load(path)


class _Stored(io.RawIOBase):
    """A file of any Hadoop file system, for the driver to read an archive's directory."""

    def __init__(self, stream, size: int):
        self.stream, self.size, self.at = stream, size, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self.at = offset + (0, self.at, self.size)[whence]
        return self.at

    def readinto(self, into) -> int:
        n = max(0, min(len(into), BLOCK, self.size - self.at))
        if n:
            self.stream.seek(self.at)
            found = self.stream.readNBytes(n)
            n = len(found)
            into[:n] = found
            self.at += n
        return n


class _Pieces(io.RawIOBase):
    """Rows of bytes as a file."""

    def __init__(self, values: Iterator[bytes]):
        self.values, self.rest = values, b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self.rest:
            found = next(self.values, None)
            if found is None:
                return 0
            self.rest = found
        n = min(len(into), len(self.rest))
        into[:n], self.rest = self.rest[:n], self.rest[n:]
        return n


@dataclass
class Span:
    """Where an archive holds a member: from its local header to what comes next."""

    file: str
    start: int
    end: int
    member: zipfile.ZipInfo


def _directories(spark: SparkSession, path: str, every: bool, suffix: str) -> tuple[dict[str, tuple[str, int]], list[Span]]:
    """The path and size of an archive, or of those in a folder, by the name that Spark gives a row's file, and
    the places of their members."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [fs.getFileStatus(place)]
    if found[0].isDirectory():
        found = sorted((x for x in fs.listStatus(place) if x.getPath().getName().lower().endswith(".zip")), key=lambda x: x.getPath().getName())
    files, out = {}, []
    for x in found:
        named = x.getPath().toString()
        file = spark._jvm.org.apache.hadoop.fs.Path(named).toUri().toString()
        files[file] = (named, x.getLen())
        stream = fs.open(x.getPath())
        try:
            with zipfile.ZipFile(io.BufferedReader(_Stored(stream, x.getLen()), BLOCK)) as z:
                starts = sorted({m.header_offset for m in z.infolist()} | {z.start_dir})
                for _, m in members(z, every, suffix):
                    if m.flag_bits & 1:
                        raise RuntimeError(f"{file}!{m.filename} is encrypted")
                    end = starts[bisect_right(starts, m.header_offset)]
                    if end - m.header_offset < 30 + m.compress_size:
                        raise zipfile.BadZipFile(f"{file}!{m.filename} overlaps another member")
                    out.append(Span(file, m.header_offset, end, m))
        finally:
            stream.close()
    return files, out


def spark_lines(spark: SparkSession, path: str, every: bool = True, suffix: str = ".csv") -> DataFrame:
    """zip_lines() of archives that only Spark can open, a partition a member. Their bytes are read as lines, so
    files are split as any text is; the sizes of the splits' lines say where in its file each split's begin.
    Members are checked against the directory's CRC-32."""
    ship(spark)
    files, spans = _directories(spark, path, every, suffix)
    if not spans:
        return spark.createDataFrame([], LINES)
    read = dict.fromkeys((x.file for x in spans), 0)
    found = records.lines(spark, [files[file][0] for file in read])
    # a row for each split, as many as the driver plans
    ends = found.groupBy("file", "start").agg(F.sum(F.octet_length("value") + F.lit(1).cast("long")).alias("n")).orderBy("file", "start").collect()
    begins = {}
    for file, start, n in ends:
        begins[file, start] = read[file]
        read[file] += n
    for file, n in read.items():
        if n - files[file][1] not in (0, 1):  # the last line may lack its end
            raise OSError(f"{n} bytes were read of {file}, which has {files[file][1]}")
    places: dict[str, list[tuple[int, int, int]]] = {file: [] for file in read}
    for k, x in sorted(enumerate(spans), key=lambda found: found[1].start):
        places[x.file].append((x.start, x.end, k))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, at = None, 0
        for batch in batches:
            out: list[tuple[int, int, bytes]] = []
            runs: list[tuple[str, int, list[bytes]]] = []
            for file, start, value in zip(*(c.to_pylist() for c in batch.columns)):
                if not runs or runs[-1][:2] != (file, start):
                    runs.append((file, start, []))
                runs[-1][2].extend((value, b"\n"))
            for file, start, values in runs:
                if (file, start) != key:
                    key, at = (file, start), begins[file, start]
                text, held = b"".join(values), places[file]
                i = max(0, bisect_right(held, (at,)) - 1)
                while i < len(held) and held[i][0] < at + len(text):
                    first, end, k = held[i]
                    a, b = max(first - at, 0), min(end - at, len(text))
                    out += [(k, at + c, text[c : min(c + PIECE, b)]) for c in range(a, b, PIECE)]
                    i += 1
                at += len(text)
            yield pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.binary()))], names=["nth", "at", "value"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((k, value) for batch in batches for k, value in zip(batch.column("nth").to_pylist(), batch.column("value").to_pylist()))
        head = next(rows, None)
        if head is None:
            return
        span = spans[head[0]]
        f = io.BufferedReader(_Pieces(value for row in ((head,), rows) for _, value in row), BLOCK)
        local = f.read(30)
        f.read(int.from_bytes(local[26:28], "little") + int.from_bytes(local[28:30], "little"))  # name and extra field
        with zipfile.ZipExtFile(f, "r", span.member) as member:
            yield from lines_of(member, f"{span.file}!{span.member.filename}")

    pieces = found.select("file", "start", F.col("value").cast("binary").alias("value")).mapInArrow(deal, "nth int, at long, value binary")
    return pieces.repartitionById(len(spans), F.col("nth")).sortWithinPartitions("at").mapInArrow(unpack, LINES)
