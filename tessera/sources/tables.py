"""Text tables: CSV in and out, bucketed indexes, zipped sources. All columns are text."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.errors import MissingInputError
from tessera.functions import names, values
from tessera.operators.registry import require, trim_headers
from tessera.operators.resume import coerce
from tessera.sources import archives, records


def filesystem(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as its own."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return fs.exists(p)


def quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a quoted cell of a CSV file may hold a line break: no line has an odd number of quotes
    where none does. Stops at the first."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def read_csv(spark: SparkSession, path: str, na_cells: bool = True, position: str = "") -> DataFrame:
    """Every column as text, missing cells (and, by default, cells that say so) as ''. Headers are
    trimmed, a byte order mark is dropped, quoted line breaks stay inside their cell; files are split, with
    such breaks (see sources.records) or without. position: a column of that name in order of the rows."""
    if not exists(spark, path):
        raise MissingInputError(path)
    broken = quoted_breaks(spark, path)
    plain = spark.read.option("header", True).option("inferSchema", False).option("escape", '"').option("encoding", "UTF-8")
    raw = plain.option("multiLine", broken).csv(path)
    if not raw.columns:
        raise MissingInputError(f"{path} is empty")
    df = records.read(spark, path, trim_headers(raw).columns) if broken else trim_headers(raw)
    cell = values.na_to_blank if na_cells else values.text
    order = F.col("_place") if broken else F.struct(F.input_file_name(), F.input_file_block_start(), F.monotonically_increasing_id())
    place = [order.alias(position)] if position else []
    df = df.drop("_place") if broken and not position else df
    return df.select(*[cell(F.col(f"`{c}`")).alias(c) for c in df.columns if c != "_place"], *place)


def newest_csv(spark: SparkSession, path: str) -> str:
    """A .csv path itself, else the folder's .csv file with the latest modification."""
    if path.lower().endswith(".csv"):
        return path
    fs, p = filesystem(spark, path)
    found = [s for s in (fs.listStatus(p) if fs.exists(p) else []) if s.getPath().getName().lower().endswith(".csv")]
    if not found:
        raise MissingInputError(f"no .csv file in {path}")
    return max(found, key=lambda s: s.getModificationTime()).getPath().toString()


def copy(spark: SparkSession, source: str, target: str) -> int:
    """Copy a file between any two Hadoop file systems, block by block; its bytes."""
    fs, p = filesystem(spark, source)
    if not fs.exists(p):
        raise MissingInputError(source)
    to, q = filesystem(spark, target)
    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(fs.open(p), to.create(q, True), 1 << 20, True)
    return to.getFileStatus(q).getLen()


def write_chunks(spark: SparkSession, target: str, chunks: Iterable[bytes]) -> int:
    """Write a download as it arrives; its bytes."""
    fs, p = filesystem(spark, target)
    out, n = fs.create(p, True), 0
    try:
        for block in chunks:
            out.write(bytearray(block))
            n += len(block)
    finally:
        out.close()
    return n


def unzip(spark: SparkSession, path: str, target: str) -> None:
    """The first .csv member of an archive, streamed to target by the driver's JVM: for one file of a snapshot.
    read_zip() unpacks on the executors."""
    fs, p = filesystem(spark, path)
    if not fs.exists(p):
        raise MissingInputError(path)
    jvm = spark._jvm
    archive = jvm.java.util.zip.ZipInputStream(fs.open(p))
    try:
        while (member := archive.getNextEntry()) is not None:
            if not member.isDirectory() and member.getName().lower().endswith(".csv"):
                to, q = filesystem(spark, target)
                out = to.create(q, True)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(archive, out, 1 << 20, False)
                finally:
                    out.close()
                return
    finally:
        archive.close()
    raise MissingInputError(f"no .csv in {path}")


def read_zip(spark: SparkSession, path: str, staging: str, position: str = "", every: bool = False) -> DataFrame:
    """The first .csv member of an archive, or every one of an archive or a folder of archives, unpacked to the
    staging folder (a task each) and read from there in parallel. Members have the same columns."""
    if not exists(spark, path):
        raise MissingInputError(path)
    target = f"{staging.rstrip('/')}/{uuid.uuid4().hex}"
    found = archives.zip_lines if archives.reachable(path) else archives.spark_lines
    lines = found(spark, path, every).select(F.col("value").cast("string"))
    lines.write.options(compression="none", maxRecordsPerFile=0).text(target)  # a file per member, each with a header
    fs, p = filesystem(spark, target)
    if not any(s.getLen() and not s.getPath().getName().startswith("_") for s in fs.listStatus(p)):
        raise MissingInputError(f"no .csv in {path}")
    return read_csv(spark, target, na_cells=False, position=position)


def write_zip(spark: SparkSession, source: str, target: str) -> None:
    """The files of a folder as members of one archive, block by block."""
    fs, p = filesystem(spark, source)
    to, q = filesystem(spark, target)
    jvm = spark._jvm
    out = jvm.java.util.zip.ZipOutputStream(to.create(q, True))
    try:
        for s in sorted(fs.listStatus(p), key=lambda s: s.getPath().getName()):
            if not s.getPath().getName().startswith(("_", ".")):
                out.putNextEntry(jvm.java.util.zip.ZipEntry(s.getPath().getName()))
                member = fs.open(s.getPath())
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(member, out, 1 << 20, False)
                member.close()
                out.closeEntry()
    finally:
        out.close()


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", columns: Iterable[str] | None = None) -> None:
    """A folder of CSV parts with header; columns: their fixed order, missing ones ''."""
    (coerce(df, tuple(columns)) if columns else df).write.mode(mode).options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def append_csv(df: DataFrame, path: str, columns: Iterable[str] | None = None) -> None:
    write_csv(df, path, "append", columns)


def write_index(index: DataFrame, path: str) -> None:
    """A token index in one folder per bucket; rows of a bucket meet in few files."""
    index.repartition("bucket", "token").write.mode("errorifexists").partitionBy("bucket").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("bucket", "token", "company_number")


def write_profiles(companies: DataFrame, path: str) -> None:
    """One row per company in one folder per bucket of its number."""
    dealt = companies.withColumn("bucket", names.bucket(F.col("company_number")))
    dealt.repartition("bucket", "company_number").write.mode("errorifexists").partitionBy("bucket").parquet(path)


def file_digest(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file, read block by block."""
    fs, p = filesystem(spark, path)
    if not fs.exists(p):
        raise MissingInputError(path)
    jvm = spark._jvm
    digest = jvm.java.security.MessageDigest.getInstance("SHA-256")
    into = jvm.java.security.DigestOutputStream(jvm.java.io.OutputStream.nullOutputStream(), digest)
    jvm.org.apache.hadoop.io.IOUtils.copyBytes(fs.open(p), into, 1 << 20, True)
    return bytes(b & 255 for b in digest.digest()).hex()


def table_digest(df: DataFrame) -> str:
    """A digest of a table's rows whatever their order and partitioning: sums of their hashes."""
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`").alias(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256)
    sums = [F.coalesce(F.sum(F.conv(F.substring("h", 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")), F.lit(0)).cast("string") for k in range(4)]
    return df.select(row.alias("h")).agg(F.sha2(F.concat_ws(",", F.count(F.lit(1)).cast("string"), *sums), 256)).first()[0]


def read_register(spark: SparkSession, path: str, columns: Iterable[str], position: str = "") -> DataFrame:
    return require(read_csv(spark, newest_csv(spark, path), position=position), columns, "register")
