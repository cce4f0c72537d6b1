"""Line dedup by winnowing over line hashes.

A document is its sequence of non-blank lines. In every window of `window` consecutive lines the
one with the least hash (of several the last) is selected; these minima are the document's
fingerprints. Two documents that share a run of `window` lines or more have a fingerprint in it in
common, so only selected positions are dealt by hash, and those whose fingerprint occurs nowhere
else go no further. From each shared position the match is extended to both sides: to every
window of which it is the minimum, compared by two 64-bit hashes of all its lines. A run that goes on
beyond a window has the next fingerprint there, so overlapping windows merge into maximal runs. All
occurrences but the first, in order of doc_id and line, go.

A line of at least `ALONE` words, or of `ALONE_BYTES` bytes, is a window by itself and its own
fingerprint, so that a passage of one line between other neighbours and a document of one line
take part.

Only hashes are shuffled: one row per fingerprint, pre-aggregated per hash. A line that a third of
all documents share is one partially aggregated row on one side of a join and a splittable
shuffle on the other: aggregates and what survives the first join are written, as a join is
only split by adaptive execution where it reads shuffles and nothing else.

Defined results: a null text is an empty one and keeps its null; blank lines never start or join
a match and stay; a document whose rows are repeated counts once, and documents without doc_id
come before all others, in order of a hash of their text; documents without a repeated run come
back unchanged; an empty table gives an empty table; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._tables import materialize, read

WINDOW = 2
#: Words, or bytes where a language has no spaces, from which one line is a passage.
ALONE, ALONE_BYTES = 50, 300


def _is_long(line: Column, alone: int) -> Column:
    return (F.octet_length(line) >= ALONE_BYTES) | (F.size(F.split(F.trim(line), r"[\x20\x09-\x0D]+")) >= alone)


def selected(docs: DataFrame, window: int, alone: int | None) -> DataFrame:
    """One row per fingerprint: doc_id, body_key, its hash, its position among the non-blank lines, and
    `windows`, those that it is the minimum of: first position, two keys, line numbers."""
    lines = F.filter(
        F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x, i: F.struct(i.alias("at"), x.alias("line"))),
        lambda x: F.trim(x["line"]) != "",
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("body_key"), lines.alias("lines")).filter(F.size("lines") >= (window if alone is None else 1))
    places = F.array().cast("array<int>") if alone is None else F.filter(F.transform("lines", lambda x, i: F.when(_is_long(x["line"], alone), i)), lambda i: i.isNotNull())
    rows = rows.select(
        "doc_id", "body_key", F.col("lines.at").alias("at"), F.transform("lines", lambda x: F.xxhash64(x["line"])).alias("h"),
        F.transform("lines", lambda x: F.xxhash64(F.lit("second"), x["line"])).alias("g"), places.alias("places"),
    )
    starts = F.filter(F.sequence(F.lit(0), F.size("h") - 1), lambda i: i <= F.size("h") - window)
    cut = lambda c, i, n: F.slice(c, i + 1, n)
    least = lambda x: F.size(x) - F.array_position(F.reverse(x), F.array_min(x)).cast("int")  # noqa: E731  # the last of equal minima
    rows = rows.withColumn("minima", F.transform(starts, lambda i: i + least(cut("h", i, window))))
    run = lambda i, n: F.struct(i.alias("start"), F.xxhash64(cut("h", i, n)).alias("key"), F.xxhash64(cut("g", i, n)).alias("check"), cut("at", i, n).alias("at"))
    around = lambda p: F.filter(F.sequence(F.greatest(F.lit(0), p - (window - 1)), F.least(p, F.size("minima") - 1)), lambda i: F.get("minima", i) == p)
    found = F.transform(F.array_distinct("minima"), lambda p: F.struct(F.get("h", p).alias("fingerprint"), p.alias("position"), F.transform(around(p), lambda i: run(i, window)).alias("windows")))
    single = F.transform("places", lambda p: F.struct(F.xxhash64(F.lit("alone"), F.get("h", p)).alias("fingerprint"), p.alias("position"), F.array(run(p, 1)).alias("windows")))
    return rows.select("doc_id", "body_key", F.inline(found if alone is None else F.concat(found, single)))


def repeated_lines(docs: DataFrame, window: int = WINDOW, alone: int | None = ALONE) -> DataFrame:
    """doc_id, body_key and the sorted numbers of the lines that belong to later repeated runs."""
    found = selected(docs, window, alone)
    place = F.struct("doc_id", "body_key", "position")
    shared = found.groupBy("fingerprint").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter(F.col("first") < F.col("last")).select("fingerprint")
    shared = materialize(shared, "line-fingerprints")
    matched = found.join(shared, "fingerprint").select("doc_id", "body_key", F.inline("windows"))
    matched = materialize(matched, "line-windows")
    here = F.struct("doc_id", "body_key", "start")
    classes = matched.groupBy("key", "check").agg(F.min(here).alias("first"), F.max(here).alias("last")).filter(F.col("first") < F.col("last")).drop("last")
    classes = materialize(classes, "line-classes")
    later = matched.join(classes, ["key", "check"]).filter(here > F.col("first"))
    return later.groupBy("doc_id", "body_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("at")))).alias("gone"))


def line_dedup(docs: DataFrame, window: int = WINDOW, alone: int | None = ALONE) -> DataFrame:
    """docs with `text` freed of later repeated runs, and `lines_total`, `lines_removed` beside it.
    alone None: runs of `window` lines only."""
    names = [c for c in docs.columns if c not in ("lines_total", "lines_removed")]
    rows = docs.select(F.struct(*names).alias("row"))  # one name of ours, so that none of theirs clashes
    gone = repeated_lines(docs, window, alone).select(F.col("doc_id").alias("gone_id"), F.col("body_key").alias("gone_key"), "gone")
    marked = rows.join(gone, F.col("row.doc_id").eqNullSafe(F.col("gone_id")) & (F.xxhash64("row.text") == F.col("gone_key")), "left")
    marked = marked.select("row", "gone", F.split("row.text", "\n", -1).alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))
    total = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines"))
    removed = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone"))
    kept = [text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names]
    return marked.select(*kept, total.alias("lines_total"), removed.alias("lines_removed"))


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: lines, lines removed, and length and digest of the text that stays."""
    out = line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return out.select(
        "doc_id",
        F.col("lines_total").cast("long").alias("n_lines"),
        F.col("lines_removed").cast("long").alias("n_removed"),
        F.length(text).cast("long").alias("n_kept_chars"),
        F.sha2(text, 256).alias("kept_sha256"),
    )


OP8_SQL = r"""
WITH cut AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS nr FROM cut
), solid AS (
  SELECT *, lead(line) OVER d AS next_line, lead(nr) OVER d AS next_nr
  FROM line WHERE trim(line, ' ') <> '' WINDOW d AS (PARTITION BY doc_id ORDER BY nr)
), ranked AS (
  SELECT doc_id, nr, next_nr, row_number() OVER (PARTITION BY line, next_line ORDER BY doc_id, nr) AS nth
  FROM solid WHERE next_nr IS NOT NULL
), alone AS (
  SELECT doc_id, nr, row_number() OVER (PARTITION BY line ORDER BY doc_id, nr) AS nth
  FROM solid WHERE strlen(line) >= 300 OR len(regexp_split_to_array(trim(line, ' '), '[\x20\x09-\x0D]+')) >= 50
), gone AS (
  SELECT DISTINCT doc_id, nr FROM (
    SELECT doc_id, nr FROM ranked WHERE nth > 1 UNION ALL SELECT doc_id, next_nr FROM ranked WHERE nth > 1
    UNION ALL SELECT doc_id, nr FROM alone WHERE nth > 1)
), kept AS (
  SELECT line.doc_id, count(*) AS n_lines, count(gone.nr) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY line.nr) FILTER (WHERE gone.nr IS NULL), '') AS text
  FROM line LEFT JOIN gone ON line.doc_id = gone.doc_id AND line.nr = gone.nr GROUP BY line.doc_id
)
SELECT doc_id, n_lines, n_removed, length(text) AS n_kept_chars, sha256(text) AS kept_sha256 FROM kept
"""
