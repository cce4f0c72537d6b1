"""Fill-in-the-middle: a text cut at two boundaries, its pieces put in another order behind markers.

Each text is decoded to an array of code points. The classes of neighbours say where units (lines,
words, single characters) end, flatnonzero lists these places, and two ranks drawn from hashes of
doc_id choose two of them; the three slices are encoded again. The draw depends on the seed and doc_id
alone, never on partitions or order. restore() rebuilds the text from output and form with DataFrame
functions, so it shares no code with the cut.

One map, no shuffle. A text is held as code points (four bytes each) once, with its boundaries.

Defined results: null texts are empty, have no units and stay plain; a text that holds a marker stays
plain, as it couldn't be rebuilt; a null doc_id draws as the empty string does; bytes that are no UTF-8
come out as they went in; rows that repeat a document are cut alike; an empty table gives an empty one;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm._tables import read, ship, whole_texts
from tessera.llm._text import pieces

PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM = 7, 100, 50
OTHER, GAP, BREAK = 0, 1, 2
_GAPS = np.array([0x20, 0x09, 0x0B, 0x0C, 0x0D], np.uint32)


def decode(text: bytes) -> np.ndarray:
    """Code points; bytes that are no UTF-8 become lone surrogates and encode() turns them back."""
    return np.frombuffer(text.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)


def encode(points: np.ndarray) -> bytes:
    return points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogateescape")


def boundaries(points: np.ndarray, unit: str = "line") -> np.ndarray:
    """Where units end, the end of the text included. A line ends behind its line break, a word behind
    the white space that follows it."""
    if not len(points):
        return np.zeros(0, np.int64)
    kind = np.where(points == 10, BREAK, OTHER)
    if unit == "line":
        inner = kind[:-1] == BREAK
    elif unit == "word":
        kind[np.isin(points, _GAPS)] = GAP
        inner = (kind[:-1] != OTHER) & (kind[1:] == OTHER)
    elif unit == "char":
        inner = np.ones(len(points) - 1, bool)
    else:
        raise ValueError(f"unit {unit!r} is none of line, word, char")
    return np.append(np.flatnonzero(inner) + 1, len(points))


def cut(text: bytes, draws: tuple[int, int, int, int], unit: str, rate: int, spm: int, markers: tuple[bytes, bytes, bytes]) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, code points of prefix and middle, and output of one text."""
    points = decode(text)
    ends = boundaries(points, unit)
    n = len(ends)
    if not text or draws[2] % 100 >= rate or any(m in text for m in markers):
        return n, "plain", None, None, text
    a, b = (int(ends[rank - 1]) if rank else 0 for rank in sorted((draws[0] % (n + 1), draws[1] % (n + 1))))
    prefix, middle, suffix = encode(points[:a]), encode(points[a:b]), encode(points[b:])
    p, s, m = markers
    if draws[3] % 100 < spm:
        return n, "spm", a, b - a, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", a, b - a, b"".join((p, prefix, s, suffix, m, middle))


def check_markers(markers: tuple[str, str, str]) -> None:
    """Markers must differ and none may begin as any ends, else a cut could make another one up."""
    for a in markers:
        for b in markers:
            if not a or (a != b and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)) + (a != b))):
                raise ValueError(f"markers {markers} can't be told apart")
    if len(set(markers)) < 3:
        raise ValueError(f"markers {markers} can't be told apart")


def fill_in_middle(docs: DataFrame, unit: str = "line", seed: int = SEED, rate: int = RATE, spm: int = SPM, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars, output. Of 100 texts `rate`
    are cut, and of 100 of these `spm` have the suffix first."""
    check_markers(markers)
    ship(docs.sparkSession)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    given = whole_texts(docs, "doc_id", "text").select("doc_id", "body", *[F.conv(F.substring(drawn, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)])
    marks = tuple(m.encode() for m in markers)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, "body"):
            draws = zip(*(batch.column(f"h{k}").to_pylist() for k in range(1, 5)))
            got = [cut(data[a:b].tobytes(), h, unit, rate, spm, marks) for a, b, h in zip(offsets[:-1], offsets[1:], draws)]
            n, form, prefix, middle, output = zip(*got)
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary())], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = given.schema["doc_id"].dataType.simpleString()
    out = given.mapInArrow(work, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restore(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that fill_in_middle() cut."""
    p, s, m = (F.lit(x) for x in markers)
    part = lambda x, mark, k: F.split_part(x, mark, F.lit(k))
    middle, lead = part(output, m, 2), part(output, m, 1)
    psm = F.concat(part(part(lead, s, 1), p, 2), middle, part(lead, s, 2))
    spm = F.concat(part(lead, p, 2), middle, part(part(lead, p, 1), s, 2))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fill_in_middle(read(spark, sf_dir, "documents"))
    restored = F.sha2(restore(F.col("output"), F.col("form")).cast("binary"), 256)
    return got.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), restored.alias("restored_sha256"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
g AS (SELECT *, len(u) AS n, [('0x' || h[1:8])::BIGINT, ('0x' || h[9:16])::BIGINT, ('0x' || h[17:24])::BIGINT, ('0x' || h[25:32])::BIGINT] AS r FROM d),
p AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain' WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM g),
c AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM p),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS output FROM c),
x AS (SELECT *, CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN split_part(split_part(output, '<S>', 1), '<P>', 2) || split_part(output, '<M>', 2) || split_part(split_part(output, '<S>', 2), '<M>', 1)
    ELSE split_part(split_part(output, '<P>', 2), '<M>', 1) || split_part(output, '<M>', 2) || split_part(split_part(output, '<P>', 1), '<S>', 2) END AS restored FROM o)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(output) AS output_sha256, sha256(restored) AS restored_sha256
FROM x
"""
