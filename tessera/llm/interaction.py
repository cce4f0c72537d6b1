"""How text filters act on each other: what each removes, alone, after others and in every order.

One map scans the Arrow buffers of whole texts. Byte classes by table look-up and their prefix sums
give words, capitals, symbols and code points of every text; distinct words are neighbours in the
order of (text, hash of word), and equal hashes count as one word only after their bytes were
compared (a text where two words share a hash is counted by its words). What is left of a document is a
mask of failed filters and the digest of its text, some 60 bytes. Copies of an earlier text are found
on these: rows are added up by digest and mask before any are dealt, so a text that a third of all
rows repeat is a few rows a task. The masks, at most 32 a part, are then reduced to all orders at once
by products with fixed selectors.

Long texts are scanned in blocks of `BLOCK` bytes, cut where white space is; what is kept of a block is
its distinct words' hashes and places, so a text takes a small multiple of its bytes. Texts are the same
when their SHA-256 is.

Defined results: null texts are empty and have no words; the null language is the empty string; rows
without doc_id have no order, so they neither are copies nor make others copies; rows that repeat a
doc_id and text are copies of smaller ids only, each counted; a document has a label 1 if any of its
label rows has; an empty table has no parts and gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm._tables import read, ship
from tessera.llm._text import SPACE, Hasher, pieces, ragged, words

FILTERS = "ABCDE"
#: The limits of A (words), B and C (percent), and D's symbols.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, SYMBOLS = 200, 50, 3, b"#$%&*|"
BLOCK = 1 << 20
_SPREAD = 4096


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether the n bytes at a and at b are equal, a megabyte at a time."""
    out, upto, k = np.ones(len(n), bool), np.cumsum(n), 0
    while k < len(n):
        stop = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + BLOCK, "right")))
        if stop == k + 1:
            out[k] = np.array_equal(data[a[k] : a[k] + n[k]], data[b[k] : b[k] + n[k]])
        else:
            differ = data[ragged(a[k:stop], n[k:stop])] != data[ragged(b[k:stop], n[k:stop])]
            out[k:stop] = np.add.reduceat(differ, np.concatenate([[0], np.cumsum(n[k : stop - 1])])) == 0
        k = stop
    return out


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, hashes: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of distinct words of each row, and which words are the first of theirs."""
    order = np.lexsort((hashes, rows))
    s, n, r, h = starts[order], (ends - starts)[order], rows[order], hashes[order]
    alike = np.flatnonzero((h[1:] == h[:-1]) & (r[1:] == r[:-1]))
    same = n[alike] == n[alike + 1]
    same[same] = _same_bytes(data, s[alike[same]], s[alike[same] + 1], n[alike[same]])
    first = np.ones(len(order), bool)
    first[alike[same] + 1] = False
    counts = np.bincount(r[first], minlength=n_rows)
    for row in np.unique(r[alike[~same]]):  # two words with one hash: this row again, by its words
        at, seen = np.flatnonzero(r == row), {}
        for k in at:
            seen.setdefault(data[s[k] : s[k] + n[k]].tobytes(), k)
        first[at] = False
        first[list(seen.values())] = True
        counts[row] = len(seen)
    return counts, order[first]


def _blocks(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut behind the last white space of every BLOCK bytes; a longer word is a block by itself."""
    p = 0
    while p < len(data):
        q = min(p + BLOCK, len(data))
        gaps = np.flatnonzero(SPACE[data[p:q]]) if q < len(data) else np.zeros(0, np.int64)
        if len(gaps):
            q = p + int(gaps[-1]) + 1
        elif q < len(data):
            while q < len(data) and not len(gaps := np.flatnonzero(SPACE[data[q : q + BLOCK]])):
                q += BLOCK
            q = q + int(gaps[0]) if q < len(data) else len(data)
        yield p, q
        p = q


def _classes(data: np.ndarray, offsets: np.ndarray, symbols: bytes) -> list[np.ndarray]:
    """Capitals, symbols and code points of every row, by prefix sums."""
    listed = np.zeros(256, bool)
    listed[list(symbols)] = True
    sums = np.zeros(len(data) + 1, np.int64)
    out = []
    for inside in ((data >= 65) & (data <= 90), listed[data], (data & 0xC0) != 0x80):
        np.cumsum(inside, out=sums[1:])
        out.append(np.diff(sums[offsets]))
    return out


def measure(data: np.ndarray, offsets: np.ndarray, symbols: bytes = SYMBOLS) -> np.ndarray:
    """Words, distinct words, capitals, symbols and code points of every row: five arrays."""
    if len(offsets) > 2 or len(data) <= BLOCK:
        starts, ends, rows = words(data, offsets)
        hashes = Hasher(data).spans(starts, ends)
        distinct, _ = _distinct(data, starts, ends, rows, hashes, len(offsets) - 1)
        return np.stack([np.bincount(rows, minlength=len(offsets) - 1), distinct, *_classes(data, offsets, symbols)])
    total, found = np.zeros(3, np.int64), []
    n_words = 0
    for p, q in _blocks(data):
        block, ends_at = data[p:q], np.array([0, q - p])
        if q - p >= BLOCK and not SPACE[block].any():
            starts, ends, hashes = np.array([0]), ends_at[1:], np.frombuffer(blake2b(block.tobytes(), digest_size=8).digest(), np.uint64)
        else:
            starts, ends, rows = words(block, ends_at)
            hashes = Hasher(block).spans(starts, ends)
        n_words += len(starts)
        _, first = _distinct(block, starts, ends, np.zeros(len(starts), np.int64), hashes, 1)
        found.append((starts[first] + p, ends[first] + p, hashes[first]))
        for from_ in range(0, q - p, BLOCK):
            part = block[from_ : from_ + BLOCK]
            total += np.array([x[0] for x in _classes(part, np.array([0, len(part)]), symbols)])
    starts, ends, hashes = (np.concatenate(x) for x in zip(*found))
    distinct, _ = _distinct(data, starts, ends, np.zeros(len(starts), np.int64), hashes, 1)
    return np.stack([[n_words], distinct, *total[:, None]])


def masks(docs: DataFrame, min_words: int = MIN_WORDS, min_distinct: int = MIN_DISTINCT, max_capitals: int = MAX_CAPITALS, symbols: bytes = SYMBOLS) -> DataFrame:
    """doc_id, part, digest of the text, n_words, n_distinct, n_capitals, n_symbols, n_chars, and mask: the sum of
    1 (A), 2 (B), 4 (C) and 8 (D) of what the text fails by itself."""
    ship(docs.sparkSession)
    body = F.coalesce(F.col("text"), F.lit(""))
    given = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(body, 256)).alias("digest"), body.cast("binary").alias("body"))
    counted = ("n_words", "n_distinct", "n_capitals", "n_symbols", "n_chars")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, "body", BLOCK):
            got = measure(data, offsets, symbols)
            n, distinct, capitals, listed, points = got
            mask = (n < min_words) + 2 * (100 * distinct < min_distinct * n) + 4 * (100 * capitals > max_capitals * points) + 8 * (listed > 0)
            yield pa.record_batch([*(batch.column(i) for i in range(3)), *(pa.array(x.astype(np.int64)) for x in got), pa.array(mask.astype(np.int32))], names=["doc_id", "part", "digest", *counted, "mask"])

    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(scan, f"doc_id {kind}, part string, digest binary, {', '.join(f'{c} long' for c in counted)}, mask int")


def with_copies(found: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by what they fail, E (16) included, and how many of them are
    labelled good and toxic."""
    once = found.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("bad"))
    # rows without doc_id find no label; by themselves they would all be dealt to one task
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(_SPREAD))).otherwise(F.lit(0).cast("long"))
    labelled = once.withColumn("spread", spread).join(known.withColumn("spread", F.lit(0).cast("long")), ["doc_id", "spread"], "left")
    labelled = labelled.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "bad")})
    here = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    groups = labelled.groupBy("digest", "part", "mask", "good", "bad").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n")).otherwise(0)).alias("ordered"), F.min(here).alias("first"))
    least = F.min(F.col("first.doc_id")).over(Window.partitionBy("digest"))  # a digest's groups: parts times labels
    firsts = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = groups.withColumn("least", least).withColumn("again", F.when(F.col("first").isNull(), F.lit(0)).otherwise(F.col("ordered") - firsts))
    two = F.array(F.struct(F.col("mask"), (F.col("n") - F.col("again")).alias("n")), F.struct((F.col("mask") + 16).alias("mask"), F.col("again").alias("n")))
    each = split.select("part", "good", "bad", F.explode(two).alias("x")).select("part", "good", "bad", "x.mask", "x.n").filter("n > 0")
    return each.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("toxic"))


def _selectors() -> tuple[list[tuple[str, int]], dict[str, np.ndarray], np.ndarray]:
    """Every order and step; which masks (columns) each count of a step takes; each step's filter."""
    mask = np.arange(1 << len(FILTERS))
    steps, which, takes = [], [], {k: [] for k in ("kept", "removed", "redundant", "unique_fails")}
    for order in permutations(range(len(FILTERS))):
        gone = np.zeros(len(mask), bool)
        for k, f in enumerate(order):
            fails = (mask >> f & 1).astype(bool)
            for name, taken in (("kept", ~gone & ~fails), ("removed", ~gone & fails), ("redundant", gone & fails), ("unique_fails", mask == 1 << f)):
                takes[name].append(taken)
            gone = gone | fails
            steps.append(("".join(FILTERS[i] for i in order), k + 1))
            which.append(f)
    return steps, {k: np.array(v, np.int64) for k, v in takes.items()}, np.array(which)


def audit(counted: DataFrame) -> DataFrame:
    """One row per part, order and step of what with_copies() gives."""
    per_part = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("rows"))  # 32 at most
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, takes, which = _selectors()
        for batch in batches:
            for part, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.zeros((3, 1 << len(FILTERS)), np.int64)
                for x in rows:
                    counts[:, x["mask"]] = x["n"], x["good"], x["toxic"]
                got = {k: v @ counts[0] for k, v in takes.items()}
                got |= {"good_lost": takes["removed"] @ counts[1], "toxic_lost": takes["removed"] @ counts[2]}
                got["shapley"] = np.array([got["removed"][which == f].sum() for f in range(len(FILTERS))])[which]
                yield pa.record_batch([pa.array([part] * len(steps)), pa.array([s[0] for s in steps]), pa.array(np.array([s[1] for s in steps], np.int32)), *(pa.array(got[c]) for c in names)], names=["part", "filter_order", "step", *names])

    return per_part.mapInArrow(reduce, f"part string, filter_order string, step int, {', '.join(f'{c} long' for c in names)}")


def filter_interactions(docs: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    """The audit of documents (doc_id, text, lang) with labels (doc_id, quality, toxic); limits as in masks()."""
    return audit(with_copies(masks(docs, **limits), labels))


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_interactions(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
    (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT filter_order, i::INT AS step, bits[i] AS bit, list_sum(bits[1:i]) - bits[i] AS before FROM o, range(1, 6) r(i)),
x AS (SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (before + bit) = 0), 0) AS kept, coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0) AS redundant, coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS good_lost, coalesce(sum(bad) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM x
"""
