"""Suffix-array dedup: every later copy of a `LENGTH`-byte string is removed from the texts.

Suffixes are sorted one bucket at a time, in blocks that one task holds:

1. Equal texts are one text; later copies of a whole text need no sorting.
2. A window of `LENGTH` bytes belongs to the bucket of the least hash among its `GRAM`-byte strings,
   a property of its bytes alone, so equal windows meet. Neighbouring windows mostly share that
   string; such a run is a segment. A segment whose bucket name occurs once in the corpus can hold
   no repeat; the names are counted first (12 bytes a segment), and only texts with repeated names
   go on, and of them only those segments.
3. In a bucket, equal segments are one. The suffixes at all window starts of the rest are sorted by
   their first `PERIOD` bytes; ties are settled by ranks of a difference cover: positions whose
   residue modulo `PERIOD` is in the cover are ranked first, by doubling, to more than `LENGTH`
   bytes, and for any two suffixes some offset below `PERIOD` brings both to ranked positions.
   Ties are split around pivots, all groups at once. Neighbours in the order that agree in `LENGTH`
   bytes are compared byte by byte; so windows are equal by content and not by hash alone.
4. Of equal windows the first, by (doc_id, start), stays; the bytes of the others go.

A passage in a third of all texts is pre-aggregated: a batch sends each distinct segment once and
marks its other occurrences at once. There are so many buckets that one gets `BUCKET_BYTES` of text on
average, and several per task of a shuffle at least.

Defined results: null and empty texts have no bytes; texts below `LENGTH` bytes lose nothing; rows
that repeat doc_id and text are one document, each returned; different texts under one doc_id are
ordered by digest; rows without doc_id come before all others; an empty table gives an empty one;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._tables import materialize, read, ship, shuffle_width, whole_texts
from tessera.llm._text import U64, Hasher, mix, pieces, ragged

LENGTH = 100
GRAM = 40
PERIOD = 16
BUCKET_BYTES = 16 << 20


def difference_cover(period: int) -> list[int]:
    """The least residues, found greedily from 0 and 1 by depth-first search, whose differences
    give every residue modulo period."""
    full = set(range(period))
    for size in range(2, period + 1):
        stack = [(0, 1)]
        while stack:
            cover = stack.pop()
            if len(cover) == size:
                if {(a - b) % period for a in cover for b in cover} == full:
                    return list(cover)
                continue
            stack.extend((*cover, k) for k in range(period - 1, cover[-1], -1))
    return list(full)


_COVER = difference_cover(PERIOD)
_IN_COVER = np.isin(np.arange(PERIOD), _COVER)
#: For two residues, the least offset that takes both into the cover.
_OFFSET = np.array([[next(k for k in range(PERIOD) if _IN_COVER[(a + k) % PERIOD] and _IN_COVER[(b + k) % PERIOD]) for b in range(PERIOD)] for a in range(PERIOD)], np.int64)


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every `width` neighbours, by prefix and suffix minima of blocks."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one bucket name: row, first window (position in data), windows, name,
    and whether windows inside the run may repeat (their least string occurs twice in it)."""
    gram = min(GRAM, length)
    width = length - gram + 1  # at most 64: positions in a window have different residues
    hashes = Hasher(data).every(gram)
    residue = np.arange(len(hashes), dtype=U64) & U64(63)
    least = sliding_least(hashes & ~U64(63) | residue, width)
    other = sliding_least(hashes & ~U64(63) | (U64(63) - residue), width)
    twice = (least ^ other) & U64(63) != U64(63)
    windows = np.maximum(np.diff(offsets) - length + 1, 0)
    at = ragged(offsets[:-1], windows)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, U64), np.zeros(0, bool)
    name = (least >> U64(6))[at]
    new = np.ones(len(at), bool)
    new[1:] = (name[1:] != name[:-1]) | (at[1:] != at[:-1] + 1)
    new[(np.cumsum(windows) - windows)[windows > 0]] = True
    first = np.flatnonzero(new)
    row = np.searchsorted(offsets, at[first], "right") - 1
    count = np.diff(np.append(first, len(at)))
    own = np.logical_or.reduceat(twice[at], first) | (count > width)
    return row, at[first], count, mix(name[first]), own


def _words_at_every_byte(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a big-endian number."""
    out = np.zeros(len(data) - 7, U64)
    for k in range(8):
        out |= data[k : len(data) - 7 + k].astype(U64) << U64(56 - 8 * k)
    return out


def _dense(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Ranks of (high, low), equal for equal pairs."""
    order = np.lexsort((low, high))
    h, w = high[order], low[order]
    step = np.zeros(len(order), np.int64)
    step[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(step)
    return out


def sorted_windows(data: np.ndarray, at: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The window starts `at` in suffix order, and for each whether it differs from the one before
    within `length` bytes. data must end in at least 2 * length + 3 * PERIOD zero bytes."""
    word = _words_at_every_byte(data)
    # ranks of the cover's positions, to at least `length` + PERIOD bytes
    reach = len(word) - PERIOD
    sample = np.flatnonzero(_IN_COVER[np.arange(reach) % PERIOD])
    rank = np.zeros(len(data) + length + 8 * PERIOD, np.int64)
    rank[sample] = _dense(word[sample], word[sample + 8]) + 1
    depth = PERIOD
    while depth < length + PERIOD:
        ahead = rank[sample + depth]
        fresh = _dense(rank[sample], ahead) + 1
        rank[sample] = fresh
        depth *= 2
    a, b = word[at], word[at + 8]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    tie = np.zeros(len(order), bool)
    tie[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    group = np.cumsum(~tie) - 1
    at = at[order]
    slots = np.arange(len(at))
    while True:  # split every open group around its middle member by the ranks of the cover
        size = np.bincount(group, minlength=int(group[-1]) + 1 if len(group) else 1)
        open_ = size[group] > 1
        slots, group = slots[open_], group[open_]
        if not len(slots):
            break
        start = np.flatnonzero(np.diff(group, prepend=-1))
        count = np.diff(np.append(start, len(group)))
        here = at[slots]
        pivot = np.repeat(here[start + count // 2], count)
        k = _OFFSET[here % PERIOD, pivot % PERIOD]
        side = np.sign(rank[here + k] - rank[pivot + k]) + 1
        key = np.repeat(np.arange(len(start)), count) * 3 + side
        by = np.argsort(key, kind="stable")
        at[slots] = here[by]
        key = key[by]
        unsettled = key % 3 != 1
        slots = slots[unsettled]
        group = np.cumsum(np.diff(key[unsettled], prepend=-1) != 0) - 1
    fresh = np.ones(len(at), bool)
    if len(at) > 1:
        left, right = at[:-1], at[1:]
        same = np.ones(len(left), bool)
        for k in [*range(0, length - 8, 8), length - 8]:
            some = np.flatnonzero(same)
            same[some] = word[left[some] + k] == word[right[some] + k]
        fresh[1:] = ~same
    return at, fresh


def later_windows(data: np.ndarray, start: np.ndarray, windows: np.ndarray, doc: np.ndarray, tie: np.ndarray, place: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For segments (start in data, windows, and doc, tie, place that order them) whether each
    window, segment by segment, equals an earlier one."""
    at = ragged(start, windows)
    owner = np.repeat(np.arange(len(start)), windows)
    nth = np.argsort(at, kind="stable")
    ordered, fresh = sorted_windows(data, at, length)
    back = nth[np.searchsorted(at[nth], ordered)]  # window numbers in suffix order
    seg = owner[back]
    position = place[seg] + ordered - start[seg]
    group = np.cumsum(fresh) - 1
    by = np.lexsort((position, tie[seg], doc[seg], group))
    first = np.ones(len(by), bool)
    first[1:] = group[by][1:] != group[by][:-1]
    later = np.ones(len(by), bool)
    later[back[by[first]]] = False
    return later


def _runs(flag: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of set flags inside segments: segment, first window in it, end."""
    edge = np.zeros(len(flag) + 1, bool)
    edge[np.concatenate([[0], np.cumsum(windows)])] = True
    before = np.concatenate([[False], flag[:-1]])
    begin = np.flatnonzero(flag & (~before | edge[:-1]))
    after = np.concatenate([flag[1:], [False]])
    end = np.flatnonzero(flag & (~after | edge[1:])) + 1
    seg = np.searchsorted(np.cumsum(windows), begin, "right")
    base = (np.cumsum(windows) - windows)[seg]
    return seg, begin - base, end - base


_KEY = "doc long, tie long"


def _digest(body: bytes) -> bytes:
    return hashlib.sha256(body).digest()[:16]


def _repeated_names(docs: DataFrame, buckets: int) -> DataFrame:
    """text_id and names: the bucket names in each text that occur elsewhere, or twice in it."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, "body", 2 << 20):
            ids = [_digest(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            first = {t: i for i, t in reversed(list(enumerate(ids)))}
            row, _, _, name, own = segments(data, offsets)
            keep = np.isin(row, list(first.values()))
            row, name = np.concatenate([row[keep], row[keep & own]]), np.concatenate([name[keep], name[keep & own]])
            bucket = ((name >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            row, name, edge = row[order], name[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
            out: dict[str, list] = {"bucket": [], "names": [], "at": [], "texts": []}
            for b in np.flatnonzero(np.diff(edge)).tolist():
                local, at = np.unique(row[edge[b] : edge[b + 1]], return_inverse=True)
                out["bucket"].append(b)
                out["names"].append(name[edge[b] : edge[b + 1]].tobytes())
                out["at"].append(at.astype(np.uint16 if len(local) < 1 << 16 else np.uint32).tobytes())
                out["texts"].append(b"".join(ids[i] for i in local.tolist()))
            yield pa.RecordBatch.from_arrays([pa.array(out["bucket"], pa.int32()), *(pa.array(out[k], pa.binary()) for k in ("names", "at", "texts"))], ["bucket", "names", "at", "texts"])

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        names, owners, texts, seen = [], [], [], {}
        for n, a, t in zip(rows["names"], rows["at"], rows["texts"]):
            local = [t[i : i + 16] for i in range(0, len(t), 16)]
            at = np.frombuffer(a, np.uint16 if len(local) < 1 << 16 else np.uint32)
            number = np.array([-1 if x in seen else seen.setdefault(x, len(seen)) for x in local], np.int64)
            new = number[at] >= 0
            names.append(np.frombuffer(n, U64)[new])
            owners.append(number[at][new])
            texts += [x for x, k in zip(local, number.tolist()) if k >= 0]
        name, owner = np.concatenate(names), np.concatenate(owners)
        _, inverse, times = np.unique(name, return_inverse=True, return_counts=True)
        more = times[inverse] > 1
        name, owner = name[more], owner[more]
        order = np.argsort(owner, kind="stable")
        name, owner = name[order], owner[order]
        begin = np.flatnonzero(np.diff(owner, prepend=-1))
        end = np.append(begin[1:], len(owner))
        return pd.DataFrame({"text_id": [texts[owner[a]] for a in begin], "names": [name[a:b].tobytes() for a, b in zip(begin, end)]})

    found = whole_texts(docs).mapInArrow(emit, "bucket int, names binary, at binary, texts binary").groupBy("bucket").applyInPandas(count, "text_id binary, names binary")
    return found.groupBy("text_id").agg(F.collect_list("names").alias("names"))


_SEGMENTS = "bucket int, doc binary, tie binary, place binary, windows binary, bytes binary"


def _candidates(texts: DataFrame, buckets: int) -> DataFrame:
    """Segments with repeated names by bucket. Bucket -1 holds later occurrences, inside one batch,
    of a segment that the batch sends once; they need no bytes."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, "body", 2 << 20):
            doc = np.asarray(batch.column(0))
            ids, named = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            body = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
            mine = np.array([_digest(x) == i for x, i in zip(body, ids)])
            tie = np.array([int.from_bytes(i[:8], "big") >> 1 for i in ids], np.int64)
            row, at, windows, name, _ = segments(data, offsets)
            edge = np.searchsorted(row, np.arange(len(ids) + 1))
            keep = np.zeros(len(row), bool)
            for i in np.flatnonzero(mine).tolist():
                a, b = edge[i], edge[i + 1]
                keep[a:b] = np.isin(name[a:b], np.frombuffer(b"".join(named[i]), U64))
            row, at, windows, name = row[keep], at[keep], windows[keep], name[keep]
            place = at - offsets[row]
            order = np.lexsort((place, tie[row], doc[row]))
            row, at, windows, name, place = row[order], at[order], windows[order], name[order], place[order]
            raw = data.tobytes()
            text = [raw[a : a + n + LENGTH - 1] for a, n in zip(at.tolist(), windows.tolist())]
            seen: set[bytes] = set()
            again = np.array([x in seen or bool(seen.add(x)) for x in text], bool)
            bucket = np.where(again, -1, ((name >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64))
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-2))
            out: list[tuple] = []
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
                o = order[a:b]
                out.append((int(bucket[o[0]]), doc[row[o]].astype(np.int64).tobytes(), tie[row[o]].tobytes(), place[o].astype(np.int64).tobytes(), windows[o].astype(np.int32).tobytes(), b"" if bucket[o[0]] < 0 else b"".join(text[i] for i in o.tolist())))
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["bucket", "doc", "tie", "place", "windows", "bytes"])

    return texts.mapInArrow(emit, _SEGMENTS)


def _later_runs(found: DataFrame) -> DataFrame:
    """doc, tie, start, stop: runs of windows that occur earlier."""

    def sort_bucket(rows: pd.DataFrame) -> pd.DataFrame:
        load = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in rows[c]])
        doc, tie, place, windows = load("doc", np.int64), load("tie", np.int64), load("place", np.int64), load("windows", np.int32).astype(np.int64)
        raw = b"".join(rows["bytes"])
        size = windows + LENGTH - 1
        begin = np.cumsum(size) - size
        order = np.lexsort((place, tie, doc))
        firsts: dict[bytes, int] = {}
        again = np.zeros(len(doc), bool)
        for i in order.tolist():  # the first of equal segments stands for all
            again[i] = firsts.setdefault(raw[begin[i] : begin[i] + size[i]], i) != i
        data = np.frombuffer(b"".join(firsts.keys()) + bytes(2 * LENGTH + 4 * PERIOD), np.uint8)
        rep = np.array(list(firsts.values()), np.int64)
        start = np.cumsum(size[rep]) - size[rep]
        flag = later_windows(data, start, windows[rep], doc[rep], tie[rep], place[rep])
        seg, a, b = _runs(flag, windows[rep])
        seg, rest = rep[seg], np.flatnonzero(again)
        who = np.concatenate([seg, rest])
        return pd.DataFrame({"doc": doc[who], "tie": tie[who], "start": np.concatenate([place[seg] + a, place[rest]]), "stop": np.concatenate([place[seg] + b, place[rest] + windows[rest]])})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                place = np.frombuffer(r["place"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(r["doc"], np.int64)), pa.array(np.frombuffer(r["tie"], np.int64)), pa.array(place), pa.array(place + np.frombuffer(r["windows"], np.int32))], ["doc", "tie", "start", "stop"])

    runs = f"{_KEY}, start long, stop long"
    sorted_ = found.filter("bucket >= 0").groupBy("bucket").applyInPandas(sort_bucket, runs)
    return sorted_.unionByName(found.filter("bucket < 0").mapInArrow(unpack, runs))


def _text_id(body: Column) -> Column:
    return F.unhex(F.substring(F.sha2(body, 256), 1, 32))


def _tie(text_id: Column) -> Column:
    """The first 63 bits of a text's digest: orders the texts of one doc_id."""
    part = lambda k: F.conv(F.hex(F.substring(text_id, k, 4)), 16, 10).cast("long")
    return F.shiftleft(part(1), 31).bitwiseOR(F.shiftright(part(5), 1))


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, kept (the bytes that stay), n_bytes, n_removed, n_spans for every row of docs."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("doc_id", F.lit(-(1 << 63))).cast("long").alias("doc"), "text")
    body = F.coalesce("text", F.lit("")).cast("binary")
    known = docs.select("doc", _text_id(body).alias("text_id"), F.octet_length(body).alias("size")).filter(F.col("size") >= LENGTH)
    known = materialize(known, "texts")
    # a task holds a bucket, so their number follows the bytes that are dealt
    buckets = max(8 * shuffle_width(spark), (known.agg(F.sum("size")).first()[0] or 0) // BUCKET_BYTES)
    known = known.select("doc", "text_id")
    firsts = materialize(known.groupBy("text_id").agg(F.min("doc").alias("first")), "first-texts")
    names = _repeated_names(docs.select("text"), buckets)
    wanted = materialize(names.join(firsts, "text_id").select(F.col("first").alias("doc"), "text_id", "names"), "repeated-names")
    # by document and text: rows without doc_id are as many documents as they have texts
    texts = docs.select("doc", _text_id(body).alias("text_id"), "text").join(wanted, ["doc", "text_id"])
    found = materialize(_candidates(whole_texts(texts, "doc", "text_id", "names"), buckets), "segments")
    runs = _later_runs(found).groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    copies = known.join(firsts, "text_id").filter(F.col("doc") > F.col("first")).select("doc", _tie(F.col("text_id")).alias("tie"))
    copies = copies.groupBy("doc", "tie").agg(F.lit(True).alias("copy"))
    state = materialize(runs.join(copies, ["doc", "tie"], "full"), "removals")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, "body"):
            rows = []
            for i, (copy, mine) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                body = data[offsets[i] : offsets[i + 1]]
                removed = spans = 0
                if copy:
                    removed, spans, body = len(body), 1, body[:0]
                elif mine:
                    step = np.zeros(len(body) + 1, np.int64)
                    np.add.at(step, [r["start"] for r in mine], 1)
                    np.add.at(step, [r["stop"] + LENGTH - 1 for r in mine], -1)
                    gone = np.cumsum(step[:-1]) > 0
                    removed, spans = int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
                    body = body[~gone]
                rows.append((int(offsets[i + 1] - offsets[i]), removed, spans, body.tobytes()))
            n, removed, spans, kept = zip(*rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    joined = docs.withColumn("tie", _tie(_text_id(body))).join(state, ["doc", "tie"], "left")
    return whole_texts(joined, "doc_id", "copy", "runs").mapInArrow(cut, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def op4_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    out = suffix_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
